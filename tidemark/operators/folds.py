"""Cross-validation folds that keep a device's rows together.

Stratified groups are sorted and dealt out in turn, so a fold is a number modulo k, and the sort key
says what the dealing balances; or they are placed so that the folds' shares of each label are alike.
Plain groups go to the fold with the fewest rows. A seeded digest of
the group stands in for shuffling.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from heapq import heapify, heapreplace
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import GROUP_LABELS, SEED
from tidemark.operators.ordering import numbered
from tidemark.session import small_side, stage

GROUP = "installation_id"


def shuffled(group: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(group).cast("string"), F.lit(f":{seed}")))


def label_counts(
    df: DataFrame, group: str, label: str, labels: Iterable[int] = GROUP_LABELS
) -> DataFrame:
    """Rows of each label per group, and how unevenly the group's labels are spread."""
    names = [f"label_{k}" for k in labels]
    counts = df.groupBy(group).agg(
        *[F.count_if(F.col(label) == k).alias(name) for k, name in zip(labels, names, strict=True)]
    )
    mean = sum((F.col(c) for c in names), F.lit(0)) / len(names)
    squares = sum(((F.col(c) - mean) * (F.col(c) - mean) for c in names), F.lit(0.0))
    return counts.withColumn("spread", F.sqrt(squares / len(names)))


def _numbered_groups(
    df: DataFrame, group: str, label: str, labels: Sequence[int], seed: int, within: str | None
) -> tuple[DataFrame, list[str]]:
    """Groups with their label counts, numbered so that those with equal counts are neighbours, the
    most unevenly spread ones first; and the names of the counts."""
    rows = df.withColumn("_outer", F.col(within)) if within else df.withColumn("_outer", F.lit(0))
    placed = rows.select(group, "_outer").distinct()
    names = [f"label_{x}" for x in labels]
    counts = label_counts(df, group, label, labels).join(placed, group)
    order = ["_outer", F.desc("spread"), *names, "_shuffle", group]
    return numbered(counts.withColumn("_shuffle", shuffled(group, seed)), order, "_number"), names


def stratified_folds(
    df: DataFrame,
    k: int,
    group: str = GROUP,
    label: str = "accuracy_group",
    labels: Sequence[int] = GROUP_LABELS,
    seed: int = SEED,
    within: str | None = None,
    name: str = "fold",
) -> DataFrame:
    """One fold per group; groups with equal label counts are spread evenly over the folds.

    `within` names a column (say, an outer fold) inside which the dealing starts anew.
    """
    outer = [within] if within else []
    dealt, names = _numbered_groups(df, group, label, labels, seed, within)
    first = dealt.groupBy("_outer").agg(F.min("_number").alias("_first"))
    fold = F.pmod(F.col("_number") - F.col("_first"), F.lit(k)).cast("int")
    folds = dealt.join(F.broadcast(first), "_outer").withColumn(name, fold)
    return folds.select(group, *[F.col("_outer").alias(c) for c in outer], *names, name)


def unevenness(counts: np.ndarray) -> np.ndarray:
    """The mean over labels of the deviation, over folds, of the folds' shares of a label.

    `counts` is (..., folds, labels); a label that has no rows counts as evenly spread.
    """
    shares = counts / np.maximum(counts.sum(axis=-2, keepdims=True), 1)
    return shares.std(axis=-2).mean(axis=-1)


_GAIN = 1e-12  # less is rounding
_NEAR = 16  # signatures after one that its groups are exchanged with


def _levelled(signatures: np.ndarray, groups: np.ndarray, k: int) -> np.ndarray:
    """How many groups of each signature (label counts of a group) each of k folds gets.

    Every fold gets the same number of them but for a remainder of less than k groups: those go,
    signature by signature, where shares become most alike. Then a group is moved to another fold,
    or exchanged for one of the next signatures, as long as that makes shares more alike.
    """
    parts = signatures / np.maximum((signatures * groups[:, None]).sum(axis=0), 1)
    shares = np.zeros((k, signatures.shape[1]))
    counts = np.repeat(groups[:, None] // k, k, axis=1)
    one = np.eye(k)
    for i, part in enumerate(parts):
        for _ in range(groups[i] % k):
            to = np.argmin((shares + one[:, :, None] * part).std(axis=1).mean(axis=1))
            counts[i, to] += 1
            shares[to] += part
    moves = one[None, :, :, None] - one[:, None, :, None]  # (from, to, fold, 1)
    now, before = shares.std(axis=0).mean(), np.inf
    while now < before - _GAIN:
        before = now
        for i, part in enumerate(parts):
            # nothing comes back, or a group of one of the next signatures
            back = np.vstack([np.zeros_like(part), parts[i + 1 : i + 1 + _NEAR]])
            there = np.vstack([np.ones(k, dtype=np.int64), counts[i + 1 : i + 1 + _NEAR]])
            allowed = (counts[i] > 0)[None, :, None] & (there > 0)[:, None, :]
            tried = (shares + moves * (part - back)[:, None, None, None, :]).std(axis=3).mean(axis=3)
            tried = np.where(allowed, tried, np.inf)
            j, at, to = np.unravel_index(np.argmin(tried), tried.shape)
            if tried[j, at, to] < now - _GAIN:
                counts[i, at] -= 1
                counts[i, to] += 1
                if j:
                    counts[i + j, to] -= 1
                    counts[i + j, at] += 1
                shares += moves[at, to] * (part - back[j])
                now = shares.std(axis=0).mean()
    return counts


def balanced_folds(
    df: DataFrame,
    k: int,
    group: str = GROUP,
    label: str = "accuracy_group",
    labels: Sequence[int] = GROUP_LABELS,
    seed: int = SEED,
    within: str | None = None,
    name: str = "fold",
) -> DataFrame:
    """One fold per group, so that every fold has about the same share of each label's rows.

    Groups with equal label counts are interchangeable: how many of them each fold gets is settled
    on the driver, over the distinct label counts (a few numbers each, however many groups have
    them), and which ones by a seeded digest, in one numbering of all groups. `within` names a
    column (say, an outer fold) inside which this is done anew.
    """
    outer = [within] if within else []
    dealt, names = _numbered_groups(df, group, label, labels, seed, within)
    dealt = stage(dealt.select(group, "_outer", "spread", *names, "_number"), "numbered")
    found = dealt.groupBy("_outer", *names).agg(F.count("*").alias("groups"), F.min("_number").alias("first"))
    rows = sorted(found.collect(), key=lambda r: r["first"])
    plan = []
    for part in dict.fromkeys(r["_outer"] for r in rows):
        own = [r for r in rows if r["_outer"] == part]
        signatures = np.array([[r[c] for c in names] for r in own], dtype=np.float64)
        counts = _levelled(signatures, np.array([r["groups"] for r in own]), k)
        for row, upto in zip(own, counts.cumsum(axis=1), strict=True):
            plan.append((row["first"], row["groups"], [row["first"] + int(n) for n in upto]))
    ends = df.sparkSession.createDataFrame(plan, "_first long, _groups long, _upto array<long>")
    firsts = found.select("_outer", *names, F.col("first").alias("_first"))
    placed = dealt.join(small_side(firsts.join(ends, "_first")), ["_outer", *names])
    fold = F.size(F.filter("_upto", lambda end: end <= F.col("_number"))).alias(name)
    return placed.select(group, *[F.col("_outer").alias(c) for c in outer], *names, fold)


def _dealt(loads: list[int], size: int, groups: int) -> list[int]:
    """How many of `groups` groups of one size each load gets, if each goes to the least of them.

    What the heap would do one by one: raise the lowest loads to a common level, then deal the rest
    in order of (load, number).
    """
    counts = [0] * len(loads)
    # the level up to which every load could be raised: at most `groups` steps below it
    low, high = min(loads), max(loads) + size * groups
    while low < high:
        level = (low + high + 1) // 2
        if sum(max(0, -(-(level - x) // size)) for x in loads) <= groups:
            low = level
        else:
            high = level - 1
    for i, x in enumerate(loads):
        counts[i] = max(0, -(-(low - x) // size))
    heap = [(x + size * c, i) for i, (x, c) in enumerate(zip(loads, counts, strict=True))]
    heapify(heap)
    for _ in range(groups - sum(counts)):  # fewer than there are loads
        load, i = heap[0]
        heapreplace(heap, (load + size, i))
        counts[i] += 1
    for i, c in enumerate(counts):
        loads[i] += size * c
    return counts


def group_folds(df: DataFrame, k: int, group: str = GROUP, seed: int = SEED) -> DataFrame:
    """One fold per group: from the largest group down, each goes to the fold with the fewest rows.

    Groups of one size are interchangeable: how many of them each fold gets is settled on the
    driver, for the distinct sizes (their number is at most the square root of twice the number of
    rows), and which ones by a seeded digest, in one numbering of all groups.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("size"))
    dealt = numbered(
        sizes.withColumn("_shuffle", shuffled(group, seed)),
        [F.desc("size"), "_shuffle", group],
        "_number",
    )
    dealt = stage(dealt.select(group, "size", "_number"), "numbered")
    found = dealt.groupBy("size").agg(F.count("*").alias("groups"), F.min("_number").alias("first"))
    loads, plan = [0] * k, []
    for row in sorted(found.collect(), key=lambda r: -r["size"]):
        upto = list(accumulate(_dealt(loads, row["size"], row["groups"])))
        plan.append((row["size"], [row["first"] + n for n in upto]))
    plan = df.sparkSession.createDataFrame(plan, "size long, _upto array<long>")
    fold = F.size(F.filter("_upto", lambda end: end <= F.col("_number")))
    return dealt.join(small_side(plan), "size").select(group, "size", fold.alias("fold"))


def with_fold(df: DataFrame, folds: DataFrame, group: str = GROUP) -> DataFrame:
    return df.join(folds.select(group, "fold"), group)


def split(df: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training rows (every other fold) and held-out rows."""
    return df.filter(F.col("fold") != fold), df.filter(F.col("fold") == fold)
