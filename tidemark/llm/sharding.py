"""Sharding by longest processing time: the largest group goes to the least-loaded shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of
from tidemark.operators.ordering import numbered
from tidemark.session import stage


def _dealt(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` equal groups each shard gets, one by one to the least-loaded (then the
    first) shard; the loads are brought up to date."""
    given = [0] * len(loads)
    if count > 4 * len(loads):
        # Below `level`, a shard takes a group as long as its load is under it: all of these come
        # before any taken at `level` or above. The largest level that `count` can pay for:
        low, high = min(loads), max(loads) + size * (count // len(loads) + 1)
        while low < high:
            level = (low + high + 1) // 2
            if sum(max(0, -(-(level - x) // size)) for x in loads) <= count:
                low = level
            else:
                high = level - 1
        given = [max(0, -(-(low - x) // size)) for x in loads]
        for i, n in enumerate(given):
            loads[i] += n * size
        count -= sum(given)
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(count):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
        given[i] += 1
        loads[i] += size
    return given


def schedule(sizes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """For (size, number of groups), largest size first: (size, groups of that size per shard).

    Exactly what a heap over single groups gives, as groups of one size are interchangeable.
    """
    loads = [0] * shards
    for size, count in sizes:
        yield size, _dealt(loads, size, count)


def shard(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, size, text_crc32, group, shard, slot): a row for each row of `docs`.

    A document's size is its UTF-8 bytes plus one; equal texts are one group (a null text equals
    an empty one) and stay together. Groups sorted by size, largest first, go to the least-loaded
    shard. So shards are as near to each other as the groups allow; a group larger than a shard's
    part makes its shard the larger. `slot` counts a shard's documents from 0.

    The heap sees (size, number of groups) only. Distinct sizes that sum to T number fewer than
    sqrt(2 T): 14 million for 100 TB if every one occurred, and they are all that the driver reads.
    Which groups of one size go where is settled by a numbering that is sorted across partitions.
    Repeated rows, null ids and null texts are documents like any other.
    """
    narrow = stage(
        texts_of(docs, id_col, text_col)
        .withColumn("text", F.coalesce("text", F.lit("")))
        .select(
            "doc_id",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("group"),
        ),
        "sizes",
    )
    groups = narrow.groupBy("group").agg(F.sum("size").alias("group_size"), F.count("*").alias("copies"))
    ranked = stage(numbered(groups, [F.desc("group_size"), "group"], "rank"), "ranked")
    sizes = (
        ranked.groupBy("group_size")
        .agg(F.count("*").alias("n"), F.min("rank").alias("from"))
        .orderBy(F.desc("group_size"))
        .collect()
    )
    # Rank by rank, a size's groups fill one shard after another.
    starts = np.array([row["from"] for row in sizes], dtype=np.int64)
    ends = [
        (row["group_size"], start, np.cumsum(given).tolist())
        for row, start, (_, given) in zip(
            sizes, starts.tolist(), schedule(((r["group_size"], r["n"]) for r in sizes), shards), strict=True
        )
    ]
    plan = docs.sparkSession.createDataFrame(ends, "group_size long, start long, ends array<long>")
    nth = F.col("rank") - F.col("start")
    placed = ranked.join(plan, "group_size").select(
        "group",
        "copies",
        F.size(F.filter("ends", lambda end: end <= nth)).cast("int").alias("shard"),
    )
    return _slots(narrow.join(placed, "group"))


def _slots(placed: DataFrame) -> DataFrame:
    """Slots from one sort over all shards: a document's number, less that of its shard's first."""
    order = ["shard", "group", "doc_id"]
    in_order = stage(numbered(placed, order, "number"), "in-order")
    firsts = in_order.groupBy("shard").agg(F.min("number").alias("first"))
    return in_order.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lower(F.hex("group")).alias("group"),
        "shard",
        (F.col("number") - F.col("first")).alias("slot"),
    )
