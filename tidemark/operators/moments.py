"""Count, total, mean and spread of all that is visible at a position, for groups of any size.

A state is (n, total, centre, shift, m2): how many values, their sum, one of the values, the sum of
their distances from it, and the sum of squared distances from their mean. States merge by adding
n, total and m2, and n1 n2 / (n1 + n2) times the squared distance of the means; every term is
positive and every distance is taken from a value the state holds, so nothing cancels, wherever the
values lie and however they drift.

A value that stays is a running merge: over the positions of a chunk, and over the chunks before. A
value that is visible only up to some position belongs to a few aligned stretches of positions, of
lengths that are powers of two; a position looks up the one stretch of each length that holds it. A
value that is replaced is thus never subtracted, which would leave its rounding behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

STATE = ("n", "total", "centre", "shift", "m2")


def _states(items: DataFrame, keys: Sequence[str], *finer: str) -> DataFrame:
    """One state for each group of `keys` and `finer`; `items` has `centre`, one for each group of
    `keys`, and need not hold it in each of the finer ones."""
    off = F.col("value") - F.col("centre")
    n = F.count("*")
    return items.groupBy(*keys, "centre", *finer).agg(
        n.alias("n"), F.sum("value").alias("total"), F.sum(off).alias("shift"), (F.var_pop(off) * n).alias("m2")
    )


def _grown(mean: Column, before_n: Column, before_mean: Column) -> Column:
    """What a state adds to the spread of those before it."""
    n = F.col("n")
    apart = mean - before_mean
    merged = F.col("m2") + apart * apart * n * before_n / (n + before_n)
    return F.when(n == 0, 0.0).when(before_n == 0, F.col("m2")).otherwise(merged)


def _none(**kinds: str) -> list[Column]:
    return [F.lit(None if c == "centre" else 0).cast(kind).alias(c) for c, kind in kinds.items()]


_KINDS = {"n": "bigint", "total": "double", "centre": "double", "shift": "double", "m2": "double"}


def _running(states: DataFrame, asked: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The state of all that stands before each asked place, where that is anything.

    states: keys, `at`, a state each; all distances are from one value of the first of them. asked:
    keys, `at`. Both have one row for each (keys, at).
    """
    asks = asked.select(*keys, at, *_none(**_KINDS), F.lit(True).alias("asks"))
    rows = (
        states.select(*keys, at, *STATE, F.lit(False).alias("asks"))
        .unionByName(asks)
        .groupBy(*keys, at)
        .agg(*[(F.max if c == "centre" else F.sum)(c).alias(c) for c in STATE], F.max("asks").alias("asks"))
    )
    before = W.partitionBy(*keys).orderBy(at).rowsBetween(W.unboundedPreceding, -1)

    def so_far(c: str) -> Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0)).cast(_KINDS[c])

    met = rows.select(
        *keys,
        at,
        "asks",
        "n",
        "m2",
        (F.col("shift") / F.nullif("n", F.lit(0))).alias("mean"),
        *[so_far(c).alias(f"before_{c}") for c in ("n", "total", "shift")],
        F.max("centre").over(before).alias("before_centre"),
    )
    before_mean = F.col("before_shift") / F.nullif("before_n", F.lit(0))
    grown = met.withColumn("m2", _grown(F.col("mean"), F.col("before_n"), before_mean))
    return (
        grown.withColumn("before_m2", so_far("m2"))
        .where("asks AND before_n > 0")
        .select(*keys, at, *[F.col(f"before_{c}").alias(c) for c in STATE])
    )


def _lasting(items: DataFrame, asked: DataFrame, keys: list[str], pos: str, chunk: int | None) -> list[DataFrame]:
    """States of the values that stay, as seen from each asked position: those of its own chunk,
    and those of the chunks before."""
    if not chunk:
        first = F.min(F.struct(pos, "value")).over(W.partitionBy(*keys))
        centred = items.withColumn("centre", first["value"])
        return [_running(_states(centred, keys, pos), asked, keys, pos)]
    inner = [*keys, "chunk"]
    items = items.withColumn("chunk", F.floor(F.col(pos) / chunk))
    asked = asked.withColumn("chunk", F.floor(F.col(pos) / chunk))
    first = items.groupBy(*inner).agg(F.min(F.struct(pos, "value")).alias("first"))
    centred = stage(items.join(first.select(*inner, F.col("first.value").alias("centre")), inner), "centred")
    within = _running(_states(centred, inner, pos), asked, inner, pos)
    # chunks, all measured from the first value of the first one
    chunks = _states(centred, inner)
    upto = W.partitionBy(*keys).orderBy("chunk").rowsBetween(W.unboundedPreceding, W.currentRow)
    chunks = chunks.withColumn("origin", F.first("centre").over(upto)).select(
        *inner,
        "n",
        "total",
        F.col("origin").alias("centre"),
        (F.col("shift") + F.col("n") * (F.col("centre") - F.col("origin"))).alias("shift"),
        "m2",
    )
    earlier = _running(chunks, asked.select(*inner).distinct(), keys, "chunk")
    places = [*keys, pos]
    return [within.select(*places, *STATE), asked.join(earlier, inner).select(*places, *STATE)]


def _passing(items: DataFrame, asked: DataFrame, keys: list[str], pos: str, until: str) -> DataFrame | None:
    """States of the values visible up to `until`, as seen from each asked position."""
    longest = items.agg(F.max(F.col(until) - F.col(pos))).first()[0]
    if longest is None:
        return None
    lengths = f"sequence(0, {int(longest).bit_length()})"
    # visible where pos < asked <= until: the stretches of asked - 1 in [pos, until)
    low, high = f"-shiftright(-{pos}, l)", f"shiftright({until}, l)"
    each = f"""flatten(transform({lengths}, l -> array(
        CASE WHEN {low} < {high} AND pmod({low}, 2) = 1 THEN struct(l AS size, {low} AS stretch) END,
        CASE WHEN {low} < {high} AND pmod({high}, 2) = 1 THEN struct(l AS size, {high} - 1 AS stretch) END)))"""
    group = [*keys, "size", "stretch"]
    placed = items.select(*keys, pos, "value", F.explode(F.filter(F.expr(each), lambda s: s.isNotNull())).alias("s"))
    placed = stage(placed.select(*keys, "value", "s.*"), "passing")
    first = placed.groupBy(*group).agg(F.min("value").alias("centre"))
    states = _states(placed.join(first, group), group)
    looks = asked.select(
        *keys, pos, F.explode(F.expr(f"transform({lengths}, l -> struct(l AS size, shiftright({pos} - 1, l) AS stretch))")).alias("s")
    ).select(*keys, pos, "s.*")
    return looks.join(states, group).select(*keys, pos, *STATE)


def visible_moments(
    items: DataFrame, asked: DataFrame, keys: Sequence[str], pos: str, until: str, chunk: int | None
) -> DataFrame:
    """`asked` with n, total, mean and m2 of the items before it; positions with none are left out.

    items: keys, an integer position, `until` and a double `value`, none null but `until`: an item
    is seen from positions beyond its own and, where `until` is not null, not beyond that.
    asked: keys and positions, each pair once; read several times, like `items`. chunk: None where no
    group has more rows than a window may hold.
    """
    keys = list(keys)
    items = items.select(*keys, F.col(pos).cast("bigint").alias(pos), F.col(until).cast("bigint").alias(until), "value")
    asked = asked.select(*keys, F.col(pos).cast("bigint").alias(pos))
    found = _lasting(items.where(F.col(until).isNull()), asked, keys, pos, chunk)
    passing = _passing(items.where(F.col(until).isNotNull()), asked, keys, pos, until)
    if passing is not None:
        found.append(passing)
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    # two states, and one of each length of a stretch, at most
    seen = together.groupBy(*keys, pos).agg(F.sort_array(F.collect_list(F.struct("n", *STATE[1:]))).alias("s"))
    from_first = "transform(s, x -> struct(x.n AS n, x.m2 AS m2, x.centre - s[0].centre + x.shift / x.n AS mean))"
    added = "aggregate(s, 0L, (a, x) -> a + x.n)"
    return (
        seen.selectExpr(*keys, pos, f"{added} AS n", "aggregate(s, 0D, (a, x) -> a + x.total) AS total", f"{from_first} AS s")
        .selectExpr("*", "aggregate(s, 0D, (a, x) -> a + x.n * x.mean) / n AS middle")
        .selectExpr(
            *keys,
            pos,
            "n",
            "total",
            "total / n AS mean",
            "aggregate(s, 0D, (a, x) -> a + x.m2 + x.n * (x.mean - middle) * (x.mean - middle)) AS m2",
        )
    )
