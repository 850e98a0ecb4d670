"""Totals and order statistics over everything before a position, for groups of any size.

A group (say, one device) may hold a large share of all rows, so no step gathers a group.
Rows are first added up per position, positions are cut into chunks of fixed length, and
a running total is a chunk's own running total plus the total of the chunks before it.
Every window therefore sees at most CHUNK rows, or one row per chunk. Where no group has more rows
than that, a group is one chunk, and there is nothing before it.

An order statistic is found digit by digit: counting, per digit, the earlier values that
share the digits found so far gives the next digit. Each round is one pass of running totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.ordering import numbered
from tidemark.session import stage

CHUNK = 1 << 16
DIGIT_BITS = 4


def prefix_totals(
    rows: DataFrame,
    keys: Sequence[str],
    pos: str,
    sums: Sequence[str],
    maxes: Sequence[str] = (),
    inclusive: bool = False,
    chunk: int | None = CHUNK,
    counted: tuple[str, str, int] | None = None,
    asked: str | None = None,
) -> DataFrame:
    """Totals of `sums` and `maxes` before (or up to) each position whose row has asks = 1.

    `rows` holds keys, an integer position, `asks`, and the columns to total; keys are not
    null. A sum over nothing is 0, a largest value over nothing is null.

    counted: a column of digits, one of weights, and how many digits there are; their weights are
    added to sums d0, d1 and so on. Rows travel with their digit, and the sums are made where they
    meet. asked: a column of what the rows that ask carry; it comes back as an array for a position.
    chunk: None where no group has more positions than one window may hold.
    """
    keys = list(keys)
    bounds = (W.unboundedPreceding, 0 if inclusive else -1)
    places = [*keys, "chunk"] if chunk else keys
    inner = W.partitionBy(*places).orderBy(pos).rowsBetween(*bounds)
    outer = W.partitionBy(*keys).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)

    # the one exchange of the rows: what follows groups by these columns and more
    if chunk:
        rows = rows.withColumn("chunk", F.floor(F.col(pos) / chunk))
    rows = rows.repartition(*[F.col(c) for c in places])
    sums = list(sums)
    if counted:
        digit, weight, width = counted
        each = {f"d{d}": F.when(F.col(digit) == d, F.col(weight)) for d in range(width)}
        rows, sums = rows.withColumns(each), [*sums, *each]

    def totals(over=None, suffix: str = "") -> list[Column]:
        added = [(F.sum(c), c) for c in sums]
        largest = [(F.max(c), c) for c in maxes]
        if over is not None:
            added = [(total.over(over), c) for total, c in added]
            largest = [(total.over(over), c) for total, c in largest]
        return [
            *[F.coalesce(total, F.lit(0)).alias(c + suffix) for total, c in added],
            *[total.alias(c + suffix) for total, c in largest],
        ]

    carried = [asked] if asked else []
    at = rows.groupBy(*places, pos).agg(
        F.max("asks").alias("asks"), *[F.collect_list(c).alias(c) for c in carried], *totals()
    )
    within = at.select(*places, pos, "asks", *carried, *totals(inner)).filter("asks = 1")
    if not chunk:
        return within.select(*keys, pos, *carried, *sums, *maxes)
    # read with all their columns, so that the rows' exchange serves this too
    earlier = at.groupBy(*places).agg(F.max("asks").alias("asks"), *[F.max(F.size(c)).alias(c) for c in carried], *totals())
    earlier = earlier.select(*places, "asks", *carried, *totals(outer, "_earlier")).filter("asks = 1")
    for c in carried:
        earlier = earlier.filter(F.col(c) > 0)
    return within.join(earlier.drop("asks", *carried), places).select(
        *keys,
        pos,
        *carried,
        *[(F.col(c) + F.col(f"{c}_earlier")).alias(c) for c in sums],
        *[F.greatest(F.col(c), F.col(f"{c}_earlier")).alias(c) for c in maxes],
    )


def ranked_values(items: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of `columns`, numbered from 0 in sorted order as `code`."""
    return numbered(items.select(*columns).distinct(), columns, "code")


def kth_smallest(
    items: DataFrame,
    asked: DataFrame,
    keys: Sequence[str],
    pos: str,
    bits: int,
    chunk: int | None = CHUNK,
) -> DataFrame:
    """`asked` with `code`: the k-th smallest code among the items before the asked position.

    `items`: keys, pos, code (0 <= code < 2^bits), weight. A negative weight takes back an
    earlier item. `asked`: keys, pos, k (1-based, at most the number of items before pos).
    """
    keys = list(keys)
    width = 1 << DIGIT_BITS
    digits = [f"d{d}" for d in range(width)]
    state = asked.withColumns({"node": F.lit(0).cast("bigint"), "left": F.col("k")})
    rounds = max(1, -(-bits // DIGIT_BITS))
    ask = F.struct(F.col("k"), F.col("left")).alias("ask")
    for level in reversed(range(rounds)):
        low = level * DIGIT_BITS
        top = level == rounds - 1
        node = F.lit(0).cast("bigint") if top else F.shiftright("code", low + DIGIT_BITS)
        digit = F.shiftright("code", low).bitwiseAND(width - 1)
        nothing = F.lit(None).cast("bigint")
        counts = items.select(
            *keys,
            node.alias("node"),
            pos,
            F.lit(0).alias("asks"),
            digit.cast("int").alias("digit"),
            "weight",
            F.lit(None).cast(state.select(ask).schema["ask"].dataType).alias("ask"),
        )
        wanted = state.select(
            *keys, "node", pos, F.lit(1).alias("asks"), nothing.cast("int").alias("digit"), nothing.alias("weight"), ask
        )
        totals = prefix_totals(
            counts.unionByName(wanted), [*keys, "node"], pos, (), chunk=chunk, counted=("digit", "weight", width), asked="ask"
        )
        running, so_far = [], F.lit(0).cast("bigint")
        for d in digits:
            so_far = so_far + F.col(d)
            running.append(so_far)
        found = (
            totals.select(*keys, "node", pos, F.array(*running).alias("running"), F.inline("ask"))
            .withColumn("digit", F.size(F.filter("running", lambda c: c < F.col("left"))))
        )
        skipped = F.when(F.col("digit") == 0, 0).otherwise(F.get("running", F.col("digit") - 1))
        state = stage(
            found.withColumns(
                {
                    "left": (F.col("left") - skipped).cast("bigint"),
                    "node": F.col("node") * width + F.col("digit"),
                }
            ).select(*state.columns),
            "kth",
        )
    return state.withColumnRenamed("node", "code").drop("left")
