"""Global numbering and running totals in sorted order, without a one-task window.

The rows are sorted across partitions and written; each partition then needs only the
totals of the partitions before it, one small row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

_BEFORE = (W.unboundedPreceding, -1)


def _sorted(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    ordered = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    return stage(ordered, "sorted").withColumn("_part", F.shiftright("_id", 33))


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """`df` with rows numbered from 0; `order` must settle every tie."""
    rows = _sorted(df, order)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0)).alias(
                "_offset"
            ),
        )
    )
    nth = F.col("_id").bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + nth).alias(name)
    )


def running_totals(df: DataFrame, order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """`df` with `<c>_before`: the total of c over the rows sorted before; no ties in `order`."""
    rows = _sorted(df, order)
    outer = W.orderBy("_part").rowsBetween(*_BEFORE)
    inner = W.partitionBy("_part").orderBy("_id").rowsBetween(*_BEFORE)
    parts = (
        rows.groupBy("_part")
        .agg(*[F.sum(c).alias(f"_{c}") for c in sums])
        .select(
            "_part",
            *[F.coalesce(F.sum(f"_{c}").over(outer), F.lit(0)).alias(f"_{c}") for c in sums],
        )
    )
    before = {
        f"{c}_before": F.coalesce(F.sum(c).over(inner), F.lit(0)) + F.col(f"_{c}") for c in sums
    }
    totals = rows.join(F.broadcast(parts), "_part").withColumns(before)
    return totals.select(*df.columns, *before)
