"""Columns to drop because an earlier column says nearly the same."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import CORRELATION_LIMIT
from tidemark.functions.naming import quoted

SUMS = ("n", "x", "y", "xx", "yy", "xy")
PARTIAL = ", ".join(["i int", *[f"{s} array<double>" for s in SUMS]])
PAIR_SUMS = ", ".join(["i int", "j int", *[f"{s} double" for s in SUMS]])

# A variance this small beside the squares it comes from is rounding noise of a constant.
NOISE = 1e-12


def _partial_sums(shifts: np.ndarray):
    """Per task, a row for each column: its sums with every later column over complete pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(shifts)
        n, x, xx, xy = (np.zeros((p, p)) for _ in range(4))
        seen = False
        for batch in batches:
            seen = True
            table = np.column_stack(
                [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            )
            known = ~np.isnan(table)
            table = np.where(known, table - shifts, 0.0)
            if known.all():  # every pair is complete: the sums are those of the columns
                n += len(table)
                x += table.sum(axis=0)[:, None]
                xx += (table * table).sum(axis=0)[:, None]
                xy += table.T @ table
                continue
            known = known.astype(float)
            n += known.T @ known
            x += table.T @ known
            xx += (table * table).T @ known
            xy += table.T @ table
        for i in range(p - 1 if seen else 0):
            later = slice(i + 1, p)
            sums = (n[i, later], x[i, later], x[later, i], xx[i, later], xx[later, i], xy[i, later])
            columns = [pa.array([i], pa.int32()), *[pa.array([s]) for s in sums]]
            yield pa.RecordBatch.from_arrays(columns, names=["i", *SUMS])

    return run


def _added(rows: pa.Table) -> pa.Table:
    """A column's rows of all tasks, added up and laid out as pairs."""
    i = rows["i"][0].as_py()
    totals = [np.sum([np.asarray(a.values) for a in rows[s]], axis=0) for s in SUMS]
    j = np.arange(i + 1, i + 1 + len(totals[0]), dtype=np.int32)
    columns = [pa.array(np.full(len(j), i, dtype=np.int32)), pa.array(j), *map(pa.array, totals)]
    return pa.table(dict(zip(["i", "j", *SUMS], columns, strict=True)))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over the rows where both are known.

    As many tasks as run at once add up all rows, however many partitions there are; of each, a
    row per column moves, and a column's rows meet in one task. Columns are shifted by their mean
    first, which keeps the sums accurate. Constants correlate as null.
    """
    columns = list(columns)
    numbers = df.select(
        *[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    )
    means = numbers.agg(*[F.avg(f"c{i}") for i in range(len(columns))]).first()
    shifts = np.array([0.0 if m is None else m for m in means])
    at_once = df.sparkSession.sparkContext.defaultParallelism
    partial = numbers.coalesce(at_once).mapInArrow(_partial_sums(shifts), PARTIAL)
    total = partial.groupBy("i").applyInArrow(_added, PAIR_SUMS)
    n = F.nullif(F.col("n"), F.lit(0.0))

    def spread(product: str, one: str, other: str):
        return F.col(product) - F.col(one) * F.col(other) / n

    def variance(square: str, one: str):
        size = spread(square, one, one)
        return F.when(size > F.col(square) * NOISE, size)

    r = spread("xy", "x", "y") / F.sqrt(variance("xx", "x") * variance("yy", "y"))
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(
        F.get(names, F.col("i")).alias("earlier"),
        F.get(names, F.col("j")).alias("later"),
        "i",
        "j",
        r.alias("r"),
    )


def correlated_columns(
    df: DataFrame, columns: Sequence[str], limit: float = CORRELATION_LIMIT
) -> DataFrame:
    """Columns to drop: those whose |r| with any earlier column is above the limit."""
    close = correlations(df, columns).filter(F.abs("r") > limit)
    return close.select(F.col("later").alias("feature")).distinct()
