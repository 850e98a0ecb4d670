"""Wide-table work: select, fill, prune, align and encode feature columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import CATEGORICAL
from tidemark.functions.naming import quoted, reject_case_twins, starting_with, with_stat

AGGREGATES = {
    "std": F.stddev_samp,
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "first": F.first,
}


def aggregate_by_prefix(
    df: DataFrame, keys: Sequence[str], stats: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Aggregate every column that starts with a prefix by that prefix's statistics."""
    picks = [
        AGGREGATES[stat](quoted(c)).alias(with_stat(c, stat))
        for prefix, wanted in stats.items()
        for c in starting_with(df.columns, prefix)
        if c not in keys
        for stat in wanted
    ]
    keyed = df.filter(" AND ".join(f"{quoted(k)} IS NOT NULL" for k in keys))
    return keyed.groupBy(*keys).agg(*picks)


def fill_zero(df: DataFrame) -> DataFrame:
    """Numbers that are missing become 0; text stays missing."""
    return df.na.fill(0.0)


def one_hot(df: DataFrame, column: str, values: Iterable[object], prefix: str) -> DataFrame:
    """A 0/1 column per listed value in place of `column`; null gives 0 everywhere."""
    values = list(values)
    reject_case_twins(f"{prefix}_{v}" for v in values)
    flags = [
        F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in values
    ]
    return df.select(*[quoted(c) for c in df.columns if c != column], *flags)


def prune(df: DataFrame, *names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names the table does not have are ignored."""
    return df.drop(*{name for some in names for name in some})


def zero_importance(importances: DataFrame) -> list[str]:
    """Features a model never used; at most one row per column of the feature table.

    A model that used none, as it never split, tells nothing about any.
    """
    rows = importances.collect()
    unused = [row["feature"] for row in rows if row["importance"] == 0]
    return unused if len(unused) < len(rows) else []


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error."""
    return df.select(*[quoted(c) for c in columns])


def stack_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both; a column only one of them has is null for the other."""
    return left.unionByName(right, allowMissingColumns=True)


def label_encode(
    train: DataFrame, *others: DataFrame, columns: Sequence[str] = CATEGORICAL
) -> list[DataFrame]:
    """Text columns as numbers 0..n-1 by sorted training value; an unseen value is an error.

    The columns are marked as nominal, with their values, so that trees take them as categories; not
    those of two values, which have one split either way and are counted faster as numbers.
    The training values are gathered by the driver: titles and worlds, not free text.
    """
    coded = [f"{c}__code" for c in columns]
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=coded,
        stringOrderType="alphabetAsc",
        handleInvalid="error",
    ).fit(train)
    values = dict(zip(columns, indexer.labelsArray, strict=True))

    def code(c: str):
        mark = {"ml_attr": {"type": "nominal", "name": c, "vals": list(values[c])}}
        return F.col(f"{c}__code").cast("int").alias(c, metadata=mark if len(values[c]) > 2 else {})

    encoded = []
    for df in (train, *others):
        done = indexer.transform(df)
        encoded.append(done.select(*[code(c) if c in columns else F.col(quoted(c)) for c in df.columns]))
    return encoded


def train_matrix(
    features: DataFrame, labels: DataFrame, targets: Mapping[str, str]
) -> DataFrame:
    """Features with the label columns joined on, renamed by `targets`; ids stay as columns."""
    wanted = labels.select(
        "installation_id",
        F.col("game_session").alias("assessment_game_session"),
        *[F.col(c).alias(name) for c, name in targets.items()],
    )
    return features.join(wanted, ["installation_id", "assessment_game_session"])
