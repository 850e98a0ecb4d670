"""Lookup tables made from the data, and the joins that use them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import small_side

SESSION_ORDER = ("timestamp", "game_session")


def _beside(table: DataFrame) -> DataFrame:
    """A lookup table computed once, and broadcast if its size in bytes allows."""
    return small_side(table)


def common_group_by_title(labels: DataFrame) -> DataFrame:
    """The most frequent accuracy group of each title; the smaller one on a tie."""
    return (
        labels.filter(F.col("title").isNotNull())
        .groupBy("title")
        .agg(F.mode("accuracy_group", True).alias("assessment_most_common_title_accuracy_group"))
    )


def first_by_title(
    sessions: DataFrame, columns: Iterable[str], order: Iterable[str] = SESSION_ORDER
) -> DataFrame:
    """Each title's first value that is not null, per column, in session order.

    Rows at the same position are ordered by all the columns together, so that one row's values
    stay together.
    """
    columns = list(columns)
    position = F.struct(*[F.col(c).alias(f"at{i}") for i, c in enumerate([*order, *columns])])
    picks = [
        F.min(F.when(F.col(c).isNotNull(), F.struct(position, F.col(c).alias("value"))))
        .getField("value")
        .alias(c)
        for c in columns
    ]
    return sessions.filter(F.col("title").isNotNull()).groupBy("title").agg(*picks)


def lookup(df: DataFrame, table: DataFrame, key: str = "title") -> DataFrame:
    """Add a lookup table's columns; an unknown key gives nulls."""
    return df.join(_beside(table), key, "left")


def lookup_strict(df: DataFrame, table: DataFrame, key: str = "title") -> DataFrame:
    """Add a lookup table's columns; an unknown key is an error."""
    found = df.join(_beside(table).withColumn("found", F.lit(True)), key, "left")
    message = F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key), F.lit("null")))
    checked = {
        c: F.when(F.col("found").isNull(), F.raise_error(message).cast(table.schema[c].dataType))
        .otherwise(F.col(c))
        for c in table.columns
        if c != key
    }
    return found.withColumns(checked).drop("found")


def session_starts(events: DataFrame) -> DataFrame:
    """First moment of each (device, session)."""
    return (
        events.filter(F.col("installation_id").isNotNull() & F.col("game_session").isNotNull())
        .groupBy("installation_id", "game_session")
        .agg(F.min("timestamp").alias("timestamp"))
    )


def with_session_start(labels: DataFrame, starts: DataFrame) -> DataFrame:
    return labels.join(starts, ["installation_id", "game_session"], "left")
