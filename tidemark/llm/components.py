"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import release, small_side, stage


def _toward_smallest(edges: DataFrame) -> DataFrame:
    """For every node, its larger neighbours are tied to its smallest one instead."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
        edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(small_side(smallest), "u")
        .where("v > u")
        .select(F.col("v").alias("high"), F.least("u", "m").alias("low"))
        .distinct()
    )


def _below_smallest(edges: DataFrame) -> DataFrame:
    """For every node, its smaller neighbours, and itself, are tied to the smallest of them."""
    smallest = edges.groupBy("high").agg(F.min("low").alias("m"))
    tied = edges.join(small_side(smallest), "high").where("low > m").select(F.col("low").alias("high"), F.col("m").alias("low"))
    return tied.union(smallest.select("high", F.col("m").alias("low"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long) but the roots; the root is the
    smallest node of its component.

    Loops, repeated edges and both directions are allowed, null ends are left out. The number of
    rounds is logarithmic in practice; each is written to the shared scratch folder, and every
    exchange is on a node, with a partial minimum before it.
    """
    tied = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        "edges",
    )
    before = _state(tied)
    while before[0]:
        large = stage(_toward_smallest(tied), "large-star")
        small = stage(_below_smallest(large), "small-star")
        release(tied, large)
        tied = small
        after = _state(tied)
        if after == before:
            break
        before = after
    return tied.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("high", "low")).alias("x")).first()
    return row.n, row.x
