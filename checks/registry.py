"""Named queries over the driver's tables, each with its oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.naming import quoted
from tidemark.session import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating-point columns rounded, so that the order of additions does not show, and
    moments without a time zone, as the tables have them."""

    def shown(name: str, kind: str) -> str:
        column = quoted(name)
        if kind in ("double", "float"):
            return f"round({column}, {digits}) AS {column}"
        if kind == "timestamp":
            return f"CAST({column} AS TIMESTAMP_NTZ) AS {column}"
        return column

    return df.selectExpr(*[shown(name, kind) for name, kind in df.dtypes])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(pin(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
