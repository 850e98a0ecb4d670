"""Readers with declared schemas. Text files follow the quoting of common CSV writers."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.functions.naming import quoted
from tidemark.sources.csv_splits import records

# What a whole-file reader takes for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


_QUOTES = {"escape": '"', "mode": "FAILFAST"}


def _texts(spark: SparkSession, path: str, names: Iterable[str]) -> DataFrame:
    """The named columns as text, found by the header; every file's header must be the same.

    A file of one split is one task; of larger ones, splits are read by as many tasks.
    """

    def reader():
        return spark.read.options(header=True, multiLine=True, **_QUOTES)

    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if largest <= split:
        found = reader().csv(path).columns
        layout = _layout(path, found, names)
        return reader().option("enforceSchema", False).schema(layout).csv(path).select(*[quoted(c) for c in names])
    rows = records(spark, path)
    headers = [r.record.removeprefix("\ufeff") for r in rows.where("header").select("record").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"the files of {path} have different headers")
    layout = _layout(path, next(csv.reader(io.StringIO(headers[0], newline=""))), names)
    parsed = rows.where("NOT header").select(F.from_csv("record", layout.toDDL(), _QUOTES).alias("r"))
    return parsed.select(*[F.col(f"r.{quoted(c)}") for c in names])


def _layout(path: str, found: list[str], names: Iterable[str]) -> StructType:
    absent = sorted(set(names) - set(found))
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return StructType([StructField(c, StringType()) for c in found])


def csv_table(
    spark: SparkSession,
    path: str,
    schema: str,
    missing: Iterable[str] = MISSING,
) -> DataFrame:
    """The columns of `schema` from a CSV, by the names in its header, whatever else it has.

    A doubled quote stands for one, and a quoted field may hold line breaks, also where a large
    file is read in splits. A field that is one of `missing` is null; any other that does not fit
    its type is an error, and so is a column that is absent.
    """
    fields = StructType.fromDDL(schema).fields
    texts = _texts(spark, path, [f.name for f in fields])
    tokens = list(missing)

    def typed(field: StructField):
        text = F.col(quoted(field.name))
        known = F.when(~text.isin(tokens), text) if tokens else text
        return known.cast(field.dataType).alias(field.name)

    return texts.select(*[typed(f) for f in fields])


def csv_events(spark: SparkSession, path: str) -> DataFrame:
    """Events, field by field: only an empty field is missing."""
    return csv_table(spark, path, schemas.EVENTS, ("",))


def csv_text(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same columns with every field as text, to be cast by the caller."""
    return _texts(spark, path, StructType.fromDDL(schema).names)


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Targets of each labelled session; only the needed columns are parsed."""
    wanted = StructType([f for f in StructType.fromDDL(schemas.LABELS) if f.name != "title"])
    return csv_table(spark, path, wanted.toDDL()).select(
        "installation_id",
        F.col("game_session").alias("assessment_game_session"),
        "num_correct",
        "num_incorrect",
        "accuracy_group",
    )


def event_props(spark: SparkSession, path: str) -> DataFrame:
    """One row per event id and property from a JSON object of lists."""
    text = spark.read.text(path, wholetext=True)
    props = F.from_json("value", "map<string, array<string>>")
    return text.select(F.explode(props).alias("event_id", "props")).select(
        "event_id", F.explode("props").alias("prop")
    )


def property_lists(spark: SparkSession, path: str) -> DataFrame:
    """The same from a table of event ids with their lists, as `writers.config` writes it."""
    lists = spark.read.schema("event_id string, props array<string>").json(path)
    return lists.select("event_id", F.explode("props").alias("prop"))


def props_by_event(props: DataFrame) -> dict[str, tuple[str, ...]]:
    """The property table as a setting for the session aggregates, one column per row."""
    found: dict[str, list[str]] = {}
    for row in sorted(props.distinct().collect()):
        found.setdefault(row["event_id"], []).append(row["prop"])
    return {event_id: tuple(names) for event_id, names in found.items()}


def drop_list(spark: SparkSession, path: str) -> DataFrame:
    """Feature names from a JSON object with one list."""
    document = spark.read.schema("features array<string>").json(path, multiLine=True)
    return document.select(F.explode("features").alias("feature"))


def tuning_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TUNING_LOG).json(path)


def importances(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, schemas.IMPORTANCES)
