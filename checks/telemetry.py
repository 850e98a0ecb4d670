"""The driver's `events` table seen as learning-game telemetry, in Spark and in DuckDB.

Sessions are three-day blocks of a user's events, two of them interleaved, so that a
session may still be running when the next assessment starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed import ASSESSMENT, COUNTED_EVENT_IDS
from tidemark.functions.rules import accuracy_group
from tidemark.operators.events import flag_attempts
from tidemark.operators.sessions import fold
from tidemark.session import stage

TITLES = {
    "click": "Bubble Bath (Activity)",
    "error": "Scrub-A-Dub",
    "purchase": "Bird Measurer (Assessment)",
    "signup": "Mushroom Sorter (Assessment)",
    "view": "Crystal Cave",
}
TYPES = {
    "click": "Activity",
    "error": "Game",
    "purchase": "Assessment",
    "signup": "Assessment",
    "view": "Game",
}
WORLDS = ("CRYSTALCAVES", "MAGMAPEAK", "TREETOPCITY")
WORLD_OF = {
    "click": "MAGMAPEAK",
    "error": "TREETOPCITY",
    "purchase": "TREETOPCITY",
    "signup": "CRYSTALCAVES",
    "view": "CRYSTALCAVES",
}
EVENT_IDS = {
    "click": ("1325467d", "7372e1a5", "1375ccb7", "d185d3ea"),
    "error": ("222660ff", "9e34ea74", "4a4c3d21", "b2dba42b"),
    "purchase": ("28520915", "ca11f653", "36fa3ebe", "30614231"),
    "signup": ("a1e4395d", "5f0eb72c", "3bf1cf26", "e694a35b"),
    "view": ("05ad839b", "08ff79ad", "27253bdc", "c58186bf"),
}
CODES = (2000, 4020, 4070, 4100, 4110)
COUNTED = tuple(sorted(e for ids in EVENT_IDS.values() for e in ids if e in COUNTED_EVENT_IDS))
VOCABULARY = {
    "title": tuple(sorted(TITLES.values())),
    "type": ("Activity", "Assessment", "Game"),
    "world": WORLDS,
}


def _case(subject: str, values: dict, otherwise: str) -> str:
    arms = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in values.items())
    return f"CASE {subject} {arms} ELSE {otherwise!r} END"


TITLE = _case("event_type", TITLES, "Other")
TYPE = _case("event_type", TYPES, "Clip")
WORLD = _case("event_type", WORLD_OF, "NONE")
EVENT_ID = _case(
    "event_type || '_' || CAST(k % 4 AS STRING)",
    {f"{t}_{i}": e for t, ids in EVENT_IDS.items() for i, e in enumerate(ids)},
    "ffffffff",
)
CODE = """CASE event_type
    WHEN 'view' THEN 2000
    WHEN 'error' THEN 4020
    WHEN 'click' THEN 4070
    WHEN 'purchase' THEN CASE WHEN k % 10 = 0 THEN 4100 ELSE 4110 END
    ELSE CASE WHEN k % 5 = 0 THEN 4110 ELSE 4100 END END"""
VERDICT = """CASE
    WHEN k % 13 = 0 THEN '"correct": true,'
    WHEN k % 12 < 5 THEN '"correct":true,'
    WHEN k % 12 < 8 THEN '"correct":false,'
    WHEN k % 12 = 8 THEN '"correct":null,'
    WHEN k % 12 = 9 THEN '"correct":0,'
    WHEN k % 12 = 10 THEN '"correct":"x",'
    ELSE '' END"""
DATA = f"""'{{' || {VERDICT} || '"duration":' || CAST(k * 10 AS STRING)
    || ',"total_duration":' || CAST(k * 20 AS STRING)
    || ',"misses":' || CAST(k % 7 AS STRING) || '}}'"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.to_date("ts"), F.to_date(F.lit("1970-01-01")))
    return (
        read(spark, sf_dir, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .withColumn("block", F.floor(day / 3))
        .select(
            F.expr(EVENT_ID).alias("event_id"),
            F.concat_ws(
                "_", F.col("user_id").cast("string"), F.col("block").cast("string"), F.col("k") % 2
            ).alias("game_session"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.expr(DATA).alias("event_data"),
            F.col("user_id").cast("string").alias("installation_id"),
            (F.col("k") + 1).alias("event_count"),
            F.expr(CODE).alias("event_code"),
            F.floor(F.col("value") * 1000).alias("game_time"),
            F.expr(TITLE).alias("title"),
            F.expr(TYPE).alias("type"),
            F.expr(WORLD).alias("world"),
        )
    )


def train_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).filter(F.col("installation_id").cast("bigint") % 5 != 0)


def test_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).filter(F.col("installation_id").cast("bigint") % 5 == 0)


def test_until_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test events up to each device's last event of an assessment, as test devices end there."""
    test = test_events(spark, sf_dir)
    at = F.struct("timestamp", "event_count", "game_session", "event_id")
    ends = test.filter(F.col("type") == ASSESSMENT).groupBy("installation_id").agg(F.max(at).alias("end"))
    return test.join(ends, "installation_id").filter(at <= F.col("end")).select(*test.columns)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training sessions that began as an assessment, and a few whose session is unknown."""
    train = train_events(spark, sf_dir)
    right, wrong = F.col("correct_attempts"), F.col("uncorrect_attempts")
    known = (
        fold(flag_attempts(train))
        .filter(F.col("type") == ASSESSMENT)
        .select(
            "game_session",
            "installation_id",
            "title",
            F.least(right, F.lit(1)).cast("int").alias("num_correct"),
            wrong.cast("int").alias("num_incorrect"),
            F.coalesce(accuracy_group(right, wrong), F.lit(0)).alias("accuracy_group"),
        )
    )
    lost = train.filter(F.col("installation_id").cast("bigint") % 50 == 1)
    none = F.lit(0)
    lost = lost.select("installation_id").distinct().select(
        F.concat(F.lit("lost_"), "installation_id").alias("game_session"),
        "installation_id",
        F.lit("Mushroom Sorter (Assessment)").alias("title"),
        none.alias("num_correct"),
        none.alias("num_incorrect"),
        none.alias("accuracy_group"),
    )
    return stage(known.unionByName(lost), "labels")


_ATTEMPT = """(type = 'Assessment' AND event_code =
    CASE WHEN title = 'Bird Measurer (Assessment)' THEN 4110 ELSE 4100 END)"""
_PRESENT = "json_exists(event_data, '$.correct')"
_KIND = "json_type(event_data, '$.correct')"
_TEXT = "json_extract_string(event_data, '$.correct')"
_TRUTH = f"""CASE
    WHEN {_KIND} IS NULL OR {_KIND} = 'NULL' THEN false
    WHEN {_KIND} = 'BOOLEAN' THEN {_TEXT} = 'true'
    WHEN {_KIND} = 'VARCHAR' THEN {_TEXT} <> ''
    ELSE CAST({_TEXT} AS DOUBLE) <> 0 END"""

GROUP_RULE = """CASE WHEN {c} = 0 AND {u} = 0 THEN NULL
    WHEN {c} = 1 AND {u} = 0 THEN 3 WHEN {c} = 1 AND {u} = 1 THEN 2
    WHEN {c} = 1 AND {u} >= 2 THEN 1 ELSE 0 END"""


def group_rule(c: str, u: str) -> str:
    return GROUP_RULE.format(c=c, u=u)


# Common table expressions the oracle queries share.
EV = f"""raw AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        CAST(floor(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) / 3) AS BIGINT) AS block
    FROM events),
ev AS (
    SELECT {EVENT_ID} AS event_id,
        CAST(user_id AS VARCHAR) || '_' || CAST(block AS VARCHAR) || '_' || CAST(k % 2 AS VARCHAR)
            AS game_session,
        ts AS "timestamp", {DATA} AS event_data, CAST(user_id AS VARCHAR) AS installation_id,
        k + 1 AS event_count, {CODE} AS event_code,
        CAST(floor(value * 1000) AS BIGINT) AS game_time, {TITLE} AS title, {TYPE} AS type,
        {WORLD} AS world
    FROM raw),
fl AS (
    SELECT *, CAST(floor(epoch(timestamp)) AS BIGINT) AS sec,
        CAST({_ATTEMPT} AS INTEGER) AS attempt,
        CAST({_ATTEMPT} AND contains(event_data, '"correct":true') AS INTEGER) AS right_text,
        CAST({_ATTEMPT} AND contains(event_data, '"correct":false') AS INTEGER) AS wrong_text,
        CAST({_ATTEMPT} AND {_PRESENT} AND {_TRUTH} AS INTEGER) AS right_json,
        CAST({_ATTEMPT} AND {_PRESENT} AND NOT ({_TRUTH}) AS INTEGER) AS wrong_json
    FROM ev),
tr AS (SELECT * FROM fl WHERE CAST(installation_id AS BIGINT) % 5 <> 0),
te AS (SELECT * FROM fl WHERE CAST(installation_id AS BIGINT) % 5 = 0)"""
