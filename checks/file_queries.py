"""Queries through files: each writes what it derives from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import telemetry as t
from checks.event_queries import ONE_HOT_GROUPS, fold_sql, gaps_sql
from checks.history_queries import CODE_COUNTS, ID_COUNTS, LABELS
from checks.registry import query
from tidemark import schemas
from tidemark.functions import rules
from tidemark.operators import search as sr
from tidemark.operators import specs as sp
from tidemark.session import scratch_path
from tidemark.sources import readers as rd
from tidemark.sources import writers as wr
from tidemark.streaming import sessions as st

EVENT_COLUMNS = """event_id, game_session, "timestamp", event_data, installation_id, event_count,
    event_code, game_time, title, "type", world"""


def written(df, label, form="csv"):
    path = scratch_path(df.sparkSession, label)
    wr.table(df, path, form)
    return path


def shuffled(df):
    """The columns in reverse, and one that nobody asks for."""
    broken = {"event_data": F.concat(F.lit("a\n"), "event_data")} if "event_data" in df.columns else {}
    return df.withColumns(broken).select(F.lit("x, \"y\"").alias("more"), *reversed(df.columns))


BROKEN = EVENT_COLUMNS.replace("event_data", "'a' || chr(10) || event_data AS event_data")


@query("scan_csv_events", f"WITH {t.EV} SELECT {BROKEN} FROM ev")
def scan_csv_events(spark, sf_dir):
    """The file has its columns in another order, and one more; payloads have line breaks."""
    return rd.csv_events(spark, written(shuffled(t.telemetry(spark, sf_dir)), "events_csv"))


@query(
    "scan_csv_text",
    f"WITH {t.EV} SELECT game_session, event_data, event_count, event_code, game_time FROM ev",
)
def scan_csv_text(spark, sf_dir):
    path = written(t.telemetry(spark, sf_dir), "events_csv")
    text = rd.csv_text(spark, path, schemas.EVENTS).select(
        "game_session", "event_data", "event_count", "event_code", "game_time"
    )
    return rules.strict_casts(text, {"event_count": "int", "event_code": "int", "game_time": "bigint"})


@query(
    "scan_csv_table",
    f"""WITH {t.EV}, {LABELS} SELECT * REPLACE (CASE WHEN accuracy_group <> 1 THEN title END AS title)
    FROM labels_t""",
)
def scan_csv_table(spark, sf_dir):
    """Titles of one group are written as missing, in several of the ways there are."""
    ways = F.array(*[F.lit(w) for w in ("NA", "null", "NaN", "")])
    way = F.get(ways, F.pmod(F.hash("game_session"), F.lit(4)))
    title = F.when(F.col("accuracy_group") == 1, way).otherwise(F.col("title"))
    labels = t.labels(spark, sf_dir).withColumn("title", title)
    return rd.csv_table(spark, written(shuffled(labels), "labels_csv"), schemas.LABELS)


def types_by_brand(spark, sf_dir):
    parts = t.read(spark, sf_dir, "part")
    return parts.groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("types"))


@query("scan_event_props", "SELECT DISTINCT p_brand AS event_id, p_type AS prop FROM part")
def scan_event_props(spark, sf_dir):
    """One JSON object of lists, as large as the brands and types of the catalogue."""
    entries = F.map_from_entries(F.collect_list(F.struct("p_brand", "types")))
    document = types_by_brand(spark, sf_dir).agg(F.to_json(entries).alias("value"))
    path = scratch_path(spark, "props_json")
    document.coalesce(1).write.text(path)
    return rd.event_props(spark, path)


@query("scan_drop_list", "SELECT DISTINCT p_brand AS feature FROM part")
def scan_drop_list(spark, sf_dir):
    names = types_by_brand(spark, sf_dir).agg(F.collect_list("p_brand").alias("features"))
    return rd.drop_list(spark, written(names, "drop_json", "json"))


def trials(spark, sf_dir):
    return t.read(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("target"),
        F.create_map(
            F.lit("max_depth"),
            F.col("s_nationkey").cast("double"),
            F.lit("learning_rate"),
            F.col("s_suppkey") / 1000.0,
        ).alias("params"),
    )


def flat(log):
    return log.select(
        "target",
        F.col("params")["max_depth"].alias("max_depth"),
        F.col("params")["learning_rate"].alias("learning_rate"),
    )


TRIALS = """SELECT s_acctbal AS target, CAST(s_nationkey AS DOUBLE) AS max_depth,
    round(s_suppkey / 1000.0, 6) AS learning_rate FROM supplier"""


def logged(spark, sf_dir):
    path = scratch_path(spark, "log_json")
    wr.tuning_log(trials(spark, sf_dir), path)
    return path


@query("scan_tuning_log", TRIALS)
def scan_tuning_log(spark, sf_dir):
    return flat(rd.tuning_log(spark, logged(spark, sf_dir)))


@query("sink_tuning_log", f"{TRIALS} UNION ALL {TRIALS} WHERE s_acctbal > 5000")
def sink_tuning_log(spark, sf_dir):
    path = logged(spark, sf_dir)
    wr.tuning_log(trials(spark, sf_dir).filter("target > 5000"), path)
    return flat(rd.tuning_log(spark, path))


@query("rank_tuning_log", f"{TRIALS} ORDER BY target DESC")
def rank_tuning_log(spark, sf_dir):
    return flat(sr.ranked_trials(rd.tuning_log(spark, logged(spark, sf_dir))))


@query("best_trial", f"SELECT * FROM ({TRIALS}) ORDER BY target DESC LIMIT 1")
def best_trial(spark, sf_dir):
    return flat(sr.best_trial(rd.tuning_log(spark, logged(spark, sf_dir))))


@query("sink_table", f"WITH {t.EV} SELECT {EVENT_COLUMNS} FROM te")
def sink_table(spark, sf_dir):
    """The second write replaces the first."""
    path = written(t.train_events(spark, sf_dir), "events", "parquet")
    wr.table(t.test_events(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("sink_if_absent", f"WITH {t.EV} SELECT {EVENT_COLUMNS} FROM tr")
def sink_if_absent(spark, sf_dir):
    """The second write finds a table and leaves it."""
    path = scratch_path(spark, "events")
    wr.table_if_absent(t.train_events(spark, sf_dir), path)
    wr.table_if_absent(t.test_events(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(
    "sink_predictions",
    f"WITH {t.EV}, {LABELS} SELECT installation_id, accuracy_group FROM labels_t",
)
def sink_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    wr.predictions(t.labels(spark, sf_dir), path)
    return rd.csv_table(spark, path, "installation_id string, accuracy_group int")


# Specifications made from the part table: an id, a text, and a JSON list of arguments.
def specs(spark, sf_dir):
    def arg(name, info, when=None):
        entry = F.struct(F.lit(name).alias("name"), info.alias("info"))
        return entry if when is None else F.when(when, entry)

    size = F.col("p_size")
    args = F.array(
        arg("game_time", F.lit("when")),
        arg("x", F.col("p_name")),
        arg("misses", F.lit("count"), size % 3 == 0),
        arg("duration", F.col("p_type"), size % 2 == 0),
        arg("duration", F.col("p_type"), size % 4 == 0),
    )
    key = F.col("p_partkey")
    return t.read(spark, sf_dir, "part").select(
        F.when(key % 3 == 0, "28520915").otherwise(F.concat(F.lit("e"), key)).alias("event_id"),
        F.col("p_name").alias("info"),
        F.to_json(F.filter(args, lambda a: a.isNotNull())).alias("args"),
    )


SPEC_ID = "CASE WHEN p_partkey % 3 = 0 THEN '28520915' ELSE 'e' || p_partkey END"
SPEC_PROPS = f"""SELECT {SPEC_ID} AS event_id, CASE WHEN p_partkey % 3 > 0 THEN ''
    ELSE concat_ws(',', CASE WHEN p_size % 2 = 0 THEN 'duration' END,
        CASE WHEN p_size % 3 = 0 THEN 'misses' END) END AS props FROM part"""


def _item(name: str, info: str) -> str:
    return f"'<li>Name: <strong>{name}</strong>, ' || {info} || '</li>'"


SPEC_ROWS = f"""SELECT {SPEC_ID} AS event_id, '<tr><td>' || {SPEC_ID} || '</td><td>' || p_name
    || '</td><td><ul>' || {_item('x', 'p_name')}
    || CASE WHEN p_size % 3 = 0 THEN {_item('misses', "'count'")} ELSE '' END
    || CASE WHEN p_size % 2 = 0 THEN {_item('duration', 'p_type')} ELSE '' END
    || CASE WHEN p_size % 4 = 0 THEN {_item('duration', 'p_type')} ELSE '' END
    || '</ul></td></tr>' AS html FROM part"""


@query("spec_prop_map", SPEC_PROPS)
def spec_prop_map(spark, sf_dir):
    path = written(specs(spark, sf_dir), "specs_csv")
    table = rd.csv_table(spark, path, schemas.SPECS)
    return sp.property_map(table).withColumn("props", F.array_join("props", ","))


@query("sink_config_json", SPEC_PROPS)
def sink_config_json(spark, sf_dir):
    path = scratch_path(spark, "props")
    wr.config(sp.property_map(specs(spark, sf_dir)), path)
    back = spark.read.schema("event_id string, props array<string>").json(path)
    return back.withColumn("props", F.array_join("props", ","))


@query("specs_html_rows", SPEC_ROWS)
def specs_html_rows(spark, sf_dir):
    return sp.report_rows(specs(spark, sf_dir))


@query(
    "stream_session_agg",
    f"""WITH {t.EV}, {fold_sql('fl', ', greatest(0, max(game_time)) AS game_time, count(*) AS n_events'
    + CODE_COUNTS + ID_COUNTS)}, {gaps_sql('fl')}
    SELECT * EXCLUDE (grp) REPLACE (round(accuracy_rate, 6) AS accuracy_rate,
        round(game_time_mean_diff, 6) AS game_time_mean_diff, round(game_time_std_diff, 6) AS game_time_std_diff),
        {ONE_HOT_GROUPS} FROM s JOIN g USING (game_session)""",
)
def stream_session_agg(spark, sf_dir):
    """Three batches, over which every session is strewn, the first two merged on the way."""
    events = t.telemetry(spark, sf_dir)
    source = scratch_path(spark, "event_files")
    events.repartition(6).write.parquet(source)
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    )
    out = scratch_path(spark, "session_updates")
    st.run_to_end(stream, out, scratch_path(spark, "stream_state"), t.CODES, t.COUNTED, merge_every=2)
    return st.sessions_so_far(spark, out)
