"""Queries on single events and on sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import telemetry as t
from checks.registry import query
from tidemark.fixed import COUNTED_EVENT_IDS, EVENT_PROPS
from tidemark.functions import rules
from tidemark.functions.attempts import is_attempt
from tidemark.functions.naming import code_column, id_column, prop_column
from tidemark.operators import events as ev
from tidemark.operators import sessions as se

KEYS = "game_session, installation_id, timestamp, event_id, event_count"
KEY_COLUMNS = [c.strip() for c in KEYS.split(",")]
LABELED = "(SELECT installation_id FROM tr WHERE attempt = 1)"


def labeled_devices(spark, sf_dir):
    events = t.train_events(spark, sf_dir).withColumn("attempt", is_attempt())
    return events.filter("attempt").select("installation_id")


@query("project_subset", f"WITH {t.EV} SELECT game_session, event_id, event_data FROM ev")
def project_subset(spark, sf_dir):
    return t.telemetry(spark, sf_dir).select("game_session", "event_id", "event_data")


@query("project_drop", f"WITH {t.EV} SELECT * EXCLUDE (event_data) FROM ev")
def project_drop(spark, sf_dir):
    return t.telemetry(spark, sf_dir).drop("event_data")


@query(
    "project_rename",
    f"""WITH {t.EV} SELECT game_session AS assessment_game_session, title AS assessment_title,
    world AS assessment_world, game_time FROM ev""",
)
def project_rename(spark, sf_dir):
    names = {
        "game_session": "assessment_game_session",
        "title": "assessment_title",
        "world": "assessment_world",
    }
    picked = t.telemetry(spark, sf_dir).select("game_session", "title", "world", "game_time")
    return picked.withColumnsRenamed(names)


@query(
    "filter_allowlist",
    f"WITH {t.EV} SELECT {KEYS} FROM ev WHERE event_id IN {COUNTED_EVENT_IDS}",
)
def filter_allowlist(spark, sf_dir):
    return ev.counted_events(t.telemetry(spark, sf_dir)).select(*KEY_COLUMNS)


@query("attempt_flags", f"WITH {t.EV} SELECT {KEYS}, attempt FROM fl")
def attempt_flags(spark, sf_dir):
    return t.telemetry(spark, sf_dir).select(*KEY_COLUMNS, is_attempt().cast("int").alias("attempt"))


def flags(spark, sf_dir, by):
    flagged = ev.flag_attempts(t.telemetry(spark, sf_dir), by)
    return flagged.select(*KEY_COLUMNS, "event_data", "is_correct_attempt", "is_uncorrect_attempt")


@query(
    "attempt_flags_substring",
    f"""WITH {t.EV} SELECT {KEYS}, event_data, right_text AS is_correct_attempt,
    wrong_text AS is_uncorrect_attempt FROM fl""",
)
def attempt_flags_substring(spark, sf_dir):
    return flags(spark, sf_dir, "text")


@query(
    "attempt_flags_json",
    f"""WITH {t.EV} SELECT {KEYS}, event_data, right_json AS is_correct_attempt,
    wrong_json AS is_uncorrect_attempt FROM fl""",
)
def attempt_flags_json(spark, sf_dir):
    return flags(spark, sf_dir, "json")


@query(
    "semi_join_labeled",
    f"WITH {t.EV} SELECT {KEYS} FROM tr WHERE installation_id IN {LABELED}",
)
def semi_join_labeled(spark, sf_dir):
    kept = ev.keep_devices(t.train_events(spark, sf_dir), labeled_devices(spark, sf_dir))
    return kept.select(*KEY_COLUMNS)


@query(
    "cast_events",
    f"""WITH {t.EV} SELECT game_session, event_id, event_count, event_code, game_time,
    game_time + event_count AS checksum FROM ev""",
)
def cast_events(spark, sf_dir):
    text = t.telemetry(spark, sf_dir).select(
        "game_session",
        "event_id",
        *[F.col(c).cast("string").alias(c) for c in ("event_count", "event_code", "game_time")],
    )
    typed = rules.strict_casts(
        text, {"event_count": "int", "event_code": "int", "game_time": "bigint"}
    )
    return typed.withColumn("checksum", F.col("game_time") + F.col("event_count"))


@query(
    "time_features",
    f"""WITH {t.EV} SELECT game_session, event_id, event_count, sec AS timestamp,
    CAST(hour(fl.timestamp) AS INTEGER) AS assessment_hour,
    CAST(isodow(fl.timestamp) - 1 AS INTEGER) AS assessment_dayofweek FROM fl""",
)
def time_features(spark, sf_dir):
    picked = t.telemetry(spark, sf_dir).select("game_session", "event_id", "event_count", "timestamp")
    return rules.time_features(picked)


# --- sessions ---------------------------------------------------------------

FIRST = ", ".join(
    f'first({c} ORDER BY fl.timestamp, event_count, installation_id, title, "type", world) AS {c}'
    for c in ("installation_id", "title", '"type"', "world")
)


def fold_sql(rows: str, extra: str, name: str = "s") -> str:
    """The session fold over `rows`, as a common table expression called `name`."""
    return f"""{name}_first AS (
    SELECT game_session, timestamp, installation_id, title, type, world,
        row_number() OVER (PARTITION BY game_session
            ORDER BY timestamp, event_count, installation_id, title, type, world) AS nth
    FROM {rows}),
{name}_agg AS (
    SELECT game_session, CAST(greatest(0, max(event_count)) AS BIGINT) AS event_count,
        CAST(sum(right_json) AS BIGINT) AS correct_attempts,
        CAST(sum(wrong_json) AS BIGINT) AS uncorrect_attempts{extra}
    FROM {rows} GROUP BY game_session),
{name} AS (
    SELECT f.* EXCLUDE (nth), a.* EXCLUDE (game_session),
        CASE WHEN correct_attempts + uncorrect_attempts = 0 THEN 0.0
            ELSE CAST(correct_attempts AS DOUBLE) / (correct_attempts + uncorrect_attempts) END
            AS accuracy_rate,
        {t.group_rule('correct_attempts', 'uncorrect_attempts')} AS grp
    FROM {name}_first f JOIN {name}_agg a USING (game_session) WHERE nth = 1)"""


def gaps_sql(rows: str, name: str = "g") -> str:
    return f"""{name}_lag AS (
    SELECT game_session, game_time - lag(game_time) OVER (PARTITION BY game_session
        ORDER BY game_time) AS gap FROM {rows}),
{name} AS (
    SELECT game_session, coalesce(avg(gap), 0.0) AS game_time_mean_diff,
        coalesce(stddev_pop(gap), 0.0) AS game_time_std_diff
    FROM {name}_lag GROUP BY game_session)"""


def counts_sql(column: str, values, label) -> str:
    def literal(v):
        return repr(v)

    return "".join(
        f", count(*) FILTER (WHERE {column} = {literal(v)}) AS {label(v)}" for v in values
    )


def props_sql(props=EVENT_PROPS) -> str:
    return "".join(
        f""", coalesce(sum(CASE WHEN event_id = '{event_id}'
            THEN CAST(json_extract_string(event_data, '$.{prop}') AS DOUBLE) END), 0.0) AS {prop_column(event_id, prop)}"""
        for event_id, names in props.items()
        for prop in names
    )


ONE_HOT_GROUPS = ", ".join(
    f"CAST(coalesce(grp = {g}, false) AS INTEGER) AS accuracy_group_{g}" for g in range(4)
)
CODE_COUNTS = counts_sql("event_code", t.CODES, code_column)
ID_COUNTS = counts_sql("event_id", COUNTED_EVENT_IDS, id_column)

SESSIONS_G2B = f"""{fold_sql('fl', ', max(game_time) AS game_time' + CODE_COUNTS + ID_COUNTS)},
{gaps_sql('fl')}"""
SESSIONS_G2A = fold_sql(
    "fl", ", greatest(0, max(game_time)) AS game_time" + CODE_COUNTS + props_sql()
)


@query(
    "session_agg",
    f"""WITH {t.EV}, {SESSIONS_G2B}
    SELECT * EXCLUDE (grp, game_time_mean_diff, game_time_std_diff),
        {ONE_HOT_GROUPS},
        round(game_time_mean_diff, 6) AS game_time_mean_diff,
        round(game_time_std_diff, 6) AS game_time_std_diff
    FROM (SELECT * REPLACE (round(accuracy_rate, 6) AS accuracy_rate) FROM s)
    JOIN g USING (game_session)""",
)
def session_agg(spark, sf_dir):
    return se.sessions_with_ids(t.telemetry(spark, sf_dir), t.CODES)


@query(
    "session_agg_props",
    f"""WITH {t.EV}, {SESSIONS_G2A}
    SELECT * EXCLUDE (grp) REPLACE (round(accuracy_rate, 6) AS accuracy_rate), {ONE_HOT_GROUPS}
    FROM s""",
)
def session_agg_props(spark, sf_dir):
    return se.sessions_with_props(t.telemetry(spark, sf_dir), t.CODES)


@query(
    "session_gap_stats",
    f"""WITH {t.EV}, {gaps_sql('fl')} SELECT game_session,
    round(game_time_mean_diff, 6) AS game_time_mean_diff,
    round(game_time_std_diff, 6) AS game_time_std_diff FROM g""",
)
def session_gap_stats(spark, sf_dir):
    return se.gap_stats(t.telemetry(spark, sf_dir))


@query(
    "event_code_counts",
    f"""WITH {t.EV} SELECT game_session{counts_sql('event_code', (*t.CODES, 9999), code_column)}
    FROM ev GROUP BY game_session""",
)
def event_code_counts(spark, sf_dir):
    events = t.telemetry(spark, sf_dir)
    return events.groupBy("game_session").agg(*ev.code_counts((*t.CODES, 9999)))


@query(
    "event_id_counts",
    f"WITH {t.EV} SELECT game_session{ID_COUNTS} FROM ev GROUP BY game_session",
)
def event_id_counts(spark, sf_dir):
    wanted = {"event_id": (COUNTED_EVENT_IDS, id_column)}
    return se.counts_by_value(t.telemetry(spark, sf_dir), wanted)


@query(
    "event_prop_sums",
    f"WITH {t.EV} SELECT game_session{props_sql()} FROM ev GROUP BY game_session",
)
def event_prop_sums(spark, sf_dir):
    return ev.session_props(t.telemetry(spark, sf_dir))


@query(
    "join_session_props",
    f"""WITH {t.EV}, p AS (SELECT game_session{props_sql()} FROM ev GROUP BY game_session)
    SELECT ev.game_session, ev.event_id, ev.event_count, p.* EXCLUDE (game_session)
    FROM ev LEFT JOIN p USING (game_session)""",
)
def join_session_props(spark, sf_dir):
    events = t.telemetry(spark, sf_dir)
    picked = events.select("game_session", "event_id", "event_count")
    return picked.join(ev.session_props(events), "game_session", "left")


COUNTS_OF_TRIES = f"""{t.EV}, c AS (SELECT game_session,
    CAST(sum(right_json) AS BIGINT) AS c, CAST(sum(wrong_json) AS BIGINT) AS u
    FROM fl GROUP BY game_session)"""


def tries(spark, sf_dir):
    flagged = ev.flag_attempts(t.telemetry(spark, sf_dir))
    return flagged.groupBy("game_session").agg(
        F.sum("is_correct_attempt").alias("c"), F.sum("is_uncorrect_attempt").alias("u")
    )


@query(
    "accuracy_rate",
    f"""WITH {COUNTS_OF_TRIES} SELECT *,
    CASE WHEN c + u = 0 THEN 0.0 ELSE round(c / CAST(c + u AS DOUBLE), 6) END AS accuracy_rate FROM c""",
)
def accuracy_rate(spark, sf_dir):
    df = tries(spark, sf_dir)
    return df.withColumn("accuracy_rate", rules.accuracy_rate(F.col("c"), F.col("u")))


@query(
    "accuracy_group",
    f"WITH {COUNTS_OF_TRIES} SELECT *, {t.group_rule('c', 'u')} AS accuracy_group FROM c",
)
def accuracy_group(spark, sf_dir):
    df = tries(spark, sf_dir)
    return df.withColumn("accuracy_group", rules.accuracy_group(F.col("c"), F.col("u")))


@query(
    "accuracy_group_onehot",
    f"""WITH {COUNTS_OF_TRIES} SELECT game_session, {ONE_HOT_GROUPS}
    FROM (SELECT *, {t.group_rule('c', 'u')} AS grp FROM c)""",
)
def accuracy_group_onehot(spark, sf_dir):
    group = rules.accuracy_group(F.col("c"), F.col("u"))
    columns = rules.group_columns(group)
    return tries(spark, sf_dir).select(
        "game_session", *[value.alias(name) for name, value in columns.items()]
    )


@query(
    "last_per_device",
    f"""WITH {t.EV} SELECT installation_id, max_by(event_id, p) FILTER (event_id IS NOT NULL) AS event_id,
    max_by(game_session, p) AS game_session, max(timestamp) AS timestamp,
    max_by(event_data, p) FILTER (event_data IS NOT NULL) AS event_data,
    max_by(event_count, p) AS event_count, max_by(event_code, p) AS event_code,
    max_by(game_time, p) FILTER (game_time IS NOT NULL) AS game_time, max_by(title, p) AS title,
    max_by(type, p) AS type, max_by(world, p) AS world
    FROM (SELECT * REPLACE (CASE WHEN event_count % 2 = 0 THEN event_data END AS event_data,
        CASE WHEN event_count % 3 > 0 THEN game_time END AS game_time),
        (timestamp, event_count) AS p FROM te) GROUP BY installation_id""",
)
def last_per_device(spark, sf_dir):
    events = t.test_events(spark, sf_dir).withColumns(
        {
            "event_data": F.when(F.col("event_count") % 2 == 0, F.col("event_data")),
            "game_time": F.when(F.col("event_count") % 3 > 0, F.col("game_time")),
        }
    )
    return ev.last_per_device(events)


_TIED = "CAST(timestamp AS DATE)"


@query(
    "last_per_device_ties",
    f"""WITH {t.EV}, o AS (SELECT *, row_number() OVER (PARTITION BY installation_id
        ORDER BY {_TIED} DESC, game_session DESC, event_id DESC, event_count DESC) AS nth FROM te)
    SELECT installation_id, {_TIED} AS day, game_session, event_id, event_count, title, type, world
    FROM o WHERE nth = 1""",
)
def last_per_device_ties(spark, sf_dir):
    """Many rows at the last position: all columns still come from one of them."""
    events = t.test_events(spark, sf_dir).select(
        "installation_id", F.to_date("timestamp").alias("day"), "game_session", "event_id",
        "event_count", "title", "type", "world",
    )
    return ev.last_per_device(events, ("day", "game_session", "event_id", "event_count"))


@query("distinct_codes", f"WITH {t.EV} SELECT DISTINCT event_code FROM ev")
def distinct_codes(spark, sf_dir):
    return t.telemetry(spark, sf_dir).select("event_code").distinct()


@query(
    "common_event_codes",
    f"WITH {t.EV} SELECT event_code FROM tr INTERSECT SELECT event_code FROM te",
)
def common_event_codes(spark, sf_dir):
    return ev.common_codes(t.train_events(spark, sf_dir), t.test_events(spark, sf_dir))
