"""Queries on lookups and on the history before each assessment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import telemetry as t
from checks.event_queries import ONE_HOT_GROUPS, counts_sql, fold_sql, gaps_sql, props_sql
from checks.registry import query
from tidemark.fixed import EVENT_PROPS
from tidemark.functions.naming import code_column, id_column, prop_columns, with_stat
from tidemark.functions.rules import epoch_seconds
from tidemark.operators import events as ev
from tidemark.operators import history as h
from tidemark.operators import lookups as lo
from tidemark.operators import sessions as se
from tidemark.plans import features as fe
from tidemark.session import scratch_path, stage
from tidemark.sources import readers as rd
from tidemark.sources import writers as wr

# --- tables -----------------------------------------------------------------

CODE_COUNTS = counts_sql("event_code", t.CODES, code_column)
ID_COUNTS = counts_sql("event_id", t.COUNTED, id_column)
GAME_TIME = ", max(game_time) AS game_time"

LABELS = f"""{fold_sql('tr', '', 'lf')},
labels_t AS (
    SELECT game_session, installation_id, title,
        CAST(least(correct_attempts, 1) AS INTEGER) AS num_correct,
        CAST(uncorrect_attempts AS INTEGER) AS num_incorrect,
        coalesce(grp, 0) AS accuracy_group
    FROM lf WHERE type = 'Assessment'
    UNION ALL
    SELECT DISTINCT 'lost_' || installation_id, installation_id, 'Mushroom Sorter (Assessment)',
        0, 0, 0
    FROM tr WHERE CAST(installation_id AS BIGINT) % 50 = 1),
kept AS (SELECT * FROM tr WHERE installation_id IN (SELECT installation_id FROM labels_t)),
mode_t AS (
    SELECT title, accuracy_group AS assessment_most_common_title_accuracy_group
    FROM (SELECT title, accuracy_group, row_number() OVER (PARTITION BY title
        ORDER BY n DESC, accuracy_group) AS nth
        FROM (SELECT title, accuracy_group, count(*) AS n FROM labels_t GROUP BY 1, 2))
    WHERE nth = 1)"""


def sessions_sql(rows: str, name: str) -> str:
    """Session table of `rows`, with counts, gaps and start second, called `name`."""
    folded = fold_sql(rows, GAME_TIME + CODE_COUNTS + ID_COUNTS, f"{name}_f")
    gaps = gaps_sql(rows, f"{name}_g")
    return f"""{folded}, {gaps},
{name} AS (SELECT *, CAST(floor(epoch(timestamp)) AS BIGINT) AS start
    FROM {name}_f JOIN {name}_g USING (game_session))"""


def targets_sql(rows: str) -> str:
    """Training targets; world and start come from `rows` (sessions or events)."""
    return f"""world_t AS (
    SELECT title, world FROM (SELECT title, world, row_number() OVER (PARTITION BY title
        ORDER BY timestamp, game_session, world) AS nth FROM {rows}) WHERE nth = 1),
start_t AS (
    SELECT installation_id, game_session, min(timestamp) AS ts FROM {rows} GROUP BY ALL),
tg AS (
    SELECT installation_id, game_session AS assessment_game_session, title AS assessment_title,
        world AS assessment_world, assessment_most_common_title_accuracy_group,
        CAST(hour(ts) AS INTEGER) AS assessment_hour,
        CAST(isodow(ts) - 1 AS INTEGER) AS assessment_dayofweek,
        CAST(floor(epoch(ts)) AS BIGINT) AS sec
    FROM labels_t JOIN world_t USING (title) LEFT JOIN mode_t USING (title)
    LEFT JOIN start_t USING (installation_id, game_session))"""


TEST_TARGETS = """tg AS (
    SELECT installation_id, game_session AS assessment_game_session, title AS assessment_title,
        world AS assessment_world, assessment_most_common_title_accuracy_group,
        CAST(hour(ts) AS INTEGER) AS assessment_hour,
        CAST(isodow(ts) - 1 AS INTEGER) AS assessment_dayofweek,
        CAST(floor(epoch(ts)) AS BIGINT) AS sec
    FROM (SELECT installation_id, max_by(game_session, (timestamp, event_count)) AS game_session,
        max_by(title, (timestamp, event_count)) AS title,
        max_by(world, (timestamp, event_count)) AS world, max(timestamp) AS ts
        FROM te GROUP BY installation_id)
    LEFT JOIN mode_t USING (title))"""

TARGET_COLUMNS = """assessment_title, assessment_world, assessment_most_common_title_accuracy_group,
    assessment_hour, assessment_dayofweek"""
TARGET_KEYS = "tg.installation_id, tg.assessment_game_session"

PAIRS = """pairs AS (
    SELECT tg.*, s.* EXCLUDE (installation_id) FROM tg LEFT JOIN s
    ON s.installation_id = tg.installation_id AND s.start < tg.sec)"""

SQL_STAT = {"std": "stddev_samp", "mean": "avg", "median": "median", "max": "max", "sum": "sum"}
EVERY, TESTS, SAME = "true", "type = 'Assessment'", "title = assessment_title"


def stats_sql(columns, stats=h.STATS, where=EVERY, prefix="", fill=False) -> list[str]:
    parts = []
    for c in columns:
        for stat in stats:
            x = f"CAST({SQL_STAT[stat]}(CAST(\"{c}\" AS DOUBLE)) FILTER (WHERE {where}) AS DOUBLE)"
            x = f"coalesce({x}, 0.0)" if fill or stat == "sum" else x
            parts.append(f'round({x}, 6) AS "{with_stat(prefix + c, stat)}"')
    return parts


def occurrences_sql(prefix: str) -> list[str]:
    parts = [
        f"CAST(count(*) FILTER (WHERE {column} = '{v}') AS DOUBLE) AS \"{prefix}_{v}_sum\""
        for column, values in t.VOCABULARY.items()
        for v in values
    ]
    return parts + [
        f'CAST(count(game_session) = 0 AS DOUBLE) AS "{prefix}_{name}_sum"'
        for name in ("__no_title", "__no_type", "__no_world")
    ]


def grouped(ctes: str, parts: list[str], extra: str = "") -> str:
    return f"""WITH {ctes}
    SELECT installation_id, assessment_game_session, {extra} {', '.join(parts)}
    FROM pairs GROUP BY ALL"""


COUNTS = [*map(code_column, t.CODES), *map(id_column, t.COUNTED)]
SESSION_HISTORY = f"{t.EV}, {LABELS}, {sessions_sql('kept', 's')}, {targets_sql('s')}, {PAIRS}"
TEST_HISTORY = f"{t.EV}, {LABELS}, {sessions_sql('te', 's')}, {TEST_TARGETS}, {PAIRS}"
G2_PARTS = [
    *stats_sql(fe.SESSION_METRICS),
    *stats_sql(COUNTS),
    *stats_sql(fe.ATTEMPT_METRICS, where=TESTS),
    *stats_sql(fe.ATTEMPT_METRICS, where=SAME, prefix=fe.PREVIOUS),
    *occurrences_sql("ttw"),
]


def kept_events(spark, sf_dir, labels):
    return ev.keep_devices(t.train_events(spark, sf_dir), labels)


def session_tables(spark, sf_dir, counted=True):
    """Training sessions, with the counts of codes and ids if wanted, and targets."""
    labels = t.labels(spark, sf_dir)
    columns = (t.CODES, t.COUNTED) if counted else ((), ())
    sessions = stage(
        se.sessions_with_ids(kept_events(spark, sf_dir, labels), *columns), "sessions"
    )
    return sessions, fe.train_targets(labels, sessions, lo.session_starts(sessions)), labels


def session_history(spark, sf_dir, measures, limits=h.Limits(), counted=False):
    sessions, targets, _ = session_tables(spark, sf_dir, counted)
    past = sessions.withColumn(h.POS, epoch_seconds(F.col("timestamp")))
    asked = stage(targets.withColumnRenamed("sec", h.POS), "targets")
    return h.history_features(past, asked, measures, limits)


def picked(df, measures, *more):
    columns = [c for m in measures for c in m.columns()]
    return df.select(h.DEVICE, h.TARGET, *more, *[f"`{c}`" for c in columns])


# --- lookups and starts -------------------------------------------------------


@query(
    "scan_labels_projected",
    f"""WITH {t.EV}, {LABELS} SELECT installation_id, game_session AS assessment_game_session,
    num_correct, num_incorrect, accuracy_group FROM labels_t""",
)
def scan_labels_projected(spark, sf_dir):
    """From a file with more columns than are used, in another order."""
    labels = t.labels(spark, sf_dir).select(
        "num_incorrect",
        "installation_id",
        "title",
        F.lit(0.5).alias("accuracy"),
        "accuracy_group",
        "game_session",
        "num_correct",
    )
    path = scratch_path(spark, "labels_csv")
    wr.table(labels, path, "csv")
    return rd.labels(spark, path)


@query("title_mode_group", f"WITH {t.EV}, {LABELS} SELECT * FROM mode_t")
def title_mode_group(spark, sf_dir):
    return lo.common_group_by_title(t.labels(spark, sf_dir))


@query(
    "lookup_title_group",
    f"""WITH {t.EV}, {LABELS} SELECT game_session, event_id, event_count, title,
    assessment_most_common_title_accuracy_group FROM ev LEFT JOIN mode_t USING (title)""",
)
def lookup_title_group(spark, sf_dir):
    events = t.telemetry(spark, sf_dir).select("game_session", "event_id", "event_count", "title")
    return lo.lookup(events, lo.common_group_by_title(t.labels(spark, sf_dir)))


@query(
    "lookup_title_world",
    f"""WITH {t.EV}, {LABELS}, f AS (
    SELECT title, type, world FROM (SELECT title, type, world, row_number() OVER (
        PARTITION BY title ORDER BY timestamp, game_session, type, world) AS nth FROM tr) WHERE nth = 1)
    SELECT game_session, title, type, world FROM labels_t JOIN f USING (title)""",
)
def lookup_title_world(spark, sf_dir):
    table = lo.first_by_title(t.train_events(spark, sf_dir), ["type", "world"])
    return lo.lookup_strict(t.labels(spark, sf_dir).select("game_session", "title"), table)


@query(
    "join_session_start",
    f"""WITH {t.EV}, {LABELS}, f AS (SELECT installation_id, game_session, min(timestamp) AS timestamp
    FROM tr GROUP BY ALL)
    SELECT installation_id, game_session, title, timestamp FROM labels_t
    LEFT JOIN f USING (installation_id, game_session)""",
)
def join_session_start(spark, sf_dir):
    labels = t.labels(spark, sf_dir).select("installation_id", "game_session", "title")
    return lo.with_session_start(labels, lo.session_starts(t.train_events(spark, sf_dir)))


# --- session-level history ------------------------------------------------------


@query(
    "asof_history",
    grouped(
        SESSION_HISTORY,
        ["count(game_session) AS n_history", *stats_sql(["game_time"], ("sum", "max"))],
        TARGET_COLUMNS + ", sec AS start,",
    ),
)
def asof_history(spark, sf_dir):
    return session_history(spark, sf_dir, h.of_columns(["game_time"], ("sum", "max")))


@query("history_stats", grouped(SESSION_HISTORY, stats_sql(fe.SESSION_METRICS)))
def history_stats(spark, sf_dir):
    measures = h.of_columns(fe.SESSION_METRICS)
    return picked(session_history(spark, sf_dir, measures), measures)


@query("history_count_stats", grouped(SESSION_HISTORY, stats_sql(COUNTS)))
def history_count_stats(spark, sf_dir):
    measures = h.of_columns(COUNTS)
    return picked(session_history(spark, sf_dir, measures, counted=True), measures)


@query(
    "assessment_history_stats",
    grouped(SESSION_HISTORY, stats_sql(fe.ATTEMPT_METRICS, where=TESTS)),
)
def assessment_history_stats(spark, sf_dir):
    measures = h.of_columns(fe.ATTEMPT_METRICS, over=h.ASSESSMENTS)
    return picked(session_history(spark, sf_dir, measures), measures)


@query(
    "same_title_stats",
    grouped(SESSION_HISTORY, stats_sql(fe.ATTEMPT_METRICS, where=SAME, prefix=fe.PREVIOUS)),
)
def same_title_stats(spark, sf_dir):
    measures = h.of_columns(fe.ATTEMPT_METRICS, over=h.SAME_TITLE, prefix=fe.PREVIOUS)
    return picked(session_history(spark, sf_dir, measures), measures)


@query("history_ttw_counts", grouped(SESSION_HISTORY, occurrences_sql("ttw")[:-3]))
def history_ttw_counts(spark, sf_dir):
    measures = [m for c, v in t.VOCABULARY.items() for m in h.occurrences(c, v, "ttw")]
    return picked(session_history(spark, sf_dir, measures), measures)


@query(
    "history_window",
    grouped(SESSION_HISTORY, stats_sql(["event_count"], ("mean", "std", "max", "median"))),
)
def history_window(spark, sf_dir):
    """The same running statistics, with every device sent through the any-size path."""
    measures = h.of_columns(["event_count"], ("mean", "std", "max", "median"))
    return picked(session_history(spark, sf_dir, measures, limits=h.ANY_SIZE), measures)


@query(
    "history_stats_any_size",
    grouped(
        SESSION_HISTORY,
        stats_sql([*fe.SESSION_METRICS, "accuracy_rate"])
        + stats_sql(fe.ATTEMPT_METRICS, where=SAME, prefix=fe.PREVIOUS),
    ),
)
def history_stats_any_size(spark, sf_dir):
    measures = [
        *h.of_columns([*fe.SESSION_METRICS, "accuracy_rate"]),
        *h.of_columns(fe.ATTEMPT_METRICS, over=h.SAME_TITLE, prefix=fe.PREVIOUS),
    ]
    return picked(session_history(spark, sf_dir, measures, limits=h.ANY_SIZE), measures)


# The same times a long way from zero: a deviation must not drown in the mean.
SHIFTED = [
    f"""round({SQL_STAT[stat]}(CAST(game_time + 1000000000 AS DOUBLE)), 3) AS shifted_{stat}"""
    for stat in ("std", "mean", "median")
]


def shifted(spark, sf_dir, limits):
    measures = [h.Measure("shifted", "game_time + 1000000000", ("std", "mean", "median"))]
    df = picked(session_history(spark, sf_dir, measures, limits=limits), measures)
    names = [f"shifted_{stat}" for stat in ("std", "mean", "median")]
    return df.select(h.DEVICE, h.TARGET, *[F.round(c, 3).alias(c) for c in names])


@query("history_shifted", grouped(SESSION_HISTORY, SHIFTED))
def history_shifted(spark, sf_dir):
    return shifted(spark, sf_dir, h.Limits())


@query("history_shifted_any_size", grouped(SESSION_HISTORY, SHIFTED))
def history_shifted_any_size(spark, sf_dir):
    return shifted(spark, sf_dir, h.ANY_SIZE)


# Values that lie near zero up to a moment and near a billion after it, or the other way round: what
# a target sees may be all small, all large, or both. Large figures are told in millions.
TURN = 1_705_300_000
DRIFTS = {
    "up": f"game_time % 1000 + CASE WHEN start >= {TURN} THEN 1000000000 ELSE 0 END",
    "down": f"game_time % 1000 + CASE WHEN start >= {TURN} THEN 0 ELSE 1000000000 END",
}


def _told(x: str) -> str:
    return f"round(CASE WHEN {x} > 1000000 THEN {x} / 1000000 ELSE {x} END, 3)"


DRIFTING = [
    _told(x if stat != "sum" else f"coalesce({x}, 0)") + f" AS {name}_{stat}"
    for name, value in DRIFTS.items()
    for stat in h.STATS_AND_SUM
    for x in [f"{SQL_STAT[stat]}(CAST({value} AS DOUBLE))"]
]


def drifting(spark, sf_dir, limits):
    measures = [h.Measure(name, value, h.STATS_AND_SUM) for name, value in DRIFTS.items()]
    df = picked(session_history(spark, sf_dir, measures, limits=limits), measures)
    names = [c for m in measures for c in m.columns()]
    return df.selectExpr(h.DEVICE, h.TARGET, *[f"{_told(c)} AS {c}" for c in names])


@query("history_drifting", grouped(SESSION_HISTORY, DRIFTING))
def history_drifting(spark, sf_dir):
    return drifting(spark, sf_dir, h.Limits())


@query("history_drifting_any_size", grouped(SESSION_HISTORY, DRIFTING))
def history_drifting_any_size(spark, sf_dir):
    return drifting(spark, sf_dir, h.ANY_SIZE)


def _by_title_sql() -> list[str]:
    parts = []
    for metric in ("game_time", "event_count"):
        for title in t.VOCABULARY["title"]:
            for stat in ("sum", "mean", "max"):
                x = f"{SQL_STAT[stat]}(CAST({metric} AS DOUBLE)) FILTER (WHERE title = '{title}')"
                parts.append(f'round(coalesce({x}, 0.0), 6) AS "{stat}_{metric}_{title}"')
    return parts


@query("pivot_time_by_title", grouped(SESSION_HISTORY, _by_title_sql()))
def pivot_time_by_title(spark, sf_dir):
    sessions, targets, _ = session_tables(spark, sf_dir, counted=False)
    return fe.time_by_value(sessions, targets, "title", t.VOCABULARY["title"])


@query("features_g2", grouped(SESSION_HISTORY, G2_PARTS, TARGET_COLUMNS + ","))
def features_g2(spark, sf_dir):
    sessions, targets, _ = session_tables(spark, sf_dir)
    return fe.session_features(sessions, targets, t.VOCABULARY)


@query("features_g2_test", grouped(TEST_HISTORY, G2_PARTS, TARGET_COLUMNS + ","))
def features_g2_test(spark, sf_dir):
    test = t.test_events(spark, sf_dir)
    sessions = stage(se.sessions_with_ids(test, t.CODES, t.COUNTED), "sessions")
    return fe.test_features_from_sessions(sessions, test, t.labels(spark, sf_dir), t.VOCABULARY)


@query(
    "no_history_defaults",
    grouped(
        SESSION_HISTORY,
        ["count(game_session) = 0 AS no_history", *occurrences_sql("ttw")[-3:]]
        + stats_sql(["game_time"], ("mean", "max")),
    ),
)
def no_history_defaults(spark, sf_dir):
    sessions, targets, _ = session_tables(spark, sf_dir)
    features = fe.session_features(sessions, targets, t.VOCABULARY)
    return features.select(
        h.DEVICE,
        h.TARGET,
        (F.col("ttw___no_title_sum") == 1).alias("no_history"),
        "ttw___no_title_sum",
        "ttw___no_type_sum",
        "ttw___no_world_sum",
        "game_time_mean",
        "game_time_max",
    )


# --- event-level history ------------------------------------------------------

PROPS = {k: v for k, v in EVENT_PROPS.items() if k in {e for ids in t.EVENT_IDS.values() for e in ids}}
PROP_COLUMNS = prop_columns(PROPS)


def event_pairs(rows: str) -> str:
    """Sessions of the events before each target, cut at the target."""
    return f"""seen AS (
    SELECT tg.*, e.* EXCLUDE (installation_id, sec)
    FROM tg LEFT JOIN {rows} e ON e.installation_id = tg.installation_id AND e.sec < tg.sec),
named AS (
    SELECT DISTINCT ON (installation_id, assessment_game_session, game_session)
        installation_id, assessment_game_session, game_session, title, type, world
    FROM seen ORDER BY installation_id, assessment_game_session, game_session, timestamp,
        event_count, title, type, world),
cut AS (
    SELECT installation_id, assessment_game_session, {TARGET_COLUMNS}, sec, game_session,
        max(game_time) AS game_time, max(event_count) AS event_count,
        coalesce(sum(right_text), 0) AS correct_attempts,
        coalesce(sum(wrong_text), 0) AS uncorrect_attempts{CODE_COUNTS}
    FROM seen GROUP BY ALL),
p AS (SELECT game_session{props_sql(PROPS)} FROM {rows} GROUP BY game_session),
pairs AS (
    SELECT cut.*, n.title, n.type, n.world, p.* EXCLUDE (game_session),
        coalesce({t.group_rule('correct_attempts', 'uncorrect_attempts')}, 0) AS grp,
        CASE WHEN correct_attempts + uncorrect_attempts = 0 THEN 0.0
            ELSE CAST(correct_attempts AS DOUBLE) / (correct_attempts + uncorrect_attempts) END
            AS accuracy_rate
    FROM cut LEFT JOIN named n USING (installation_id, assessment_game_session, game_session)
    LEFT JOIN p ON p.game_session = cut.game_session)"""


EVENT_HISTORY = f"{t.EV}, {LABELS}, {targets_sql('kept')}, {event_pairs('kept')}"
TEST_EVENT_HISTORY = f"{t.EV}, {LABELS}, {TEST_TARGETS}, {event_pairs('te')}"
FIVE = h.STATS_AND_SUM
GROUP_COUNTS = [
    f"count(*) FILTER (WHERE grp = {k}) AS accuracy_group_{k}" for k in range(4)
]
CODE_TOTALS = stats_sql([code_column(c) for c in t.CODES], ("sum",))
G1_PARTS = [
    *stats_sql(fe.EVENT_METRICS, FIVE, fill=True),
    *stats_sql(fe.EVENT_METRICS, FIVE, where=SAME, prefix=fe.PREVIOUS, fill=True),
    *stats_sql(PROP_COLUMNS, FIVE, fill=True),
    *CODE_TOTALS,
    *GROUP_COUNTS,
    *occurrences_sql("cnt"),
]
G1_TARGET_COLUMNS = """assessment_title, assessment_world,
    coalesce(assessment_most_common_title_accuracy_group, 0)
        AS assessment_most_common_title_accuracy_group,
    coalesce(assessment_hour, 0) AS assessment_hour,
    coalesce(assessment_dayofweek, 0) AS assessment_dayofweek, sec AS assessment_start_timestamp,"""


def event_features(spark, sf_dir, limits=h.Limits()):
    labels = t.labels(spark, sf_dir)
    events = kept_events(spark, sf_dir, labels)
    return fe.features_from_events(events, labels, t.CODES, t.VOCABULARY, PROPS, limits)


def g1_columns(df, wanted):
    return df.select(h.DEVICE, h.TARGET, *[f"`{c}`" for c in wanted])


@query("asof_history_events", grouped(EVENT_HISTORY, stats_sql(fe.EVENT_METRICS, ("sum", "max"), fill=True)))
def asof_history_events(spark, sf_dir):
    wanted = [with_stat(c, s) for c in fe.EVENT_METRICS for s in ("sum", "max")]
    return g1_columns(event_features(spark, sf_dir), wanted)


@query(
    "history_stats_g1",
    grouped(
        EVENT_HISTORY,
        stats_sql(fe.EVENT_METRICS, FIVE, fill=True)
        + stats_sql(fe.EVENT_METRICS, FIVE, where=SAME, prefix=fe.PREVIOUS, fill=True),
    ),
)
def history_stats_g1(spark, sf_dir):
    wanted = [with_stat(p + c, s) for p in ("", fe.PREVIOUS) for c in fe.EVENT_METRICS for s in FIVE]
    return g1_columns(event_features(spark, sf_dir), wanted)


@query("history_code_totals", grouped(EVENT_HISTORY, CODE_TOTALS))
def history_code_totals(spark, sf_dir):
    return g1_columns(event_features(spark, sf_dir), [f"{code_column(c)}_sum" for c in t.CODES])


@query("accuracy_group_counts", grouped(EVENT_HISTORY, GROUP_COUNTS))
def accuracy_group_counts(spark, sf_dir):
    return g1_columns(event_features(spark, sf_dir), [f"accuracy_group_{k}" for k in range(4)])


@query("features_g1", grouped(EVENT_HISTORY, G1_PARTS, G1_TARGET_COLUMNS))
def features_g1(spark, sf_dir):
    return event_features(spark, sf_dir)


@query("features_g1_test", grouped(TEST_EVENT_HISTORY, G1_PARTS, G1_TARGET_COLUMNS))
def features_g1_test(spark, sf_dir):
    test = t.test_events(spark, sf_dir)
    labels = t.labels(spark, sf_dir)
    return fe.test_features_from_events(test, labels, t.CODES, t.VOCABULARY, PROPS)


# --- prepared tables ----------------------------------------------------------------


@query(
    "prep_g1",
    f"""WITH {t.EV}, {LABELS} SELECT event_id, game_session, timestamp, installation_id, event_count,
    event_code, game_time, title, type, world, right_text AS is_correct_attempt,
    wrong_text AS is_uncorrect_attempt FROM kept""",
)
def prep_g1(spark, sf_dir):
    """Flagged events of labelled devices."""
    events = kept_events(spark, sf_dir, t.labels(spark, sf_dir))
    return ev.flag_attempts(events, "text").drop("event_data")


@query(
    "sessions_g2b",
    f"""WITH {t.EV}, {LABELS}, {sessions_sql('kept', 's')}
    SELECT * EXCLUDE (grp, start, accuracy_rate, game_time_mean_diff, game_time_std_diff),
    {ONE_HOT_GROUPS}, round(accuracy_rate, 6) AS accuracy_rate,
    round(game_time_mean_diff, 6) AS game_time_mean_diff,
    round(game_time_std_diff, 6) AS game_time_std_diff FROM s""",
)
def sessions_g2b(spark, sf_dir):
    events = kept_events(spark, sf_dir, t.labels(spark, sf_dir))
    return se.sessions_with_ids(events, t.CODES, t.COUNTED)


@query(
    "sessions_g2a",
    f"""WITH {t.EV}, {LABELS}, {fold_sql('kept', ', greatest(0, max(game_time)) AS game_time'
    + CODE_COUNTS + props_sql())}
    SELECT * EXCLUDE (grp) REPLACE (round(accuracy_rate, 6) AS accuracy_rate), {ONE_HOT_GROUPS} FROM s""",
)
def sessions_g2a(spark, sf_dir):
    events = kept_events(spark, sf_dir, t.labels(spark, sf_dir))
    return se.sessions_with_props(events, t.CODES)
