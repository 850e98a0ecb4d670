"""Feature tables: from sessions (whole history) or from events (history cut by event)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import GROUP_LABELS, NO_TITLE, NO_TYPE, NO_WORLD
from tidemark.functions.naming import (
    literal,
    prop_columns,
    quoted,
    reject_case_twins,
    starting_with,
)
from tidemark.functions.rules import accuracy_group, accuracy_rate, epoch_seconds, time_features
from tidemark.operators import history as h
from tidemark.operators.events import flag_attempts, last_per_device
from tidemark.operators.lookups import (
    common_group_by_title,
    first_by_title,
    lookup,
    lookup_strict,
    session_starts,
    with_session_start,
)
from tidemark.operators.running import session_states, whole_sessions
from tidemark.session import stage

SESSION_METRICS = ("game_time", "event_count", "game_time_mean_diff", "game_time_std_diff")
ATTEMPT_METRICS = ("correct_attempts", "uncorrect_attempts", "accuracy_rate")
EVENT_METRICS = ("game_time", "event_count", *ATTEMPT_METRICS)
PREVIOUS = "assessment_previous_"
COPIED = (
    "assessment_most_common_title_accuracy_group",
    "assessment_dayofweek",
    "assessment_hour",
    "assessment_title",
    "assessment_world",
)


def named_targets(assessments: DataFrame) -> DataFrame:
    """Assessments as targets: session, title and world take the assessment_ prefix."""
    return assessments.withColumnsRenamed(
        {"game_session": h.TARGET, "title": "assessment_title", "world": "assessment_world"}
    ).select(h.DEVICE, h.TARGET, F.col("timestamp").alias("sec"), *COPIED)


def train_targets(labels: DataFrame, sessions: DataFrame, starts: DataFrame) -> DataFrame:
    """Labelled assessments with the title's world and usual group, and when they started.

    A label whose session is unknown has no start, hence no history.
    """
    worlds = first_by_title(sessions, ["world"])
    assessments = lookup_strict(labels.drop("type", "world"), worlds)
    assessments = lookup(assessments, common_group_by_title(labels))
    return named_targets(time_features(with_session_start(assessments, starts)))


def test_targets(last_events: DataFrame, labels: DataFrame) -> DataFrame:
    """The last event of each device as the assessment to predict."""
    assessments = lookup(last_events, common_group_by_title(labels))
    return named_targets(time_features(assessments))


def _counts_of_values(vocabulary: dict[str, Sequence[str]], prefix: str) -> list[h.Measure]:
    reject_case_twins([v for values in vocabulary.values() for v in values])
    return [m for column, values in vocabulary.items() for m in h.occurrences(column, values, prefix)]


def _placeholders(prefix: str) -> dict:
    empty = (F.col("n_history") == 0).cast("double")
    return {f"{prefix}_{name}_sum": empty for name in (NO_TITLE, NO_TYPE, NO_WORLD)}


def session_measures(columns: Iterable[str], vocabulary: dict[str, Sequence[str]]) -> list[h.Measure]:
    """Every feature of the session-level history."""
    return [
        *h.of_columns(SESSION_METRICS),
        *h.of_columns(starting_with(columns, "cnt")),
        *h.of_columns(ATTEMPT_METRICS, over=h.ASSESSMENTS),
        *h.of_columns(ATTEMPT_METRICS, over=h.SAME_TITLE, prefix=PREVIOUS),
        *_counts_of_values(vocabulary, "ttw"),
    ]


def session_features(
    sessions: DataFrame,
    targets: DataFrame,
    vocabulary: dict[str, Sequence[str]],
    limits: h.Limits = h.Limits(),
) -> DataFrame:
    """Features over whole sessions that began before the target; missing ones stay null.

    `sessions` is read several times: pass a staged table. `vocabulary` lists the titles,
    types and worlds that get a count column.
    """
    past = sessions.withColumn(h.POS, epoch_seconds(F.col("timestamp")))
    asked = stage(targets.withColumnRenamed("sec", h.POS), "targets")
    measures = session_measures(sessions.columns, vocabulary)
    features = h.history_features(past, asked, measures, limits)
    return features.withColumns(_placeholders("ttw")).drop("n_history", h.POS)


def event_measures(
    columns: Iterable[str], vocabulary: dict[str, Sequence[str]], props: Iterable[str]
) -> list[h.Measure]:
    """Every feature of the event-level history."""
    five = h.STATS_AND_SUM
    return [
        *h.of_columns(EVENT_METRICS, five),
        *h.of_columns(EVENT_METRICS, five, over=h.SAME_TITLE, prefix=PREVIOUS),
        *h.of_columns(props, five),
        *h.of_columns(starting_with(columns, "cnt_event_code"), ("sum",)),
        *[
            h.Measure(f"accuracy_group_{k}", h.times("accuracy_group", k), ("n",))
            for k in GROUP_LABELS
        ],
        *_counts_of_values(vocabulary, "cnt"),
    ]


def _scored(right: Column, wrong: Column) -> dict[str, Column]:
    """Accuracy of a session; without an attempt it counts as group 0 here."""
    return {
        "accuracy_rate": accuracy_rate(right, wrong),
        "accuracy_group": F.coalesce(accuracy_group(right, wrong), F.lit(0)),
    }


def _with_scores(states: DataFrame) -> DataFrame:
    names = ("correct_attempts", "uncorrect_attempts")
    states = states.withColumns(_scored(*[F.col(c) for c in names]))
    if "before" not in states.columns:
        return states
    before = F.col("before")
    scored = before
    for name, value in _scored(*[before[c] for c in names]).items():
        scored = scored.withField(name, value)
    return states.withColumn("before", F.when(before.isNotNull(), scored))


def event_features(
    events: DataFrame,
    sessions: DataFrame,
    targets: DataFrame,
    codes: Sequence[object],
    vocabulary: dict[str, Sequence[str]],
    props: dict[str, Sequence[str]],
    limits: h.Limits = h.Limits(),
) -> DataFrame:
    """Features over events before the target, summed to sessions as far as they had come.

    A session still running counts cut short, but with its whole payload sums. Missing
    features are 0, and a target without history counts as one session of group 0.
    """
    targets = stage(targets, "targets")
    states, asked = session_states(events, sessions, targets, codes, props)
    states, asked = stage(_with_scores(states), "states"), stage(asked, "asked")
    measures = event_measures(states.columns, vocabulary, prop_columns(props))
    features = h.history_features(states, asked, measures, limits)
    lonely = (F.col("n_history") == 0).cast("bigint")
    features = features.withColumns(
        {**_placeholders("cnt"), "accuracy_group_0": F.col("accuracy_group_0") + lonely}
    ).drop("n_history", h.POS)
    filled = [
        f"coalesce({quoted(c)}, CAST(0 AS {kind})) AS {quoted(c)}"
        if kind in ("double", "int", "bigint") and c != "sec"
        else quoted(c)
        for c, kind in features.dtypes
    ]
    return features.selectExpr(*filled).withColumnRenamed("sec", "assessment_start_timestamp")


def features_from_sessions(
    train_sessions: DataFrame,
    labels: DataFrame,
    vocabulary: dict[str, Sequence[str]],
    limits: h.Limits = h.Limits(),
) -> DataFrame:
    """Training features, session-level history."""
    starts = session_starts(train_sessions)
    targets = train_targets(labels, train_sessions, starts)
    return session_features(train_sessions, targets, vocabulary, limits)


def test_features_from_sessions(
    test_sessions: DataFrame,
    test_events: DataFrame,
    labels: DataFrame,
    vocabulary: dict[str, Sequence[str]],
    limits: h.Limits = h.Limits(),
) -> DataFrame:
    """Features of the assessments to predict, with the training columns."""
    targets = test_targets(last_per_device(test_events), labels)
    return session_features(test_sessions, targets, vocabulary, limits)


def _flagged(events: DataFrame) -> DataFrame:
    return flag_attempts(events, "text").withColumn("sec", epoch_seconds(F.col("timestamp")))


def features_from_events(
    train_events: DataFrame,
    labels: DataFrame,
    codes: Sequence[object],
    vocabulary: dict[str, Sequence[str]],
    props: dict[str, Sequence[str]],
    limits: h.Limits = h.Limits(),
) -> DataFrame:
    """Training features, event-level history."""
    flagged = _flagged(train_events)
    sessions = whole_sessions(flagged, codes, props)
    starts = sessions.select(h.DEVICE, "game_session", "timestamp")
    targets = train_targets(labels, sessions, starts)
    return event_features(flagged, sessions, targets, codes, vocabulary, props, limits)


def test_features_from_events(
    test_events: DataFrame,
    labels: DataFrame,
    codes: Sequence[object],
    vocabulary: dict[str, Sequence[str]],
    props: dict[str, Sequence[str]],
    limits: h.Limits = h.Limits(),
) -> DataFrame:
    """Features of the assessments to predict, event-level history."""
    flagged = _flagged(test_events)
    sessions = whole_sessions(flagged, codes, props)
    targets = test_targets(last_per_device(test_events), labels)
    return event_features(flagged, sessions, targets, codes, vocabulary, props, limits)


def time_by_value(
    sessions: DataFrame,
    targets: DataFrame,
    column: str,
    values: Iterable[str],
    stats: Sequence[str] = ("sum", "mean", "max"),
    limits: h.Limits = h.Limits(),
) -> DataFrame:
    """Game time and event count of the history, one column per stat, metric and value."""
    past = sessions.withColumn(h.POS, epoch_seconds(F.col("timestamp")))
    names, measures = {}, []
    for metric in ("game_time", "event_count"):
        for value in values:
            where = f"CASE WHEN {quoted(column)} = {literal(value)} THEN {metric} END"
            measure = h.Measure(f"{metric}_{value}", where, stats)
            measures.append(measure)
            names.update({c: f"{stat}_{measure.name}" for c, stat in measure.columns().items()})
    asked = stage(targets.withColumnRenamed("sec", h.POS), "targets")
    features = h.history_features(past, asked, measures, limits)
    return features.select(
        h.DEVICE,
        h.TARGET,
        *[F.coalesce(F.col(quoted(c)), F.lit(0.0)).alias(name) for c, name in names.items()],
    )
