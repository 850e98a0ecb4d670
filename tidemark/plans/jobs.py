"""End-to-end jobs from input files to tables, one stage each.

Inputs under `data`: train.csv, test.csv, train_labels.csv, specs.csv. Every job writes its
tables under `out` and the next one reads them back, so a job can be run again on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.fixed import CATEGORICAL, COUNTED_EVENT_IDS, EVENT_PROPS
from tidemark.functions.rules import truncated_settings
from tidemark.operators.correlate import correlated_columns
from tidemark.operators.encode import zero_importance
from tidemark.operators.events import (
    common_codes,
    flag_attempts,
    keep_devices,
    last_per_device,
    session_props,
)
from tidemark.operators.lookups import session_starts
from tidemark.operators import models as mo
from tidemark.operators.search import (
    BOUNDS,
    DRAWS,
    GROUP_BOUNDS,
    GROUP_DRAWS,
    GUIDED,
    PROBES,
    Settings,
    best_trial,
    candidates,
    ranked_trials,
    suggest,
)
from tidemark.operators.sessions import sessions_with_ids, sessions_with_props
from tidemark.operators.specs import property_map, report_rows
from tidemark.plans import features as fe
from tidemark.plans import predict as pr
from tidemark.sources import readers as rd
from tidemark.sources import writers as wr


LOGS = ("tuning_num_correct", "tuning_num_incorrect", "tuning_accuracy_group", "tuning_groups")


class Files:
    """The input files and the tables made from them."""

    def __init__(self, spark: SparkSession, data: str, out: str):
        self.spark, self.data, self.out = spark, data, out

    def events(self, name: str) -> DataFrame:
        return rd.csv_events(self.spark, f"{self.data}/{name}")

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def labels(self) -> DataFrame:
        return rd.csv_table(self.spark, f"{self.data}/train_labels.csv", schemas.LABELS)

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table under `out`, made by the first job that needs it and read by the others."""
        if not wr.exists(self.spark, self.path(name)):
            self.write(make(), name)
        return self.read(name)

    def train(self) -> DataFrame:
        """Events of labelled devices: the text file is read once, for whatever job is the first."""

        def make() -> DataFrame:
            return keep_devices(self.events("train.csv"), self.labels())

        return self.once("train_events", make)

    def test(self) -> DataFrame:
        return self.once("test_events", lambda: self.events("test.csv"))

    def specs(self) -> DataFrame:
        return rd.csv_table(self.spark, f"{self.data}/specs.csv", schemas.SPECS)

    def words(self) -> dict[str, list]:
        """Values of the training events that become columns, found in one pass."""
        columns = ("title", "type", "world", "event_code", "event_id")
        row = self.once(
            "vocabulary", lambda: self.train().agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])
        ).first()
        return {c: list(row[c]) for c in columns}

    def props(self) -> dict:
        """Declared properties by event: what `describe-specs` found, else the known ones."""
        if not wr.exists(self.spark, self.path("event_props")):
            return EVENT_PROPS
        return rd.props_by_event(rd.property_lists(self.spark, self.path("event_props")))

    def write(self, df: DataFrame, name: str) -> None:
        wr.table(df, self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def vocabulary(files: Files) -> dict[str, list]:
    words = files.words()
    return {c: words[c] for c in ("title", "type", "world")}


def prepare_events(files: Files) -> None:
    """Flagged events without payload, payload sums per session, codes both sets share."""
    train, test, props = files.train(), files.test(), files.props()
    files.write(common_codes(train, test), "event_codes")
    for name, events in (("train", train), ("test", test)):
        files.write(flag_attempts(events, "text").drop("event_data"), name)
        files.write(session_props(events, props), f"{name}_session_props")


def prepare_sessions(files: Files) -> None:
    """Session tables with code and id counts, and the assessments to predict."""
    train, test, words = files.train(), files.test(), files.words()
    seen = set(words["event_id"])
    ids = [e for e in COUNTED_EVENT_IDS if e in seen]
    files.write(sessions_with_ids(train, words["event_code"], ids), "train_sessions")
    files.write(sessions_with_ids(test, words["event_code"], ids), "test_sessions")
    files.write(last_per_device(test), "test_assessments")


def prepare_sessions_with_props(files: Files) -> None:
    """Session tables with code counts and payload sums."""
    codes, props = files.words()["event_code"], files.props()
    files.write(sessions_with_props(files.train(), codes, props), "train_prop_sessions")
    files.write(sessions_with_props(files.test(), codes, props), "test_prop_sessions")


def features(files: Files) -> None:
    """Session-level features; training features that are already there are kept."""
    train, test, labels = files.read("train_sessions"), files.read("test_sessions"), files.labels()
    words = vocabulary(files)
    if not wr.exists(files.spark, files.path("train_features")):
        targets = fe.train_targets(labels, train, session_starts(train))
        files.write(fe.session_features(train, targets, words), "train_features")
    targets = fe.test_targets(files.read("test_assessments"), labels)
    files.write(fe.session_features(test, targets, words), "test_features")


def event_features(files: Files) -> None:
    """Event-level features."""
    labels, props = files.labels(), files.props()
    codes, words = files.words()["event_code"], vocabulary(files)
    make = fe.features_from_events(files.train(), labels, codes, words, props)
    files.write(make, "train_event_features")
    make = fe.test_features_from_events(files.test(), labels, codes, words, props)
    files.write(make, "test_event_features")


def predict(files: Files, folds: int = 5, rounds: int = mo.ROUNDS) -> DataFrame:
    """Two models per fold, the rule, and the majority vote; returns the mean kappa."""
    tables = files.read("train_features"), files.read("test_features")
    train, test, _ = pr.matrices(*tables, files.labels())
    score, votes = pr.predict_by_rule(*pr.out_of_fold(train, test, folds, rounds))
    wr.predictions(votes, files.path("submission"))
    return score


def prune_list(files: Files) -> None:
    """Event-level features that an earlier one nearly repeats."""
    train = files.read("train_event_features")
    names = [c for c in train.columns if c not in (*pr.IDS, *CATEGORICAL)]
    files.write(correlated_columns(train, names), "correlated_features")


def group_matrices(files: Files) -> tuple[DataFrame, DataFrame, list[str]]:
    """Event-level matrices without the columns that earlier runs found useless."""
    without = []
    if wr.exists(files.spark, files.path("correlated_features")):
        without += [r["feature"] for r in files.read("correlated_features").collect()]
    if wr.exists(files.spark, files.path("feature_importances")):
        without += zero_importance(files.read("feature_importances"))
    tables = files.read("train_event_features"), files.read("test_event_features")
    return pr.matrices(*tables, files.labels(), without=without)


def predict_groups(files: Files, folds: int = 10, trees: int = mo.TREES) -> DataFrame:
    """The four-class model: mean-probability vote and importances; returns the mean kappa."""
    train, test, columns = group_matrices(files)
    scores, votes, weights = pr.group_model_run(train, test, columns, folds, trees)
    wr.predictions(votes, files.path("group_submission"))
    files.write(weights, "feature_importances")
    return scores.agg(F.avg("kappa").alias("mean_score"))


def _search(
    files: Files,
    log: str,
    points: list[Settings],
    guided: int,
    suggested: Callable[[list[tuple[Settings, float]]], Settings],
    trial: Callable[[Settings], DataFrame],
) -> None:
    """Tries `points`, then `guided` more that `suggested` makes of the log.

    Every trial is appended to the log when it ends, and the next point follows from the log, so
    a second run goes on where the first ended and adds no trial twice.
    """
    wanted = [{k: float(v) for k, v in p.items()} for p in points]
    while True:
        logged = []
        if wr.exists(files.spark, files.path(log)):
            rows = rd.tuning_log(files.spark, files.path(log)).select("params", "target").collect()
            logged = [(dict(row["params"]), row["target"]) for row in rows]
        done = [settings for settings, _ in logged]
        left = [p for p, w in zip(points, wanted, strict=True) if w not in done]
        if not left and sum(s not in wanted for s in done) >= guided:
            return
        wr.tuning_log(trial(left[0] if left else suggested(logged)), files.path(log))


def best_trials(files: Files) -> DataFrame:
    """The best trial of every search that has a log."""
    logs = [n for n in LOGS if wr.exists(files.spark, files.path(n))]
    found = [
        best_trial(rd.tuning_log(files.spark, files.path(n))).select(F.lit(n).alias("log"), "target", "params")
        for n in logs
    ]
    if not found:
        raise ValueError("no search has been run yet")
    return reduce(DataFrame.unionByName, found)


def tune(
    files: Files, draws: int = DRAWS, guided: int = GUIDED, folds: int = 5, rounds: int = mo.ROUNDS, trees: int = mo.TREES
) -> DataFrame:
    """Search the settings of the three models; returns the best trials.

    Probes and draws come first, then points of the largest expected improvement. A second run
    goes on where the first ended.
    """
    tables = files.read("train_features"), files.read("test_features")
    train, _, _ = pr.matrices(*tables, files.labels())
    nested = pr.nested_rows(train, folds)
    for target, probes in PROBES.items():
        points = candidates(BOUNDS, draws, probes)

        def trial(point: Settings, target: str = target) -> DataFrame:
            return pr.tune(nested, target, [point], folds, rounds, trees)

        _search(files, f"tuning_{target}", points, guided if points else 0, partial(suggest, BOUNDS), trial)
    return best_trials(files)


def tune_groups(files: Files, draws: int = GROUP_DRAWS, guided: int = GUIDED, trees: int = mo.TREES) -> DataFrame:
    """Search the settings of the four-class model on event-level features, as `tune` does."""
    train, _, _ = group_matrices(files)
    points = candidates(GROUP_BOUNDS, draws, whole=truncated_settings)
    low, high = (int(n) for n in GROUP_BOUNDS["n_splits"])
    placed = pr.folds_by_number(train, range(low, high + 1) if guided else (int(p["n_splits"]) for p in points))
    suggested = partial(suggest, GROUP_BOUNDS, whole=truncated_settings)
    _search(files, "tuning_groups", points, guided, suggested, lambda p: pr.tune_group_model(placed, [p], trees))
    return best_trials(files)


def rank_log(files: Files) -> DataFrame:
    """Every log with its best trial first; returns the best trials."""
    best = best_trials(files)
    for name in LOGS:
        if wr.exists(files.spark, files.path(name)):
            files.write(ranked_trials(rd.tuning_log(files.spark, files.path(name))), f"ranked_{name}")
    return best


def describe_specs(files: Files) -> None:
    """The property map and the report rows of the event specifications."""
    wr.config(property_map(files.specs()), files.path("event_props"))
    report_rows(files.specs()).select("html").write.mode("overwrite").text(files.path("specs_html"))


JOBS: dict[str, Callable[[Files], DataFrame | None]] = {
    "prepare-events": prepare_events,
    "prepare-sessions": prepare_sessions,
    "prepare-sessions-with-props": prepare_sessions_with_props,
    "features": features,
    "event-features": event_features,
    "predict": predict,
    "prune-list": prune_list,
    "predict-groups": predict_groups,
    "tune": tune,
    "tune-groups": tune_groups,
    "rank-log": rank_log,
    "describe-specs": describe_specs,
}
