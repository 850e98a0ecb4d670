"""Queries on wide tables: encoding, pruning, correlation, folds and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import telemetry as t
from checks.event_queries import CODE_COUNTS, fold_sql
from checks.history_queries import LABELS
from checks.registry import query
from tidemark.functions import rules
from tidemark.functions.naming import code_column
from tidemark.operators import encode as en
from tidemark.operators import events as ev
from tidemark.operators import folds as fo
from tidemark.operators import metrics as me
from tidemark.operators import sessions as se
from tidemark.operators.correlate import correlated_columns, correlations
from tidemark.session import stage

SESSIONS = fold_sql("fl", ", max(game_time) AS game_time" + CODE_COUNTS)
CODE_COLUMNS = [code_column(c) for c in t.CODES]


def sessions(spark, sf_dir):
    flagged = ev.flag_attempts(t.telemetry(spark, sf_dir))
    extra = [F.max("game_time").alias("game_time"), *ev.code_counts(t.CODES)]
    return se.with_accuracy(se.fold(flagged, extra))


# --- columns ------------------------------------------------------------------


def _prefix_sql() -> str:
    parts = [
        f"round({fn}({c}), 6) AS {c}_{stat}"
        for c in CODE_COLUMNS
        for stat, fn in (("std", "stddev_samp"), ("mean", "avg"))
    ]
    parts += [f"max({c}) AS {c}_max" for c in CODE_COLUMNS]
    parts += [f"CAST(sum({c}) AS BIGINT) AS {c}_sum" for c in ("correct_attempts",)]
    return ", ".join(parts)


@query(
    "agg_by_prefix",
    f"WITH {t.EV}, {SESSIONS} SELECT installation_id, {_prefix_sql()} FROM s GROUP BY 1",
)
def agg_by_prefix(spark, sf_dir):
    return en.aggregate_by_prefix(
        sessions(spark, sf_dir),
        ["installation_id"],
        {"cnt": ("std", "mean", "max"), "correct": ("sum",)},
    )


@query(
    "fill_zero",
    f"""WITH {t.EV}, {SESSIONS} SELECT game_session,
    coalesce(CASE WHEN type = 'Assessment' THEN game_time END, 0) AS game_time,
    CASE WHEN type = 'Assessment' THEN title END AS title FROM s""",
)
def fill_zero(spark, sf_dir):
    df = sessions(spark, sf_dir)
    only = F.col("type") == "Assessment"
    return en.fill_zero(
        df.select(
            "game_session",
            F.when(only, F.col("game_time")).alias("game_time"),
            F.when(only, F.col("title")).alias("title"),
        )
    )


@query(
    "one_hot",
    f"""WITH {t.EV}, {SESSIONS} SELECT game_session, {", ".join(
        f"CAST(coalesce(title = '{v}', false) AS INTEGER) AS " + '"ttw_' + v + '"'
        for v in t.VOCABULARY["title"])} FROM s""",
)
def one_hot(spark, sf_dir):
    titles = sessions(spark, sf_dir).select("game_session", "title")
    return en.one_hot(titles, "title", t.VOCABULARY["title"], "ttw")


@query(
    "label_encode",
    f"""WITH {t.EV}, {SESSIONS}, codes AS (
        SELECT world, row_number() OVER (ORDER BY world) - 1 AS code FROM (SELECT DISTINCT world FROM tr))
    SELECT game_session, CAST(code AS INTEGER) AS world FROM s JOIN codes USING (world)
    WHERE CAST(installation_id AS BIGINT) % 5 = 0""",
)
def label_encode(spark, sf_dir):
    train = t.train_events(spark, sf_dir).select("world").distinct()
    test = sessions(spark, sf_dir).filter(F.col("installation_id").cast("bigint") % 5 == 0)
    return en.label_encode(train, test.select("game_session", "world"), columns=["world"])[1]


@query(
    "prune_features",
    f"""WITH {t.EV}, {SESSIONS} SELECT * EXCLUDE (grp, accuracy_rate, cnt_event_code_4020,
    cnt_event_code_4070, timestamp) FROM s""",
)
def prune_features(spark, sf_dir):
    """Drops columns by importance; the importances come from the data (0 where no error code)."""
    df = sessions(spark, sf_dir).drop("accuracy_rate", *[f"accuracy_group_{k}" for k in range(4)])
    weights = ev_importances(spark, sf_dir)
    return en.prune(df, en.zero_importance(weights), ["timestamp", "a column it never had"])


def ev_importances(spark, sf_dir):
    """A made importance per code: how often it is an attempt's code."""
    events = t.telemetry(spark, sf_dir)
    return events.groupBy("event_code").agg(
        F.count_if(F.col("event_code").isin(2000, 4100, 4110)).cast("double").alias("importance")
    ).select(F.concat(F.lit("cnt_event_code_"), "event_code").alias("feature"), "importance")


@query("align_schema", f"WITH {t.EV}, {SESSIONS} SELECT world, game_session, game_time FROM s")
def align_schema(spark, sf_dir):
    return en.align(sessions(spark, sf_dir), ["world", "game_session", "game_time"])


@query(
    "union_by_name",
    f"""WITH {t.EV} SELECT game_session, title, NULL AS world FROM tr
    UNION ALL SELECT game_session, NULL, world FROM te""",
)
def union_by_name(spark, sf_dir):
    train = t.train_events(spark, sf_dir).select("game_session", "title")
    test = t.test_events(spark, sf_dir).select("game_session", "world")
    return en.stack_rows(train, test)


@query(
    "join_labels",
    f"""WITH {t.EV}, {LABELS}, {SESSIONS} SELECT s.installation_id, s.game_session AS assessment_game_session,
    s.game_time, l.accuracy_group AS target
    FROM s JOIN labels_t l ON l.installation_id = s.installation_id AND l.game_session = s.game_session""",
)
def join_labels(spark, sf_dir):
    features = sessions(spark, sf_dir).select(
        "installation_id", F.col("game_session").alias("assessment_game_session"), "game_time"
    )
    return en.train_matrix(features, t.labels(spark, sf_dir), {"accuracy_group": "target"})


@query(
    "train_matrix",
    f"""WITH {t.EV}, {LABELS}, {SESSIONS}, codes AS (
        SELECT title, row_number() OVER (ORDER BY title) - 1 AS code FROM (SELECT DISTINCT title FROM s))
    SELECT s.installation_id, s.game_session AS assessment_game_session, s.game_time,
        CAST(code AS INTEGER) AS title, {", ".join(CODE_COLUMNS)},
        l.num_correct, l.num_incorrect, l.accuracy_group
    FROM s JOIN labels_t l USING (installation_id, game_session) JOIN codes ON codes.title = s.title""",
)
def train_matrix(spark, sf_dir):
    df = sessions(spark, sf_dir).select(
        "installation_id",
        F.col("game_session").alias("assessment_game_session"),
        "game_time",
        "title",
        *CODE_COLUMNS,
    )
    encoded = en.label_encode(df, columns=["title"])[0]
    targets = {c: c for c in ("num_correct", "num_incorrect", "accuracy_group")}
    return en.train_matrix(encoded, t.labels(spark, sf_dir), targets)


# --- correlation ----------------------------------------------------------------

NUMBERS = {
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "twice": "2 * l_quantity + l_discount",
    "negated": "l_tax - l_quantity",
    "discount": "l_discount",
    "one": "1",
    "gaps": "CASE WHEN l_linenumber % 3 > 0 THEN l_extendedprice + l_quantity END",
    "tax": "l_tax",
    "flat_gaps": "CASE WHEN l_linenumber % 2 = 0 THEN 0.1 END",
    "line": "l_linenumber",
}
NUMBERS_SQL = "n AS (SELECT " + ", ".join(
    f"CAST({x} AS DOUBLE) AS {c}" for c, x in NUMBERS.items()
) + " FROM lineitem)"


def _pairs_sql() -> str:
    names = list(NUMBERS)
    return " UNION ALL ".join(
        f"SELECT '{a}' AS earlier, '{b}' AS later, {i} AS i, {j} AS j, "
        f"CASE WHEN isfinite(corr({a}, {b})) THEN corr({a}, {b}) END AS r FROM n"
        for i, a in enumerate(names)
        for j, b in enumerate(names)
        if i < j
    )


def numbers(spark, sf_dir):
    lines = t.read(spark, sf_dir, "lineitem")
    return lines.selectExpr(*[f"CAST({x} AS DOUBLE) AS {c}" for c, x in NUMBERS.items()])


@query(
    "correlation_pairs",
    f"WITH {NUMBERS_SQL} SELECT earlier, later, i, j, round(r, 6) AS r FROM ({_pairs_sql()})",
)
def correlation_pairs(spark, sf_dir):
    return correlations(numbers(spark, sf_dir), list(NUMBERS))


@query(
    "correlated_drop_list",
    f"WITH {NUMBERS_SQL} SELECT DISTINCT later AS feature FROM ({_pairs_sql()}) WHERE abs(r) > 0.9",
)
def correlated_drop_list(spark, sf_dir):
    return correlated_columns(numbers(spark, sf_dir), list(NUMBERS))


# --- folds ------------------------------------------------------------------------

FOLD_COUNTS = """gc AS (
    SELECT installation_id, """ + ", ".join(
    f"count(*) FILTER (WHERE accuracy_group = {k}) AS label_{k}" for k in range(4)
) + """ FROM labels_t GROUP BY 1),
gs AS (SELECT *, (label_0 + label_1 + label_2 + label_3) / 4.0 AS m FROM gc),
sp AS (SELECT * EXCLUDE (m), sqrt(((label_0 - m) * (label_0 - m) + (label_1 - m) * (label_1 - m)
    + (label_2 - m) * (label_2 - m) + (label_3 - m) * (label_3 - m)) / 4) AS spread FROM gs)"""
DEAL = """ORDER BY spread DESC, label_0, label_1, label_2, label_3,
    md5(installation_id || ':2019'), installation_id"""
STRATIFIED = f"""{t.EV}, {LABELS}, {FOLD_COUNTS}, fold_t AS (
    SELECT installation_id, label_0, label_1, label_2, label_3,
        CAST((row_number() OVER ({DEAL}) - 1) % 5 AS INTEGER) AS fold FROM sp)"""


@query(
    "fold_label_counts",
    f"WITH {t.EV}, {LABELS}, {FOLD_COUNTS} SELECT * REPLACE (round(spread, 6) AS spread) FROM sp",
)
def fold_label_counts(spark, sf_dir):
    return fo.label_counts(t.labels(spark, sf_dir), "installation_id", "accuracy_group")


@query("stratified_group_fold", f"WITH {STRATIFIED} SELECT * FROM fold_t")
def stratified_group_fold(spark, sf_dir):
    return fo.stratified_folds(t.labels(spark, sf_dir), 5)


@query(
    "balanced_group_fold",
    f"""WITH {t.EV}, {LABELS}, c AS (
        SELECT installation_id, {", ".join(f"count(*) FILTER (accuracy_group = {x}) AS label_{x}" for x in range(4))}
        FROM labels_t GROUP BY 1)
    SELECT label_0, label_1, label_2, label_3, count(*) AS devices, true AS no_worse
    FROM c GROUP BY 1, 2, 3, 4""",
)
def balanced_group_fold(spark, sf_dir):
    """Devices by label counts, and whether the folds' shares of the labels are at least as alike as
    those of dealing in turn."""
    labels = t.labels(spark, sf_dir)
    names = [f"label_{x}" for x in range(4)]
    placed = stage(fo.balanced_folds(labels, 5), "placed")

    def uneven(folds):
        sums = folds.groupBy("fold").agg(*[F.sum(c).alias(c) for c in names]).select(*names).toPandas()
        return fo.unevenness(sums.to_numpy(dtype=float))

    no_worse = bool(uneven(placed) <= uneven(fo.stratified_folds(labels, 5)))
    once = F.count("*") == F.countDistinct("installation_id")
    return placed.groupBy(*names).agg(F.count("*").alias("devices"), (once & F.lit(no_worse)).alias("no_worse"))


# From the largest group down, each to the fold with the fewest rows; of groups of one size, the
# first ones in the order of a digest go to the first fold that gets any.
HEAP_FOLDS = """z AS (SELECT installation_id, count(*) AS size FROM labels_t GROUP BY 1),
    placed AS (SELECT *, row_number() OVER (ORDER BY size DESC, md5(installation_id || ':2019'), installation_id) AS rn,
        row_number() OVER (PARTITION BY size ORDER BY md5(installation_id || ':2019'), installation_id) AS nth FROM z),
    dealing AS (
        SELECT CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS size, CAST(0 AS BIGINT) AS fold,
            list_transform(range(10), lambda x: CAST(0 AS BIGINT)) AS loads
        UNION ALL
        SELECT p.rn, p.size, CAST(list_position(loads, list_min(loads)) AS BIGINT) AS fold,
            list_transform(loads, lambda x, i: x + CASE WHEN i = list_position(loads, list_min(loads)) THEN p.size ELSE 0 END)
        FROM dealing d JOIN placed p ON p.rn = d.rn + 1),
    shares AS (SELECT size, fold, sum(count(*)) OVER (PARTITION BY size ORDER BY fold) AS upto
        FROM dealing WHERE rn > 0 GROUP BY size, fold)"""


@query(
    "group_fold",
    f"""WITH RECURSIVE {t.EV}, {LABELS}, {HEAP_FOLDS}
    SELECT installation_id, p.size, CAST(min(fold) - 1 AS INTEGER) AS fold
    FROM placed p JOIN shares s ON p.size = s.size AND p.nth <= s.upto GROUP BY installation_id, p.size""",
)
def group_fold(spark, sf_dir):
    return fo.group_folds(t.labels(spark, sf_dir), 10)


@query(
    "group_fold_load",
    f"""WITH RECURSIVE {t.EV}, {LABELS}, {HEAP_FOLDS}
    SELECT CAST(list_max(loads) AS BIGINT) AS most, CAST(list_min(loads) AS BIGINT) AS least
    FROM dealing WHERE rn = (SELECT max(rn) FROM dealing)""",
)
def group_fold_load(spark, sf_dir):
    """Rows of the fullest and of the emptiest fold."""
    loads = fo.group_folds(t.labels(spark, sf_dir), 10).groupBy("fold").agg(F.sum("size").alias("rows"))
    return loads.agg(F.max("rows").alias("most"), F.min("rows").alias("least"))


@query(
    "nested_fold",
    f"""WITH {STRATIFIED} SELECT f.*, CAST((row_number() OVER (PARTITION BY fold {DEAL}) - 1) % 2
        AS INTEGER) AS half FROM fold_t f JOIN (SELECT installation_id, spread FROM sp) USING (installation_id)""",
)
def nested_fold(spark, sf_dir):
    labels = t.labels(spark, sf_dir)
    outer = fo.stratified_folds(labels, 5)
    return fo.stratified_folds(fo.with_fold(labels, outer), 2, within="fold", name="half")


@query(
    "fold_train_test",
    f"""WITH {STRATIFIED}, r AS (SELECT l.*, fold FROM labels_t l JOIN fold_t USING (installation_id))
    SELECT CAST(k AS INTEGER) AS held_fold, fold = k AS held, installation_id, game_session
    FROM r, range(5) x(k)""",
)
def fold_train_test(spark, sf_dir):
    labels = t.labels(spark, sf_dir)
    placed = fo.with_fold(labels, fo.stratified_folds(labels, 5))
    parts = None
    for k in range(5):
        for held, part in enumerate(fo.split(placed, k)):
            rows = part.select(
                F.lit(k).alias("held_fold"),
                F.lit(bool(held)).alias("held"),
                "installation_id",
                "game_session",
            )
            parts = rows if parts is None else parts.unionByName(rows)
    return parts


# --- predictions and scores -------------------------------------------------------

# A truth, a guess, a score and a fold for each event.
PREDICTIONS = """pr AS (
    SELECT event_id AS id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        CAST(event_id % 5 AS INTEGER) AS fold FROM events),
pd AS (SELECT id, user_id, fold, k % 4 AS truth,
    CASE WHEN id % 3 = 0 THEN k % 4 ELSE CAST((id + k) % 4 AS INTEGER) END AS guess,
    CAST(k % 2 AS INTEGER) AS yes, CAST((k * 7 + id) % 50 AS DOUBLE) / 50 AS score FROM pr)"""


def predictions(spark, sf_dir):
    k, row = F.col("k"), F.col("id")
    return (
        t.read(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("id"),
            "user_id",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            (F.col("event_id") % 5).cast("int").alias("fold"),
        )
        .select(
            "id",
            "user_id",
            "fold",
            (k % 4).alias("truth"),
            F.when(row % 3 == 0, k % 4).otherwise(((row + k) % 4).cast("int")).alias("guess"),
            (k % 2).alias("yes"),
            (((k * 7 + row) % 50).cast("double") / 50).alias("score"),
        )
    )


@query(
    "metric_qwk",
    f"""WITH {PREDICTIONS} SELECT fold, round(1 - sum((truth - guess) * (truth - guess))
        / (sum(truth * truth) + sum(guess * guess)
        - 2 * sum(truth) * CAST(sum(guess) AS DOUBLE) / count(*)), 6) AS kappa FROM pd GROUP BY fold""",
)
def metric_qwk(spark, sf_dir):
    return me.weighted_kappa(predictions(spark, sf_dir), "truth", "guess", by=["fold"])


@query(
    "cv_mean_score",
    f"""WITH {PREDICTIONS} SELECT round(avg(kappa), 6) AS mean_score FROM (SELECT fold,
        1 - sum((truth - guess) * (truth - guess)) / (sum(truth * truth) + sum(guess * guess)
        - 2 * sum(truth) * CAST(sum(guess) AS DOUBLE) / count(*)) AS kappa FROM pd GROUP BY fold)""",
)
def cv_mean_score(spark, sf_dir):
    kappas = me.weighted_kappa(predictions(spark, sf_dir), "truth", "guess", by=["fold"])
    return me.mean_score(kappas, "kappa")


AUC_SQL = """round((sum(r) - p * (p + 1) / 2.0) / (p * n), 6) AS auc FROM (
    SELECT yes, (rank() OVER (ORDER BY {score}) + rank() OVER (ORDER BY {score})
        + count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r,
        count(*) FILTER (WHERE yes = 1) OVER () AS p, count(*) FILTER (WHERE yes = 0) OVER () AS n
    FROM pd) WHERE yes = 1 GROUP BY p, n"""


@query("metric_auc", f"WITH {PREDICTIONS} SELECT {AUC_SQL.format(score='score')}")
def metric_auc(spark, sf_dir):
    return me.area_under_roc(predictions(spark, sf_dir), "yes", "score")


@query("metric_auc_labels", f"WITH {PREDICTIONS} SELECT {AUC_SQL.format(score='(guess >= 2)')}")
def metric_auc_labels(spark, sf_dir):
    df = predictions(spark, sf_dir).withColumn("hard", (F.col("guess") >= 2).cast("int"))
    return me.area_under_roc(df, "yes", "hard")


@query(
    "metric_rmse",
    f"""WITH {PREDICTIONS} SELECT fold, round(sqrt(avg((truth - score) * (truth - score))), 6) AS rmse
    FROM pd GROUP BY fold""",
)
def metric_rmse(spark, sf_dir):
    return me.root_mean_square_error(predictions(spark, sf_dir), "truth", "score", by=["fold"])


@query(
    "vote_majority",
    f"""WITH {PREDICTIONS} SELECT user_id, guess FROM (SELECT user_id, guess, row_number() OVER (
        PARTITION BY user_id ORDER BY n DESC, guess) AS nth
        FROM (SELECT user_id, guess, count(*) AS n FROM pd GROUP BY 1, 2)) WHERE nth = 1""",
)
def vote_majority(spark, sf_dir):
    return me.vote_majority(predictions(spark, sf_dir), "user_id", "guess")


@query(
    "vote_mean_proba",
    f"""WITH {PREDICTIONS} SELECT user_id, guess FROM (SELECT user_id, guess, row_number() OVER (
        PARTITION BY user_id ORDER BY p DESC, guess) AS nth
        FROM (SELECT user_id, guess, sum(CAST(score * 50 AS BIGINT)) / CAST(count(*) * 50 AS DOUBLE) AS p
            FROM pd GROUP BY 1, 2)) WHERE nth = 1""",
)
def vote_mean_proba(spark, sf_dir):
    df = predictions(spark, sf_dir)
    return me.vote_mean_probability(df, "user_id", "guess", "score")


@query(
    "mean_importance",
    f"""WITH {t.EV}, f AS (SELECT 'cnt_event_code_' || event_code AS feature, world,
        avg(event_count) AS importance FROM ev GROUP BY ALL)
    SELECT feature, round(avg(importance), 6) AS importance FROM f GROUP BY 1""",
)
def mean_importance(spark, sf_dir):
    events = t.telemetry(spark, sf_dir)
    by_fold = events.groupBy("event_code", "world").agg(F.avg("event_count").alias("importance"))
    name = F.concat(F.lit("cnt_event_code_"), "event_code")
    return me.mean_importance(by_fold.withColumn("feature", name))


@query(
    "argmax_class",
    f"""WITH {PREDICTIONS} SELECT id, CAST(CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END
        AS INTEGER) AS class FROM (SELECT id, score AS a, CAST(truth AS DOUBLE) / 4 AS b, 0.5 AS c FROM pd)""",
)
def argmax_class(spark, sf_dir):
    df = predictions(spark, sf_dir)
    classes = F.array(F.col("score"), F.col("truth").cast("double") / 4, F.lit(0.5))
    return df.select("id", me.argmax(classes).alias("class"))


@query(
    "attempts_to_group",
    f"""WITH {PREDICTIONS} SELECT id, CASE WHEN score > 0.4 THEN 0 WHEN score < 0.07 THEN 3
        WHEN greatest(u, 0) < 1 THEN 3 WHEN greatest(u, 0) < 2 THEN 2 ELSE 1 END AS accuracy_group
    FROM (SELECT id, score, (guess - 1) * 1.5 + score AS u FROM pd)""",
)
def attempts_to_group(spark, sf_dir):
    misses = (F.col("guess") - 1) * 1.5 + F.col("score")
    group = rules.attempts_to_group(F.col("score"), misses)
    return predictions(spark, sf_dir).select("id", group.alias("accuracy_group"))


@query(
    "round_params",
    """SELECT event_id, name, round_even(value, 0) AS rounded, CAST(trunc(value) AS DOUBLE) AS truncated
    FROM (SELECT event_id, 'max_depth' AS name, floor(value) + 0.5 AS value FROM events
        UNION ALL SELECT event_id, 'max_bin', value FROM events)
    UNION ALL SELECT event_id, 'learning_rate', value, value FROM events""",
)
def round_params(spark, sf_dir):
    events = t.read(spark, sf_dir, "events")
    settings = F.array(
        F.struct(F.lit("max_depth").alias("name"), (F.floor("value") + 0.5).cast("double").alias("value")),
        F.struct(F.lit("max_bin").alias("name"), F.col("value")),
        F.struct(F.lit("learning_rate").alias("name"), F.col("value")),
    )
    long = events.select("event_id", F.explode(settings).alias("s")).select("event_id", "s.*")
    return long.select(
        "event_id",
        "name",
        rules.rounded_setting(F.col("name"), F.col("value")).alias("rounded"),
        rules.truncated_setting(F.col("name"), F.col("value")).alias("truncated"),
    )


@query(
    "sort_assessments",
    f"WITH {t.EV}, {LABELS} SELECT * FROM labels_t ORDER BY installation_id, game_session",
)
def sort_assessments(spark, sf_dir):
    return t.labels(spark, sf_dir).orderBy("installation_id", "game_session")
