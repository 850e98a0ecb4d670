"""Train, score and predict from feature tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import CATEGORICAL, SEED
from tidemark.functions.rules import attempts_to_group, truncated_settings
from tidemark.operators import metrics
from tidemark.operators import models as mo
from tidemark.operators.encode import align, label_encode, train_matrix
from tidemark.operators.folds import balanced_folds, group_folds, split, with_fold
from tidemark.operators.search import BOUNDS, GROUP_BOUNDS, Settings, nested_score, searched, suggest, trial_table
from tidemark.operators.search import with_nested_folds
from tidemark.session import stage, stage_evenly

IDS = ("installation_id", "assessment_game_session")
TARGETS = {
    "num_correct": "num_correct",
    "num_incorrect": "num_incorrect",
    "accuracy_group": "accuracy_group",
}


def matrices(
    train_features: DataFrame,
    test_features: DataFrame,
    labels: DataFrame,
    without: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Encoded training and test rows with a vector of the features that vary, and the names of all."""
    columns = [c for c in train_features.columns if c not in IDS and c not in set(without)]
    train = train_matrix(align(train_features, [*IDS, *columns]), labels, TARGETS)
    test = align(test_features, [*IDS, *columns])
    text = [c for c in CATEGORICAL if c in columns]
    train, test = label_encode(train, test, columns=text)
    train = mo.assemble(train, columns).select(*IDS, *TARGETS, "features")
    test = mo.assemble(test, columns).select(*IDS, "features")
    train, test = mo.varying(stage(train, "vectors"), test)
    return stage_evenly(train, "train"), stage(test, "test"), columns


def _marked(train: DataFrame, held: DataFrame) -> DataFrame:
    """Training rows and, marked, the rows that only decide when to stop."""
    return train.withColumn("check", F.lit(False)).unionByName(held.withColumn("check", F.lit(True)))


def _two_models(train, held, correct_settings, uncorrect_settings, rounds, patience):
    rows, widest = _marked(train, held), mo.categories(train)
    correct = mo.correct_model("num_correct", correct_settings, rounds, widest)
    correct = mo.fit_with_patience(correct, rows, "check", patience)
    uncorrect = mo.uncorrect_model("num_incorrect", uncorrect_settings, rounds, widest)
    uncorrect = mo.fit_with_patience(uncorrect, rows, "check", patience)

    def score(df: DataFrame) -> DataFrame:
        first = mo.probabilities(correct.transform(df)).select(
            *df.columns, F.col("probability")[0].alias("no_correct")
        )
        both = uncorrect.transform(first).select(
            *first.columns, F.col("prediction").alias("misses")
        )
        return both.withColumn(
            "prediction", attempts_to_group(F.col("no_correct"), F.col("misses"))
        )

    return score


def out_of_fold(
    train: DataFrame,
    test: DataFrame,
    folds: int = 5,
    rounds: int = mo.ROUNDS,
    correct_settings: Mapping[str, float] = mo.CORRECT_SETTINGS,
    uncorrect_settings: Mapping[str, float] = mo.UNCORRECT_SETTINGS,
    patience: int = mo.PATIENCE,
) -> tuple[DataFrame, DataFrame]:
    """Predictions of each fold's two models, on its held-out rows and on the test rows."""
    dealt = balanced_folds(train, folds, seed=SEED)
    placed = stage_evenly(with_fold(train, dealt), "placed")

    def fitted(fold: int) -> Callable[[DataFrame], DataFrame]:
        return _two_models(*split(placed, fold), correct_settings, uncorrect_settings, rounds, patience)

    held_out, tests = [], []
    for fold, score in enumerate(mo.together(fitted, range(folds))):
        _, held = split(placed, fold)
        held_out.append(score(held).drop("features"))
        tests.append(score(test).drop("features").withColumn("fold", F.lit(fold)))
    return reduce(DataFrame.unionByName, held_out), reduce(DataFrame.unionByName, tests)


def predict_by_rule(held_out: DataFrame, tests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean kappa over the folds, and the majority vote per device."""
    kappas = metrics.weighted_kappa(held_out, "accuracy_group", "prediction", by=["fold"])
    votes = metrics.vote_majority(tests, "installation_id", "prediction")
    return (
        metrics.mean_score(kappas, "kappa"),
        votes.withColumnRenamed("prediction", "accuracy_group"),
    )


def group_model_run(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str],
    folds: int = 10,
    trees: int = mo.TREES,
    settings: Mapping[str, float] = mo.GROUP_SETTINGS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The single four-class model: kappa per fold, test predictions, mean importances."""
    placed = stage_evenly(with_fold(train, group_folds(train, folds)), "placed")
    forest = mo.group_model("accuracy_group", settings, trees, mo.categories(train))
    models = mo.together(lambda fold: forest.fit(split(placed, fold)[0]), range(folds))
    held_out, tests, weights, names = [], [], [], mo.vector_names(train)
    for fold, model in enumerate(models):
        _, held = split(placed, fold)
        held_out.append(
            mo.probabilities(model.transform(held)).select(
                "fold", "accuracy_group", metrics.argmax(F.col("probability")).alias("prediction")
            )
        )
        tests.append(
            mo.probabilities(model.transform(test)).select(
                "installation_id", F.posexplode("probability").alias("accuracy_group", "p")
            )
        )
        weights += mo.importance_rows(model, columns, fold, names)
    scores = metrics.weighted_kappa(
        reduce(DataFrame.unionByName, held_out), "accuracy_group", "prediction", by=["fold"]
    )
    ensemble = metrics.vote_mean_probability(
        reduce(DataFrame.unionByName, tests), "installation_id", "accuracy_group", "p"
    )
    rows = train.sparkSession.createDataFrame(
        weights, "fold int, feature string, importance double"
    )
    return scores, ensemble, metrics.mean_importance(rows)


Fit = Callable[[DataFrame, DataFrame], Callable[[DataFrame], float]]


def fit_for(
    target: str, settings: Settings, rounds: int = mo.ROUNDS, trees: int = mo.TREES, patience: int = mo.PATIENCE
) -> Fit:
    """How one trial is fitted and scored; larger is better for every target.

    A score that is undefined, where the scored rows have one label only, is an error.
    """

    def fit(train: DataFrame, stop: DataFrame) -> Callable[[DataFrame], float]:
        rows, widest = _marked(train, stop), mo.categories(train)
        if target == "num_correct":
            model = mo.correct_model(target, settings, rounds, widest)
            model = mo.fit_with_patience(model, rows, "check", patience)
        elif target == "num_incorrect":
            model = mo.uncorrect_model(target, settings, rounds, widest)
            model = mo.fit_with_patience(model, rows, "check", patience)
        else:
            model = mo.group_model(target, settings, trees, widest).fit(train)

        def score(df: DataFrame) -> float:
            scored = model.transform(df)
            if target == "num_correct":
                value = metrics.area_under_roc(scored, target, "prediction").first()["auc"]
            elif target == "num_incorrect":
                value = metrics.root_mean_square_error(scored, target, "prediction").first()["rmse"]
            else:
                value = mo.KappaEvaluator(target).evaluate(scored)
            if value is None:
                raise ValueError(f"the score of {target} is undefined: the rows have one label only")
            return -value if target == "num_incorrect" else value

        return score

    return fit


def nested_rows(train: DataFrame, folds: int = 5) -> DataFrame:
    """Training rows with their nested folds, made once for all trials of a search."""
    return stage_evenly(with_nested_folds(train, folds), "nested")


def tune(
    nested: DataFrame,
    target: str,
    points: Sequence[Settings],
    folds: int = 5,
    rounds: int = mo.ROUNDS,
    trees: int = mo.TREES,
    patience: int = mo.PATIENCE,
    guided: int = 0,
) -> DataFrame:
    """Every point's cross-validation score over `nested_rows`, as a trial table; after `points`,
    `guided` more of the largest expected improvement on the trials before them."""

    def scores(point: Settings) -> list[float]:
        return nested_score(nested, fit_for(target, point, rounds, trees, patience), folds)

    trials = searched(points, guided, partial(suggest, BOUNDS), scores)
    return trial_table(nested.sparkSession, trials)


def folds_by_number(train: DataFrame, numbers: Iterable[int]) -> dict[int, DataFrame]:
    """Training rows in device folds, made once for each number of folds."""
    return {n: stage_evenly(with_fold(train, group_folds(train, n)), "placed") for n in sorted(set(numbers))}


def tune_group_model(
    placed: Mapping[int, DataFrame], points: Sequence[Settings], trees: int = mo.TREES, guided: int = 0
) -> DataFrame:
    """Every point's mean kappa over device folds; a point's n_splits is the number of folds. After
    `points`, `guided` more of the largest expected improvement on the trials before them."""

    def scores(point: Settings) -> list[float]:
        folds = int(point["n_splits"])
        rows = placed[folds]
        forest = mo.group_model("accuracy_group", point, trees, mo.categories(rows))

        def score(fold: int) -> float:
            rest, held = split(rows, fold)
            fitted = forest.fit(mo.share_of_cores(rest, folds))
            return mo.KappaEvaluator("accuracy_group").evaluate(fitted.transform(held))

        return mo.together(score, range(folds))

    trials = searched(points, guided, partial(suggest, GROUP_BOUNDS, whole=truncated_settings), scores)
    return trial_table(next(iter(placed.values())).sparkSession, trials)
