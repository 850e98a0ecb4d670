"""How models are fitted: on evenly dealt rows, without features that say nothing, and without a refit."""

from pyspark.sql import functions as F

from tidemark.operators import encode as en
from tidemark.operators import models as mo
from tidemark.plans import predict as pr
from tidemark.session import stage, stage_evenly


def features(spark, n=240):
    rows = [(f"d{i}", f"s{i}", "ab"[i % 2], "w", float(i % 5), 1.0 if i % 7 else None, 2.0) for i in range(n)]
    names = "installation_id string, assessment_game_session string, assessment_title string,"
    return spark.createDataFrame(rows, names + " assessment_world string, x double, gap double, same double")


def labels(spark, n=240):
    rows = [(f"d{i}", f"s{i}", int(i % 5 > 1), i % 3, i % 4) for i in range(n)]
    names = "installation_id string, game_session string, num_correct int, num_incorrect int, accuracy_group int"
    return spark.createDataFrame(rows, names)


def test_training_rows_fill_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    few = stage(features(spark).coalesce(1), "few")
    assert stage_evenly(few, "even").rdd.getNumPartitions() >= cores > 1
    train, _, _ = pr.matrices(few, few, labels(spark))
    sizes = train.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 240 and max(sizes) <= 240 // cores + cores


def test_features_that_never_vary_are_left_out(spark):
    train, test, columns = pr.matrices(features(spark), features(spark, 9), labels(spark))
    assert columns == ["assessment_title", "assessment_world", "x", "gap", "same"]
    # the title, x, gap, which is 0 where it is missing, and the mark of gap
    assert mo.vector_names(train) == mo.vector_names(test) == ["_f0", "_f2", "_f3", "_m3"]
    assert {r.features.size for r in test.collect()} == {4}
    model = mo.group_model("accuracy_group", {"max_depth": 3, "min_child_samples": 1}, 5).fit(train)
    rows = mo.importance_rows(model, columns, 0, mo.vector_names(train))
    assert sum(n for *_, n in rows) == (model.totalNumNodes - 5) / 2 > 0
    assert rows[1][2] == rows[4][2] == 0 < rows[2][2]


def test_two_values_are_a_number_and_three_a_category(spark):
    three = features(spark).withColumn("assessment_world", F.concat(F.lit("w"), F.col("x") % 3))
    (coded,) = en.label_encode(three)
    assert "ml_attr" not in coded.schema["assessment_title"].metadata
    assert mo.categories(mo.assemble(coded, ["assessment_title", "assessment_world"])) == 3


def test_first_rounds_are_the_shorter_fit(spark):
    train, _, _ = pr.matrices(features(spark), features(spark), labels(spark))
    settings = {"max_depth": 2, "min_child_samples": 1, "learning_rate": 0.2}
    for model in (mo.correct_model("num_correct", settings, 6), mo.uncorrect_model("num_incorrect", settings, 6)):
        short, fitted = model.copy({model.maxIter: 4}).fit(train), mo.first_rounds(model.fit(train), 4)
        assert fitted.getNumTrees == 4 and fitted.treeWeights == short.treeWeights
        told = [[r.prediction for r in m.transform(train).orderBy("installation_id").collect()] for m in (short, fitted)]
        assert told[0] == told[1]


def test_fits_run_at_the_same_time_and_keep_their_order():
    from threading import Barrier

    gate = Barrier(mo.FITS)

    def met(i):
        gate.wait(20)
        return i * i

    assert mo.together(met, range(mo.FITS)) == [i * i for i in range(mo.FITS)]


def test_fits_of_a_point_share_the_cores(spark, monkeypatch):
    """Nine fits, five at a time on eight cores, have two partitions each, and see all their rows."""
    train, _, _ = pr.matrices(features(spark), features(spark), labels(spark))
    placed, seen = pr.folds_by_number(train, [9]), []

    class Forest:
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return self

        def transform(self, held):
            return held.withColumn("prediction", F.col("accuracy_group").cast("double"))

    monkeypatch.setattr(mo, "group_model", lambda *args: Forest())
    (trial,) = pr.tune_group_model(placed, [{"n_splits": 9}]).collect()
    cores = spark.sparkContext.defaultParallelism
    assert {n for n, _ in seen} == {-(-cores // mo.FITS)}
    assert sum(n for _, n in seen) == 8 * 240 and trial.scores == [1.0] * 9
