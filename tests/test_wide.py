import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.rules import rounded_settings
from tidemark.operators import encode as en
from tidemark.operators import folds as fo
from tidemark.operators import metrics as me
from tidemark.operators import models as mo
from tidemark.operators import ordering as od
from tidemark.operators import search as sr
from tidemark.operators.correlate import correlated_columns, correlations
from tidemark.operators.lookups import common_group_by_title


def test_label_encode(spark):
    train = spark.createDataFrame([("TREETOPCITY",), ("CRYSTALCAVES",), ("MAGMAPEAK",)], "w string")
    (coded,) = en.label_encode(train, columns=["w"])
    assert sorted(r["w"] for r in coded.collect()) == [0, 1, 2]
    test = spark.createDataFrame([("MAGMAPEAK",)], "w string")
    assert en.label_encode(train, test, columns=["w"])[1].first()["w"] == 1
    with pytest.raises(Exception, match="Unseen label"):
        en.label_encode(train, spark.createDataFrame([("X",)], "w string"), columns=["w"])[1].collect()


def test_align(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, a int, x int")
    assert en.align(df, ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        en.align(df, ["a", "c"])


def test_stack_rows(spark):
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "b int")
    assert sorted(map(tuple, en.stack_rows(one, two).collect()), key=str) == [(1, None), (None, 2)]


def test_prune_and_fill(spark):
    df = spark.createDataFrame([(None, None, 1)], "a double, t string, `Air Show (x)` int")
    filled = en.fill_zero(en.prune(df, ["Air Show (x)", "unknown"]))
    assert tuple(filled.first()) == (0.0, None)
    weights = spark.createDataFrame([("a", 0.0), ("b", 0.1)], "feature string, importance double")
    assert en.zero_importance(weights) == ["a"]


def test_one_hot_of_null_is_all_zero(spark):
    df = spark.createDataFrame([("x",), (None,)], "t string")
    rows = en.one_hot(df, "t", ["x", "y"], "ttw").collect()
    assert sorted(map(tuple, rows)) == [(0, 0), (1, 0)]


def test_mode_takes_the_smaller_on_a_tie(spark):
    df = spark.createDataFrame([("t", g) for g in (3, 0, 3, 0)], "title string, accuracy_group int")
    assert common_group_by_title(df).first()[1] == 0


TABLE = [(1, 2, 1, 1), (2, 4, 1, -1), (3, 6, 1, 1), (4, 8, 1, -1)]


def test_correlated_columns_follow_the_given_order(spark):
    df = spark.createDataFrame(TABLE, "a int, b int, c int, d int")
    for order, want in ((["a", "b", "c", "d"], ["b"]), (["b", "a", "c", "d"], ["a"])):
        assert [r[0] for r in correlated_columns(df, order).collect()] == want


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 5.0), (2.0, None), (3.0, 1.0), (None, 7.0), (4.0, 0.5)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(3)
    got = correlations(df, ["x", "y"]).first()["r"]
    want = df.na.drop().agg(F.corr("x", "y")).first()[0]
    assert got == pytest.approx(want)


def test_constant_on_the_complete_pairs_never_qualifies(spark):
    rows = [(0.1, float(i)) for i in range(7)] + [(9.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert correlations(df, ["x", "y"]).first()["r"] is None


def test_numbering_and_running_totals(spark):
    rows = [(i * 37 % 101, i) for i in range(101)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    numbers = {r["k"]: r["n"] for r in od.numbered(df, ["k"], "n").collect()}
    assert numbers == {k: k for k in range(101)}
    totals = {r["k"]: r["v_before"] for r in od.running_totals(df, ["k"], ["v"]).collect()}
    by_key = dict(rows)
    assert totals == {k: sum(by_key[j] for j in range(k)) for k in range(101)}


def labelled(spark, parts=4):
    draw = random.Random(1)
    rows = [(f"g{i}", x) for i in range(200) for x in (draw.choices(range(4), k=draw.randint(1, 6)))]
    return spark.createDataFrame(rows, "installation_id string, accuracy_group int").repartition(parts)


def test_stratified_folds(spark):
    folds = fo.stratified_folds(labelled(spark), 5).collect()
    assert len(folds) == len({r["installation_id"] for r in folds}) == 200
    assert {r["fold"] for r in folds} == set(range(5))
    by_signature = {}
    for r in folds:
        signature = tuple(r[f"label_{k}"] for k in range(4))
        by_signature.setdefault(signature, Counter())[r["fold"]] += 1
    for counts in by_signature.values():
        sizes = [counts.get(k, 0) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1
    again = fo.stratified_folds(labelled(spark, 9), 5).collect()
    assert {(r["installation_id"], r["fold"]) for r in folds} == {
        (r["installation_id"], r["fold"]) for r in again
    }


def test_group_folds(spark):
    sizes = {"a": 5, "b": 4, "c": 3, "d": 3, "e": 2, "f": 1}
    rows = [(g,) for g, n in sizes.items() for _ in range(n)]
    folds = fo.group_folds(spark.createDataFrame(rows, "installation_id string"), 3).collect()
    totals = Counter()
    for r in folds:
        totals[r["fold"]] += r["size"]
    assert [totals[k] for k in range(3)] == [6, 6, 6]


def test_nested_folds_keep_groups_whole(spark):
    placed = sr.with_nested_folds(labelled(spark), 3)
    rows = placed.select("installation_id", "fold", "half").distinct().collect()
    assert len(rows) == 200
    assert {(r["fold"], r["half"]) for r in rows} == {(f, h) for f in range(3) for h in range(2)}


def test_scores(spark):
    df = spark.createDataFrame(
        list(zip([0, 0, 1, 2, 3, 3], [0, 1, 1, 2, 1, 3], strict=True)), "a int, p int"
    )
    assert me.weighted_kappa(df, "a", "p").first()["kappa"] == pytest.approx(2 / 3)
    gapped = df.select((F.col("a") * 2).alias("a"), (F.col("p") * 2).alias("p"))
    assert me.weighted_kappa(gapped, "a", "p").first()["kappa"] == pytest.approx(2 / 3)
    constant = spark.createDataFrame([(1, 1)], "a int, p int")
    assert me.weighted_kappa(constant, "a", "p").first()["kappa"] is None
    ranked = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")
    assert me.area_under_roc(ranked, "y", "s").first()["auc"] == 0.75
    numbers = spark.createDataFrame([(0, 0.0), (1, 2.0), (2, 4.0)], "y int, p double")
    assert me.root_mean_square_error(numbers, "y", "p").first()["rmse"] == pytest.approx(1.290994, abs=1e-6)


def test_votes(spark):
    votes = spark.createDataFrame([("d", x) for x in (0, 0, 3, 3, 1)], "id string, g int")
    assert me.vote_majority(votes, "id", "g").first()["g"] == 0
    shares = spark.createDataFrame(
        [("d", c, p) for c, p in enumerate((0.1, 0.4, 0.4, 0.1))], "id string, c int, p double"
    )
    assert me.vote_mean_probability(shares, "id", "c", "p").first()["c"] == 1


def test_settings():
    assert rounded_settings({"max_depth": 2.5, "num_leaves": 3.5, "reg_alpha": 2.5}) == {
        "max_depth": 2,
        "num_leaves": 4,
        "reg_alpha": 2.5,
    }
    points = sr.candidates(sr.BOUNDS, 3, sr.PROBES["num_correct"])
    assert len(points) == 6 and points == sr.candidates(sr.BOUNDS, 3, sr.PROBES["num_correct"])
    assert points[0]["max_depth"] == 8
    for point in points[3:]:
        assert all(sr.BOUNDS[k][0] - 1 <= v <= sr.BOUNDS[k][1] + 1 for k, v in point.items())
    assert mo.ml_settings({"max_bin": 1.2, "colsample_bytree": 0.5, "num_leaves": 3}, mo.BOOSTED) == {
        "maxBins": 2,
        "featureSubsetStrategy": "0.5",
    }


def test_trials(spark):
    trials = sr.trial_table(spark, [({"a": 1.0}, [0.1]), ({"a": 2.0}, [0.6, 0.8]), ({"a": 3.0}, [0.3])])
    assert [round(r["target"], 6) for r in sr.ranked_trials(trials).collect()] == [0.7, 0.3, 0.1]
    assert sr.best_trial(trials).first()["params"] == {"a": 2.0}


def test_models_beat_a_constant(spark):
    rows = [(f"d{i}", float(i % 4), None if i % 5 == 0 else 1.0, i % 4, min(i % 4, 1), i % 4) for i in range(200)]
    df = spark.createDataFrame(
        rows, "id string, x double, gap double, accuracy_group int, num_correct int, num_incorrect int"
    )
    vectors = mo.assemble(df, ["x", "gap"])
    settings = {"max_depth": 3, "min_child_samples": 1, "learning_rate": 0.3}
    scored = mo.group_model("accuracy_group", settings, 5).fit(vectors).transform(vectors)
    assert mo.KappaEvaluator("accuracy_group").evaluate(scored) > 0.5
    sums = mo.probabilities(scored).select(F.aggregate("probability", F.lit(0.0), lambda s, x: s + x))
    assert all(abs(r[0] - 1) < 1e-9 for r in sums.collect())
    marked = vectors.withColumn("check", F.col("id") < "d3")
    model = mo.correct_model("num_correct", settings, 5, "check").fit(marked)
    assert me.area_under_roc(model.transform(vectors), "num_correct", "prediction").first()["auc"] > 0.9
