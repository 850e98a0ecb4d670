import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES
from tidemark.llm.toxicity import _learn, fit, held_out, score


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    for value in set(scores):  # ties share their mean rank
        same = scores == value
        ranks[same] = ranks[same].mean()
    pos = labels == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("sf,least", [("0.01", 0.8), ("0.1", 0.93)])
def test_held_out_accuracy(spark, sf, least):
    sf = f"/root/testdata/sf{sf}"
    rows = QUERIES["op7_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    told = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    scores, truth, said = (np.array(x) for x in zip(*told, strict=True))
    print(sf, "auc", auc(scores, truth), "said", said.sum(), "true", truth.sum(), "both", (said & truth).sum())
    assert auc(scores, truth) >= least
    assert (said & truth).sum() >= 0.9 * said.sum()


class Row:
    def __init__(self, on, is_p, is_u):
        self.on, self.is_p, self.is_u = on, is_p, is_u


def test_unlabelled_toxic_texts_do_not_teach_that_toxic_is_clean():
    # feature 0 marks toxic texts, feature 1 is everywhere; half of the unlabelled are toxic
    rows = [Row([0, 1], 1, False) for _ in range(50)]
    rows += [Row([0, 1], 0, True) for _ in range(50)] + [Row([1], 0, True) for _ in range(50)]
    model = _learn(("bad", "the"), rows, prior=0.5)
    assert model.bias + model.weights.sum() > 1 and model.bias + model.weights[1] < -1


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def test_nulls_empty_texts_and_clashing_names(spark):
    rows = [(i, "clean words here" if i % 3 else "nasty words here", "s") for i in range(120)]
    rows += [(None, "nasty", "s"), (500, None, "s"), (501, "", "s"), (502, "w " * 50_000 + "nasty", "s"), (5, "clean", "s"), (5, "clean", "s")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(120)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    docs = frame(spark, rows)
    got = score(docs, fit(docs, labels), "toxicity").collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.toxicity)
    assert min(by[3][0], by[None][0], by[502][0]) > 0.5 > max(by[4][0], by[500][0], by[501][0])


def test_one_or_two_examples_give_a_model(spark):
    rows = [(i, f"clean words here number{i % 7}", "s") for i in range(100)]
    rows += [(i, f"nasty vile words here number{i % 7}", "s") for i in range(100, 140)]
    docs = frame(spark, rows)
    inside = [r.doc_id for r in docs.where("doc_id >= 100").where(~held_out(F.col("doc_id"))).orderBy("doc_id").collect()]
    clean = [r.doc_id for r in docs.where("doc_id < 100").where(~held_out(F.col("doc_id"))).orderBy("doc_id").collect()]
    for n in (1, 2):
        known = [(i, 1) for i in inside[:n]] + [(i, 0) for i in clean[: 3 * n]]
        model = fit(docs, spark.createDataFrame(known, "doc_id long, toxic int"))
        assert model is not None and {"nasty", "vile"} <= set(model.names)
        got = {r.doc_id: r.t for r in score(docs, model, "t").collect()}
        assert min(got[i] for i in range(100, 140)) > max(got[i] for i in range(100))


def test_features_are_counted_over_all_unlabelled_texts(spark, monkeypatch):
    rows = [(i, "nasty plain" if i % 10 == 0 else "plain words", "s") for i in range(200)]
    docs = frame(spark, rows + [(10, "nasty again", "s")] * 50)
    known = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "doc_id long, toxic int")
    counted, learnt = [], []
    choose, learn = toxicity._choose, toxicity._learn
    monkeypatch.setattr(toxicity, "_choose", lambda sample, texts, n: counted.append(texts.count()) or choose(sample, texts, n))
    monkeypatch.setattr(toxicity, "_learn", lambda names, rows, *rest: learnt.append(len(rows)) or learn(names, rows, *rest))
    assert fit(docs, known, positive=8, unlabelled=5) is not None
    assert counted == [docs.where(~held_out(F.col("doc_id"))).count()]
    assert 8 <= learnt[0] <= 13  # a row an id, however often it repeats


def test_without_examples_or_rows(spark):
    docs, none = frame(spark, [(1, "a", "s")]), spark.createDataFrame([], "doc_id long, toxic int")
    assert fit(docs, none) is None and score(docs, None, "t").first().t == 0.0
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert fit(frame(spark, []), labels) is None
