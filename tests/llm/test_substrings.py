import hashlib
import random
import re

import numpy as np
import pytest

from checks.compare import connect, rows
from tidemark.llm import substrings
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.substrings import _Runs, cut_repeats

WORD = re.compile("[^\\x20\\x09-\\x0d]+")


def brute(texts, window):
    """texts: (doc_id, text); per row n_words, n_removed and what is kept."""
    split = [(i, WORD.findall(t or "")) for i, t in texts]
    first = {}
    for i, w in split:
        if i is not None:
            for at in range(len(w) - window + 1):
                run = tuple(w[at : at + window])
                first[run] = min(first.get(run, i), i)
    out = []
    for i, w in split:
        gone = set()
        for at in range(len(w) - window + 1):
            if i is not None and first[tuple(w[at : at + window])] < i:
                gone.update(range(at, at + window))
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((i, len(w), len(gone), " ".join(kept)))
    return out


def some_texts(seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(4, 30))] for _ in range(8)]
    texts = []
    for i in rng.sample(range(100), 30):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages)[rng.randint(0, 3) :] + [rng.choice("xyz") + str(rng.randint(0, 9))] * rng.randint(0, 3)
        texts.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    texts += [(200, "q " * 40), (201, "q " * 60), (202, "ab " * 50), (203, "x ab " * 30), (204, None), (205, " \t")]
    texts += [texts[0], texts[0], (texts[1][0], texts[2][1]), (None, texts[3][1]), (None, None)]
    return texts


@pytest.mark.parametrize("window,anchor", [(5, 2), (7, 7), (3, 10), (12, 4)])
def test_matches_brute_force(spark, window, anchor):
    texts = some_texts(window)
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts], "doc_id long, text string, first string")
    docs = docs.selectExpr("*", "first AS anchor", "first AS firsts", "first AS text_key", "first AS cut_")
    got = cut_repeats(docs, window, anchor).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, *r.cut) for r in got), key=key) == sorted(brute(texts, window), key=key)


def test_query_matches_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = QUERIES["op8_substrings"](spark, sf)
    got = df.collect()
    want = {i: (i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(texts, 50)}
    assert {r.doc_id: tuple(r) for r in got} == want and len(got) == len(texts)
    assert any(r.n_removed for r in got)
    cursor = connect(sf).execute(ORACLES["op8_substrings"])
    assert rows([d[0] for d in cursor.description], cursor.fetchall()) == rows(df.columns, got)


def test_equal_runs_have_equal_anchors():
    runs = _Runs(50, 10)
    rng = random.Random(3)
    shared = " ".join(str(rng.random()) for _ in range(60))
    a, b = (runs.of(f"{'p ' * n}{shared} {'s ' * n}".encode())[0] for n in (3, 17))
    assert np.array_equal(a[3:14], b[17:28])


def test_copies_of_a_row_are_worked_on_once(spark, monkeypatch):
    shared = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"a {shared} b")] + [(2, f"c {shared} d {shared[:40]}")] * 40 + [(2, f"other {shared} text"), (3, shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []

    def watched(work):
        def run(texts, *rest):
            listed = [c for c in ("firsts", "counts") if c in texts.columns]
            seen.extend((work.__name__, r.doc_id, r.text_key, *(len(r[c]) for c in listed)) for r in texts.drop("text").collect())
            return work(texts, *rest)

        return run

    for name in ("_segments", "_single_runs"):
        monkeypatch.setattr(substrings, name, watched(getattr(substrings, name)))
    got = cut_repeats(docs, 10, 3).collect()
    assert sorted((r.doc_id, *r.cut) for r in got) == sorted(brute(rows, 10))
    assert {s[0] for s in seen} == {"_segments", "_single_runs"}
    assert len(seen) == len({s[:3] for s in seen}) and max(s[-1] for s in seen if s[0] == "_single_runs") <= 30


def test_empty_table(spark):
    assert cut_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_side_is_broadcast_on_a_guess_of_its_size(spark):
    """The places to cut are arrays of any length, which Spark takes for one entry each."""
    common = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(i, f"{common} x{i}") for i in range(6)], "doc_id long, text string")
    found = cut_repeats(docs, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted(r.cut.n_removed for r in found.collect()) == [0, 80, 80, 80, 80, 80]
