import hashlib
import random
import re
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.common import told_apart
from tidemark.llm.merkle import differing, fingerprint, fingerprints, likeness, with_next
from tidemark.llm.queries import QUERIES

PHRASE = re.compile(r"[^.!?]{1,64}[.!?]*|[.!?]+")


def brute_paragraphs(text):
    return [PHRASE.findall(line) for line in (text or "").split("\n")]


def brute_likeness(a, b):
    if (a or "") == (b or ""):
        return 1.0
    x, y = ({p for line in brute_paragraphs(t) for p in line} for t in (a, b))
    return len(x & y) / (max(len(x), len(y)) + 1)


def brute_next(rows):
    """rows: (doc_id, text): each with the text after it."""
    named = sorted((i, t or "") for i, t in rows if i is not None)
    after = [(i, t, named[(n + 1) % len(named)][1]) for n, (i, t) in enumerate(named)]
    return after + [(None, t or "", named[0][1] if named else None) for i, t in rows if i is None]


def check(rows, after):
    """rows of the query against (doc_id, text, next text)."""
    want = {}
    for i, text, following in after:
        moved = len(text) // 4
        edited = text[: len(text) - moved] + following[:moved]
        want.setdefault(i, []).append(
            (len(text), hashlib.sha256(edited.encode()).hexdigest(), round(brute_likeness(text, edited), 9), round(brute_likeness(text, following), 9))
        )
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)))
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_brute_force(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op5_merkle"](spark, sf).collect()
    check(rows, brute_next(docs))
    prints = {}
    for r in rows:
        assert prints.setdefault(r.fingerprint, dict(docs)[r.doc_id]) == dict(docs)[r.doc_id]
    near = sum(r.near_edited > r.near_next for r in rows)
    assert near > 0.9 * len(rows)


def test_nulls_ties_and_ids_far_apart(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([i, i * 10**15, -i]), "é. ü!" * rng.randint(0, 40)) for i in range(60)]
    rows += [(3, None), (3, ""), (3, "same text"), (3, "same text"), (2**63 - 1, "last"), (-(2**63), "first one. of all"), (None, "no id"), (None, None), (9, "long text\n" * 30_000)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, n_chars string")
    docs.selectExpr("*", "n_chars AS bucket", "n_chars AS cell", "n_chars AS entry", "n_chars AS next").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    check(QUERIES["op5_merkle"](spark, str(tmp_path)).collect(), brute_next(rows))


def test_branches_locate_edits(spark):
    lines = [f"paragraph {i} says this. and that." for i in range(40)]
    edited = [*lines]
    edited[3], edited[21] = "changed. here.", edited[21] + " more"
    longer = [*lines, "one at the end"]
    rows = [("\n".join(lines), "\n".join(x)) for x in (edited, lines, longer)] + [("", "a"), (None, "")]
    df = spark.createDataFrame(rows, "a string, b string").select(fingerprint(F.col("a")).alias("a"), fingerprint(F.col("b")).alias("b"))
    got = df.select(differing(F.col("a"), F.col("b")).alias("d"), likeness(F.col("a"), F.col("b")).alias("l")).collect()
    assert [r.d for r in got] == [[3, 21], [], [40], [0], []]
    assert got[1].l == got[4].l == 1.0 and 0.9 < got[0].l < 1


def test_empty_table_and_no_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints(empty).collect() == [] and with_next(empty).collect() == []
    bare = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    assert with_next(bare).first().next.text is None


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op5_merkle"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_buckets_are_cut_by_rank(spark, tmp_path):
    """A far id, and a row that is a third of the table, leave no bucket with much more than its share."""
    rows = [(i, f"text {i}. of some length") for i in range(4_000)] + [(10**15, "far away")] + [(77, "copy. of text 77")] * 2_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for table in (read, docs):
        named = told_apart(table).withColumn("key", F.expr(merkle._KEY))
        bounds = merkle._bounds(named, 10_000).collect()
        keys = sorted(r.key for r in named.select("key").collect())
        firsts = [r.key for r in sorted(bounds, key=lambda r: r.number)]
        assert firsts == sorted(firsts) and firsts[0] == keys[0] and len(firsts) > 10
        assert [r.follow for r in sorted(bounds, key=lambda r: r.number)] == firsts[1:] + firsts[:1]
        held = Counter(bisect_right(firsts, k) for k in keys)
        assert max(held.values()) < 2 * len(keys) / len(firsts)
    check(QUERIES["op5_merkle"](spark, str(tmp_path)).collect(), brute_next(rows))


def test_places_of_keys(spark, monkeypatch):
    """Many cells: a key is placed in its cell, then in its bucket."""
    monkeypatch.setattr(merkle, "_STEPS", 4)
    monkeypatch.setattr(merkle, "_BUCKET_BYTES", 300)
    rows = [(i * 7, f"text {i}") for i in range(500)] + [(None, "no id")]
    got = with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    after = {(i, t): n for i, t, n in brute_next(rows)}
    assert {(r.doc_id, r.text): r.next.text for r in got} == after and len(got) == len(rows)
