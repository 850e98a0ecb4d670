import random
import re

import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES
from tidemark.llm.simhash import _signed, fingerprint, keep_one, links, near_duplicates
from tidemark.session import stage

WORD = re.compile("[^\\x20\\x09-\\x0d]+")


def brute_print(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    values = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(v >> i & 1 for v in values) > len(values))


def brute_roots(nodes, near):
    """Smallest member of the component of each node, over all pairs."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if near(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \t\r\n", "One", "Zwei wörter", "a b c", "a b c a b c a b c", "É\x85x é\x1cx y Z z\n" * 40, "w " * 50_000])
def test_fingerprint_is_the_majority_of_bits(text):
    assert fingerprint((text or "").encode()) == brute_print(text)


@pytest.mark.parametrize("distance,segments,crowded", [(3, 2, 1), (3, 2, 128), (2, 4, 2), (0, 2, 1)])
def test_links_reach_what_all_pairs_reach(spark, distance, segments, crowded):
    rng = random.Random(distance * 10 + segments)
    values = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(10):
            values.add(center)
            for _ in range(rng.randint(0, 3)):
                center ^= 1 << rng.choice([1, 2, 3, 30, 31, 32, 33, 62, 63])
    nodes = spark.createDataFrame([(_signed(v),) for v in sorted(values)], "fingerprint long")
    roots = {r.node: r.root for r in components(links(nodes, distance, segments, crowded)).collect()}
    want = brute_roots([_signed(v) for v in values], lambda a, b: (a ^ b).bit_count() <= distance if (a < 0) == (b < 0) else ((a ^ b) & (2**64 - 1)).bit_count() <= distance)
    assert {n: roots.get(n, n) for n in want} == want


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(900, 1300)] + [(5000, 5000), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[i] == 900 for i in range(901, 1300))
    assert 5000 not in got and components(spark.createDataFrame([], "a long, b long")).collect() == []


def check_against_brute(rows, texts):
    want = brute_roots({brute_print(t) for t in texts.values()}, lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for i, t in texts.items():
        root = want[brute_print(t)]
        first[root] = min(first.get(root, i), i)
    for r in rows:
        assert r.fingerprint == f"{brute_print(texts[r.doc_id]):016x}"
        assert r.component_id == first[want[brute_print(texts[r.doc_id])]]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op2_simhash"](spark, sf).collect()
    assert len(rows) == len(texts)
    check_against_brute(rows, texts)


BASE = " ".join(f"word{i}" for i in range(400))


def test_nulls_copies_and_clashing_names(spark):
    rows = [
        (7, BASE, "x"), (5, BASE, "y"), (5, BASE, "y"), (9, BASE + " more", "z"), (None, BASE, "n"),
        (1, None, "x"), (2, "", "x"), (3, "alone here now", "x"), (None, "unnamed text only", "a"),
        (None, "unnamed text only", "b"), (4, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    docs = docs.selectExpr("doc_id", "text", "component_id", "component_id AS fingerprint", "component_id AS root")
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    near = (brute_print(BASE) ^ brute_print(BASE + " more")).bit_count() <= 3
    assert by[7] == by[5] == {5} and by[9] == ({5} if near else {9})
    assert by[1] == by[2] == by[4] == {1} and by[3] == {3} and by[None] == {5, None}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert sorted(left, key=lambda x: (x is None, x)) == sorted({1, 3, 5} | (set() if near else {9})) + [None]


def test_one_doc_id_with_texts_of_several_groups(spark):
    other, third = (" ".join(f"{w}{i}" for i in range(400)) for w in ("other", "third"))
    rows = [
        (1, BASE, "a"), (1, other, "b"), (5, BASE, "c"),  # two groups named by one id
        (2, third, "d"), (6, third, "e"), (6, "alone here now", "f"), (6, "alone here now", "g"),  # one copy, one of its own
        (None, "unnamed text only", "h"), (None, "unnamed text only", "h"), (None, third, "i"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _llm string")
    got = sorted((r.doc_id or 0, r.text) for r in keep_one(docs).collect())
    assert got == sorted([(1, BASE), (1, other), (2, third), (6, "alone here now"), (0, "unnamed text only")])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == [] and keep_one(docs).collect() == []


def test_no_table_is_broadcast_on_a_guess_of_its_size(spark, monkeypatch):
    """Spark takes the probes, 33 rows exploded from each of two keys of a node, for a tiny table."""
    plans = []

    def staged(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(simhash, "stage", staged)
    close = [(i, " ".join(f"w{j}" for j in range(300)) + f" x{i}") for i in range(40)]
    docs = spark.createDataFrame(close + [(i, f"alone {i} here") for i in range(40, 80)], "doc_id long, text string")
    plans.append(near_duplicates(docs, crowded=4)._jdf.queryExecution().executedPlan().toString())
    joins = [p for p in plans if "Join" in p]
    probing = [p for p in joins if "explode" in p or "Generate" in p]
    assert probing and not [p for p in probing if "BroadcastHashJoin" in p]


def test_rows_to_keep_are_broadcast_only_after_they_are_measured(spark, monkeypatch):
    docs = stage(spark.createDataFrame([(i, f"alone {i} here") for i in range(50)], "doc_id long, text string"), "docs")
    measured = simhash.small_side
    monkeypatch.setattr(simhash, "small_side", lambda df: measured(df, most=16))
    plan = keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert keep_one(docs).count() == 50
