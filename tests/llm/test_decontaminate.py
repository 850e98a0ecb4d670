import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import contaminated, winnowed
from tidemark.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        theirs = words(item_text)
        n = min(window, len(theirs))
        for i in range(len(theirs) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == theirs[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(own), len(hit), sorted(str(i) for i in found if i is not None)


def frames(spark, docs, items):
    # other columns, with names that the operator uses itself
    return (
        spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, k1 string, length int"),
        spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, words string, p string"),
    )


def check(spark, docs, items, **how):
    got = contaminated(*frames(spark, docs, items), **how).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in got), key=repr) == sorted(
        ((d, *brute(t, items, how.get("window", 10))) for d, t in docs), key=repr
    )


LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [
    (1, LONG),
    (2, "Alpha, beta; GAMMA delta"),
    (3, "solo"),
    (4, None),
    (5, "?!"),
    (None, "nameless words of an item that has no id whatever it is"),
    (7, " ".join(["the"] * 25)),
    (1, "a second text of the first item, of more words than ten"),
    (10, LONG),
]
DOCS = [
    (0, None),
    (1, ""),
    (2, "... \n"),
    (3, f"x {LONG} y"),
    (4, " ".join(f"w{i}" for i in range(5, 15))),
    (5, " ".join(f"w{i}" for i in range(5, 14))),
    (6, "alpha beta gamma delta alpha beta gamma"),
    (7, "a solo, a solo"),
    (8, "the " * 300),
    (9, "the " * 9),
    (10, "Nameless words of an item that has no id whatever it is, SOLO"),
    (11, "é\x00w1\x85w2 " + LONG.replace(" ", "\n") + "É"),
    (12, "noise " * 30_000 + LONG + " noise" * 20_000),
    (None, LONG),
    (None, LONG),
    (3, f"x {LONG} y"),
]


def test_against_brute_force(spark):
    check(spark, DOCS, ITEMS)


def test_other_windows_and_random_texts(spark):
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choices("abc", k=rng.randrange(0, 40)))) for i in range(60)]
    items = [(i, " ".join(rng.choices("abc", k=rng.randrange(0, 14)))) for i in range(12)]
    check(spark, docs, items, window=10)
    check(spark, docs, items, window=6, gram=6)
    check(spark, docs, items, window=1)


@pytest.mark.parametrize("gram", [1, 2, 3, 4, 5, 10])
def test_every_shared_window_leaves_a_shared_fingerprint(spark, gram):
    rng = random.Random(gram)
    shared = rng.choices("abcdef", k=10)
    lists = [rng.choices("abcdef", k=rng.randrange(0, 9)) + shared + rng.choices("abcdef", k=5) for _ in range(20)]
    rows = spark.createDataFrame([(x,) for x in lists], "w array<string>").select(
        winnowed(F.col("w"), 10, gram).alias("p"), "w"
    ).collect()
    at = []
    for r in rows:
        start = next(i for i in range(len(r.w)) if r.w[i : i + 10] == shared)
        at.append([p.hash for p in r.p if p.first <= start < p.end])
        # spans follow each other and cover every window once
        assert [p.first for p in r.p] == [0, *[p.end for p in r.p][:-1]] and r.p[-1].end == len(r.w) - 9
    assert len({tuple(x) for x in at}) == 1 and len(at[0]) == 1


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert contaminated(docs.limit(0), items).count() == 0
    got = contaminated(docs, items.limit(0)).collect()
    assert len(got) == len(DOCS) and all(r.n_hit == 0 and r.items == [] for r in got)
    assert {r.doc_id: r.n_words for r in got if r.doc_id == 12} == {12: 50_040}


def test_sides_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.decontaminate.small_side", lambda df: df)
    check(spark, DOCS, ITEMS)


def test_query_columns(spark, tmp_path):
    docs, items = frames(spark, DOCS, ITEMS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    by_id = {r.doc_id: r for r in QUERIES["op11_winnowing"](spark, str(tmp_path)).collect()}
    assert by_id[3].n_items == 2 and by_id[3].contaminated
    assert by_id[3].items_sha256 == hashlib.sha256(b"1,10").hexdigest()
    assert not by_id[0].contaminated and by_id[0].items_sha256 == hashlib.sha256(b"").hexdigest()
