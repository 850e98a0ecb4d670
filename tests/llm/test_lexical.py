import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm.lexical import rank

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs]
    total, words = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for i, own in wanted.items():
        scored = []
        for d, c in held:
            if c:
                m = 100 - 90 + 90 * c.total() * total // words
                score = 0
                for t in own & c.keys():
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                if score > 0:
                    scored.append((-score, d is None, d))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(i, n, d, -s) for n, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, terms string, n int"),
        spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, block string, term int"),
    )


def check(spark, docs, items, **how):
    got = rank(*frames(spark, docs, items), **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got.collect()), key=repr)
    assert rows == brute(docs, items, how.get("k", 10))


DOCS = [
    (0, None),
    (1, ""),
    (2, " .,;\n"),
    (3, "The cat sat on the cat's mat"),
    (4, "CAT cat CAT"),
    (5, "cat-and-dog É é ünd"),
    (6, "dog " * 50_000 + "cat"),
    (7, "concatenate category"),
    (None, "cat dog"),
    (None, "cat dog"),
    (9, "dog cat"),
    (9, "dog cat"),
    (-3, "dog cat"),
    (11, "\x00dog\x85cat dog_cat"),
]
ITEMS = [(1, "cat"), (2, "The DOG the dog"), (3, None), (4, "--"), (5, "nowhere"), (None, "mat é"), (None, "ünd"), (1, "sat"), (8, "cat dog mat the on")]


@pytest.mark.parametrize("block_bytes", [4 << 20, 100])
def test_against_brute_force(spark, block_bytes):
    check(spark, DOCS, ITEMS, block_bytes=block_bytes)
    check(spark, DOCS, ITEMS, k=2, block_bytes=block_bytes)


def test_ties_and_many_batches(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.lexical._CELLS", 16)
    rng = random.Random(3)
    docs = [(rng.randrange(200), " ".join(rng.choices("abcdefgh", k=rng.randrange(0, 6)))) for _ in range(400)]
    items = [(i, " ".join(rng.choices("abcdefgh", k=3))) for i in range(20)]
    check(spark, docs, items, k=7)


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert rank(docs.limit(0), items).count() == 0
    assert rank(docs, items.limit(0)).count() == 0


def test_an_item_beyond_the_bound_is_an_error(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.lexical.MOST_BYTES", 100)
    with pytest.raises(ValueError, match="different terms"):
        rank(*frames(spark, DOCS, ITEMS))
