import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm.spelling import near_pairs, variants, vocabulary

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, least=7, often=2, every=31):
    found = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= least
    return {w: n for w, n in found.items() if n >= often}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, times=10):
    words, out = brute_words(rows), {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if near(w, o))
        form = others[0][1] if others and -others[0][0] >= times * n else None
        out[w] = (form, n, len(others), words[form] if form else None)
    roots = {}
    for w in out:
        at = w
        while out[at][0]:
            at = out[at][0]
        roots[w] = at
    return {(w, form, roots[w], *rest) for w, (form, *rest) in out.items()}


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, word string, n int")


def got(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


ROWS = [
    (0, None),
    (1, ""),
    (None, "Nullified nullified"),
    (2, "exactly sevenly seventy seventx seventies " * 2),
    (3, "received " * 1000 + "recieved receved receeved " * 9 + "RECEIVED"),
    (4, "receved " * 120 + "recevd recevd short"),
    (5, "naïveté naiveté naiveté naïveté naïvetés ÀÉÎÕÜÿß×÷ ÀÉÎÕÜÿß×÷ won't over-the-counter over_counter"),
    (3, "received " * 1000 + "recieved receved receeved " * 9 + "RECEIVED"),
    (6, "abcdefgh abcdefgi abcdefgj " * 3),
    (7, "z" * 5000 + " " + "z" * 5000 + " " + "z" * 5001),
    (8, "ĀabcdefghĀ éabcdefg"),
]


def test_against_brute_force(spark):
    assert got(variants(frame(spark, ROWS))) == brute(ROWS)


@pytest.mark.parametrize("crowd", [1, 3, 10_000])
def test_crowded_chunks_lose_no_pair(spark, crowd):
    rng = random.Random(crowd)
    words = {"".join(rng.choices("ab", k=rng.randrange(2, 13))) for _ in range(400)}
    words |= {"prefix" + "".join(rng.choices("abcd", k=rng.randrange(1, 5))) for _ in range(200)}
    words = sorted(words)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    found = [tuple(sorted((r.word, r.other))) for r in near_pairs(df, crowd).collect()]
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if near(a, b)}
    assert len(found) == len(set(found)) and set(found) == want


def test_random_texts(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("".join(rng.choices("aé", k=rng.choice([7, 8]))) for _ in range(200))) for i in range(20)]
    assert got(variants(frame(spark, rows))) == brute(rows)


def test_counts_are_sent_before_they_grow(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.spelling._HELD", 2)
    assert {r.word: r.n for r in vocabulary(frame(spark, ROWS)).collect()} == brute_words(ROWS)


def test_empty_tables(spark):
    assert variants(frame(spark, ROWS).limit(0)).count() == 0
    assert variants(frame(spark, [(1, None), (2, "few words")])).count() == 0


def test_sides_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.spelling.small_side", lambda df: df)
    assert got(variants(frame(spark, ROWS), crowd=2)) == brute(ROWS)
