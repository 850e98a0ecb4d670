import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm.backoff import scores
from tidemark.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, order, backoff, least):
    """rows: (doc_id, text); sorted (doc_id, n_words, n_backed_off, score)."""
    split = []
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        split.append((i, WORD.findall(low)))
    counts = Counter(tuple(w[at : at + n]) for _, w in split for n in range(1, order + 1) for at in range(len(w) - n + 1))
    everything = sum(len(w) for _, w in split)
    out = []
    for i, w in split:
        total, backed = 0.0, 0
        for at in range(len(w)):
            most = min(order, at + 1)
            for n in range(most, 0, -1):
                gram = tuple(w[at - n + 1 : at + 1])
                if n == 1 or counts[gram] >= least:
                    before = counts[gram[:-1]] if n > 1 else everything
                    total += math.log(counts[gram] / before) + (most - n) * math.log(backoff)
                    backed += n < most
                    break
        out.append((i, len(w), backed, round(total, 6)))
    return sorted(out, key=lambda r: (r[0] is None, r))


def ordered(rows):
    found = [(r.doc_id, r.n_words, r.n_backed_off, round(r.score, 6)) for r in rows]
    return sorted(found, key=lambda r: (r[0] is None, r))


def close(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-9, abs=1e-5)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op1_backoff"](spark, sf).collect()
    close(ordered(rows), brute(docs, 3, 0.4, 2))
    assert all((r.mean_score is None) == (r.n_words == 0) for r in rows)


@pytest.mark.parametrize("order,least,table", [(1, 2, 1 << 20), (2, 3, 16), (4, 2, 64), (3, 1, 1 << 20)])
def test_orders_thresholds_and_parts(spark, order, least, table):
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice("a b c D d É é the of".split()) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    rows += [(0, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (None, None), (50, None), (51, " \t\n"), (52, "long text " * 40_000)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, block string")
    got = scores(docs.selectExpr("*", "block AS part", "block AS score"), order, 0.4, least, table=table).collect()
    close(ordered(got), brute(rows, order, 0.4, least))


def test_empty_table(spark):
    assert scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
