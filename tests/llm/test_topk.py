import math
import random

import numpy as np
import pytest

from checks.compare import connect, rows
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.topk import Block, top_k


def brute(vectors, wanted, k):
    """vectors, wanted: (id, list): what top_k returns."""
    def usable(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if usable(i, v)]
    out = []
    for i, q in {(i, tuple(math.floor(256 * x) for x in v)) for i, v in wanted if usable(i, v)}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in kept if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_sql(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    df = QUERIES["op6_topk"](spark, sf)
    cursor = connect(sf).execute(ORACLES["op6_topk"])
    assert rows([d[0] for d in cursor.description], cursor.fetchall()) == rows(df.columns, df.collect())


def test_odd_vectors_ties_and_clashing_names(spark):
    rng = random.Random(9)
    vectors = [(i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(3)]) for i in range(150)]
    vectors += [(i, [0.5, 0.5, 0.5]) for i in range(200, 300)]  # a very common vector
    vectors += [(7, [0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5]), (None, [9.0, 9.0, 9.0]), (400, None), (401, [1.0, None, 1.0]),
                (402, [float("nan"), 1.0, 1.0]), (403, [float("inf"), 1.0, 1.0]), (404, [0.1, 0.2]), (405, []), (406, [-3.7, 12.0, 0.001])]
    df = spark.createDataFrame([(i, v, "s") for i, v in vectors], "vec_id long, embedding array<double>, score string")
    df = df.selectExpr("*", "score AS rank", "score AS id", "score AS copy", "score AS width")
    for k in (1, 5, 400):
        got = top_k(df, df.where("vec_id % 50 = 0 OR vec_id IN (7, 404, 405, 406)"), k, block=64).collect()
        wanted = [(i, v) for i, v in vectors if i is not None and (i % 50 == 0 or i in (7, 404, 405, 406))]
        assert sorted(map(tuple, got)) == brute(vectors, wanted, k)


@pytest.mark.parametrize("reach,slices", [(100, 16), (100, 3), (10**6, 16), (10**6, 5), (1, 16)])
def test_slices_find_the_best_rows(reach, slices):
    rng = np.random.default_rng(reach + slices)
    for n in (1, 63, 64, 200):
        ids = rng.permutation(1000)[:n]
        vectors = rng.integers(-reach, reach + 1, (n, 6))
        queries, query_ids = rng.integers(-reach, reach + 1, (9, 6)), np.append(ids[:1], np.arange(5000, 5008))
        for query_id, got, scores in Block(ids, vectors, slices).best(query_ids, queries, 4):
            q = queries[list(query_ids).index(query_id)]
            want = sorted((-int(v @ q), i) for i, v in zip(ids, vectors, strict=True) if i != query_id)[:4]
            assert sorted(zip((-scores).tolist(), got.tolist(), strict=True))[:4] == want
            if slices == 16 and reach == 100:
                assert len(got) <= 4


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert top_k(empty, empty).collect() == top_k(empty, one).collect() == top_k(one, one).collect() == []


def test_products_beyond_64_bits_are_errors_not_rankings(spark):
    def best(rows):
        df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
        return [(r.query_id, r.vec_id, r.score) for r in top_k(df, df, k=1).orderBy("query_id").collect()]

    # as large as fits: (256e6)**2 * 2 is below 2**62
    far = 256 * 10**6
    assert best([[1e6, 1e6], [1e6, 1e6], [1.0, 1.0], [-1e6, 1e6]])[:2] == [(0, 1, 2 * far * far), (1, 0, 2 * far * far)]
    for size in (1e7, 1e17):
        with pytest.raises(Exception, match="64-bit integers"):
            best([[size, size], [size, size], [1.0, 1.0], [-size, size]])
