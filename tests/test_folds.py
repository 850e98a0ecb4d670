import heapq
import random
from collections import Counter

import numpy as np
import pytest

from checks import telemetry as t
from tidemark.operators import folds as fo


def heap_loads(sizes, k):
    heap = [(0, i) for i in range(k)]
    for size in sorted(sizes, reverse=True):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
    return [load for load, _ in sorted(heap, key=lambda x: x[1])]


@pytest.mark.parametrize("seed", range(40))
def test_dealing_by_size_is_what_a_heap_does(seed):
    draw = random.Random(seed)
    k = draw.randrange(1, 9)
    sizes = [draw.choice([1, 2, 3, 7, draw.randrange(1, 500)]) for _ in range(draw.randrange(1, 300))]
    loads = [0] * k
    for size in sorted(set(sizes), reverse=True):
        counts = fo._dealt(loads, size, sizes.count(size))
        assert sum(counts) == sizes.count(size) and min(counts) >= 0
    assert loads == heap_loads(sizes, k)


def test_folds_are_balanced_by_load(spark):
    draw = random.Random(1)
    sizes = {f"d{i}": 1 + int(400 * draw.random() ** 12) for i in range(60)} | {"big": 420}
    rows = [(g,) for g, n in sizes.items() for _ in range(n)]
    found = fo.group_folds(spark.createDataFrame(rows, "installation_id string"), 5).collect()
    assert {r["installation_id"]: r["size"] for r in found} == sizes
    loads = [sum(r["size"] for r in found if r["fold"] == f) for f in range(5)]
    assert loads == heap_loads(sizes.values(), 5)


def test_more_folds_than_groups_and_no_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "installation_id string")
    assert {r["installation_id"]: r["fold"] for r in fo.group_folds(df, 5).collect()} == {"b": 0, "a": 1}
    assert fo.group_folds(df.limit(0), 5).count() == 0


def greedy(signatures, k):
    """Group by group, each to the fold that leaves the shares of the labels most alike."""
    total = np.maximum(np.sum(signatures, axis=0), 1)
    counts = np.zeros((k, len(total)))
    for s in sorted(signatures, key=lambda s: -np.std(s)):
        tried = []
        for f in range(k):
            counts[f] += s
            tried.append(np.mean([np.std(counts[:, x] / total[x]) for x in range(len(total))]))
            counts[f] -= s
        counts[int(np.argmin(tried))] += s
    return counts


def folded(rows, k):
    counts = np.zeros((k, 4))
    for r in rows:
        counts[r["fold"]] += [r[f"label_{x}"] for x in range(4)]
    return counts


@pytest.mark.parametrize("seed", range(20))
def test_levelled_is_no_worse_than_the_greedy_loop(seed):
    draw = random.Random(seed)
    kinds = [[draw.choice([0, 0, 1, 2, draw.randrange(30)]) for _ in range(4)] for _ in range(30)]
    signatures = [draw.choice(kinds) for _ in range(200)]
    found = Counter(map(tuple, signatures))
    distinct = np.array(sorted(found, key=lambda s: -np.std(s)), dtype=float)
    groups = np.array([found[tuple(int(x) for x in s)] for s in distinct])
    counts = fo._levelled(distinct, groups, 5)
    assert counts.sum(axis=1).tolist() == groups.tolist() and counts.min() >= 0
    assert fo.unevenness(counts.T @ distinct) <= fo.unevenness(greedy(signatures, 5))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_balanced_folds_of_the_tables(spark, sf):
    labels = t.labels(spark, f"/root/testdata/sf{sf}")
    rows = fo.balanced_folds(labels, 5).collect()
    assert len(rows) == labels.select("installation_id").distinct().count()
    signatures = [[r[f"label_{x}"] for x in range(4)] for r in rows]
    assert fo.unevenness(folded(rows, 5)) <= fo.unevenness(greedy(signatures, 5)) + 1e-12
    again = fo.balanced_folds(labels.repartition(7), 5).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_balanced_within_and_of_nothing(spark):
    rows = [(f"d{i}", (i * j) % 4, i % 3) for i in range(50) for j in range(1 + i % 7)]
    df = spark.createDataFrame(rows, "installation_id string, accuracy_group int, part int")
    got = fo.balanced_folds(df, 2, within="part", name="half").collect()
    assert len(got) == 50
    for part in range(3):
        own = [r for r in got if r["part"] == part]
        assert {r["half"] for r in own} == {0, 1}
        counts = np.zeros((2, 4))
        for r in own:
            counts[r["half"]] += [r[f"label_{x}"] for x in range(4)]
        signatures = [[r[f"label_{x}"] for x in range(4)] for r in own]
        assert fo.unevenness(counts) <= fo.unevenness(greedy(signatures, 2)) + 1e-12
    assert fo.balanced_folds(df.limit(0), 5).collect() == []
    assert fo.balanced_folds(df.where("installation_id = 'd3'"), 5).count() == 1
