import heapq
import random
import zlib
from collections import Counter, defaultdict

from tidemark.llm.queries import QUERIES
from tidemark.llm.sharding import schedule, shard


def brute(groups, shards):
    """Groups as sizes, one by one through a heap: the sizes each shard gets."""
    heap, got = [(0, i) for i in range(shards)], defaultdict(Counter)
    for size in sorted(groups, reverse=True):
        load, i = heapq.heappop(heap)
        got[i][size] += 1
        heapq.heappush(heap, (load + size, i))
    return got


def test_schedule_is_the_heap_over_single_groups():
    rng = random.Random(1)
    for _ in range(60):
        shards = rng.choice([1, 2, 5, 16])
        sizes = {rng.randint(1, 60): rng.choice([1, 2, 7, 40, 500]) for _ in range(rng.randint(1, 12))}
        want = brute([s for s, n in sizes.items() for _ in range(n)], shards)
        for size, given in schedule(sorted(sizes.items(), reverse=True), shards):
            assert given == [want[i][size] for i in range(shards)]
            assert sum(given) == sizes[size]


def check(rows, texts, shards):
    """rows: (doc_id, text) multiset told by crc; every law of the result."""
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in texts
    )
    slots, where = defaultdict(list), {}
    groups = Counter(t or "" for _, t in texts)
    by_text = {zlib.crc32(t.encode()): t for t in groups}
    assert len(by_text) == len(groups)
    got = defaultdict(Counter)
    for r in rows:
        slots[r.shard].append(r.slot)
        text = by_text[r.text_crc32]
        if text not in where:
            where[text] = r.shard
            got[r.shard][size(text) * groups[text]] += 1
        assert where[text] == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = brute([size(t) * n for t, n in groups.items()], shards)
    assert all(got[i] == want[i] for i in range(shards))


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op9_sharding"](spark, sf).collect()
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    check(rows, texts, 16)


def test_nulls_copies_ties_and_clashing_names(spark):
    rng = random.Random(2)
    texts = [(i, rng.choice(["aa", "bb", "cé", "dd"]) * rng.randint(0, 3)) for i in range(60)]
    texts += [(None, "aa"), (None, None), (5, "aa"), (5, "aa"), (70, "x" * 100_000), (71, None), (72, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts], "doc_id long, text string, shard string")
    docs = docs.selectExpr("*", "shard AS size", "shard AS rank", "shard AS `group`", "shard AS number")
    check(shard(docs, 4).collect(), texts, 4)


def test_empty_table(spark):
    assert shard(spark.createDataFrame([], "doc_id long, text string"), 3).collect() == []
