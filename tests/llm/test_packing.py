import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import Packer, pack
from tidemark.llm.queries import QUERIES
from tidemark.llm.tokenizers_in_tasks import json_encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, window):
    """docs: ids by doc_id. Every id in one piece, windows gapless; the padding is returned."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(docs)
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            ids = docs[doc][at : at + p.length]
            assert (p.start, p.doc_tokens) == (at, len(docs[doc])) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
            at += p.length
        assert at == len(docs[doc])
    padding = 0
    for pieces in by_sequence.values():
        fill = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == fill
            fill += p.length
        assert fill <= window
        padding += 0 if fill & (fill - 1) == 0 else window - fill
    return padding


def test_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: ids_of(tokenizer, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert check(QUERIES["op4_packing"](spark, sf).collect(), docs, 2048) == 0


def test_nulls_long_texts_and_clashing_names(spark, tokenizer):
    texts = [None, "", "a", "<|endoftext|> x", "long text " * 20_000, "é\x85 \n" * 30, *["same"] * 5]
    docs = spark.createDataFrame([(i, t, "s", "s") for i, t in enumerate(texts)] + [(None, "none", "s", "s")], "doc_id long, text string, ids string, start string")
    rows = pack(docs.selectExpr("*", "ids AS sequence_id"), PATH, 64).selectExpr("*", "crc32(ids) AS ids_crc32").drop("ids").collect()
    assert check(rows, {**{i: ids_of(tokenizer, t) for i, t in enumerate(texts)}, None: ids_of(tokenizer, "none")}, 64) == 0
    twice = pack(docs.where("doc_id = 6").union(docs.where("doc_id = 6")), PATH, 64).collect()
    assert sum(r.length for r in twice) == 2 * len(ids_of(tokenizer, "same"))


def test_sequences_of_partitions_stay_apart(spark, tokenizer):
    texts = [f"text {i} " * (i % 7 + 1) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    rows = pack(docs, PATH, 64).coalesce(2).selectExpr("*", "crc32(ids) AS ids_crc32").collect()
    assert check(rows, {i: ids_of(tokenizer, t) for i, t in enumerate(texts)}, 64) == 0


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def brute_level(counts, size, window):
    """The best of all levels by the sum of squares itself."""
    def after(level):
        now = list(counts)
        if level:
            now[level] -= 1
        if level + size < window:
            now[level + size] += 1
        return sum(n * n for n in now[1:window])

    choices = [0] + [h for h in range(1, window - size + 1) if counts[h]]
    least = min(after(h) for h in choices)
    return max(h for h in choices if after(h) == least)


def test_levels_by_the_sum_of_squares():
    rng = random.Random(4)
    packer, window = Packer(24), 24
    for n in range(600):
        size = rng.choice([1, 2, 3, 5, 8, 13, 23, 24])
        assert packer.level_for(size) == brute_level(packer.counts.tolist(), size, window)
        packer.add(n, np.arange(size))
    assert [len(x) for x in packer.open] == packer.counts[:-1].tolist()
    assert all(sum(len(p.ids) for p in pieces) == window for pieces in packer.closed)


def test_few_windows_stay_open():
    rng = random.Random(5)
    packer = Packer(100)
    for n in range(20_000):
        packer.add(n, np.arange(rng.randint(1, 99)))
    assert packer.counts.sum() < 0.1 * (len(packer.closed) + packer.counts.sum())


def test_rank_encoder_gives_the_library_s_ids(tokenizer):
    encode = json_encoder(open(PATH, "rb").read())
    rng = random.Random(6)
    marks = "abZ'stlrevmd 019\t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u180e\u2003\u2028\u3000\ufeff.,!<|>éßñ中語한٠½²ª\u0301😀\u200d"
    for n in range(4000):
        text = "".join(rng.choice(marks) if n % 2 else chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF), 32, 10])) for _ in range(rng.randint(0, 30)))
        text += "<|endoftext|>" * (n % 10 == 0)
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
