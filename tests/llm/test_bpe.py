import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm.bpe import decode, encode
from tidemark.llm.queries import QUERIES
from tidemark.llm.tokenizers_in_tasks import PATTERN

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_published_one():
    assert PATTERN == public_tokenizers.PATTERN


def test_query_is_the_library_s(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_byte_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def some_texts():
    rng = random.Random(7)
    marks = "abZ'stlrevmd 019  \t\n\n\r\x0b\x1c\x85\xa0\u2003\u3000.,!<|>éß中語٠½\u0301😀"
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += ["a" * 300, " " * 300, "don't " * 60, "we'll\n\n  they're " * 20, "word " * 20 + "x" * 200 + " word" * 20, "\n \t" * 90, "1234567 " * 40]
    return texts


@pytest.mark.parametrize("chunk,overlap", [(32, 8), (50, 25), (16, 3), (64, 64)])
def test_chunks_give_what_the_whole_gives(spark, library, chunk, overlap):
    texts = some_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1]), (None, None), (900, None), (901, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, ids string")
    docs = docs.selectExpr("*", "ids AS key", "ids AS start", "ids AS run")
    got = decode(encode(docs, PATH, chunk, overlap), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=key) == sorted(want, key=key)


def test_null_ids_stay_null(spark):
    got = decode(spark.createDataFrame([(1, None, "x"), (2, [], "y"), (3, [0, 1], "z")], "n int, ids array<int>, decoded string"), PATH)
    assert [r.decoded for r in got.orderBy("n").collect()][:2] == [None, b""]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(docs, PATH), PATH).collect() == []
