import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.llm.test_simhash import brute_print, brute_roots
from tests.llm.test_substrings import brute
from tidemark.llm.toxicity import fit, score

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    outs = []
    for name, work in corpus_pipeline.STAGES:
        work(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        outs.append(docs)
    # toxicity: the operator's own decision, each kept row as it was
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(whole, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in score(whole, model).collect() if r.score < 0.5}
    assert {r.doc_id: r for r in outs[0].collect()} == {i: rows[i] for i in clean}
    # near-duplicates: the smallest id of each component
    prints = {i: brute_print(rows[i].text) for i in clean}
    roots = brute_roots(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for i in sorted(clean):
        first.setdefault(roots[prints[i]], i)
    assert {r.doc_id: r for r in outs[1].collect()} == {i: rows[i] for i in first.values()}
    # repeated passages
    after = {i: (gone, kept) for i, _, gone, kept in brute([(i, rows[i].text) for i in first.values()], 50)}
    got = {r.doc_id: r for r in outs[2].collect()}
    assert outs[2].columns == whole.columns and outs[2].schema == outs[1].schema
    assert set(got) == set(after)
    for i, (gone, kept) in after.items():
        text = kept if gone else rows[i].text
        assert got[i].text == text and got[i].n_chars == (len(text) if gone else rows[i].n_chars)
    # packing: every document whole, the stage's texts
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = {}
    for r in sorted(outs[3].collect(), key=lambda r: (r.doc_id, r.start)):
        pieces.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert pieces == {
        i: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for i, r in got.items()
    }


def test_run_is_the_stages_in_turn(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "packing"]
    got = __spark_entry__.queries()["pipeline"](spark, SF)
    assert got.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(got.columns)


def test_odd_rows_go_through_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    rows = [(1, None, None, None, None, "a"), (2, "", "en", "s", 0, "b"), (3, "word " * 60, "en", "s", 300, "c"),
            (3, "word " * 60, "en", "s", 300, "c"), (None, "other text", "en", "s", 9, "d"), (4, "w" * 100_000, "en", "s", 9, None)]
    docs = spark.createDataFrame(rows, schema)
    for _, work in corpus_pipeline.STAGES[:-1]:
        docs = work(spark, docs, SF)
        assert docs.schema == spark.createDataFrame([], schema).schema
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect()) == [(False, 1), (False, 3), (False, 4), (True, 0)]
    empty = spark.createDataFrame([], schema)
    for _, work in corpus_pipeline.STAGES:
        empty = work(spark, empty, SF) if empty.columns[0] == "doc_id" else empty
    assert empty.collect() == []
