"""The corpus pipeline: toxic texts go, near-duplicates and repeated passages go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and gives a table that is written and read again as the next
one's `docs`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.packing import pack
from tidemark.llm.simhash import keep_one
from tidemark.llm.substrings import cut_repeats
from tidemark.llm.toxicity import fit, score
from tidemark.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, "_llm_score").where("_llm_score < 0.5").drop("_llm_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of those linked by fingerprints of 3-word shingles, 3 bits apart."""
    return keep_one(docs, shingle=3, distance=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the first document that has them.

    A document without such a passage keeps its text as it is; others keep their remaining words,
    joined by one space, and a document that is nothing but repeats keeps its row and no words.
    """
    changed = F.col("_llm_cut.n_removed") > 0
    text = F.when(changed, F.col("_llm_cut.kept")).otherwise(F.col("text"))
    out = cut_repeats(docs, window=50, name="_llm_cut").withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", length)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens; a row per piece, its ids included."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

# Hashes, a trained classifier and tokenizers are beyond SQL; the tests hold the result against
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over `documents`, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
