"""Byte-level BPE over whole texts: overlapping chunks, stitched where their pre-tokens agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, texts_of
from tidemark.llm.tokenizers_in_tasks import PATTERN, once, rank_encoding, shipped

CHUNK = 1 << 16
OVERLAP = 1 << 11


def meeting_points(text: str, start: int, low: int, high: int) -> list[int]:
    """Pre-token boundaries of the chunk `text`, which stands at `start`, from `low` up to `high`.

    Only ends of words before white space count: there every scan has a boundary, wherever it
    began, because no pre-token goes from a word into white space. Two chunks that both have such
    a boundary agree from it on.
    """
    found, at = [], start
    for piece in regex.findall(PATTERN, text):
        if piece[0] in " \t\r\n" and at > start and low <= at < high and not text[at - start - 1].isspace():
            found.append(at)
        at += len(piece)
    return found


def encode(
    docs: DataFrame,
    ranks: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, ids array<int>): a row for each row of `docs`, by a rank file.

    A text of up to `chunk` characters is one chunk. A longer one is cut into chunks that reach
    `overlap` characters into the next. They are pre-tokenised in parallel, cut at the first
    boundary that both see in the overlap, and encoded in parallel; a chunk that shares none with
    the one before (no white space in the overlap) is joined to it first. Long copies are encoded
    once. Null and empty texts have no ids; null ids and repeated rows are rows like any other.
    """
    content = shipped(docs.sparkSession, ranks)

    def encoded(texts: list[str]) -> pa.Array:
        encoding = once(content.value, rank_encoding)
        parts = [encoding.encode_to_numpy(t, disallowed_special=()) for t in texts]
        ends = np.cumsum([0, *map(len, parts)])
        values = np.concatenate([np.zeros(0, np.uint32), *parts]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))

    texts = texts_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    short = map_batches(
        texts.where(F.length("text") <= chunk),
        lambda batch: {"doc_id": batch["doc_id"], "ids": encoded(batch["text"])},
        "doc_id long, ids array<int>",
    )
    long = texts.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    whole = _long_ids(long.groupBy("key").agg(F.first("text").alias("text")), encoded, chunk, overlap)
    return short.union(long.select("doc_id", "key").join(whole, "key").select("doc_id", "ids"))


def _long_ids(texts: DataFrame, encoded, chunk: int, overlap: int) -> DataFrame:
    """(key, ids) of each (key, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = range(0, len(text), chunk)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": [key] * len(starts),
                        "start": list(starts),
                        "part": [text[s : s + chunk + overlap] for s in starts],
                    }
                )

    parts = texts.select("key", "text").mapInArrow(cut, "key string, start long, part string")
    spread = parts.repartition("key", "start")

    def scan(batch: dict[str, list]) -> dict[str, list]:
        each = list(zip(batch["start"], batch["part"], strict=True))
        return {
            **batch,
            "head": [meeting_points(p, s, s, s + overlap) for s, p in each],
            "tail": [meeting_points(p, s, s + chunk, s + chunk + overlap) for s, p in each],
        }

    scanned = map_batches(spread, scan, "key string, start long, part string, head array<long>, tail array<long>")
    in_order = W.partitionBy("key").orderBy("start")
    cuts = scanned.withColumn(
        "cut",
        F.when(F.col("start") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(in_order)))),
    ).withColumn("run", F.count("cut").over(in_order))
    runs = (
        cuts.groupBy("key", "run")
        .agg(F.array_sort(F.collect_list(F.struct("start", "part"))).alias("parts"), F.min("cut").alias("low"))
        .withColumn("high", F.lead("low").over(W.partitionBy("key").orderBy("run")))
    )

    def finish(batch: dict[str, list]) -> dict[str, list]:
        own = []
        for found, low, high in zip(batch["parts"], batch["low"], batch["high"], strict=True):
            start = found[0]["start"]
            text = "".join(p["part"][:chunk] for p in found[:-1]) + found[-1]["part"]
            own.append(text[low - start : None if high is None else high - start])
        return {"key": batch["key"], "run": batch["run"], "ids": encoded(own)}

    pieces = map_batches(runs.select("key", "run", "parts", "low", "high"), finish, "key string, run long, ids array<int>")
    whole = pieces.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("run", "ids"))).alias("runs"))
    return whole.select("key", F.flatten(F.col("runs.ids")).alias("ids"))


def decode(ids: DataFrame, ranks: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """`ids` with a binary column `name`: the bytes of its tokens, one after another.

    Null stays null, no ids give no bytes; an id that the file lacks is an error.
    """
    content = shipped(ids.sparkSession, ranks)
    columns = [c for c in ids.columns if c != name]
    schema = ", ".join([f"`{c}` {ids.schema[c].dataType.simpleString()}" for c in columns] + [f"`{name}` binary"])

    def table(ranks_file: bytes) -> dict[int, bytes]:
        encoding = rank_encoding(ranks_file)
        return {i: encoding.decode_single_token_bytes(i) for i in encoding._mergeable_ranks.values()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = once(content.value, table)
        for batch in batches:
            found = batch.column(columns.index(ids_col))
            values = found.values.to_numpy(zero_copy_only=False).tolist()
            ends = found.offsets.to_pylist()
            out = [
                b"".join([token[i] for i in values[a:b]]) if there else None
                for a, b, there in zip(ends, ends[1:], found.is_valid().to_pylist(), strict=False)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*columns, name])

    return ids.select(*[f"`{c}`" for c in columns]).mapInArrow(run, schema)
