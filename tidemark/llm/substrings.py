"""Repeated passages, found by winnowed anchors, extended both ways, and cut where they repeat.

Every run of `window` words has an anchor: the smallest hash among its runs of `anchor` words. It
depends on the run alone, so equal runs have equal anchors wherever they stand. Consecutive runs
with one anchor form a segment, whose span is all the words of its runs. Documents meet on
anchors, never pair by pair:

* documents with equal anchor and equal span repeat a whole segment: all but the first are cut;
* where one anchor has several spans, the match ends inside them. There the first document of
  each span extends the anchor both ways into its single runs, and runs meet instead of spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.session import shuffled, small_side, stage

_WORDS = 1 << 17  # hashes of words that a task keeps at hand
_SEGMENT = "doc_id long, text_key long, first int, runs int, anchor long, span long"
_RUN = "doc_id long, text_key long, first int, anchor long, run long"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 4096, 2 * len(self.up))
            steps = np.full(size, self.base, dtype=np.uint64)
            back = np.full(size, self.inverse, dtype=np.uint64)
            steps[0] = back[0] = 1
            self.up, self.down = np.cumprod(steps), np.cumprod(back)
        return self.up[:n], self.down[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread polynomial hashes over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Runs:
    """Hashes of the runs of words of one text."""

    def __init__(self, window: int, anchor: int) -> None:
        self.window, self.anchor = window, min(anchor, window)
        self.words = _WordHashes()
        self.for_anchors, self.for_spans = _Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD93)

    def _prefixes(self, hashes: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
        up, down = powers.upto(len(hashes))
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up, out=sums[1:])
        return sums, down

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The anchor of each run of `window` words, and what span hashes are made of."""
        words = text.split()
        if len(words) < self.window:
            return None
        hashes = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        sums, down = self._prefixes(hashes, self.for_anchors)
        small = _mixed((sums[self.anchor :] - sums[: -self.anchor]) * down[: len(words) - self.anchor + 1])
        width, size, least = self.window - self.anchor + 1, 1, small
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        n = len(words) - self.window + 1
        least = np.minimum(least[:n], least[width - size : width - size + n])
        return least, *self._prefixes(hashes, self.for_spans)

    def segments(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """First run, number of runs, anchor and span hash of each segment."""
        found = self.of(text)
        if found is None:
            return None
        least, sums, down = found
        first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        count = np.diff(np.append(first, len(least)))
        span = _mixed((sums[first + count - 1 + self.window] - sums[first]) * down[first])
        return first, count, least[first], span

    def single(self, text: bytes, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """First word, anchor and hash of every run of the given segments."""
        least, sums, down = self.of(text)
        at = np.concatenate([np.arange(f, f + c) for f, c in zip(first, count, strict=True)])
        return at, least[at], _mixed((sums[at + self.window] - sums[at]) * down[at])


def _table(schema: str, columns: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """A batch of numpy columns, each given in parts; no batch where there are no parts."""
    if columns[0]:
        names = [c.split()[0] for c in schema.split(", ")]
        kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in schema.split(", ")]
        whole = [np.concatenate(parts) for parts in columns]
        arrays = [
            pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(k.to_pandas_dtype()), type=k)
            for x, k in zip(whole, kinds, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _segments(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(window, anchor)
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = runs.segments(text)
                if found is not None:
                    n = len(found[0])
                    for parts, x in zip(columns, (np.full(n, doc), np.full(n, key), *found), strict=True):
                        parts.append(x)
            yield from _table(_SEGMENT, columns)

    return texts.mapInArrow(run, _SEGMENT)


def _single_runs(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """Runs of the segments listed in `firsts` and `counts` (arrays) beside each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(window, anchor)
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(5)]
            for doc, key, text, first, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, own, values = runs.single(text, np.array(first), np.array(count))
                for parts, x in zip(columns, (np.full(len(at), doc), np.full(len(at), key), at, own, values), strict=True):
                    parts.append(x)
            yield from _table(_RUN, columns)

    return texts.mapInArrow(run, _RUN)


def _each_once(texts: DataFrame) -> DataFrame:
    """Rows that share doc_id and text_key once; only rows that repeat are moved for it."""
    same = ["doc_id", "text_key"]
    found = texts.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = small_side(found)
    if repeated.isEmpty():
        return texts
    once = texts.join(repeated, same, "left_semi").groupBy(*same).agg(F.min("text").alias("text"))
    return texts.join(repeated, same, "left_anti").union(stage(once, "once"))


def repeated_places(docs: DataFrame, window: int, anchor: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, firsts, ends): the words to cut, as stretches in arrays per document."""
    texts = small_batches(docs).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        _text_key(text_col).alias("text_key"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
    ).where("doc_id IS NOT NULL AND text IS NOT NULL")
    # copies of a row do not cut each other, so one stands for all
    texts = _each_once(texts)
    segments = stage(_segments(texts, window, anchor), "segments")
    shared = (
        segments.groupBy("anchor")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
            (F.min("span") < F.max("span")).alias("several"),
        )
        .where("first_doc < last_doc")
        .select("anchor", "first_doc", "several")
    )
    met = stage(segments.join(shuffled(shared), "anchor"), "met")
    whole = met.where("NOT several AND doc_id > first_doc")
    several = met.where("several").drop("first_doc")
    first_of_span = several.groupBy("anchor", "span").agg(F.min("doc_id").alias("first_doc"))
    of_span = stage(several.join(shuffled(first_of_span), ["anchor", "span"]), "spans")
    whole = whole.select("doc_id", "text_key", "first", "runs").union(
        of_span.where("doc_id > first_doc").select("doc_id", "text_key", "first", "runs")
    )
    extended = (
        of_span.where("doc_id = first_doc")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("first", "runs")).alias("s"))
        .select("doc_id", "text_key", F.col("s.first").alias("firsts"), F.col("s.runs").alias("counts"))
    )
    again = texts.join(shuffled(extended), ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "firsts", "counts")
    singles = stage(_single_runs(again, window, anchor), "runs")
    first_of_run = (
        singles.groupBy("anchor", "run")
        .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .where("first_doc < last_doc")
    )
    # a written side: a join straight on an aggregate is not split where a run is very common
    cut = singles.join(shuffled(stage(first_of_run, "shared-runs")), ["anchor", "run"]).where("doc_id > first_doc")
    return (
        whole.union(cut.select("doc_id", "text_key", "first", F.lit(1).alias("runs")))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("first", (F.col("first") + F.col("runs") + (window - 1)).alias("end"))).alias("s"))
        .select("doc_id", "text_key", F.col("s.first").alias("firsts"), F.col("s.end").alias("ends"))
    )


def _text_key(text_col: str) -> Column:
    """Tells the texts of rows that share a doc_id."""
    return F.xxhash64(F.col(f"`{text_col}`"))


def _cut(texts: pd.Series, firsts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    out = []
    for text, first, end in zip(texts, firsts, ends, strict=True):
        words = (text or "").encode().split()
        n = len(words)
        if first is not None:
            steps = np.zeros(n + 1, dtype=np.int64)
            np.add.at(steps, np.asarray(first, dtype=np.int64), 1)
            np.add.at(steps, np.asarray(end, dtype=np.int64), -1)
            stays = (np.cumsum(steps[:-1]) == 0).tolist()
            words = [w for w, stay in zip(words, stays, strict=True) if stay]
        out.append((n, n - len(words), b" ".join(words).decode()))
    return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])


def cut_repeats(
    docs: DataFrame,
    window: int = 50,
    anchor: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    name: str = "cut",
) -> DataFrame:
    """`docs` with a struct column `name`: n_words, n_removed, kept (words joined by one space).

    Words are runs without ASCII white space. A word is removed if it lies in a run of `window`
    words that also starts in a document with a smaller doc_id; runs are judged on the input. A
    row in, a row out. Repeated rows are cut alike and do not cut each other, as their doc_id is
    the same; rows without a doc_id are neither cut nor a reason to cut; a null or empty text has
    no words. Texts equal in 128 bits of anchor and run hash count as equal.
    """
    places = repeated_places(docs, window, anchor, id_col, text_col).select(
        F.col("doc_id").alias("_llm_id"),
        F.col("text_key").alias("_llm_key"),
        F.col("firsts").alias("_llm_firsts"),
        F.col("ends").alias("_llm_ends"),
    )
    own = [F.col(f"`{c}`") for c in docs.columns]
    same = (F.col(f"`{id_col}`").cast("long") == F.col("_llm_id")) & (_text_key(text_col) == F.col("_llm_key"))
    text = F.col(f"`{text_col}`").cast("string")
    cut = F.pandas_udf(_cut, "n_words long, n_removed long, kept string")
    return docs.join(shuffled(places), same, "left").select(*own, cut(text, "_llm_firsts", "_llm_ends").alias(name))
