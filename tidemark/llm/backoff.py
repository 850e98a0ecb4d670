"""Stupid-backoff language-model scores from n-gram count tables of the whole corpus.

Documents are dealt to blocks by their place in the table, which spreads copies of a row too. A
block sends its distinct n-grams with their counts to the count tables, which are partitioned by the
n-grams' hashes; a table adds up and tells each block the totals of the n-grams it asked for; the
block looks every n-gram of its documents up and sums. Between tasks an n-gram is one entry in a
sorted list of hashes, not a row, so a frequent n-gram moves once per block however often it stands
there.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import told_apart

_BLOCK_BYTES = 8 << 20
_TABLE = 1 << 20  # n-grams that one part of a count table gets, about
_WORDS = 1 << 17
_SPARE_BITS = 20  # a hash has this many bits more than it takes to number all n-grams,
_LEAST_BITS = 48  # and this many at least
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SENT = "part long, block long, size long, hashes binary, counts binary"
_TOLD = "part long, block long, size long, counts binary"
_SCORE = "doc_id long, n_words long, n_backed_off long, score double"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _planes(x: np.ndarray) -> bytes:
    """Numbers by byte planes: the leading ones are nearly all zero and shrink on the way."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").ravel()


class _Grams:
    """All n-grams of a block's documents: hashes by place, for n = 1 up to the order."""

    def __init__(self, texts: list[bytes], order: int, shift: int) -> None:
        self.shift = np.uint64(shift)
        parts, self.lengths = [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            words = text.lower().split()
            self.lengths[i] = len(words)
            parts.append(np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words)))
        own = np.concatenate([np.zeros(0, dtype=np.uint64), *parts])
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        # place of a word in its document: an n-gram that ends there needs n - 1 words before it
        firsts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(own)) - np.repeat(firsts, self.lengths)
        self.hashes = [_mixed(own)]
        for n in range(2, order + 1):
            longer = np.zeros(len(own), dtype=np.uint64)
            # the n-gram that ends at i is the one of n - 1 words before it, and the word at i
            longer[1:] = _mixed(self.hashes[-1][:-1] * _STEP + own[1:] + np.uint64(n))
            self.hashes.append(longer)

    def ending(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The places where an n-gram ends, and its hash, in as many bits as are used."""
        ends = np.flatnonzero(self.place >= n - 1)
        return ends, self.hashes[n - 1][ends] >> self.shift


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value starts in a sorted list."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


def scores(
    docs: DataFrame,
    order: int = 3,
    backoff: float = 0.4,
    least: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    table: int = _TABLE,
) -> DataFrame:
    """(doc_id, n_words, n_backed_off, score): a row for each row of `docs`.

    A word scores c(n-gram) / c(its first n - 1 words) for the longest n-gram, of up to `order`
    words, that ends with it and stands at least `least` times in the corpus; each shorter step
    costs a factor `backoff`. A single word scores c(word) / all words, however rare. Before a
    document's first words there is nothing to back off from. `score` sums the natural logarithms;
    n_backed_off counts the words that backed off. Counts are those of all documents, the scored
    one included: what stands in it alone is below `least`.

    A-Z are lower-cased, words are runs without ASCII white space. A null or empty text has no
    words and scores 0. Repeated rows count and score each; null ids are rows like any other.
    N-grams are told by hashes, of 20 bits more than number all of them (48 at least, 64 at most):
    the chance that one shares its hash with any other is at most one in a million.
    """
    spark = docs.sparkSession
    texts = told_apart(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"), "row")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-size // _BLOCK_BYTES), at_once)
    # a word and its space are six bytes or more in most texts; one power of two of parts an order
    bits = max(0, math.ceil(math.log2(max(1, size / 6 / table))))
    numbered = math.ceil(math.log2(max(1, size * order / 6)))
    shift = 64 - min(64, max(_LEAST_BITS, numbered + _SPARE_BITS))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).drop("row")

    def part_of(n: int, bucket: int) -> int:
        return (n << bits) + bucket

    def parts(n: int, ordered: np.ndarray) -> list[tuple[int, int, int]]:
        """(part, from, to) of a sorted list of hashes; parts go by the leading bits."""
        if bits == 0:
            return [(part_of(n, 0), 0, len(ordered))]
        edges = (np.arange(1, 1 << bits, dtype=np.uint64)) << np.uint64(64 - shift - bits)
        at = [0, *np.searchsorted(ordered, edges).tolist(), len(ordered)]
        return [(part_of(n, b), x, y) for b, (x, y) in enumerate(zip(at, at[1:], strict=False)) if x < y]

    def send(own: pa.Table) -> pa.Table:
        grams = _Grams(own["text"].to_pylist(), order, shift)
        # part 0 adds up all words
        rows = [(0, 1, _planes(np.zeros(1)), _planes(grams.lengths.sum(keepdims=True)))]
        for n in range(1, order + 1):
            ordered = np.sort(grams.ending(n)[1])
            if not len(ordered):
                continue
            first = _firsts(ordered)
            ordered, counts = ordered[first], np.diff(np.append(first, len(ordered)))
            for part, x, y in parts(n, ordered):
                rows.append((part, y - x, _planes(np.diff(ordered[x:y], prepend=np.uint64(0))), _planes(counts[x:y])))
        columns = list(zip(*rows, strict=True))
        return pa.table(
            {
                "part": pa.array(columns[0], pa.int64()),
                "block": pa.array([own["block"][0].as_py()] * len(rows), pa.int64()),
                "size": pa.array(columns[1], pa.int64()),
                "hashes": pa.array(columns[2], pa.binary()),
                "counts": pa.array(columns[3], pa.binary()),
            }
        )

    def add_up(own: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.cumsum(_numbers(h.as_py()), dtype=np.uint64) for h in own["hashes"]])
        counts = np.concatenate([_numbers(c.as_py()) for c in own["counts"]])
        # sorted runs one after another, which a stable sort merges
        by_hash = np.argsort(hashes, kind="stable")
        first = _firsts(hashes[by_hash])
        sums = np.add.reduceat(counts[by_hash], first)
        totals = np.empty(len(hashes), dtype=np.uint64)
        totals[by_hash] = np.repeat(sums, np.diff(np.append(first, len(hashes))))
        sizes = np.cumsum(own["size"].to_numpy())[:-1]
        told = [_planes(t) for t in np.split(totals, sizes)]
        return own.select(["part", "block", "size"]).append_column("counts", pa.array(told, pa.binary()))

    def look_up(own: pa.Table, told: pa.Table) -> pa.Table:
        grams = _Grams(own["text"].to_pylist(), order, shift)
        told = told.sort_by("part")
        n_of = told["part"].to_numpy() >> bits
        totals = [_numbers(c.as_py()) for c in told["counts"]]
        counts = []  # by n: the corpus count of the n-gram that ends at each word, 0 where none can
        for n in range(1, order + 1):
            here = np.zeros(len(grams.doc))
            ends, hashes = grams.ending(n)
            if len(ends):
                by_hash = np.argsort(hashes)
                first = _firsts(hashes[by_hash])
                own_totals = np.concatenate([t for t, m in zip(totals, n_of, strict=True) if m == n])
                here[ends[by_hash]] = np.repeat(own_totals, np.diff(np.append(first, len(ends))))
            counts.append(here)
        words = float(totals[0][0])
        logs = np.zeros(len(grams.doc))
        settled, steps = np.zeros(len(logs), dtype=bool), np.zeros(len(logs))
        for n in range(order, 0, -1):
            possible = ~settled & (grams.place >= n - 1)
            found = possible & ((counts[n - 1] >= least) if n > 1 else True)
            at = np.flatnonzero(found)
            before = counts[n - 2][at - 1] if n > 1 else words
            logs[at] = np.log(counts[n - 1][at]) - np.log(before) + steps[at] * math.log(backoff)
            settled |= found
            steps += possible & ~found
        return pa.table(
            {
                "doc_id": own["doc_id"],
                "n_words": pa.array(grams.lengths, pa.int64()),
                "n_backed_off": pa.array(np.bincount(grams.doc[steps > 0], minlength=len(grams.lengths)), pa.int64()),
                "score": pa.array(np.bincount(grams.doc, weights=logs, minlength=len(grams.lengths)), pa.float64()),
            }
        )

    # a stated number of partitions is not merged into fewer: tasks sort few blocks at a time
    dealt = dealt.repartition(2 * at_once, "block")
    sent = dealt.groupBy("block").applyInArrow(send, _SENT)
    told = sent.groupBy("part").applyInArrow(add_up, _TOLD).repartition(2 * at_once, "block")
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(look_up, _SCORE)
