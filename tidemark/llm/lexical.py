"""Ranked lexical search by an Aho-Corasick scan of the documents, without an index of them.

The terms of a block of items go into one automaton, each between two blanks, and a document is
read once as its words between blanks: every hit is a whole term, and hits per term are its
frequency in the document. What a document hit is kept as two short lists. Their totals give the
weights of the terms; a second look over the lists adds up the scores of the block's items, of
which each task sends its best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, map_batches, texts_of
from tidemark.operators.ordering import running_totals
from tidemark.session import stage

BLOCK_BYTES = 4 << 20  # terms of a block's items, each counted with _TERM_BYTES for its entry
_TERM_BYTES = 64
MOST_BYTES = 64 << 20  # of a block with an item that is larger than a block
_CELLS = 1 << 21  # scores, and hits of items, that a task has at hand
# Bytes outside words become blanks, and A-Z becomes a-z.
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)
_FOUND = "doc_id long, n long, terms array<int>, counts array<int>"
_BEST = "item int, doc_id long, score long"


def _words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(item_id, block, term): the terms of each item, once each."""
    given = items.select(
        F.col(f"`{item_col}`").alias("item_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    kind = given.schema["item_id"].dataType.simpleString()
    terms = stage(
        map_batches(
            given,
            lambda batch: {
                "item_id": batch["item_id"],
                "terms": [[w.decode() for w in sorted(set(_words(t)))] for t in batch["text"]],
            },
            f"item_id {kind}, terms array<string>",
        )
        .select("item_id", F.explode("terms").alias("term"))
        .distinct(),
        "item-terms",
    )
    sizes = terms.groupBy("item_id").agg(F.sum(F.octet_length("term").cast("long") + _TERM_BYTES).alias("bytes"))
    blocks = running_totals(sizes, ["item_id"], ["bytes"]).select("item_id", F.floor(F.col("bytes_before") / block_bytes).alias("block"))
    blocks = blocks.withColumnRenamed("item_id", "own_id")
    return stage(
        terms.join(blocks, F.col("item_id").eqNullSafe(F.col("own_id"))).select("item_id", "block", "term"), "blocks"
    )


class _Automaton:
    """Made once in each task that scans."""

    def __init__(self, terms: list[str]) -> None:
        self.found = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.found.add_word(f" {term} ", i)
        self.found.make_automaton()

    def scan(self, text: bytes) -> tuple[int, dict[int, int]]:
        """Number of words, and how often each term is one of them."""
        words = _words(text)
        # a blank belongs to the term before it and to the one after
        hits = self.found.iter(f" {b' '.join(words).decode()} ") if words else ()
        return len(words), Counter([i for _, i in hits])


def _scan(texts: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts): the words of a document, and the terms among them by number."""
    sent = texts.sparkSession.sparkContext.broadcast(terms)
    made: list[_Automaton] = []

    def work(batch: dict[str, list]) -> dict[str, list]:
        if not made:
            made.append(_Automaton(sent.value))
        found = [made[0].scan(t) for t in batch["text"]]
        return {
            "doc_id": batch["doc_id"],
            "n": [n for n, _ in found],
            "terms": [list(hits) for _, hits in found],
            "counts": [list(hits.values()) for _, hits in found],
        }

    return map_batches(texts, work, _FOUND)


class _Best:
    """The k best documents of each item, so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, null id, id
        self.least = np.zeros(items, np.int64)  # what a score must reach

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        doc, item = np.nonzero((scores > 0) & (scores >= self.least))
        new = (item, scores[doc, item], no_id[doc], ids[doc])
        item, score, no_id, ids = (np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((ids, no_id, -score, item))
        item = item[order]
        starts = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item)))) if len(item) else item
        self.rows = [x[order][rank < self.k] for x in (np.concatenate((self.rows[0], new[0])), score, no_id, ids)]
        full = rank == self.k - 1
        self.least[item[full]] = score[order][full]


def _score(found: DataFrame, weights: np.ndarray, starts: np.ndarray, items: np.ndarray, total: int, words: int, k: int) -> DataFrame:
    """(item, doc_id, score): the best k documents of each item in each task.

    items[starts[t]:starts[t + 1]] are the items that have the term t.
    """
    n_items = int(items.max()) + 1
    sent = found.sparkSession.sparkContext.broadcast((weights, starts, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, start, item = sent.value
        best = _Best(n_items, k)
        for batch in batches:
            ids = batch.column(0)
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            sizes = batch.column(2).value_lengths().to_numpy()
            first = np.concatenate(([0], np.cumsum(sizes)))
            terms, counts = (batch.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
            # a document's m, on Python integers: their product may leave 64 bits
            m = np.array([100 - 90 + 90 * n * total // words for n in batch.column(1).to_pylist()], dtype=np.int64)
            gain = weight[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(m, sizes)))
            spread = start[terms + 1] - start[terms]  # items that a hit counts for
            upto = np.concatenate(([0], np.cumsum(spread)))[first]
            low = 0
            while low < len(ids):
                high = min(low + max(1, _CELLS // n_items), len(ids))
                high = max(low + 1, min(high, int(np.searchsorted(upto, upto[low] + _CELLS, "right")) - 1))
                part = slice(first[low], first[high])
                own = spread[part]
                doc = np.repeat(np.repeat(np.arange(high - low), sizes[low:high]), own)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(own) - own, own)
                cell = doc * n_items + item[np.repeat(start[terms[part]], own) + nth]
                scores = np.zeros((high - low) * n_items, np.int64)
                np.add.at(scores, cell, np.repeat(gain[part], own))
                best.add(scores.reshape(-1, n_items), ids[low:high], no_id[low:high])
                low = high
        item, score, no_id, ids = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(ids, mask=no_id.astype(bool)), pa.array(score)],
            names=["item", "doc_id", "score"],
        )

    return found.select("doc_id", "n", "terms", "counts").where(F.size("terms") > 0).mapInArrow(run, _BEST)


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents of each item, or all that score.

    Terms are runs of ASCII letters and digits and of all other characters, with A-Z as a-z. With N
    documents that have a term, L terms in all, n in a document, df documents that have a term and
    tf its occurrences in one, a term weighs w = floor(1000 ln((2N + 2) / (2df + 1))), and an item
    scores the sum of w * (10^9 tf div (1000 tf + 8m)) over its terms, once each, where
    m = 10 + 90nN div L. A score of 0 is no match. Equal scores rank by ascending id, null ids last.

    Null and empty texts have no terms, as documents and as items; rows that share an item's id, a
    null one included, are one item with the terms of all; repeated documents are rows like any
    other. No items, or no documents, give no rows. Other columns are not read.

    Items go in blocks whose terms take `block_bytes`, and the last item's; only a block's terms are
    on the driver and in a broadcast. An item with more than 64 MB of different terms is an error.
    """
    blocks = _blocks(items, item_col, item_text_col, block_bytes)
    texts = as_bytes(texts_of(docs, id_col, text_col))
    kind = blocks.schema["item_id"].dataType.simpleString()
    empty = blocks.sparkSession.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    last = blocks.agg(F.max("block")).first()[0]
    best = [_of_block(texts, blocks.where(F.col("block") == b), k) for b in range(-1 if last is None else last + 1)]
    best = reduce(DataFrame.unionByName, best, empty)
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _of_block(texts: DataFrame, block: DataFrame, k: int) -> DataFrame:
    size = block.agg(F.sum(F.octet_length("term").cast("long") + _TERM_BYTES)).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"an item has {size} bytes of different terms, more than {MOST_BYTES}")
    rows = block.select("item_id", "term").collect()
    if not rows:  # an item may fill several blocks
        kind = block.schema["item_id"].dataType.simpleString()
        return block.sparkSession.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
    number = {i: at for at, i in enumerate(ids)}
    of_term: dict[str, list[int]] = {}
    for r in rows:
        of_term.setdefault(r.term, []).append(number[r.item_id])
    terms = sorted(of_term)
    found = stage(_scan(texts, terms), "found")
    totals = found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("words")).first()
    df = np.zeros(len(terms), dtype=np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[r.t] = r.df  # a row for each term of the block at most
    n = totals.documents
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum([len(of_term[t]) for t in terms])))
    of_items = np.concatenate([of_term[t] for t in terms])
    best = _score(found, weights, starts, of_items, n, totals.words or 1, k)
    kind = block.schema["item_id"].dataType.simpleString()
    named = block.sparkSession.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind}")
    return best.join(F.broadcast(named), "item").select("item_id", "doc_id", "score")
