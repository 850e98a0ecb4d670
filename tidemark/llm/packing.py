"""Packing documents into windows of tokens, online, by the sum of squares."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of
from tidemark.llm.tokenizers_in_tasks import json_encoder, once, shipped

PIECE = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
_TASK_BITS = 33  # a task's windows are numbered below this


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def split(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
            Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens),
        )


@dataclass
class Packer:
    """Windows by fill level. `counts[h]` tells how many are filled up to h; each piece goes where
    the sum of squares of the counts is least afterwards, a full window counting for nothing."""

    window: int
    counts: np.ndarray = field(init=False)
    open: list[list[list[Piece]]] = field(init=False)
    closed: list[list[Piece]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.counts = np.zeros(self.window + 1, dtype=np.int64)
        self.open = [[] for _ in range(self.window)]

    def level_for(self, size: int) -> int:
        """The level that a piece of this size should be put on; 0 is a new window. Of equal
        choices, the highest level."""
        room = self.window - size
        new = 2 * self.counts[size] + 1 if size < self.window else 0
        if room <= 0:
            return 0
        here = self.counts[1 : room + 1]
        change = 2 * (self.counts[size + 1 : size + room + 1] - here) + 2
        change[-1] = 1 - 2 * here[-1]  # a window filled up leaves the count
        change[here == 0] = np.iinfo(np.int64).max
        best = room - 1 - int(np.argmin(change[::-1]))
        return best + 1 if change[best] <= new else 0

    def place(self, piece: Piece) -> None:
        size = len(piece.ids)
        level = self.level_for(size)
        pieces = self.open[level].pop() if level else []
        self.counts[level] -= bool(level)
        pieces.append(piece)
        if level + size == self.window:
            self.closed.append(pieces)
        else:
            self.open[level + size].append(pieces)
            self.counts[level + size] += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """A document; one longer than a window fills windows of its own first."""
        rest = Piece(doc_id, 0, ids, len(ids))
        while len(rest.ids) > self.window:
            full, rest = rest.split(self.window)
            self.closed.append([full])
        self.place(rest)

    def finish(self) -> None:
        """What is left in partly filled windows, fullest first, is cut to fill windows to the end;
        the last tokens go to windows of a power of two, which need no padding."""
        left = [p for level in reversed(self.open) for pieces in level for p in pieces]
        total = sum(len(p.ids) for p in left)
        sizes = [self.window] * (total // self.window)
        sizes += [1 << b for b in reversed(range(self.window.bit_length())) if total % self.window >> b & 1]
        left.reverse()
        for size in sizes:
            pieces = []
            while size:
                piece = left.pop()
                if len(piece.ids) > size:
                    piece, rest = piece.split(size)
                    left.append(rest)
                pieces.append(piece)
                size -= len(piece.ids)
            self.closed.append(pieces)
        self.__post_init__()


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.

    A document is its text's ids by the tokenizer file, then `end_id`; a null or empty text is
    `end_id` alone. Each task packs its own partition, so windows are tasks' own, sequence_id
    counts on from the partition's number shifted by 33 bits, and there is no exchange. Every
    window is full but the last few of a task, which hold a power of two each. A task holds open
    windows only. Repeated rows and null ids are documents like any other.
    """
    content = shipped(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once(content.value, json_encoder)
        packer, end = Packer(window), np.array([end_id], dtype=np.uint32)
        sequence = None

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            closed, packer.closed = packer.closed, []
            rows = []
            for pieces in closed:
                offset = 0
                for p in pieces:
                    rows.append((p.doc_id, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.doc_tokens, sequence, offset))
                    offset += len(p.ids)
                sequence += 1
            if rows:
                kinds = [pa.binary() if "binary" in c else pa.int64() for c in PIECE.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=[c.split()[0] for c in PIECE.split(", ")],
                )

        for batch in batches:
            if sequence is None and batch.num_rows:
                sequence = batch.column(2)[0].as_py() << _TASK_BITS
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True):
                packer.add(doc_id, np.concatenate((encode(text or ""), end)))
                if len(packer.closed) >= 512:
                    yield from done()
        packer.finish()
        yield from done()

    # the partition's own number, which stays when partitions are put together later
    texts = texts_of(docs, id_col, text_col).withColumn("partition", F.spark_partition_id())
    return texts.mapInArrow(run, PIECE)
