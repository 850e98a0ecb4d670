"""Exact top-k by inner product over a bit-sliced index.

A block of rows is kept as bitmaps: for every dimension, one bitmap per bit of the attribute. A
query's scores over a block are added up as slices too, carry by carry, for all rows at once; the
best rows are then read off the slices from the most significant one downward.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

BLOCK = 4096  # rows of a block of the index
_MOST = float(1 << 62)
QUERIES = 256  # queries of a block, about
SLICES = 16  # bits that an attribute has at most in the index

_HIT = "query_id long, query_key long, vec_id long, score long"


def bitmaps(values: np.ndarray, bits: int) -> np.ndarray:
    """(bits, words): bit b of every value, 64 rows a word."""
    n = len(values)
    padded = np.zeros(-(-n // 64) * 64, dtype=np.uint64)
    padded[:n] = values
    slices = (padded[None, :] >> np.arange(bits, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(slices.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


class Block:
    """The slices of a block: attributes above their smallest value, coarser if they are wide."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, slices: int = SLICES) -> None:
        order = np.argsort(ids, kind="stable")  # of equal scores, the smallest id is the first bit
        self.ids, self.vectors = ids[order], vectors[order]
        self.low = self.vectors.min(axis=0)
        above = (self.vectors - self.low).astype(np.uint64)
        widest = int(above.max()).bit_length() if above.size else 0
        self.shift = max(0, widest - slices)
        self.bits = max(1, widest - self.shift)
        above >>= np.uint64(self.shift)
        self.slices = [bitmaps(column, self.bits) for column in above.T]
        self.rows = bitmaps(np.ones(len(ids), dtype=np.uint64), 1)[0]

    def add_up(self, queries: np.ndarray) -> list[np.ndarray]:
        """Slices (queries, words) of a sum that orders the rows as their inner products do.

        Products are added bit by bit of the weight. A negative weight takes the complement of the
        slices, which differs from the product by the same amount in every row.
        """
        size = np.abs(queries)
        columns: list[list[np.ndarray]] = []  # by bit, what is still to be added

        def put(bit: int, bitmap: np.ndarray) -> None:
            while bit >= len(columns):
                columns.append([])
            columns[bit].append(bitmap)
            if len(columns[bit]) == 3:
                a, b, c = columns[bit]
                either = a ^ b
                columns[bit] = [either ^ c]
                put(bit + 1, (a & b) | (either & c))

        for d in range(queries.shape[1]):
            turned = np.where(queries[:, d] < 0, ~np.uint64(0), np.uint64(0))[:, None]
            own = [self.slices[d][b][None, :] ^ turned for b in range(self.bits)]
            for j in range(int(size[:, d].max()).bit_length() if len(size) else 0):
                has = (size[:, d] >> j) & 1
                if has.any():
                    mask = (-has).astype(np.uint64)[:, None]
                    for b in range(self.bits):
                        put(j + b, own[b] & mask)
        # at most two bitmaps are left at a bit: one last addition
        out, carry, bit = [], None, 0
        while bit < len(columns) or carry is not None:
            left = [*(columns[bit] if bit < len(columns) else []), *([carry] if carry is not None else [])]
            carry = None
            if len(left) == 3:
                either = left[0] ^ left[1]
                carry = (left[0] & left[1]) | (either & left[2])
                left = [either ^ left[2]]
            elif len(left) == 2:
                carry, left = left[0] & left[1], [left[0] ^ left[1]]
            out.append(left[0] if left else np.zeros((len(queries), len(self.rows)), dtype=np.uint64))
            bit += 1
        return out

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: its id, and ids and scores of rows that include its k best of the block
        (never the rows with the query's own id); boundary rows are settled by exact products."""
        sums = self.add_up(queries)
        # rows that can still be chosen; surely chosen so far
        open_ = np.repeat(self.rows[None, :], len(queries), axis=0)
        for i, own in enumerate(query_ids):
            for at in range(*np.searchsorted(self.ids, [own, own + 1])):
                open_[i, at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
        everything = open_.copy()
        sure = np.zeros_like(open_)
        least = np.zeros(len(queries), dtype=object)  # the sum that the k-th best has
        for bit in range(len(sums) - 1, -1, -1):
            with_bit = open_ & sums[bit]
            enough = (np.bitwise_count(sure | with_bit).sum(axis=1) >= k)[:, None]
            sure = np.where(enough, sure, sure | with_bit)
            open_ = np.where(enough, with_bit, open_ & ~sums[bit])
            least += enough[:, 0].astype(object) << bit
        if self.shift:
            # coarse slices: whatever the lost bits could lift to the k-th best is looked at too
            slack = (np.abs(queries).astype(object).sum(axis=1) if len(queries) else least) + 1
            open_ = self._at_least(sums, everything, np.maximum(least - slack, 0)) & ~sure
        for i, query_id in enumerate(query_ids):
            chosen = self._places(sure[i])
            edge = self._places(open_[i])
            if not self.shift:
                edge = edge[: max(0, k - len(chosen))]  # all equal: the smallest ids
            at = np.concatenate((chosen, edge))
            yield int(query_id), self.ids[at], self.vectors[at] @ queries[i]

    @staticmethod
    def _places(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    @staticmethod
    def _at_least(sums: list[np.ndarray], rows: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Rows whose sum is `least` or more, per query."""
        above, equal = np.zeros_like(rows), rows.copy()
        for bit in range(len(sums) - 1, -1, -1):
            one = ((least >> bit) & 1).astype(bool)[:, None]
            above = np.where(one, above, above | (equal & sums[bit]))
            equal = np.where(one, equal & sums[bit], equal & ~sums[bit])
        return above | equal


def _check_bound(rows: np.ndarray, queries: np.ndarray) -> None:
    """Raise where an inner product could leave 64 bits, so that none wraps around unseen."""
    most = np.abs(rows).max(axis=0, initial=0).astype(float) @ np.abs(queries).max(axis=0, initial=0).astype(float)
    if most >= _MOST:
        raise ValueError(f"inner products may reach {most:.3g}, beyond 64-bit integers: use a smaller scale")


def _quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, q): floor(scale * x) of every component; vectors without finite components are out."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x")).where(
        "id IS NOT NULL AND x IS NOT NULL"
    ).where(finite).select("id", F.transform("x", lambda v: _whole(v, scale)).alias("q"))


def _whole(value: Column, scale: int) -> Column:
    """floor(scale * value), where that is far enough inside 64 bits."""
    large = F.raise_error(F.lit(f"a component times {scale} is beyond 64-bit integers: use a smaller scale"))
    return F.when(F.abs(value * scale) < _MOST, F.floor(value * scale)).otherwise(large.cast("long"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of (id, q) gathered as blocks, each task its own: n, ids, values (little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_width: dict[int, tuple[list[int], list[list[int]]]] = {}

        def out(width: int) -> pa.RecordBatch:
            ids, values = by_width.pop(width)
            return pa.RecordBatch.from_pydict(
                {
                    "width": [width],
                    "ids": [np.array(ids, dtype="<i8").tobytes()],
                    "vectors": [np.array(values, dtype="<i8").tobytes()],
                }
            )

        for batch in batches:
            for i, q in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, values = by_width.setdefault(len(q), ([], []))
                ids.append(i)
                values.append(q)
                if len(ids) == size:
                    yield out(len(q))
        for width in list(by_width):
            yield out(width)

    return rows.select("id", "q").mapInArrow(run, "width long, ids binary, vectors binary")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): each query's k best rows by integer inner product.

    Components are floor(scale * x). A row is no candidate of the query with its own id; of equal
    scores the smaller vec_id wins; fewer candidates give fewer rows. Rows without an id, and
    vectors that are null or hold null or non-finite components, take no part; vectors of another
    length than the query's are no candidates; empty vectors score zero. Repeated query rows are
    one query (an id with several vectors is several), repeated candidate rows are candidates each.
    An empty table of either gives no rows. Where quantised components, or inner products of a block
    of rows and one of queries, could reach 2**62, that is an error.

    Each task gathers its rows in blocks of `block`; queries are dealt to blocks by hash. Every
    block of rows meets every block of queries, on a grid: rows are sent to each block of queries,
    and where there are fewer of those than shuffle partitions, a block of queries has copies that
    share the rows. A pair of blocks gives k rows a query and block. Nothing is broadcast, and
    memory holds one pair.
    """
    spark = vectors.sparkSession
    rows = _packed(_quantised(vectors, scale, id_col, vector_col), block)
    wanted = stage(_quantised(queries, scale, id_col, vector_col).distinct(), "queries")
    parts = max(1, -(-wanted.count() // QUERIES))
    copies = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // parts))
    numbers = [F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")) for n in (parts, copies)]
    dealt = rows.withColumn("copy", F.pmod(F.xxhash64("ids"), F.lit(copies))).withColumn("part", F.explode(numbers[0]))
    sent = (
        wanted.groupBy(F.size("q").cast("long").alias("width"), F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"))
        .agg(F.collect_list(F.struct("id", "q", F.xxhash64("q").alias("key"))).alias("asked"))
        .withColumn("copy", F.explode(numbers[1]))
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, Block] | None = None
        for batch in batches:
            for width, ids, values, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is None or last[0] != ids:
                    own = np.frombuffer(ids, dtype="<i8")
                    last = (ids, Block(own, np.frombuffer(values, dtype="<i8").reshape(len(own), width)))
                asked_ids = np.array([a["id"] for a in asked], dtype=np.int64)
                asked_for = np.array([a["q"] for a in asked], dtype=np.int64).reshape(len(asked), width)
                _check_bound(last[1].vectors, asked_for)
                found = list(last[1].best(asked_ids, asked_for, k))
                counts, keys = [len(x) for _, x, _ in found], [a["key"] for a in asked]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(asked_ids, counts), pa.int64()),
                        pa.array(np.repeat(np.array(keys, dtype=np.int64), counts), pa.int64()),
                        pa.array(np.concatenate([x for _, x, _ in found]), pa.int64()),
                        pa.array(np.concatenate([s for _, _, s in found]), pa.int64()),
                    ],
                    names=["query_id", "query_key", "vec_id", "score"],
                )

    pairs = dealt.join(sent, ["part", "copy", "width"]).select("width", "ids", "vectors", "asked")
    order = W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.mapInArrow(meet, _HIT)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
