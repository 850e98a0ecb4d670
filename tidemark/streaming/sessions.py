"""The session fold over a stream of event files.

Every aggregate of the fold merges, so a batch is folded by itself and written as a part, and the
stream keeps no state. A part has a row for each session, and one for each bucket of a session's game
times: gaps depend on which times stand next to each other, in whatever batches they came. Parts are
merged in tiers, which bounds how many there are; a session's row is what its parts merge to.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.naming import code_column, id_column, quoted
from tidemark.operators.events import flag_attempts
from tidemark.operators.sessions import (
    FIRST_SEEN,
    KEY,
    counts_by_value,
    first_row,
    gap_buckets,
    gaps_of,
    merge_gap_buckets,
    with_accuracy,
)
from tidemark.sources.writers import exists

# How columns of two parts merge; all others add up.
_MERGED = {"first": F.min, "event_count": F.max, "game_time": F.max}


def fold_part(events: DataFrame, codes: Iterable[object] = (), ids: Iterable[str] = ()) -> DataFrame:
    """One row per session of the given events, in columns that merge."""
    events = events.filter(F.col(KEY).isNotNull())

    def largest(name: str):
        return F.greatest(F.lit(0), F.max(name)).cast("bigint").alias(name)

    part = (
        flag_attempts(events, "json")
        .groupBy(KEY)
        .agg(
            first_row(FIRST_SEEN).alias("first"),
            largest("event_count"),
            F.sum("is_correct_attempt").alias("correct_attempts"),
            F.sum("is_uncorrect_attempt").alias("uncorrect_attempts"),
            largest("game_time"),
            F.count("*").alias("n_events"),
        )
    )
    counted = {"event_code": (list(codes), code_column), "event_id": (list(ids), id_column)}
    counted = {c: (values, name) for c, (values, name) in counted.items() if values}
    return part.join(counts_by_value(events, counted), KEY) if counted else part


def merge_parts(parts: DataFrame) -> DataFrame:
    """One row per session of all parts, still in columns that merge."""
    columns = [c for c in parts.columns if c != KEY]
    return parts.groupBy(KEY).agg(
        *[_MERGED.get(c, F.sum)(quoted(c)).alias(c) for c in columns]
    )


@dataclass(frozen=True)
class _Table:
    """A written part: the batches `first` to `last`, merged `tier` times."""

    path: str
    tier: int
    first: int
    last: int

    def within(self, other: _Table) -> bool:
        return self != other and other.tier > self.tier and other.first <= self.first and self.last <= other.last

    @property
    def sessions(self) -> str:
        return f"{self.path}/sessions"

    @property
    def gaps(self) -> str:
        return f"{self.path}/gaps"


def _table(path: str, tier: int, first: int, last: int) -> _Table:
    return _Table(f"{path}/part={tier}-{first}-{last}", tier, first, last)


def _written(spark: SparkSession, path: str) -> list[_Table]:
    """Every whole part under `path`; its gaps are written first, so its sessions mark it whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
    found = [_table(path, *map(int, n.split("=")[1].split("-"))) for n in names if n.startswith("part=")]
    return sorted((x for x in found if exists(spark, x.sessions)), key=lambda x: (x.first, -x.tier))


def _live(tables: list[_Table]) -> list[_Table]:
    """Those that are not merged into another."""
    return [x for x in tables if not any(x.within(y) for y in tables)]


def _drop(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _write(table: _Table, sessions: DataFrame, gaps: DataFrame) -> None:
    gaps.write.mode("overwrite").parquet(table.gaps)
    sessions.write.mode("overwrite").parquet(table.sessions)


def compact(spark: SparkSession, path: str, merge_every: int) -> None:
    """Merge `merge_every` parts of a tier into one of the next, tier by tier.

    An event is thus rewritten once per tier, so the bytes written for a batch grow with the
    logarithm of their number. What is merged stays for readers that have begun, until the next
    merge after the one that took it up. Can be repeated after a failure.
    """
    before = _written(spark, path)
    tier, merged = 0, False
    while True:
        same = [x for x in _live(_written(spark, path)) if x.tier == tier]
        if len(same) < merge_every:
            break
        into = _table(path, tier + 1, same[0].first, same[-1].last)
        sessions = merge_parts(spark.read.parquet(*[x.sessions for x in same]))
        _write(into, sessions, merge_gap_buckets(spark.read.parquet(*[x.gaps for x in same])))
        tier, merged = tier + 1, True
    if merged:
        for old in before:
            if any(old.within(x) for x in before):
                _drop(spark, old.path)


def run_to_end(
    events: DataFrame,
    path: str,
    checkpoint: str,
    codes: Iterable[object] = (),
    ids: Iterable[str] = (),
    merge_every: int = 16,
) -> None:
    """Process what is there: a part for each batch, compacted as they become many.

    A batch that is repeated after a failure replaces its own part, or is in a merged one already.
    """
    codes, ids = list(codes), list(ids)
    if merge_every < 2:
        raise ValueError("at least two parts make a merge")

    def write(batch: DataFrame, number: int) -> None:
        own = _table(path, 0, number, number)
        if not any(own.within(x) for x in _written(batch.sparkSession, path)):
            _write(own, fold_part(batch, codes, ids), gap_buckets(batch.filter(F.col(KEY).isNotNull())))
        compact(batch.sparkSession, path, merge_every)

    (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
        .awaitTermination()
    )


def sessions_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The session table as of the last batch, with accuracy and the gaps of game times."""
    live = _live(_written(spark, path))
    merged = merge_parts(spark.read.parquet(*[x.sessions for x in live]))
    gaps = gaps_of(merge_gap_buckets(spark.read.parquet(*[x.gaps for x in live])))
    picks = [
        F.col("first.at.timestamp" if c == "timestamp" else f"first.{c}").alias(c) for c in FIRST_SEEN
    ]
    rest = [quoted(c) for c in merged.columns if c not in (KEY, "first")]
    whole = with_accuracy(merged.select(KEY, *picks, *rest)).join(gaps, KEY, "left")
    return whole.na.fill(0.0, gaps.columns[1:])
