"""Sessions: fold events into one row per session, in one exchange, with bounded groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.fixed import COUNTED_EVENT_IDS, EVENT_PROPS
from tidemark.functions.rules import accuracy_group, accuracy_rate, group_columns
from tidemark.functions.naming import code_column, id_column, quoted
from tidemark.operators.events import code_counts, flag_attempts, prop_sums, with_props

KEY = "game_session"
ORDER = ("timestamp", "event_count")
FIRST_SEEN = ("timestamp", "installation_id", "title", "type", "world")

# Distinct game times per bucket when gaps are measured; bounds the array built for one.
GAP_BUCKET = 1 << 16


def first_row(columns: Iterable[str], order: Iterable[str] = ORDER) -> Column:
    """The first row's columns in event order; equal positions are settled by the values."""
    order = list(order)
    return F.min(F.struct(F.struct(*order).alias("at"), *[c for c in columns if c not in order]))


def fold(
    events: DataFrame, extra: Iterable[Column] = (), first_seen: Iterable[str] = FIRST_SEEN
) -> DataFrame:
    """One row per session: first-seen attributes, largest event count, attempts, and `extra`."""
    first_seen = list(first_seen)
    folded = events.groupBy(KEY).agg(
        first_row(first_seen).alias("first"),
        F.greatest(F.lit(0), F.max("event_count")).cast("bigint").alias("event_count"),
        F.sum("is_correct_attempt").alias("correct_attempts"),
        F.sum("is_uncorrect_attempt").alias("uncorrect_attempts"),
        *extra,
    )
    picks = [
        (F.col("first.at.timestamp") if c == "timestamp" else F.col(f"first.{c}")).alias(c)
        for c in first_seen
    ]
    rest = [c for c in folded.columns if c not in (KEY, "first")]
    return folded.select(KEY, *picks, *rest)


def with_accuracy(sessions: DataFrame) -> DataFrame:
    right, wrong = F.col("correct_attempts"), F.col("uncorrect_attempts")
    return sessions.withColumns(
        {"accuracy_rate": accuracy_rate(right, wrong), **group_columns(accuracy_group(right, wrong))}
    )


def gap_buckets(events: DataFrame, key: str = KEY, value: str = "game_time") -> DataFrame:
    """(key, bucket, n, ts): how many times of a session lie in each bucket, and which, sorted.

    A bucket holds at most GAP_BUCKET distinct times, however many events a session has.
    """
    times = events.filter(F.col(value).isNotNull()).select(
        key, F.col(value).cast("bigint").alias("t")
    )
    return times.groupBy(key, F.floor(F.col("t") / GAP_BUCKET).alias("bucket")).agg(
        F.count("t").alias("n"), F.sort_array(F.collect_set("t")).alias("ts")
    )


def merge_gap_buckets(buckets: DataFrame, key: str = KEY) -> DataFrame:
    """One row per bucket of rows of `gap_buckets`, whatever order their events came in."""
    return buckets.groupBy(key, "bucket").agg(
        F.sum("n").alias("n"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("ts")
    )


def gap_stats(events: DataFrame, key: str = KEY, value: str = "game_time") -> DataFrame:
    """Mean and population deviation of the gaps between a session's sorted game times."""
    return gaps_of(gap_buckets(events, key, value), key, value)


def gaps_of(buckets: DataFrame, key: str = KEY, value: str = "game_time") -> DataFrame:
    """`gap_stats` from the buckets, which link through their ends.

    Repeated times add gaps of zero, so only their count matters. Sums are exact integers.
    """
    buckets = buckets.select(
        key,
        "bucket",
        "n",
        F.col("ts")[0].alias("low"),
        F.element_at("ts", -1).alias("high"),
        F.expr(
            "aggregate(zip_with(slice(ts, 2, size(ts)), slice(ts, 1, size(ts) - 1),"
            " (b, a) -> (b - a) * (b - a)), 0L, (s, x) -> s + x)"
        ).alias("squares"),
    )
    exact = "decimal(38,0)"
    link = (F.col("low") - F.lag("high").over(W.partitionBy(key).orderBy("bucket"))).cast(exact)
    n, span = F.col("n") - 1, (F.col("high") - F.col("low")).cast(exact)
    spread = n.cast(exact) * F.col("squares") - span * span
    return (
        buckets.withColumn("link", F.coalesce(link, F.lit(0).cast(exact)))
        .groupBy(key)
        .agg(
            F.sum("n").alias("n"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum(F.col("squares").cast(exact) + (F.col("link") * F.col("link")).cast(exact)).alias(
                "squares"
            ),
        )
        .select(
            key,
            F.when(n < 1, 0.0).otherwise(span.cast("double") / F.nullif(n, F.lit(0))).alias(
                f"{value}_mean_diff"
            ),
            F.when(n < 1, 0.0)
            .otherwise(F.sqrt(spread.cast("double")) / F.nullif(n, F.lit(0)))
            .alias(f"{value}_std_diff"),
        )
    )


Counted = Mapping[str, tuple[Iterable[object], Callable[[object], str]]]


def counts_by_value(events: DataFrame, wanted: Counted) -> DataFrame:
    """How often listed values stand in each session: for each column of `wanted`, its values and
    what names the column made of one.

    Rows are counted per (session, value) first, so an event is not compared with every value,
    and the counts are partitioned by session, as the session table is.
    """
    named = [(f"{c}={v}", name(v)) for c, (values, name) in wanted.items() for v in values]
    keys = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in wanted]
    each = events.filter(F.col(KEY).isNotNull()).select(KEY, F.explode(F.array(*keys)).alias("value"))
    counted = each.groupBy(KEY).pivot("value", [v for v, _ in named]).count()
    columns = [F.coalesce(F.col(quoted(v)), F.lit(0).cast("bigint")).alias(c) for v, c in named]
    return counted.select(KEY, *columns)


def sessions_with_ids(
    events: DataFrame, codes: Iterable[object], ids: Iterable[str] = COUNTED_EVENT_IDS
) -> DataFrame:
    """Session table with code and id counts and game-time gaps; events without a session are out."""
    events = events.filter(F.col(KEY).isNotNull())
    sessions = fold(flag_attempts(events, "json"), [F.max("game_time").alias("game_time")])
    counted = {"event_code": (codes, code_column), "event_id": (ids, id_column)}
    counted = {c: (values, name) for c, (values, name) in counted.items() if values}
    if counted:
        sessions = sessions.join(counts_by_value(events, counted), KEY)
    order = [KEY, *FIRST_SEEN, "event_count", "correct_attempts", "uncorrect_attempts", "game_time"]
    counts = [c for c in sessions.columns if c not in order]
    sessions = sessions.select(*order, *[quoted(c) for c in counts])
    return with_accuracy(sessions).join(gap_stats(events), KEY, "left").na.fill(0.0)


def sessions_with_props(
    events: DataFrame,
    codes: Iterable[object],
    props: Mapping[str, Iterable[str]] = EVENT_PROPS,
) -> DataFrame:
    """Session table with code counts and payload property sums."""
    flagged = with_props(flag_attempts(events, "json"), props)
    longest = F.greatest(F.lit(0), F.max("game_time")).cast("bigint").alias("game_time")
    return with_accuracy(fold(flagged, [longest, *code_counts(codes), *prop_sums(props)])).na.fill(0.0)
