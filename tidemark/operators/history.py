"""Features of a target moment from everything earlier on the same device.

A device is answered from one array of its sessions, which each of its targets reads, as long as
what its targets read in all is bounded in bytes. Any other goes through `moments` and `prefix`,
where no group is ever gathered. Neither squares a value far from those it is compared with: the
array plan takes distances from the mean of what the target sees, `moments` merges states.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.fixed import ASSESSMENT
from tidemark.functions.naming import literal, quoted, with_stat
from tidemark.operators.moments import visible_moments
from tidemark.operators.prefix import CHUNK, kth_smallest, ranked_values
from tidemark.session import small_side, stage

DEVICE = "installation_id"
TARGET = "assessment_game_session"
POS = "start"
STATS = ("std", "mean", "median", "max")
ORDERED = {"median", "max"}
STATS_AND_SUM = ("sum", "mean", "max", "std", "median")

ALL, ASSESSMENTS, SAME_TITLE = "all", "assessments", "same title"


@dataclass(frozen=True)
class Limits:
    """Up to where a device is answered in one task; beyond, it is spread over tasks.

    sessions: how many one array holds. values: sessions times targets times measures, the
    doubles that a device's targets read in all, so 32 MB by default.
    """

    sessions: int = 4096
    values: int = 1 << 22


ANY_SIZE = Limits(0, 0)


@dataclass(frozen=True)
class Measure:
    """A value of a session in SQL, the sessions that count, and the statistics wanted of it."""

    name: str
    value: str
    stats: Sequence[str] = STATS
    over: str = ALL

    def among(self) -> str:
        if self.over == ASSESSMENTS:
            return f"CASE WHEN type = {literal(ASSESSMENT)} THEN {self.value} END"
        return self.value

    def columns(self) -> dict[str, str]:
        return {with_stat(self.name, stat): stat for stat in self.stats}


def of_columns(
    columns: Iterable[str], stats: Sequence[str] = STATS, over: str = ALL, prefix: str = ""
) -> list[Measure]:
    return [Measure(prefix + c, quoted(c), stats, over) for c in columns]


def times(column: str, value: object) -> str:
    """1 where the column has the value."""
    return f"CASE WHEN {quoted(column)} = {literal(value)} THEN 1 END"


def occurrences(column: str, values: Iterable[str], prefix: str) -> list[Measure]:
    """How many earlier sessions have each value; the suffix is that of a summed 0/1 column."""
    return [Measure(f"{prefix}_{v}", times(column, v), ("sum",)) for v in values]


def _count() -> Measure:
    return Measure("n_history", "1", ("n",))


def history_features(
    sessions: DataFrame,
    targets: DataFrame,
    measures: Sequence[Measure],
    limits: Limits = Limits(),
    chunk: int = CHUNK,
) -> DataFrame:
    """`targets` with `n_history` and each measure's statistics over earlier sessions.

    Both tables are read several times: pass staged ones.
    sessions: installation_id, start (integer position), title, type, and the measured
    columns. A column `before` (a struct of the measured columns, null on a session's first
    row) marks rows that replace an earlier state of the same session.
    targets: installation_id, assessment_game_session (together unique), start,
    assessment_title. A target sees the sessions whose start is strictly smaller.
    """
    measures = [_count(), *measures]
    sessions = sessions.filter(F.col(POS).isNotNull() & F.col(DEVICE).isNotNull())
    # A target without a device has no history; it never enters a join, where all would meet.
    lost, targets = targets.filter(F.col(DEVICE).isNull()), targets.filter(F.col(DEVICE).isNotNull())
    rows = (
        sessions.select(DEVICE, F.lit(0).alias("target"))
        .unionByName(targets.select(DEVICE, F.lit(1).alias("target")))
        .groupBy(DEVICE)
        .agg(
            F.count_if(F.col("target") == 0).alias("sessions"),
            F.count_if(F.col("target") == 1).alias("targets"),
        )
    )
    read = F.col("sessions").cast("double") * F.col("targets") * len(measures)
    over = (F.col("sessions") > limits.sessions) | (read > limits.values)
    crowded = rows.filter(over & (F.col("targets") > 0))
    # a device whose rows fit a window is one chunk
    crowded = stage(crowded.select(DEVICE, (F.col("sessions") + F.col("targets") <= chunk).alias("whole")), "crowded")
    kinds = sorted(r["whole"] for r in crowded.select("whole").distinct().collect())
    if not kinds:
        results = [_by_arrays(sessions, targets, measures)]
    else:

        def part(chosen: DataFrame, how: str) -> tuple[DataFrame, DataFrame]:
            return sessions.join(chosen, DEVICE, how), targets.join(chosen, DEVICE, how)

        results = [_by_arrays(*part(small_side(crowded.select(DEVICE)), "left_anti"), measures)]
        for whole in kinds:
            chosen = small_side(crowded.filter(F.col("whole") == whole).select(DEVICE))
            results.append(_by_prefix(*part(chosen, "left_semi"), measures, None if whole else chunk))
    nothing = lost.withColumn("seen", F.lit(None).cast(_array_type(sessions, measures)))
    return reduce(DataFrame.unionByName, [*results, _from_arrays(nothing, targets.columns, measures)])


# --- devices within the limits ------------------------------------


def _features(measures: Sequence[Measure]) -> Iterator[tuple[int, str, str, str]]:
    """Measure number, statistic, sessions that count and column name of every feature."""
    for i, m in enumerate(measures):
        for column, stat in m.columns().items():
            yield i, stat, m.over, m.name if stat == "n" else column


def _array_statistic(stat: str, xs: str) -> str:
    """A statistic of an array of doubles, in SQL; null where it has no value.

    The array is sorted where the statistic needs an order.
    """
    n, total = f"size({xs})", f"aggregate({xs}, 0D, (s, v) -> s + v)"
    mean = f"({total} / nullif({n}, 0))"
    squares = f"aggregate({xs}, 0D, (s, v) -> s + (v - mean_{xs}) * (v - mean_{xs}))"
    return {
        "n": f"CAST({n} AS BIGINT)",
        "sum": total,
        "mean": mean,
        "max": f"get({xs}, {n} - 1)",
        "median": f"(get({xs}, ({n} - 1) div 2) + get({xs}, {n} div 2)) / 2",
        "std": f"CASE WHEN {n} > 1 THEN sqrt({squares} / ({n} - 1)) END",
    }[stat]


def _array_type(sessions: DataFrame, measures: Sequence[Measure]) -> str:
    at, title = (sessions.schema[c].dataType.simpleString() for c in (POS, "title"))
    values = ", ".join(f"m{i}: double" for i in range(len(measures)))
    return f"array<struct<{POS}: {at}, until: {at}, title: {title}, {values}>>"


def _until(sessions: DataFrame) -> DataFrame:
    """`until`: where the next state of a session stands, up to which this one is seen."""
    next_state = F.lit(None).cast(sessions.schema[POS].dataType)
    if "before" in sessions.columns:
        next_state = F.lead(POS).over(W.partitionBy(DEVICE, "game_session").orderBy(POS))
    return sessions.withColumn("until", next_state)


def _by_arrays(
    sessions: DataFrame, targets: DataFrame, measures: Sequence[Measure]
) -> DataFrame:
    """Each target reads the one array of its device, whose length the limits bound."""
    values = [f"CAST({m.among()} AS DOUBLE) AS m{i}" for i, m in enumerate(measures)]
    states = _until(sessions).selectExpr(
        DEVICE, f"struct({POS}, until, title, {', '.join(values)}) AS state"
    )
    blocks = states.groupBy(DEVICE).agg(F.collect_list("state").alias("states"))
    seen = targets.join(blocks, DEVICE, "left").selectExpr(
        *[quoted(c) for c in targets.columns],
        f"""filter(states, s -> s.{POS} < {POS} AND (s.until IS NULL OR s.until >= {POS})) AS seen""",
    )
    return _from_arrays(seen, targets.columns, measures)


def _from_arrays(seen: DataFrame, columns: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The targets' `columns` and every feature of what each has `seen`; null is nothing."""
    arrays = []
    for i, m in enumerate(measures):
        value = f"s.m{i}"
        if m.over == SAME_TITLE:
            value = f"CASE WHEN s.title = assessment_title THEN {value} END"
        known = f"filter(transform(seen, s -> {value}), v -> v IS NOT NULL)"
        known = f"coalesce({known}, CAST(array() AS ARRAY<DOUBLE>))"
        arrays.append(f"sort_array({known}) AS m{i}" if ORDERED & set(m.stats) else f"{known} AS m{i}")
    kept = [quoted(c) for c in columns]
    spread = {i for i, m in enumerate(measures) if "std" in m.stats}
    means = [f"{_array_statistic('mean', f'm{i}')} AS mean_m{i}" for i in sorted(spread)]
    features = [
        f"{_array_statistic(stat, f'm{i}')} AS {quoted(name)}"
        for i, stat, _, name in _features(measures)
    ]
    return seen.selectExpr(*kept, *arrays).selectExpr("*", *means).selectExpr(*kept, *features)


# --- devices of any size --------------------------------------------------------


def _long(sessions: DataFrame, measures: Sequence[Measure], weight: int) -> DataFrame:
    """One row per session and measure: device, measure, scope, start, value, weight, and the
    position from which on a later state of the session takes its place."""
    until = "until" if "until" in sessions.columns else "NULL"
    entries = [
        f"struct({i} AS measure, {_scope(m, 'title')} AS scope, CAST({m.among()} AS DOUBLE) AS value)"
        for i, m in enumerate(measures)
    ]
    return (
        sessions.selectExpr(DEVICE, POS, f"CAST({until} AS BIGINT) AS until", f"explode(array({', '.join(entries)})) AS entry")
        .selectExpr(DEVICE, POS, "until", "entry.*", f"CAST({weight} AS BIGINT) AS weight")
        .filter("value IS NOT NULL AND scope IS NOT NULL")
    )


def _scope(measure: Measure, title: str) -> str:
    return title if measure.over == SAME_TITLE else "''"


def _by_prefix(
    sessions: DataFrame, targets: DataFrame, measures: Sequence[Measure], chunk: int | None
) -> DataFrame:
    """chunk: None for devices whose sessions and targets one window may hold."""
    keys = [DEVICE, "measure", "scope"]
    items = _long(_until(sessions), measures, 1)
    if "before" in sessions.columns:
        past = sessions.filter(F.col("before").isNotNull())
        replaced = past.select(
            *[c for c in past.columns if c not in past.schema["before"].dataType.names and c != "before"],
            "before.*",
        )
        items = items.unionByName(_long(replaced, measures, -1))

    items = stage(items, "items")
    needs_rank = [i for i, m in enumerate(measures) if ORDERED & set(m.stats)]
    sortable = items.filter(F.col("measure").isin(needs_rank))
    ranks = stage(ranked_values(sortable, ["measure", "value"]), "ranks")
    lowest = ranks.groupBy("measure").agg(F.min("code").alias("lowest"))  # a row for each measure
    ranks = ranks.join(F.broadcast(lowest), "measure").select(
        "measure", "value", (F.col("code") - F.col("lowest")).alias("code")
    )
    ranks = stage(ranks, "codes")
    coded = stage(sortable.join(small_side(ranks), ["measure", "value"]), "coded")

    scopes = [
        f"struct({i} AS measure, {_scope(m, 'assessment_title')} AS scope)"
        for i, m in enumerate(measures)
    ]
    target_keys = [DEVICE, TARGET]
    wanted = stage(
        targets.selectExpr(*target_keys, POS, f"explode(array({', '.join(scopes)})) AS w")
        .select(*target_keys, POS, "w.*")
        .filter(F.col(POS).isNotNull() & F.col("scope").isNotNull()),
        "wanted",
    )
    asked = wanted.select(*keys, POS).distinct()

    totals = stage(
        visible_moments(items.filter("weight > 0"), asked, keys, POS, "until", chunk), "totals"
    )

    n = F.col("n")
    wanted_ranks = F.array_distinct(F.array(F.expr("(n + 1) div 2"), F.expr("n div 2 + 1"), n))
    ranked = totals.filter(F.col("measure").isin(needs_rank)).select(
        *keys, POS, F.explode(wanted_ranks).alias("k")
    )
    bits = int(ranks.agg(F.max("code")).first()[0] or 0).bit_length()
    at = [*keys, POS]
    by_rank = (
        kth_smallest(coded, ranked, keys, POS, bits, chunk)
        .join(ranks, ["measure", "code"])
        .groupBy(*at)
        .agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("v"))
    )
    stats = totals.join(by_rank, at, "left").select(
        *at,
        n.cast("double").alias("n"),
        F.col("total").alias("sum"),
        "mean",
        F.when(n > 1, F.sqrt(F.col("m2") / F.nullif(n - 1, F.lit(0)))).alias("std"),
        (
            (F.element_at("v", F.expr("(n + 1) div 2")) + F.element_at("v", F.expr("n div 2 + 1"))) / 2
        ).alias("median"),
        F.element_at("v", n).alias("max"),
    )
    picks = []
    for i, stat, _, name in _features(measures):
        value = f"max(CASE WHEN measure = {i} THEN {stat} END)"
        if stat == "n":
            value = f"CAST({value} AS BIGINT)"
        picks.append(F.expr(f"{value} AS {quoted(name)}"))
    wide = wanted.join(stats, at, "left").groupBy(*target_keys).agg(*picks)
    zero = {name for _, stat, _, name in _features(measures) if stat in ("n", "sum")}
    features = [
        f"coalesce({quoted(name)}, 0) AS {quoted(name)}" if name in zero else quoted(name)
        for *_, name in _features(measures)
    ]
    kept = [quoted(c) for c in targets.columns]
    return targets.join(wide, target_keys, "left").selectExpr(*kept, *features)
