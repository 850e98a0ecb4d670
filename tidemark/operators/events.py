"""Event-level work: keep devices, flag attempts, count codes and ids, sum payload properties.

The counting helpers return aggregate expressions, so that one pass over the events
and one exchange on the session feed every column of the session table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import COUNTED_EVENT_IDS, EVENT_PROPS
from tidemark.functions.attempts import flags_from_json, flags_from_text, is_attempt, json_value
from tidemark.functions.naming import code_column, literal, prop_column, quoted
from tidemark.session import small_side


def keep_devices(
    events: DataFrame, devices: DataFrame | None, key: str = "installation_id"
) -> DataFrame:
    """Events of the listed devices; no list, or an empty one, keeps every event."""
    if devices is None:
        return events
    ids = small_side(devices.select(key).filter(F.col(key).isNotNull()).distinct())
    return events if ids.isEmpty() else events.join(ids, key, "left_semi")


def flag_attempts(events: DataFrame, by: str = "json") -> DataFrame:
    """Whether an event is a right or a wrong attempt, by the payload's `text` or its `json`.

    Only payloads of attempts are parsed, and each once: the value is a column of its own, over
    which the tests branch.
    """
    if by == "text":
        right, wrong = flags_from_text()
        return events.withColumns({"is_correct_attempt": right, "is_uncorrect_attempt": wrong})
    value = F.when(is_attempt(), json_value(F.col("event_data"), "correct"))
    right, wrong = flags_from_json(F.col("_correct"))
    told = events.withColumn("_correct", value)
    return told.withColumns({"is_correct_attempt": right, "is_uncorrect_attempt": wrong}).drop("_correct")


def counted_events(events: DataFrame, ids: Iterable[str] = COUNTED_EVENT_IDS) -> DataFrame:
    return events.filter(F.col("event_id").isin(list(ids)))


def _count_if(column: str, value: object, name: str) -> Column:
    return F.expr(f"count_if({column} = {literal(value)}) AS {quoted(name)}")


def code_counts(codes: Iterable[object]) -> list[Column]:
    return [_count_if("event_code", code, code_column(code)) for code in codes]


def with_props(
    events: DataFrame, props: Mapping[str, Iterable[str]] = EVENT_PROPS
) -> DataFrame:
    """Add a struct of the declared properties, parsed only on events that declare any."""
    if not props:
        return events
    names = sorted({name for declared in props.values() for name in declared})
    layout = ", ".join(f"{name} double" for name in names)
    declares = F.col("event_id").isin(sorted(props))
    return events.withColumn("props", F.when(declares, F.from_json("event_data", layout)))


def prop_sums(props: Mapping[str, Iterable[str]] = EVENT_PROPS) -> list[Column]:
    """Sums of declared properties; a declared property missing from a payload is an error."""
    sums = []
    for event_id, names in props.items():
        wanted = literal(event_id)
        for name in names:
            missing = f"raise_error(concat({literal(f'event {event_id} has no {name}: ')}, event_data))"
            value = f"CASE WHEN event_id = {wanted} THEN coalesce(props.{name}, {missing}) ELSE 0D END"
            sums.append(F.expr(f"sum({value}) AS {quoted(prop_column(event_id, name))}"))
    return sums


def session_props(
    events: DataFrame, props: Mapping[str, Iterable[str]] = EVENT_PROPS
) -> DataFrame:
    """One row per session with the sum of every declared property, 0 where none was seen."""
    if not props:
        return events.select("game_session").distinct()
    return with_props(events, props).groupBy("game_session").agg(*prop_sums(props))


def last_per_device(
    events: DataFrame,
    order: Iterable[str] = ("timestamp", "event_count", "game_session", "event_id"),
) -> DataFrame:
    """Each column's last value that is not null, per device.

    `order` settles which row is the last, so that columns without nulls come from one row; rows
    that agree on all of it and still differ are settled by the value.
    """
    key = "installation_id"
    position = F.struct(*[F.col(c).alias(f"at{i}") for i, c in enumerate(order)])
    picks = []
    for name in events.columns:
        if name != key:
            last = F.max(F.when(F.col(name).isNotNull(), F.struct(position, F.col(name).alias("value"))))
            picks.append(last.getField("value").alias(name))
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(*picks)


def common_codes(left: DataFrame, right: DataFrame, column: str = "event_code") -> DataFrame:
    return left.select(column).intersect(right.select(column))


def distinct_values(df: DataFrame, *columns: str) -> dict[str, list]:
    """Sorted values of columns that are about to become columns, all in one pass.

    They are as many as the table made from them will have columns. Each task sends its own
    distinct values, one set a column.
    """
    found = df.agg(*[F.collect_set(c).alias(c) for c in columns]).first()
    return {c: sorted(found[c]) for c in columns}
