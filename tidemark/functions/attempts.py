"""Which events are attempts at an assessment, and whether the attempt was right."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed import (
    ASSESSMENT,
    ATTEMPT_CODE,
    BIRD_MEASURER,
    BIRD_MEASURER_ATTEMPT_CODE,
)


def is_attempt() -> Column:
    code = F.when(F.col("title") == BIRD_MEASURER, BIRD_MEASURER_ATTEMPT_CODE).otherwise(ATTEMPT_CODE)
    return (F.col("type") == ASSESSMENT) & (F.col("event_code") == code)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def flags_from_text() -> tuple[Column, Column]:
    """Right and wrong, by the exact text of the payload (spacing matters)."""
    data = F.col("event_data")
    return (
        _flag(is_attempt() & F.contains(data, F.lit('"correct":true'))),
        _flag(is_attempt() & F.contains(data, F.lit('"correct":false'))),
    )


def json_value(payload: Column, key: str) -> Column:
    """The value of a key of a JSON payload, parsed once; null where the key is absent."""
    return F.try_variant_get(F.parse_json(payload), f"$.{key}", "variant")


def truth_of(value: Column) -> Column:
    """True or false as a scripting language would see a JSON value."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind.isNull(), F.lit(None).cast("boolean"))
        .when(kind == "VOID", F.lit(False))
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(F.try_variant_get(value, "$", "double") != 0)
    )


def flags_from_json(value: Column) -> tuple[Column, Column]:
    """Right and wrong, by the payload's value; null for what is no attempt."""
    truth = truth_of(value)
    return _flag(truth), _flag(~truth)
