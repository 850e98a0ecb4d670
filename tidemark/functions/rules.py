"""Row rules: accuracy, groups, time parts, casts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import FIRST_TRY_BELOW, GROUP_LABELS, INTEGER_SETTINGS, NEVER_CORRECT_ABOVE


def accuracy_rate(correct: Column, wrong: Column) -> Column:
    tries = correct + wrong
    return F.when(tries == 0, 0.0).otherwise(correct / F.nullif(tries, F.lit(0)))


def accuracy_group(correct: Column, wrong: Column) -> Column:
    """3 = first try, 2 = second, 1 = later, 0 = never (or more than one right); null = no try."""
    solved_once = correct == 1
    return (
        F.when((correct == 0) & (wrong == 0), F.lit(None).cast("int"))
        .when(solved_once & (wrong == 0), 3)
        .when(solved_once & (wrong == 1), 2)
        .when(solved_once & (wrong >= 2), 1)
        .otherwise(0)
    )


def group_columns(group: Column) -> dict[str, Column]:
    return {
        f"accuracy_group_{label}": F.coalesce((group == label).cast("int"), F.lit(0))
        for label in GROUP_LABELS
    }


def attempts_to_group(no_correct_chance: Column, misses: Column) -> Column:
    floored = F.greatest(misses, F.lit(0.0))
    return (
        F.when(no_correct_chance > NEVER_CORRECT_ABOVE, 0)
        .when(no_correct_chance < FIRST_TRY_BELOW, 3)
        .when(floored < 1, 3)
        .when(floored < 2, 2)
        .otherwise(1)
    )


def epoch_seconds(moment: Column) -> Column:
    return F.unix_timestamp(moment.cast("timestamp"))


def time_features(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Hour and weekday (Monday is 0) of a moment, which itself becomes epoch seconds."""
    moment = F.col(column).cast("timestamp")
    return df.withColumns(
        {
            "assessment_hour": F.hour(moment),
            "assessment_dayofweek": F.weekday(moment),
            column: epoch_seconds(F.col(column)),
        }
    )


def strict_casts(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed columns from text; text that is no number is an error under ANSI mode."""
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def rounded_settings(params: Mapping[str, float]) -> dict[str, float]:
    """Search settings with the integer ones rounded half to even."""
    return {k: int(round(v)) if k in INTEGER_SETTINGS else v for k, v in params.items()}


def truncated_settings(params: Mapping[str, float]) -> dict[str, float]:
    """Search settings with the integer ones cut towards zero."""
    return {k: int(v) if k in INTEGER_SETTINGS else v for k, v in params.items()}


def rounded_setting(name: Column, value: Column) -> Column:
    return F.when(name.isin(*INTEGER_SETTINGS), F.bround(value, 0)).otherwise(value)


def truncated_setting(name: Column, value: Column) -> Column:
    """The other rounding in use: integer settings cut towards zero."""
    return F.when(name.isin(*INTEGER_SETTINGS), value.cast("bigint").cast("double")).otherwise(value)
