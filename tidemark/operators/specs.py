"""Event specifications: which properties to extract, and a readable report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import EVENT_PROPS, SPEC_PROPS, SPEC_REPORT_SKIPPED
from tidemark.schemas import SPEC_ARGS


def _args() -> Column:
    return F.from_json("args", SPEC_ARGS, {"mode": "FAILFAST"})


def property_map(
    specs: DataFrame,
    event_ids: Iterable[str] = tuple(EVENT_PROPS),
    wanted: Iterable[str] = SPEC_PROPS,
) -> DataFrame:
    """Wanted properties each event declares; events off the list get an empty list."""
    declared = F.array_distinct(F.transform(_args(), lambda a: a["name"]))
    found = F.array_sort(F.array_intersect(declared, F.array(*[F.lit(w) for w in wanted])))
    nothing = F.array().cast("array<string>")
    listed = F.col("event_id").isin(list(event_ids))
    return specs.select("event_id", F.when(listed, found).otherwise(nothing).alias("props"))


def report_rows(specs: DataFrame, skipped: Iterable[str] = SPEC_REPORT_SKIPPED) -> DataFrame:
    """One HTML table row per event, listing the arguments that are not skipped."""
    shown = F.filter(_args(), lambda a: ~a["name"].isin(list(skipped)))
    items = F.transform(
        shown,
        lambda a: F.concat(
            F.lit("<li>Name: <strong>"), a["name"], F.lit("</strong>, "), a["info"], F.lit("</li>")
        ),
    )
    cells = [F.col("event_id"), F.col("info"), F.concat(F.lit("<ul>"), F.array_join(items, ""), F.lit("</ul>"))]
    row = F.concat(
        F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>")
    )
    return specs.select("event_id", row.alias("html"))
