"""Devices whose rows fit one window move once a step; larger ones go on in chunks."""

import contextlib
import io
import random

from pyspark.sql import functions as F

from tidemark.operators import history as h
from tidemark.operators.prefix import prefix_totals


def test_one_exchange_without_chunks_and_one_more_for_the_chunks_before(spark):
    rows = spark.range(50).select(
        (F.col("id") % 3).alias("d"), F.col("id").alias("at"), (F.col("id") % 2).cast("int").alias("asks"),
        (F.col("id") % 4).cast("int").alias("digit"), F.lit(1).cast("bigint").alias("weight"), F.col("id").alias("ask"),
    )
    found = {}
    for chunk in (None, 7):
        df = prefix_totals(rows, ["d"], "at", (), chunk=chunk, counted=("digit", "weight", 4), asked="ask")
        said = io.StringIO()
        with contextlib.redirect_stdout(said):
            df.explain()
        if chunk is None:
            assert said.getvalue().count("Exchange hashpartitioning") == 1
        found[chunk] = sorted((r.d, r.at, list(r.ask), r.d0, r.d1, r.d2, r.d3) for r in df.collect())
    assert found[None] == found[7]
    assert len(found[7]) == 25
    for d, at, ask, *counts in found[7]:
        assert ask == [at] and counts == [sum(1 for i in range(at) if i % 3 == d and i % 4 == k) for k in range(4)]


def test_small_and_large_devices_in_one_table(spark):
    draw = random.Random(5)
    sessions = [(f"d{i % 3}", draw.randrange(10**6), "t", "Game", draw.choice([None, 1.0, 2.5, 1e9])) for i in range(90)]
    sessions += [("big", draw.randrange(10**6), "t", "Game", draw.gauss(0, 5)) for _ in range(60)]
    targets = [(f"d{i % 3}" if i % 4 else "big", f"a{i}", draw.randrange(10**6), "t") for i in range(40)]
    sessions = spark.createDataFrame(sessions, "installation_id string, start bigint, title string, type string, x double")
    targets = spark.createDataFrame(
        targets, "installation_id string, assessment_game_session string, start bigint, assessment_title string"
    )
    measures = h.of_columns(["x"], h.STATS_AND_SUM)
    told = []
    for limits, chunk in ((h.Limits(), 50), (h.ANY_SIZE, 50), (h.ANY_SIZE, 1000)):
        df = h.history_features(sessions, targets, measures, limits, chunk).orderBy(h.TARGET)
        told.append([[None if v is None else round(v, 4) if isinstance(v, float) else v for v in r] for r in df.collect()])
    assert told[0] == told[1] == told[2] and len(told[0]) == 40
