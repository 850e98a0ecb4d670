import pytest
from pyspark.sql import functions as F

from tests.fixtures import BIRD, CODES, RIGHT, event, events
from tidemark.functions import rules
from tidemark.operators import events as ev
from tidemark.operators import lookups as lo
from tidemark.operators import sessions as se
from tidemark.session import row_bytes, small_side


def by_session(df):
    return {row["game_session"]: row.asDict() for row in df.collect()}


def test_session_table(spark):
    got = by_session(se.sessions_with_ids(events(spark), CODES, ["e"]))
    s1, s2, s3 = got["s1"], got["s2"], got["s3"]
    assert (s1["event_count"], s1["game_time"]) == (3, 400)
    assert (s1["game_time_mean_diff"], s1["game_time_std_diff"]) == (200, 100)
    assert (s2["event_count"], s2["game_time"]) == (4, 95)
    assert s2["game_time_mean_diff"] == pytest.approx(31.666667, abs=1e-6)
    assert s2["game_time_std_diff"] == pytest.approx(19.293062, abs=1e-6)
    assert (s2["correct_attempts"], s2["uncorrect_attempts"], s2["accuracy_rate"]) == (1, 1, 0.5)
    assert [s2[f"accuracy_group_{k}"] for k in range(4)] == [0, 0, 1, 0]
    assert [s1[f"accuracy_group_{k}"] for k in range(4)] == [0, 0, 0, 0]
    assert [s2[f"cnt_event_code_{c}"] for c in CODES] == [1, 0, 1, 2]
    assert (s3["game_time_mean_diff"], s3["game_time_std_diff"], s3["cnt_event_id_e"]) == (0, 0, 1)


def test_first_row_wins_but_flags_follow_each_row(spark):
    rows = [
        event("10:00:05", "s", BIRD, 4110, data=RIGHT, world="W2"),
        event("10:00:00", "s", "Game A", 2000, world="W1"),
    ]
    got = by_session(se.sessions_with_ids(events(spark, rows), CODES, []))["s"]
    assert (got["title"], got["type"], got["world"]) == ("Game A", "Game", "W1")
    assert got["correct_attempts"] == 1


def test_gaps_link_across_buckets_and_count_repeats(spark):
    big = se.GAP_BUCKET
    times = [0, 0, 5, big - 1, big, 3 * big + 7, 3 * big + 7, 5 * big]
    df = spark.createDataFrame([("s", x) for x in times], "game_session string, game_time bigint")
    row = se.gap_stats(df).first()
    import numpy as np

    gaps = np.diff(sorted(times))
    assert row["game_time_mean_diff"] == pytest.approx(gaps.mean())
    assert row["game_time_std_diff"] == pytest.approx(gaps.std())


def test_equal_gaps_have_no_deviation(spark):
    df = spark.createDataFrame(
        [("s", 100_003 * i) for i in range(50)], "game_session string, game_time bigint"
    )
    assert se.gap_stats(df).first()["game_time_std_diff"] == 0


CASES = {
    '{"correct":true}': (1, 0),
    '{"correct":false}': (0, 1),
    '{"correct":null}': (0, 1),
    '{"correct":0}': (0, 1),
    '{"correct":0.0}': (0, 1),
    '{"correct":""}': (0, 1),
    '{"correct":[]}': (0, 1),
    '{"correct":{}}': (0, 1),
    '{"correct":1}': (1, 0),
    '{"correct":-0.5}': (1, 0),
    '{"correct":"x"}': (1, 0),
    '{"correct":"false"}': (1, 0),
    '{"correct":[0]}': (1, 0),
    '{"correct":{"a":1}}': (1, 0),
    '{"other":true}': (0, 0),
    '{"a":{"correct":true}}': (0, 0),
}


def flagged(spark, by, texts):
    rows = [event("10:00:00", "s", BIRD, 4110, data=x) for x in texts]
    picked = ev.flag_attempts(events(spark, rows), by).collect()
    return {r["event_data"]: (r["is_correct_attempt"], r["is_uncorrect_attempt"]) for r in picked}


def test_json_truth(spark):
    assert flagged(spark, "json", CASES) == CASES


def test_malformed_payload_is_an_error(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        flagged(spark, "json", ['{"correct":'])


def test_text_flags_mind_spaces_and_see_nested_keys(spark):
    want = {
        '{"correct":true}': (1, 0),
        '{"correct": true}': (0, 0),
        '{"a":{"correct":true}}': (1, 0),
        '{"correct":false}': (0, 1),
    }
    assert flagged(spark, "text", want) == want


def test_accuracy_rules(spark):
    cases = {
        (0, 0): (None, 0.0),
        (1, 0): (3, 1.0),
        (1, 1): (2, 0.5),
        (1, 2): (1, 1 / 3),
        (1, 9): (1, 0.1),
        (0, 3): (0, 0.0),
        (2, 0): (0, 1.0),
        (2, 1): (0, 2 / 3),
    }
    df = spark.createDataFrame(list(cases), "c bigint, u bigint")
    group = rules.accuracy_group(F.col("c"), F.col("u"))
    rate = rules.accuracy_rate(F.col("c"), F.col("u"))
    got = {(r["c"], r["u"]): (r["g"], r["a"]) for r in df.select("c", "u", group.alias("g"), rate.alias("a")).collect()}
    assert {k: g for k, (g, _) in got.items()} == {k: g for k, (g, _) in cases.items()}
    assert {k: a for k, (_, a) in got.items()} == pytest.approx({k: a for k, (_, a) in cases.items()})


def test_attempts_to_group(spark):
    cases = {
        (0.41, 0.0): 0,
        (0.4, 0.0): 3,
        (0.4, 1.0): 2,
        (0.4, 2.0): 1,
        (0.069, 5.0): 3,
        (0.07, 5.0): 1,
        (0.2, -3.0): 3,
        (0.2, 0.999): 3,
        (0.2, 1.999): 2,
    }
    df = spark.createDataFrame(list(cases), "p double, u double")
    picked = df.select("p", "u", rules.attempts_to_group(F.col("p"), F.col("u")).alias("g"))
    assert {(r["p"], r["u"]): r["g"] for r in picked.collect()} == cases


def test_time_features(spark):
    df = spark.sql("SELECT timestamp'2019-09-06T17:53:46.937Z' AS timestamp")
    row = rules.time_features(df).first()
    assert (row["timestamp"], row["assessment_hour"], row["assessment_dayofweek"]) == (1567792426, 17, 4)


def test_missing_declared_property_is_an_error(spark):
    props = {"e": ("duration",)}
    good = [event("10:00:00", "s", "Game A", 2000, data='{"duration":2.5}')]
    row = ev.session_props(events(spark, good), props).first()
    assert row["event_data_prop_e_duration"] == 2.5
    bad = [event("10:00:00", "s", "Game A", 2000, data="{}")]
    with pytest.raises(Exception, match="has no duration"):
        ev.session_props(events(spark, bad), props).collect()


def test_undeclared_events_are_not_parsed(spark):
    rows = [event("10:00:00", "s", "Game A", 2000, data="not json", event_id="other")]
    row = ev.session_props(events(spark, rows), {"e": ("duration",)}).first()
    assert row["event_data_prop_e_duration"] == 0


def test_last_per_device_skips_nulls_per_column(spark):
    df = spark.createDataFrame(
        [("d", 1, "a", 1), ("d", 2, None, 2), (None, 3, "z", 3)],
        "installation_id string, timestamp int, title string, event_count int",
    )
    (row,) = ev.last_per_device(df, ("timestamp", "event_count")).collect()
    assert (row["title"], row["event_count"], row["timestamp"]) == ("a", 2, 2)


def test_no_or_empty_device_list_keeps_everything(spark):
    df = events(spark)
    nobody = df.filter("false")
    assert ev.keep_devices(df, None).count() == df.count()
    assert ev.keep_devices(df, nobody).count() == df.count()
    assert ev.keep_devices(df, df.limit(1)).count() == df.count()


def test_strict_cast(spark):
    df = spark.createDataFrame([("12x",)], "event_count string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rules.strict_casts(df, {"event_count": "int"}).collect()


def test_values_for_columns(spark):
    df = spark.range(2000).selectExpr("id", "nullif(id % 3, 2) AS k")
    assert ev.distinct_values(df, "id", "k") == {"id": list(range(2000)), "k": [0, 1]}


def test_a_tie_does_not_mix_rows(spark):
    rows = [("d", 1, 1, "s1", "Z", "W1"), ("d", 1, 1, "s2", "A", "W0")]
    df = spark.createDataFrame(
        rows, "installation_id string, timestamp int, event_count int, game_session string, title string, world string"
    )
    (row,) = ev.last_per_device(df, ("timestamp", "event_count", "game_session")).collect()
    assert (row["game_session"], row["title"], row["world"]) == ("s2", "A", "W0")
    rows = [("T", 1, "s", "b", "W1"), ("T", 1, "s", "a", "W2")]
    df = spark.createDataFrame(rows, "title string, timestamp int, game_session string, type string, world string")
    assert lo.first_by_title(df, ["type", "world"]).collect() == [("T", "a", "W2")]


def test_size_of_a_join_side_is_checked_in_bytes(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 1000) AS text", "array(id) AS many")
    size = df.agg(F.sum(row_bytes(df))).first()[0]
    assert 1_000_000 < size < 1_200_000
    plan = lambda most: df.join(small_side(df, most), "id")._jdf.queryExecution().toString()
    assert "strategy=broadcast" in plan(1 << 30) and "strategy=broadcast" not in plan(1000)
