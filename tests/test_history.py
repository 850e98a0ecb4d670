import math
import random
import statistics

import pytest

from tests.fixtures import BIRD, CODES, MUSHROOM, VOCABULARY, event, events, labels
from tidemark.operators import history as h
from tidemark.operators import prefix as px
from tidemark.operators.sessions import sessions_with_ids
from tidemark.plans import features as fe
from tidemark.session import stage

EVERY_SIZE = pytest.mark.parametrize("limits", [h.Limits(), h.ANY_SIZE], ids=["small", "any size"])


def by_target(df):
    return {(r["installation_id"], r["assessment_game_session"]): r.asDict() for r in df.collect()}


def session_features(spark, limits=h.Limits(), label_rows=None, rows=None):
    sessions = stage(sessions_with_ids(events(spark, rows), CODES, []), "sessions")
    return by_target(
        fe.features_from_sessions(sessions, labels(spark, label_rows), VOCABULARY, limits)
    )


@EVERY_SIZE
def test_session_history_goldens(spark, limits):
    got = session_features(spark, limits)
    s3 = got[("d1", "s3")]
    stats = [s3[f"game_time_{s}"] for s in h.STATS]
    assert stats == pytest.approx([215.667568, 247.5, 247.5, 400], abs=1e-6)
    assert s3["event_count_std"] == pytest.approx(0.707107, abs=1e-6)
    assert [s3[f"cnt_event_code_4070_{s}"] for s in h.STATS] == pytest.approx([math.sqrt(2), 1, 1, 2])
    assert [s3[f"cnt_event_code_2000_{s}"] for s in h.STATS] == [0, 1, 1, 1]
    assert [s3[f"correct_attempts_{s}"] for s in h.STATS] == [None, 1, 1, 1]
    assert s3["assessment_previous_correct_attempts_max"] is None
    assert [s3["ttw_Game A_sum"], s3[f"ttw_{BIRD}_sum"], s3["ttw_W1_sum"]] == [1, 1, 2]
    assert (s3["ttw_Game_sum"], s3["ttw_Assessment_sum"], s3["ttw___no_title_sum"]) == (1, 1, 0)
    s2 = got[("d1", "s2")]
    assert [s2[f"game_time_{s}"] for s in h.STATS] == [None, 400, 400, 400]
    assert s2["correct_attempts_max"] is None
    s1 = got[("d1", "s1")]
    assert s1["game_time_mean"] is None and s1["cnt_event_code_4070_max"] is None
    assert (s1["ttw___no_title_sum"], s1["ttw___no_world_sum"], s1["ttw_Game A_sum"]) == (1, 1, 0)
    assert s1["assessment_title"] == "Game A" and s1["assessment_world"] == "W1"


@EVERY_SIZE
def test_event_history_goldens(spark, limits):
    df = fe.features_from_events(events(spark), labels(spark), CODES, VOCABULARY, {}, limits)
    got = by_target(df)
    s3 = got[("d1", "s3")]
    assert s3["game_time_sum"] == 495
    assert s3["assessment_previous_game_time_max"] == 0
    assert [s3[f"accuracy_group_{k}"] for k in range(4)] == [1, 0, 1, 0]
    assert s3["cnt_event_code_4110_sum"] == 2 and s3["cnt_Game A_sum"] == 1
    s1 = got[("d1", "s1")]
    assert s1["game_time_mean"] == 0 and s1["accuracy_group_0"] == 1
    assert s1["cnt___no_title_sum"] == 1


CUT = [
    event("11:00:00", "x1", "Game A", 2000, 1, 0, device="d2"),
    event("11:00:30", "x1", "Game A", 2000, 2, 300, device="d2"),
    event("11:00:10.9", "x0", "Game A", 2000, 9, 999, device="d2"),
    event("11:00:10", "x2", MUSHROOM, 2000, 1, 0, device="d2"),
]


@EVERY_SIZE
def test_whole_session_or_cut_at_the_event(spark, limits):
    label = [("x2", "d2", MUSHROOM, 0, 0, 0)]
    whole = session_features(spark, limits, label, CUT)[("d2", "x2")]
    assert (whole["game_time_max"], whole["event_count_max"]) == (300, 2)
    df = fe.features_from_events(
        events(spark, CUT), labels(spark, label), CODES, VOCABULARY, {}, limits
    )
    cut = by_target(df)[("d2", "x2")]
    assert (cut["game_time_max"], cut["event_count_max"], cut["event_count_sum"]) == (0, 1, 1)


def test_label_without_session_gets_defaults(spark):
    got = session_features(spark, label_rows=[("lost", "d1", MUSHROOM, 0, 0, 0)])
    row = got[("d1", "lost")]
    assert row["game_time_mean"] is None and row["ttw___no_title_sum"] == 1


def test_unknown_title_is_an_error(spark):
    with pytest.raises(Exception, match="unknown title: Nowhere"):
        session_features(spark, label_rows=[("s3", "d1", "Nowhere", 0, 0, 0)])


def test_columns_that_differ_in_case_are_refused(spark):
    with pytest.raises(ValueError, match="differ only in case"):
        fe.session_measures([], {"title": ("Dino", "dino")})


# --- the paths against brute force ---------------------------------------------


def made_sessions(seed):
    """One device with most rows, a few small ones, ties in time and repeated values."""
    draw = random.Random(seed)
    sessions, targets = [], []
    for n in range(260):
        device = "hot" if draw.random() < 0.6 else f"d{draw.randrange(4)}"
        start = draw.randrange(200)
        title = draw.choice(["a", "b", "c"])
        value = draw.choice([0.0, 1.0, -2.5, 1e-3, 1e6 / 3, draw.uniform(-5, 5)])
        whole = draw.choice([0, 0, 0, 1, 2, -7, draw.randrange(1000)])
        kind = draw.choice(["Assessment", "Game"])
        known = None if draw.random() < 0.1 else value
        sessions.append((device, f"s{n}", start, title, kind, known, whole))
    for n in range(70):
        device = draw.choice(["hot", "hot", "d0", "d1", "nobody"])
        start = None if n == 0 else draw.randrange(210)
        targets.append((device, f"t{n}", start, draw.choice(["a", "b", "z"])))
    return sessions, targets


def expected(values, stat):
    if stat == "n":
        return len(values)
    if stat == "sum":
        return sum(values)
    if not values or (stat == "std" and len(values) < 2):
        return None
    return {
        "mean": statistics.fmean,
        "median": statistics.median,
        "max": max,
        "std": statistics.stdev,
    }[stat](values)


MEASURES = [
    ("value", h.ALL),
    ("whole", h.ALL),
    ("value", h.ASSESSMENTS),
    ("whole", h.SAME_TITLE),
]


def measures():
    return [
        h.Measure(f"{column}_{over}", column, h.STATS_AND_SUM, over)
        for column, over in MEASURES
    ]


def close(a, b):
    return (a is None and b is None) or (
        a is not None and b is not None and a == pytest.approx(b, rel=1e-6, abs=1e-6)
    )


@pytest.mark.parametrize(
    "limits",
    [h.Limits(), h.ANY_SIZE, h.Limits(60, 20_000)],
    ids=["arrays", "prefix", "mixed"],
)
@pytest.mark.parametrize("offset", [0, 1_000_000_000])
def test_every_path_agrees_with_brute_force(spark, limits, offset):
    sessions, targets = made_sessions(7)
    sessions = [(*x[:5], None if x[5] is None else x[5] + offset, x[6] + offset) for x in sessions]
    # rows without a device belong to nobody
    sessions += [(None, "lost", 1, "a", "Game", 5.0, 5)]
    targets += [(None, f"lost{n}", 100, "a") for n in range(3)]
    s = spark.createDataFrame(
        sessions,
        "installation_id string, game_session string, start bigint, title string, type string,"
        " value double, whole bigint",
    )
    t = spark.createDataFrame(
        targets,
        "installation_id string, assessment_game_session string, start bigint,"
        " assessment_title string",
    )
    got = by_target(h.history_features(s, t, measures(), limits, chunk=16))
    assert len(got) == len(targets)
    for device, name, start, title in targets:
        past = [
            x for x in sessions if start is not None and device is not None and x[0] == device and x[2] < start
        ]
        row = got[(device, name)]
        assert row["n_history"] == len(past)
        for column, over in MEASURES:
            seen = [
                x[5] if column == "value" else x[6]
                for x in past
                if over == h.ALL
                or (over == h.ASSESSMENTS and x[4] == "Assessment")
                or (over == h.SAME_TITLE and x[3] == title)
            ]
            seen = [x for x in seen if x is not None]
            for stat in h.STATS_AND_SUM:
                assert close(row[f"{column}_{over}_{stat}"], expected(seen, stat)), (name, over, stat)


@pytest.mark.parametrize("limits", [h.Limits(), h.ANY_SIZE], ids=["arrays", "prefix"])
def test_running_sessions_agree_with_brute_force(spark, limits):
    draw = random.Random(3)
    rows, label_rows = [], []
    for n in range(150):
        device = draw.choice(["d1", "d1", "d1", "d2"])
        session = f"{device}-{draw.randrange(9)}"
        title = [BIRD, MUSHROOM, "Game A"][int(session[-1]) % 3]
        at = f"10:{draw.randrange(20):02d}:{draw.randrange(60):02d}"
        code = draw.choice([4100, 4110, 2000])
        data = draw.choice(['{"correct":true}', '{"correct":false}', "{}"])
        rows.append(event(at, session, title, code, n, draw.randrange(5000), data, device))
    first = {}
    for row in rows:
        first[row[1]] = min(first.get(row[1], row[2]), row[2])
    for session in sorted(first):
        label_rows.append((session, session[:2], [BIRD, MUSHROOM, "Game A"][int(session[-1]) % 3], 0, 0, 0))
    df = fe.features_from_events(
        events(spark, rows), labels(spark, label_rows), CODES, VOCABULARY, {}, limits
    )
    got = by_target(df)
    for session, device, title, *_ in label_rows:
        start = first[session].replace(microsecond=0)
        states = {}
        for row in rows:
            if row[4] == device and row[2].replace(microsecond=0) < start:
                states.setdefault(row[1], []).append(row)

        def tries(state, text):
            attempt = 4110 if state[0][8] == BIRD else 4100
            return sum(
                r[9] == "Assessment" and r[6] == attempt and text in r[3] for r in state
            )

        right = [tries(x, '"correct":true') for x in states.values()]
        wrong = [tries(x, '"correct":false') for x in states.values()]
        rate = [c / (c + u) if c + u else 0.0 for c, u in zip(right, wrong, strict=True)]
        longest = [max(r[7] for r in x) for x in states.values()]
        row = got[(device, session)]
        for name, values in (
            ("game_time", longest),
            ("correct_attempts", right),
            ("uncorrect_attempts", wrong),
            ("accuracy_rate", rate),
        ):
            for stat in h.STATS_AND_SUM:
                want = expected(values, stat) or 0.0
                assert close(row[f"{name}_{stat}"], want), (session, name, stat)


def test_prefix_totals_are_strict_and_bounded_by_chunks(spark):
    rows = [("g", p, 0, 1) for p in range(0, 100, 3)] + [("g", p, 1, 0) for p in (0, 1, 50, 99)]
    df = spark.createDataFrame(rows, "g string, pos bigint, asks int, n bigint")
    got = px.prefix_totals(df, ["g"], "pos", ["n"], chunk=8).collect()
    assert {r["pos"]: r["n"] for r in got} == {0: 0, 1: 1, 50: 17, 99: 33}


def test_taken_back_values_leave_the_order_statistics(spark):
    items = spark.createDataFrame(
        [("g", 1, 5, 1), ("g", 1, 9, 1), ("g", 2, 9, -1), ("g", 2, 300, 1), ("g", 3, 7, 1)],
        "g string, pos bigint, code bigint, weight bigint",
    )
    asked = spark.createDataFrame(
        [("g", 2, 2), ("g", 3, 2), ("g", 4, 2)], "g string, pos bigint, k bigint"
    )
    got = px.kth_smallest(items, asked, ["g"], "pos", 9, chunk=2).collect()
    assert {r["pos"]: r["code"] for r in got} == {2: 9, 3: 300, 4: 7}


def seen_states(rows, start):
    """The values a target sees of (session, start, value) rows: the last state of each session."""
    last = {}
    for session, at, value in sorted(rows, key=lambda r: r[1]):
        if at < start:
            last[session] = value
    return list(last.values())


DRIFTING = {
    "up": [(f"s{i}", i, i % 2 + (1e9 if i >= 100 else 0)) for i in range(200)],
    "down": [(f"s{i}", i, i % 2 + (0 if i >= 100 else 1e9)) for i in range(200)],
    "first far away": [("s0", 0, 1e12), *[(f"s{i}", i, 0.1 * (i % 3)) for i in range(1, 60)]],
    # the state that was far away is replaced before and after others come
    "taken back": [("s0", 0, 1e12), ("s0", 5, 0.25), *[(f"s{i}", i, 0.1 * (i % 3)) for i in range(1, 60)]],
    "often taken back": [(f"s{i % 7}", i, 3e8 * (i % 5 == 0) + i % 3) for i in range(150)],
    "constant": [(f"s{i}", i, 0.1) for i in range(40)],
}


@pytest.mark.parametrize("name", DRIFTING)
def test_deviations_are_exact_however_values_drift(spark, name):
    from statistics import fmean, stdev

    rows = DRIFTING[name]
    before, made = {}, []
    for session, start, value in rows:
        state = None if session not in before else (before[session],)
        made.append(("d", session, start, "a", "Game", float(value), state))
        before[session] = float(value)
    s = spark.createDataFrame(
        made,
        "installation_id string, game_session string, start bigint, title string, type string,"
        " value double, before struct<value: double>",
    )
    starts = [0, 1, 2, 3, 5, 6, 17, 99, 100, 101, 130, 300]
    t = spark.createDataFrame(
        [("d", f"t{x}", x, "a") for x in starts],
        "installation_id string, assessment_game_session string, start bigint, assessment_title string",
    )
    got = by_target(h.history_features(s, t, [h.Measure("v", "value", h.STATS_AND_SUM)], h.ANY_SIZE, chunk=16))
    for x in starts:
        seen, row = seen_states(rows, x), got[("d", f"t{x}")]
        assert row["n_history"] == len(seen)
        if len(seen) > 1:
            assert row["v_std"] == pytest.approx(stdev(seen), rel=1e-9, abs=0), x
            assert row["v_mean"] == pytest.approx(fmean(seen), rel=1e-12), x
            assert row["v_median"] == statistics.median(seen) and row["v_max"] == max(seen)
