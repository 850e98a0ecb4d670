import random

import pytest

from tests.fixtures import BIRD, CODES, RIGHT, WRONG, event, events
from tidemark import schemas
from tidemark.operators.sessions import sessions_with_ids
from tidemark.streaming import sessions as st


def strewn(n=120):
    """Events of a few sessions in no order, with equal, missing and far-apart game times."""
    draw = random.Random(5)
    rows = []
    for i in range(n):
        time = draw.choice([None, 0, 7, 70_000, draw.randrange(400_000), draw.randrange(300)])
        at = f"10:{draw.randrange(60):02d}:{draw.randrange(60):02d}"
        session = draw.choice(["s1", "s1", "s1", "s2", "s3", None])
        rows.append(event(at, session, BIRD, draw.choice(CODES), i, time, draw.choice([RIGHT, WRONG, "{}"])))
    return [*rows, event("10:00:00", "lonely", BIRD, 2000, 1, 5)]


@pytest.mark.parametrize("batches,merge_every,live", [(9, 2, 2), (6, 4, 3), (3, 16, 3)])
def test_stream_equals_batch_with_parts_that_interleave(spark, tmp_path, batches, merge_every, live):
    rows = strewn()
    for i in range(batches):
        events(spark, rows[i::batches]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schemas.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    st.run_to_end(stream, out, f"{tmp_path}/state", CODES, ["e"], merge_every)
    got = {r["game_session"]: r.asDict() for r in st.sessions_so_far(spark, out).collect()}
    want = {r["game_session"]: r.asDict() for r in sessions_with_ids(events(spark, rows), CODES, ["e"]).collect()}
    assert got.keys() == want.keys() == {"s1", "s2", "s3", "lonely"}
    for session, row in want.items():
        assert row["game_time_mean_diff"] > 0 or session == "lonely"
        for name, value in row.items():
            if name != "game_time":  # a stream's largest time is 0 where all are missing
                value = pytest.approx(value) if isinstance(value, float) else value
                assert got[session][name] == value, (session, name)
    # as many parts as the number of batches has digits, and ones, to that base
    assert len(st._live(st._written(spark, out))) == live


def test_a_repeated_batch_counts_once(spark, tmp_path):
    rows, out = strewn(), f"{tmp_path}/out"
    parts = [events(spark, rows[i::4]) for i in range(4)]

    def write(number):
        own = st._table(out, 0, number, number)
        if not any(own.within(x) for x in st._written(spark, out)):
            st._write(own, st.fold_part(parts[number], CODES), st.gap_buckets(parts[number].filter("game_session IS NOT NULL")))
        st.compact(spark, out, 2)

    for number in (0, 0, 1, 1, 2, 3, 3):
        write(number)
    reader = st.sessions_so_far(spark, out)
    assert [(x.tier, x.first, x.last) for x in st._live(st._written(spark, out))] == [(2, 0, 3)]
    n = {r["game_session"]: r["n_events"] for r in reader.collect()}
    assert n == {s: sum(r[1] == s for r in rows) for s in ("s1", "s2", "s3", "lonely")}


def test_one_part_is_no_merge(spark, tmp_path):
    with pytest.raises(ValueError, match="two parts"):
        st.run_to_end(None, str(tmp_path), str(tmp_path), merge_every=1)
