"""Small hand-made telemetry."""

from datetime import datetime

from tidemark import schemas

BIRD = "Bird Measurer (Assessment)"
MUSHROOM = "Mushroom Sorter (Assessment)"


def moment(text):
    return datetime.fromisoformat(f"2019-09-06T{text}+00:00")


def event(
    at, session, title, code, count=1, game_time=0, data="{}", device="d1", world="W1", event_id="e"
):
    kind = "Assessment" if "Assessment" in title else "Game"
    return (
        event_id,
        session,
        moment(at),
        data,
        device,
        count,
        code,
        game_time,
        title,
        kind,
        world,
    )


RIGHT, WRONG = '{"correct":true}', '{"correct":false}'

STORY = [
    event("10:00:00", "s1", "Game A", 2000, 1, 0),
    event("10:00:01", "s1", "Game A", 4070, 2, 100),
    event("10:00:02", "s1", "Game A", 4070, 3, 400),
    event("10:05:00", "s2", BIRD, 2000, 1, 0),
    event("10:05:10", "s2", BIRD, 4110, 2, 50, WRONG),
    event("10:05:20", "s2", BIRD, 4110, 3, 90, RIGHT),
    event("10:05:25", "s2", BIRD, 4100, 4, 95, RIGHT),
    event("10:10:00", "s3", MUSHROOM, 2000, 1, 0),
]

LABELS = [
    ("s3", "d1", MUSHROOM, 0, 0, 0),
    ("s2", "d1", BIRD, 1, 1, 2),
    ("s1", "d1", "Game A", 0, 0, 0),
]

VOCABULARY = {
    "title": ("Game A", BIRD, MUSHROOM),
    "type": ("Game", "Assessment"),
    "world": ("W1",),
}
CODES = (2000, 4070, 4100, 4110)


def events(spark, rows=None):
    return spark.createDataFrame(STORY if rows is None else rows, schemas.EVENTS)


def labels(spark, rows=None):
    return spark.createDataFrame(LABELS if rows is None else rows, schemas.LABELS)
