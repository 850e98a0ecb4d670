"""Declared schemas of the input files."""

from __future__ import annotations

EVENTS = (
    "event_id string, game_session string, timestamp timestamp, event_data string, "
    "installation_id string, event_count int, event_code int, game_time bigint, "
    "title string, type string, world string"
)

LABELS = (
    "game_session string, installation_id string, title string, "
    "num_correct int, num_incorrect int, accuracy_group int"
)

SPECS = "event_id string, info string, args string"
SPEC_ARGS = "array<struct<name: string, info: string>>"

IMPORTANCES = "feature string, importance double"
TUNING_LOG = "target double, params map<string, double>"
