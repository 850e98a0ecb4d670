"""Names of generated columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping


def with_stat(column: str, stat: str) -> str:
    return column if stat in ("", "first") else f"{column}_{stat}"


def code_column(code: object) -> str:
    return f"cnt_event_code_{code}"


def id_column(event_id: str) -> str:
    return f"cnt_event_id_{event_id}"


def prop_column(event_id: str, prop: str) -> str:
    return f"event_data_prop_{event_id}_{prop}"


def prop_columns(props: Mapping[str, Iterable[str]]) -> list[str]:
    return [prop_column(event_id, prop) for event_id, names in props.items() for prop in names]


def starting_with(columns: Iterable[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> str:
    """A value as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def reject_case_twins(columns: Iterable[str]) -> None:
    """Two names that differ only in case cannot be told apart by Spark."""
    seen: dict[str, str] = {}
    for name in columns:
        twin = seen.setdefault(name.lower(), name)
        if twin != name:
            raise ValueError(f"columns {twin!r} and {name!r} differ only in case")
