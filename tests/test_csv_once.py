"""The lines of records with line breaks are written once, and move once, to be joined."""

import contextlib
import io

from tests.test_csv_splits import small_splits, written  # noqa: F401
from tidemark.session import stage
from tidemark.sources import csv_splits


def test_lines_are_written_once_and_move_once(spark, tmp_path, small_splits, monkeypatch):  # noqa: F811
    rows = [(str(i), "x\n" * (i % 9) + 'y"z', "w" * (i % 50)) for i in range(60)]
    written(tmp_path / "f.csv", rows)
    labels = []
    monkeypatch.setattr(csv_splits, "stage", lambda df, label: labels.append(label) or stage(df, label))
    found = csv_splits.records(spark, str(tmp_path / "f.csv"))
    assert labels == ["lines"]
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        found.explain()
    assert "Window" not in said.getvalue() and said.getvalue().count("Exchange hashpartitioning") == 1
    assert found.count() == 61
