import pytest

import __spark_entry__ as entry
from checks.compare import check, connect

SF = "/root/testdata/sf0.001"

QUICK = [
    "attempt_flags_json",
    "event_prop_sums",
    "features_g2_test",
    "group_fold",
    "last_per_device",
    "lookup_title_world",
    "metric_auc",
    "metric_qwk",
    "scan_csv_events",
    "session_gap_stats",
    "specs_html_rows",
    "stream_session_agg",
]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 90


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_its_oracle(spark, name):
    outcome = check(spark, connect(SF), name, SF)
    assert outcome["ok"], outcome


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "game_time_median" in df.columns
