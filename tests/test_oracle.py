"""Registered queries vs their DuckDB oracle on sf0.001 (the full sweep is tests/oracle_check.py)."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck

SAMPLE = ["feature_matrix", "apply_rules", "global_budget", "pos_merged", "cleaning_audit", "price_summary",
          "ddm_first_detection", "drift_summary", "ks_statistic", "baseline_metrics", "improvement_report",
          "order_listing", "calendar_gaps", "cv_folds", "update_rules", "drift_replay", "adwin_replay",
          "ddm_replay", "ks_test", "drift_check", "events_drift_batch", "monitor_counts", "stream_pos_history"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    from shelfcast.plans.registry import ORACLE, QUERIES, load_all
    load_all()
    msg = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ": OK" in msg, msg


def test_every_query_registered_with_entry():
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 85 and len(o) >= 75
