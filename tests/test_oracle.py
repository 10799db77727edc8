"""Every registered query equals its DuckDB oracle (the driver's check)."""

import pytest

import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import __spark_entry__ as entry
from conftest import SF0001, SF001
from oracle_compare import compare, duck

# late-data queries have no late rows at sf0.001 (too sparse), so they run at sf0.01
LATE = {"late_rows", "late_counts", "late_window_counts", "late_window_rows", "late_updates",
        "late_updates_by_key"}


@pytest.fixture(scope="module")
def ducks():
    return {SF0001: duck(SF0001), SF001: duck(SF001)}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, ducks, name):
    sf = SF001 if name in LATE else SF0001
    res = compare(spark, ducks[sf], sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert res["ok"], res


KEYED = ["rolling_sum", "rolling_argmax", "running_count", "keyed_bucket_count", "bucket_count",
         "gate", "threshold_alert", "jump_alert", "jump_alert_ttl", "alert_counter", "rise_alert",
         "late_updates", "late_updates_by_key"]


@pytest.mark.parametrize("name", KEYED)
def test_hot_path_matches_oracle(spark, ducks, name):
    """Every keyed scan with its keys cut into slices."""
    from kairo.plans.scan import CHUNK_ROWS_CONF
    sf = SF001 if name in LATE else SF0001
    spark.conf.set(CHUNK_ROWS_CONF, "20")
    try:
        res = compare(spark, ducks[sf], sf, name, entry.queries()[name], entry.oracle_sql()[name])
    finally:
        spark.conf.unset(CHUNK_ROWS_CONF)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "min", "max", "end_ts"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_listed():
    assert set(entry.oracle_sql()) <= set(entry.queries())
