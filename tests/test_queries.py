"""Every registered query against its SQL twin on the small sample."""

import os

import pytest

import __spark_entry__ as entry
from conftest import plan
from oracle_check import compare, duck
from ticklake.operators import lookup
from ticklake.plans.oracle import ORACLE
from ticklake.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", ["kline_daily_range", "snapshot_range", "raw_kline", "factor_matrix", "kline_resample_min5"])
def test_no_python_in_plans(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["kline_minute_range", "kline_resample_min60", "kline_resample_week", "normalize_timestamps", "snapshot_time_of_day"])
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("name", [
    "kline_daily_range", "snapshot_range", "stock_basic_asof", "history_stock_status", "request_order",
    "incremental_select", "membership_daily", "codes_available", "load_kline_daily",
])
def test_results_beyond_the_broadcast_limit(spark, con, name, monkeypatch):
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", 0)
    assert compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None
