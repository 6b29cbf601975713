from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ticklake.sources import raw


@pytest.mark.parametrize("name", ["trade_time", "TRADE_TIME", "kline_time", "KLINE_TIME", "trade_date", "DATE", "datetime"])
def test_every_time_alias(spark, name):
    df = spark.createDataFrame([(" a ", "20240105", "1.5")], f"CODE string, `{name}` string, OPEN string")
    assert rows(raw.kline(df), "code", "trade_time", "open", "close") == [("a", datetime(2024, 1, 5), 1.5, None)]


def test_alias_order_and_missing_time(spark):
    df = spark.createDataFrame([("a", "20240105", "20240106")], "code string, trade_date string, kline_time string")
    assert raw.kline(df).first()["trade_time"] == datetime(2024, 1, 6)
    with pytest.raises(ValueError):
        raw.kline(spark.createDataFrame([("a",)], "code string"))


def test_rows_without_code_or_time_are_rejected(spark):
    df = spark.createDataFrame([("a", "20240105"), (None, "20240105"), (" ", "20240105"), ("a", "123456789")], "code string, trade_time string")
    assert raw.kline(df, "min1").count() == 1


def test_scanned_names(spark):
    df = spark.createDataFrame([("a", "20240105093000123", "7.0", "1.5")], "code string, snapshot_time string, `ask _volume1` string, `pre_settle:` string")
    assert rows(raw.snapshot(df), "trade_time", "ask_volume1", "pre_settle") == [(datetime(2024, 1, 5, 9, 30, 0, 123000), 7, 1.5)]


def test_other_types_in_a_drop(spark):
    df = spark.createDataFrame(
        [("a", 20240105, float("nan"), 5)], "MARKET_CODE string, TRADE_DATE int, PRE_CLOSE double, IS_ST_SEC int")
    assert rows(raw.status(df), "trade_date", "market_code", "preclose", "is_st_sec") == [(date(2024, 1, 5), "a", None, "5")]
    flags = spark.createDataFrame([("920001.BJ", [1, 62]), ("430001.BJ", [1]), (" ", [])], "code string, security_status array<int>")
    got = raw.code_info(flags.withColumn("security_status", F.col("security_status").cast("array<string>")), "BJ_A")
    assert rows(got, "security_type", "code", "security_status_raw") == [("BJ_A", "920001.BJ", "1,62")]


def test_stock_basic_and_calendar(spark):
    df = spark.createDataFrame([("a", "Name", "20100101", "1.0"), (None, "x", "", "")], "MARKET_CODE string, SECURITY_NAME string, LISTDATE string, IS_LISTED string")
    got = raw.stock_basic(df, date(2024, 1, 5))
    assert rows(got, "snapshot_date", "market_code", "security_name", "list_date", "is_listed") == [(date(2024, 1, 5), "a", "Name", 20100101, 1)]
    days = spark.createDataFrame([(20240105,), (20240230,)], "trade_date int")
    assert rows(raw.calendar(days, "SH")) == [("SH", date(2024, 1, 5))]


def test_code_from_the_path(spark, tmp_path):
    for code in ("600000.SH", "000001.SZ"):
        spark.createDataFrame([("20240105", "1")], "trade_time string, open string").coalesce(1).write.csv(
            str(tmp_path / code), header=True)
    drop = spark.read.csv([str(tmp_path / "600000.SH"), str(tmp_path / "000001.SZ")], header=True)
    got = raw.kline(raw.with_path_code(drop, r"/([0-9]+\.[A-Z]{2})/"))
    assert rows(got, "code", "open") == [("000001.SZ", 1.0), ("600000.SH", 1.0)]


def test_membership_days_and_fallback_to_natural_days(spark):
    calendar = spark.createDataFrame([(date(2024, 1, d),) for d in (2, 3, 3, 5)], "trade_date date")
    assert rows(raw.trading_days(calendar, 20240102, 20240104)) == [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    assert rows(raw.trading_days(calendar, 20230101, 20230103)) == [(date(2023, 1, d),) for d in (1, 2, 3)]
    held = spark.createDataFrame([("SH_A", "a", date(2024, 1, 1), date(2024, 1, 3)), ("SH_A", "a", date(2024, 1, 3), date(2024, 1, 9))],
                                 "security_type string, code string, in_date date, out_date date")
    got = raw.membership_daily(held, raw.trading_days(calendar, 20240101, 20240131))
    assert rows(got) == [(date(2024, 1, d), "SH_A", "a") for d in (2, 3, 5)]
