import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from ticklake import schemas as S
from ticklake.operators import watermarks as W
from ticklake.plans import loads, views
from ticklake.plans.market import MarketLake
from ticklake.sources import raw

DAY = date(2024, 2, 1)


def kline(spark, days, codes=("a", "b"), price=1.0, seq=1):
    data = [(datetime(2024, 1, 1) + timedelta(days=d), c, price + d, seq) for c in codes for d in days]
    df = spark.createDataFrame(data, "trade_time timestamp_ntz, code string, open double, o long")
    return raw.normalize(df, "kline_daily").withColumn("o", F.lit(seq))


def stored(lake, table="kline_daily"):
    return rows(lake.latest(table))


def test_ensure_tables_twice_keeps_data(spark, lake):
    lake.ensure_tables()
    lake.append("kline_daily", kline(spark, range(3)))
    lake.ensure_tables()
    assert lake.read("kline_daily").count() == 6
    assert lake.read("kline_daily").schema.names == S.TABLES["kline_daily"].stored_schema.names
    assert {t: lake.read(t).count() for t in S.TABLES} == {t: 6 if t == "kline_daily" else 0 for t in S.TABLES}


def test_tables_need_no_setup(spark, lake):
    assert lake.read("price_factor").count() == 0
    assert lake.read("price_factor").schema.names == S.TABLES["price_factor"].stored_schema.names


def test_duplicates_are_kept_at_rest_and_removed_on_read(spark, lake):
    lake.append("kline_daily", kline(spark, range(3), price=1.0), 1)
    lake.append("kline_daily", kline(spark, range(3), price=9.0), 2)
    assert lake.read("kline_daily").count() == 12
    got = views.kline(lake.read("kline_daily"), ["a"], 20240101, 20240131)
    assert [r["open"] for r in got.collect()] == [9.0, 10.0, 11.0]
    before = stored(lake)
    lake.compact("kline_daily", ["202401"])
    assert lake.read("kline_daily").count() == 6 and stored(lake) == before
    assert {r[0] for r in lake.read("kline_daily").select("ingest_seq").distinct().collect()} == {2}


def test_months_of_one_load_are_read_without_a_shuffle(spark, lake):
    for load in (1, 2):
        lake.append("kline_daily", kline(spark, (0, 1, 40), price=float(load)), load)
    lake.append("kline_daily", kline(spark, (70,)), 3)

    def read(begin, end):
        months = lake.unique_months("kline_daily", begin, end)
        fast = views.kline(lake.read("kline_daily"), None, begin, end, ordered=False, unique_months=months)
        slow = views.kline(lake.read("kline_daily"), None, begin, end, ordered=False)
        assert rows(fast) == rows(slow)
        return months, fast

    assert read(20240101, 20240331)[0] == ["202403"]
    lake.compact("kline_daily", ["202401"])
    months, fast = read(20240101, 20240331)
    assert months == ["202401", "202403"] and "Exchange" in plan(fast)
    assert "Exchange" not in plan(read(20240105, 20240131)[1])
    lake.append("kline_daily", kline(spark, (1,), price=9.0), 4)
    assert read(20240101, 20240131)[0] == []


def test_compaction_leaves_other_months_alone(spark, lake):
    for load in (1, 2):
        lake.append("kline_daily", kline(spark, (0, 40)), load)
    lake.compact("kline_daily", ["202402"])
    assert dict(rows(lake.read("kline_daily").groupBy("month").count())) == {"202401": 4, "202402": 2}
    lake.append("code_info", spark.createDataFrame([("SH_A", "a", "x")], "security_type string, code string, symbol string").transform(
        lambda d: raw.normalize(d, "code_info")), 1)
    lake.append("code_info", raw.normalize(spark.createDataFrame([("SH_A", "a", "y")], "security_type string, code string, symbol string"), "code_info"), 2)
    lake.compact("code_info")
    assert rows(lake.read("code_info"), "symbol", "ingest_seq") == [("y", 2)]


def test_key_only_tables_take_new_keys_only(spark, lake):
    days = lambda *d: spark.createDataFrame([("SH", date(2024, 1, x)) for x in d], "market string, trade_date date")
    assert lake.append("trade_calendar", days(1, 2, 2), 1).row_count == 2
    assert lake.append("trade_calendar", days(2, 3), 2).row_count == 1
    assert rows(lake.read("trade_calendar"), "trade_date", "ingest_seq") == [(date(2024, 1, d), s) for d, s in ((1, 1), (2, 1), (3, 2))]
    assert lake.append("trade_calendar", days(1).limit(0), 3).row_count == 0


def test_copies_inside_one_load(spark, lake):
    twice = kline(spark, range(2), price=1.0, seq=1).union(kline(spark, range(2), price=5.0, seq=2))
    assert lake.append("kline_daily", twice, 1, "o").row_count == 4
    assert sorted({r[2] for r in stored(lake)}) == [5.0, 6.0]


def test_files_of_a_month_hold_disjoint_codes(spark, lake):
    """A hot code stands in several files, the others in one each (but at file edges)."""
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    for size in sizes:
        spark.conf.set(size, "64k")
    try:
        days = spark.range(0, 60000, numPartitions=8).select(
            F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id % 43000, 0)").alias("trade_time"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 900).cast("string")).alias("code"), F.rand(1).alias("open"))
        lake.append("kline_minute", raw.normalize(days, "kline_minute"))
    finally:
        for size in sizes:
            spark.conf.unset(size)
    files = lake.read("kline_minute").groupBy(F.input_file_name().alias("f")).agg(
        F.min("code").alias("lo"), F.max("code").alias("hi"), F.max(F.col("code") == "hot").alias("hot")).orderBy("lo", "hi").collect()
    assert len(files) > 2 and sum(r["hot"] for r in files) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))


def test_a_write_that_dies_changes_nothing(spark, lake, monkeypatch):
    """Compaction fails after its files are written: the old rows stay, the repeat succeeds."""
    from ticklake.sources.manifest import Manifest

    info = lambda name: raw.normalize(spark.createDataFrame([("SH_A", "a", name)], "security_type string, code string, symbol string"), "code_info")
    for load in (1, 2):
        lake.append("code_info", info(str(load)), load)
        lake.append("kline_daily", kline(spark, (0, 40), price=float(load)), load)
    before = {t: rows(lake.read(t)) for t in ("code_info", "kline_daily")}

    def broken(self, entries):
        raise OSError("no space")

    opened = lake.read("kline_daily")
    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "switch", broken)
        for table in before:
            with pytest.raises(OSError):
                lake.compact(table)
            with pytest.raises(OSError):
                lake.append(table, info("9") if table == "code_info" else kline(spark, (0,)), 9)
    assert {t: rows(lake.read(t)) for t in before} == before
    for table in before:
        assert lake.vacuum(table)
        lake.compact(table)
    assert rows(lake.read("code_info"), "symbol", "ingest_seq") == [("2", 2)]
    assert rows(opened) == before["kline_daily"]  # a reader keeps what it opened
    assert lake.read("kline_daily").count() == 4 and lake.compact("kline_daily") == []


def test_order_decides_inside_a_load(spark, lake):
    """NULL orders are lowest, NaN highest; among equals the larger values win, in whatever order they come."""
    data = [("a", 1.0, None), ("a", 2.0, 0), ("b", 5.0, None), ("b", 4.0, None), ("c", 1.0, 7), ("c", None, 7)]
    for i, part in enumerate((data, data[::-1])):
        drop = spark.createDataFrame([(datetime(2024, 1 + i, 1), *r) for r in part], "trade_time timestamp_ntz, code string, open double, o int")
        lake.append("kline_daily", raw.normalize(drop, "kline_daily", keep=["o"]), i + 1, "o")
        got = lake.read("kline_daily").where(F.col("ingest_seq") == i + 1)
        assert rows(got, "code", "open") == [("a", 2.0), ("b", 5.0), ("c", 1.0)]


def test_both_dedup_plans_agree_on_null_orders(spark):
    from ticklake.operators.dedup import latest_per_key

    data = spark.createDataFrame([("a", 1.0, "x", None), ("a", 2.0, "y", -5), ("b", 3.0, "z", None)], "k string, v double, t string, o bigint")
    narrow, wide = latest_per_key(data, ["k"], ["v"], "o"), latest_per_key(data, ["k"], ["v", "t"], "o")
    assert "max_by" in plan(narrow) and "max_by" not in plan(wide)
    assert rows(narrow) == rows(wide, "k", "v") == [("a", 2.0), ("b", 3.0)]


# ----------------------------------------------------------------- loads

def test_load_twice_is_load_once(spark, lake):
    first = loads.load_kline(lake, kline(spark, range(5)), run_date=DAY)
    once = stored(lake)
    again = loads.load_kline(lake, kline(spark, range(5)), run_date=DAY)
    forced = loads.load_kline(lake, kline(spark, range(5)), run_date=DAY, force=True)
    assert (first.status, first.row_count) == ("success", 10)
    assert (again.status, again.row_count, again.end_date) == ("skipped", 0, date(2024, 1, 5))
    assert (forced.status, forced.row_count, forced.end_date) == ("success", 0, date(2024, 1, 5))
    assert stored(lake) == once and lake.read("kline_daily").count() == 10


def test_two_windows_are_one(spark, lake, tmp_path):
    from ticklake.sources.lake import Lake

    loads.load_kline(lake, kline(spark, range(40)), end=20240110, run_date=DAY)
    loads.load_kline(lake, kline(spark, range(40)), end=20240301, run_date=DAY)
    other = Lake(spark, str(tmp_path / "other"))
    loads.load_kline(other, kline(spark, range(40)), run_date=DAY)
    assert stored(lake) == stored(other)


def test_watermark_is_per_code(spark, lake):
    loads.load_kline(lake, kline(spark, range(5), codes=("a",)), codes=["a"], run_date=DAY)
    got = loads.load_kline(lake, kline(spark, range(6)), codes=["a", "b"], run_date=DAY)
    assert got.row_count == 1 + 6


def test_lookback_completes_a_day(spark, lake):
    loads.load_kline(lake, kline(spark, range(3), price=1.0), run_date=DAY)
    got = loads.load_kline(lake, kline(spark, range(3), price=9.0), run_date=DAY, force=True, lookback_days=1)
    assert got.row_count == 2
    assert rows(lake.latest("kline_daily"), "open") == [(1.0,), (1.0,), (11.0,), (11.0,), (2.0,), (2.0,)]


def test_failure_is_logged_and_does_not_count_as_success(spark, lake):
    def broken():
        raise RuntimeError("source is down")

    with pytest.raises(RuntimeError):
        loads.load_kline(lake, broken, run_date=DAY)
    assert loads.load_kline(lake, None, run_date=DAY).status == "failed"
    assert loads.load_kline(lake, kline(spark, range(2)), run_date=DAY).status == "success"
    statuses = [r["status"] for r in lake.read("sync_task_log").orderBy("finished_at").collect()]
    assert statuses == ["failed", "failed", "success"]


def test_a_skipped_run_does_not_open_the_source(spark, lake):
    loads.load_kline(lake, kline(spark, range(2)), run_date=DAY)

    def never():
        raise AssertionError("opened")

    assert loads.load_kline(lake, never, run_date=DAY, codes=None).status == "skipped"


def test_empty_fetch_is_a_success_with_no_rows(spark, lake):
    got = loads.load_kline(lake, kline(spark, range(1)).limit(0), run_date=DAY)
    assert (got.status, got.row_count) == ("success", 0)
    assert W.succeeded_on(lake.read("sync_task_log")).first()["rows_loaded"] == 0
    assert loads.succeeded_today(lake, "query_kline", "task=query_kline|begin_date=|end_date=", DAY)


def test_run_that_died_before_its_log_row(spark, lake):
    lake.append("kline_daily", kline(spark, range(5)), 1)  # rows written, no log row
    assert loads.load_kline(lake, kline(spark, range(6)), run_date=DAY).row_count == 2
    assert len(stored(lake)) == 12


def test_periods(spark, lake):
    assert loads.kline_table("day")[0] == loads.kline_table("10008")[0] == "kline_daily"
    assert loads.kline_table("min1")[0] == loads.kline_table(10000)[0] == "kline_minute"
    for period in ("week", "min5", " "):
        with pytest.raises(ValueError):
            loads.kline_table(period)
    with pytest.raises(ValueError):
        loads.load_kline(lake, kline(spark, range(2)), begin=20240105, end=20240101)


# ----------------------------------------------------------------- front door

class Drops:
    """A source over small drops; counts how often it is opened."""

    def __init__(self, spark):
        self.spark, self.opened = spark, []

    def _rows(self, name, data, schema):
        self.opened.append(name)
        return self.spark.createDataFrame(data, schema)

    def calendar(self, market):
        return raw.calendar(self._rows("calendar", [("20240103",), ("2024-01-02",)], "trade_date string"), market)

    def code_info(self, kind):
        return raw.code_info(self._rows("code_info", [("920001.BJ", "n"), ("430001.BJ", "m"), ("600000.SH", "o")], "code string, symbol string"), kind)

    def membership(self, kind):
        return raw.membership(self._rows("membership", [("a", "20240102"), ("b", "20240103")], "code string, trade_date string"), kind)

    def factors(self, kind):
        return raw.factors(self._rows("factors", [("20240102", 1.0, 2.0)], "trade_date string, a double, b double"), kind)

    def stock_basic(self, day):
        return raw.stock_basic(self._rows("basic", [("a", "A"), ("b", "B")], "MARKET_CODE string, SECURITY_NAME string"), day)

    def status(self):
        return raw.status(self._rows("status", [("a", "20240102", "1.5"), ("b", "20240102", "2.5"), ("b", "20240103", "3.5")], "MARKET_CODE string, TRADE_DATE string, PRECLOSE string"))

    def kline(self, period):
        at = "20240102" if period == "day" else "202401020931"
        return raw.kline(self._rows("kline", [("a", at, "1.5"), ("b", at, "2.5")], "code string, trade_time string, open string"), period)

    def snapshot(self):
        return raw.snapshot(self._rows("snapshot", [("a", "20240102093000123", "1.5")], "code string, trade_time string, last string"))


def test_front_door(spark, lake):
    drops = Drops(spark)
    market = MarketLake(lake, drops, require_rows=True)
    assert [r[0] for r in market.get_calendar().collect()] == ["20240102", "20240103"]
    assert market.get_calendar("datetime").first()[0] == datetime(2024, 1, 2)
    assert drops.opened.count("calendar") == 1
    assert market.get_code_info("EXTRA_STOCK_A").columns[:3] == ["code", "symbol", "security_status"]
    assert [r[0] for r in market.get_code_list().collect()] == ["600000.SH", "920001.BJ"]
    assert [r[0] for r in market.resolve_codes("", limit=1).collect()] == ["600000.SH"]
    assert [r[0] for r in market.resolve_codes("b, a,b").collect()] == ["a", "b"]
    assert [r[0] for r in market.get_hist_code_list("SH_A", 20240101, 20240102).collect()] == ["a"]
    assert market.get_backward_factor(["b", "x", "a"]).columns == ["trade_date", "b", "a"]
    assert [r["MARKET_CODE"] for r in market.get_stock_basic(["b", "a"]).collect()] == ["b", "a"]
    status = market.get_history_stock_status(["b", "a"], 20240101, 20240131).collect()
    assert [(r["MARKET_CODE"], r["TRADE_DATE"], r["PRECLOSE"]) for r in status] == [
        ("b", "20240102", 2.5), ("b", "20240103", 3.5), ("a", "20240102", 1.5)]
    assert market.query_kline(["a", "b"], 20240101, 20240131).count() == 2
    assert market.query_kline_minute(["a"], 20240101, 20240131, 930, 1130).first()["open"] == 1.5
    assert market.query_snapshot(["a"], 20240101, 20240131).first()["trade_time"] == datetime(2024, 1, 2, 9, 30, 0, 123000)
    assert market.get_latest_trade_date() == date(2024, 1, 3)
    assert market.default_window() == (date(2010, 1, 1), date(2024, 1, 3))
    assert market.audit().where("succeeded").count() >= 8
    assert market.checkpoints().where("status = 'success'").count() >= 8


def test_frames_of_codes_at_the_front_door(spark, lake):
    """A universe is a request: trimmed, with a scope of its own, the same for the same codes in any order."""
    drops = Drops(spark)
    market = MarketLake(lake, drops)
    frame = lambda *codes: spark.createDataFrame([(c,) for c in codes], "code string")
    assert market.query_kline(frame(" a "), 20240101, 20240131).count() == 1
    assert market.query_kline(frame("b", " ", "b"), 20240101, 20240131).count() == 1
    assert market.query_kline(frame("b"), 20240101, 20240131).count() == 1
    assert market.query_kline(["a", "b"], 20240101, 20240131).count() == 2
    assert drops.opened.count("kline") == 3
    assert loads.codes_mark(frame("x", "y")) == loads.codes_mark(frame(" y", "x", "x")) != loads.codes_mark(frame("x"))
    assert market.get_backward_factor(frame("b", "a")).columns == ["trade_date", "a", "b"]
    assert rows(market.get_stock_basic(frame("b", "a").withColumnRenamed("code", "market_code")), "MARKET_CODE") == [("a",), ("b",)]
    assert market.get_history_stock_status(frame("b"), 20240101, 20240131).count() == 2
    with pytest.raises(ValueError):
        market.query_kline(spark.createDataFrame([(1, 2)], "x int, y int"), 20240101, 20240131)
    with pytest.raises(TypeError):
        market.query_kline(7, 20240101, 20240131)


def test_codes_and_months_reach_the_scan(spark, lake):
    drops = Drops(spark)
    for day in (2, 3):
        loads.load_stock_basic(lake, drops.stock_basic(date(2024, day, 5)), run_date=date(2024, day, 5))
    loads.load_status(lake, drops.status(), run_date=DAY)
    basic, status = lake.read("stock_basic"), lake.read("history_stock_status")
    for text in (plan(W.common_watermark(basic, ["a"], "market_code", "snapshot_date")), plan(views.stock_basic(basic, ["a"])),
                 plan(views.stock_status(status, ["a"], 20240101, 20240131))):
        assert "EqualTo(market_code,a)" in text
    assert "(month" in plan(views.stock_basic(basic, ["a"])).split("PartitionFilters")[1].split("]")[0]
    assert "Exchange" not in plan(views.stock_status(status, ["a"], ordered=False)).split("Window")[0].split("Sort")[0]


def test_rows_that_a_load_leaves_out_are_counted(spark, lake):
    drop = spark.createDataFrame([("a", "20240102"), (None, "20240102"), ("b", "junk")], "code string, trade_date string")
    got = loads.load_kline(lake, raw.normalize(drop, "kline_daily"), run_date=DAY)
    assert (got.row_count, got.reject_count) == (1, 2)
    assert rows(lake.read("sync_task_log"), "row_count", "reject_count") == [(1, 2)]


def test_the_log_can_be_rewritten(spark, lake):
    for i in range(3):
        loads.load_kline(lake, kline(spark, range(i + 1)), run_date=DAY, force=True)
    before = rows(lake.read("sync_task_log"))
    assert lake.compact("sync_task_log") == ["202402"] and lake.vacuum("sync_task_log")
    assert rows(lake.read("sync_task_log")) == before and len(lake.manifest("sync_task_log").entries()) == 1


def test_front_door_without_source_and_with_bad_arguments(spark, lake):
    market = MarketLake(lake)
    assert market.query_kline(["a"], 20240101, 20240131).count() == 0
    assert market.get_stock_basic(["a"]).count() == 0
    with pytest.raises(views.NoData):
        MarketLake(lake, require_rows=True).get_calendar()
    for call in (lambda: market.query_kline([], 20240101, 20240131), lambda: market.query_kline(["a"], 20240201, 20240131),
                 lambda: market.query_kline(["a"], 20240101, 20240131, "week"), lambda: market.get_calendar("json"),
                 lambda: market.get_code_info(" "), lambda: market.get_calendar("str", "")):
        with pytest.raises(ValueError):
            call()


def test_stock_basic_needs_every_code(spark, lake):
    drops = Drops(spark)
    loads.load_stock_basic(lake, drops.stock_basic(date(2024, 1, 2)), run_date=date(2024, 1, 2))
    loads.load_stock_basic(lake, drops.stock_basic(date(2024, 1, 3)).where("market_code = 'a'"), run_date=date(2024, 1, 3))
    market = MarketLake(lake)
    assert market.get_stock_basic(["a", "zz"]).count() == 0
    assert rows(market.get_stock_basic(["b", "a"]), "MARKET_CODE") == [("a",), ("b",)]
    common = W.common_watermark(lake.read("stock_basic"), ["a", "b"], "market_code", "snapshot_date")
    assert common.first()[0] == date(2024, 1, 2)


def test_load_ids_grow_even_if_the_clock_is_behind(spark, lake, monkeypatch):
    from ticklake.sources import lake as module

    loads.load_kline(lake, kline(spark, range(2), price=1.0), run_date=DAY)
    monkeypatch.setattr(module.time, "time_ns", lambda: 1000)
    loads.load_kline(lake, kline(spark, range(2), price=9.0), run_date=DAY, force=True, lookback_days=5)
    assert rows(lake.latest("kline_daily"), "open") == [(10.0,), (10.0,), (9.0,), (9.0,)]


def test_rows_of_one_key_spread_over_several_files(spark, lake):
    """All rejects of one load and reason share their key; range partitioning alone put them into one task."""
    bad = spark.range(4000).select(
        F.lit(date(2024, 1, 2)).alias("run_date"), F.lit("kline_daily").alias("target_table"), F.lit("t").alias("task_name"),
        F.lit("no code").alias("reason"), F.concat(F.lit('{"open": '), F.col("id").cast("string"), F.lit("}")).alias("row"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lake.append("rejected_rows", bad, 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = lake.read("rejected_rows")
    assert stored.select(F.input_file_name()).distinct().count() > 1
    assert rows(stored, "row") == rows(bad, "row")
