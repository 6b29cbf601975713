from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import plan, rows
from ticklake import schemas as S
from ticklake.operators import bars as B, lookup, matrix, quality, ranges, watermarks as W
from ticklake.operators.dedup import latest_per_key, new_keys, union_latest
from ticklake.plans import views
from ticklake.sources import raw

D = date


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ----------------------------------------------------------------- dedup

def test_later_row_wins_as_a_whole_even_with_null(spark):
    df = frame(spark, [("a", 1.0, 10.0, 1), ("a", None, 11.0, 2), ("b", 3.0, None, 1)],
               "k string, x double, y double, ingest_seq long")
    assert rows(latest_per_key(df, ["k"], ["x", "y"])) == rows(frame(spark, [("a", None, 11.0), ("b", 3.0, None)], "k string, x double, y double"))


def test_both_dedup_plans_agree_and_combine_before_the_shuffle(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 700).cast("string")).alias("k"),
        (F.col("id") * 1.5).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).cast("double").alias("y"),
        F.col("id").alias("ingest_seq"),
    )
    fixed = latest_per_key(df, ["k"], ["x", "y"])
    text = latest_per_key(df.withColumn("x", F.col("x").cast("string")), ["k"], ["x", "y"])
    assert rows(fixed.withColumn("x", F.col("x").cast("string"))) == rows(text)
    assert "partial_max_by" in plan(fixed) and "SortAggregate" not in plan(fixed)
    assert plan(text).count("WindowGroupLimit") >= 2


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 9).map(float))), min_size=1, max_size=40))
def test_dedup_against_brute_force(spark, data):
    df = frame(spark, [(k, v, i) for i, (k, v) in enumerate(data)], "k int, v double, ingest_seq long")
    want = {k: v for k, v in data}
    assert dict(rows(latest_per_key(df, ["k"], ["v"]))) == want


def test_union_and_new_keys(spark):
    kind = "k string, v int, ingest_seq long"
    old, new = frame(spark, [("a", 1, 1), ("b", 1, 1)], kind), frame(spark, [("b", 2, 2), ("c", 2, 2)], kind)
    assert rows(union_latest(old, new, ["k"], ["v"])) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(new_keys(new.union(new), old.union(old), ["k"])) == [("c",)]


# ----------------------------------------------------------------- lookups

@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join_on_a_hot_code(spark, how):
    big = spark.range(0, 3000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("code"),
        F.lit(7).alias("copy"),
    )
    small = frame(spark, [("hot", 1), ("4", 2), ("zz", 3)], "code string, pos int")
    joined = [lookup.lookup_join(big, small, ["code"], how, max_broadcast_bytes=n) for n in (1 << 20, 0)]
    assert "__salt" in plan(joined[1]) and "__salt" not in plan(joined[0])
    assert "BroadcastHashJoin" in plan(joined[0])
    assert rows(joined[0]) == rows(joined[1])
    assert joined[0].columns == joined[1].columns


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_copies_of_a_small_file_are_shuffled_not_broadcast(spark, tmp_path, how):
    """A lookup past the byte limit is small on disk: Spark must not broadcast its salted copies."""
    spark.range(2000).select(F.col("id").cast("string").alias("code")).write.parquet(str(tmp_path / "codes"))
    codes = spark.read.parquet(str(tmp_path / "codes"))
    big = spark.range(0, 3000, numPartitions=8).select((F.col("id") % 2500).cast("string").alias("code"))
    salted = lookup.lookup_join(big, codes, ["code"], how, size=1 << 40)
    assert "__salt" in plan(salted) and "BroadcastExchange" not in plan(salted)
    assert rows(salted) == rows(big.join(codes, ["code"], how))


def test_salt_spreads_copies_of_one_row(spark):
    copies = spark.range(0, 6400, numPartitions=64).select(F.lit("hot").alias("code"))
    salt = copies.select(F.pmod(F.spark_partition_id(), F.lit(lookup.SALTS)).alias("s")).groupBy("s").count()
    counts = [r["count"] for r in salt.collect()]
    assert len(counts) == lookup.SALTS and max(counts) == min(counts)


def test_long_code_list_becomes_a_join(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("code"))
    short, long = [str(i) for i in range(100)], [str(i) for i in range(1500)]
    assert lookup.only_codes(df, short).count() == 100 and "Join" not in plan(lookup.only_codes(df, short))
    assert lookup.only_codes(df, long + long).count() == 1500 and "LeftSemi" in plan(lookup.only_codes(df, long))
    assert lookup.only_codes(df, None).count() == 2000


def test_distinct_in_order(spark):
    df = frame(spark, [(" b", 0), ("a", 1), (" ", 2), ("b", 3)], "code string, pos int")
    assert rows(lookup.distinct_in_order(df)) == [("a", 1), ("b", 0)]


# ----------------------------------------------------------------- ranges

def bars(spark, *items):
    return frame(spark, [(t, c, o, o + 1, o - 1, o, 1.0, o, s) for t, c, o, s in items],
                 "trade_time timestamp_ntz, code string, open double, high double, low double, close double, "
                 "volume double, amount double, ingest_seq long")


def test_dates_and_times_of_day_are_inclusive(spark):
    at = lambda h, m: datetime(2024, 1, 5, h, m)
    df = bars(spark, (at(9, 29), "a", 1.0, 1), (at(9, 30), "a", 2.0, 1), (at(11, 30), "a", 3.0, 1), (at(11, 31), "a", 4.0, 1))
    assert [r["open"] for r in views.kline(df, ["a"], 20240105, "2024-01-05", 930, 1130).collect()] == [2.0, 3.0]
    exact = datetime(2024, 1, 5, 11, 30, 0, 999)
    late = datetime(2024, 1, 5, 11, 30, 0, 1000)
    ticks = bars(spark, (datetime(2024, 1, 5, 9, 30), "a", 1.0, 1), (exact, "a", 2.0, 1), (late, "a", 3.0, 1))
    assert ranges.snapshot_time_of_day(ticks, 93000000, 113000000).count() == 2
    midnight_next = bars(spark, (datetime(2024, 1, 5, 23, 59), "a", 1.0, 1), (datetime(2024, 1, 6), "a", 2.0, 1))
    assert ranges.date_range(midnight_next, "trade_time", 20240105, 20240105).count() == 1
    assert ranges.date_range(midnight_next, "trade_time").count() == 2


def test_range_reaches_the_scan(spark, lake):
    lake.append("kline_daily", bars(spark, (datetime(2024, 1, 5), "a", 1.0, 1), (datetime(2024, 2, 5), "b", 1.0, 1)))
    text = plan(views.kline(lake.read("kline_daily"), ["a"], 20240101, 20240131, ordered=False))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert all(f in pushed for f in ("GreaterThanOrEqual(trade_time", "LessThan(trade_time", "EqualTo(code,a)"))
    assert "PartitionFilters: [isnotnull(month" in text
    only = plan(views.kline(lake.read("kline_daily"), ["a"], 20240101, 20240131, ordered=False).select("code", "close"))
    assert "ReadSchema: struct<trade_time:timestamp_ntz,code:string,close:double,ingest_seq:bigint>" in only


def test_snapshot_layouts(spark, lake):
    for kind, fields in S.SNAPSHOT_LAYOUTS.items():
        got = views.snapshot(lake.read("market_snapshot"), ["a"], 20240101, 20240131, kind=kind)
        assert got.columns == fields
    assert len(S.TABLES["market_snapshot"].columns) == 55
    assert set().union(*S.SNAPSHOT_LAYOUTS.values()) == set(S.TABLES["market_snapshot"].columns)


# ----------------------------------------------------------------- watermarks

def test_watermarks(spark):
    df = frame(spark, [("a", D(2024, 1, 5)), ("a", D(2024, 1, 3)), ("c", D(1985, 6, 1))], "code string, trade_date date")
    latest = W.latest_date_map(df, ["a", "b", "c"], date_column="trade_date")
    assert rows(latest) == [("a", D(2024, 1, 5)), ("b", None), ("c", None)]
    assert W.common_watermark(df, ["a", "b"]).first()[0] is None
    assert W.common_watermark(df, ["a", "a", " a"]).first()[0] == D(2024, 1, 5)
    # the common form takes old dates as they are
    assert W.common_watermark(df, ["a", "c"]).first()[0] == D(1985, 6, 1)
    assert W.common_watermark(df, []).first()[0] is None
    empty = df.limit(0)
    assert W.latest_date(empty).first()[0] is None
    assert W.latest_or_today(empty).first()[0] is not None


def test_incremental_select(spark):
    stored = frame(spark, [("a", D(2024, 1, 5)), ("old", D(1985, 1, 1))], "code string, trade_date date")
    incoming = frame(spark, [(c, D(2024, 1, d)) for c in ("a", "b", "old") for d in range(1, 10)], "code string, trade_date date")
    got = W.incremental_select(incoming, stored, ["code"], "trade_date", 20240103, 20240108)
    assert rows(got) == [("a", D(2024, 1, d)) for d in (6, 7, 8)] + [(c, D(2024, 1, d)) for c in ("b", "old") for d in range(3, 9)]
    again = W.incremental_select(incoming, stored, ["code"], "trade_date", 20240103, 20240108, lookback_days=2)
    assert [d for c, d in rows(again) if c == "a"] == [D(2024, 1, d) for d in (4, 5, 6, 7, 8)]


@pytest.mark.parametrize("since", [None, D(2023, 1, 1), D(2024, 2, 1), D(2030, 1, 1)])
def test_recent_first_scan_gives_the_same_watermarks(spark, since):
    days = [("a", D(2023, 5, 1)), ("a", D(2024, 3, 1)), ("b", D(2023, 6, 1)), ("c", D(2024, 2, 2))]
    stored = frame(spark, [(c, d, f"{d:%Y%m}") for c, d in days], "code string, trade_date date, month string")
    wanted = frame(spark, [("a",), ("b",), ("c",), ("new",), ("a",)], "code string")
    got = W.group_watermarks(stored, wanted, ["code"], "trade_date", since)
    assert rows(got) == [("a", D(2024, 3, 1)), ("b", D(2023, 6, 1)), ("c", D(2024, 2, 2))]


def log_frame(spark, *items):
    t0 = datetime(2024, 1, 1)
    return frame(
        spark,
        [("t", "s", D(2024, 1, 2), status, "kline_daily", first, last, n, 0, None, t0 + timedelta(hours=i), t0 + timedelta(hours=i))
         for i, (status, first, last, n) in enumerate(items)],
        S.TABLES["sync_task_log"].schema,
    )


def test_skipped_after_success_changes_nothing(spark):
    log = log_frame(spark, ("success", D(2024, 1, 1), D(2024, 1, 2), 5), ("skipped", None, None, 0))
    assert W.succeeded_on(log).first()["succeeded"] is True
    assert W.latest_checkpoint(log).first()["checkpoint_date"] == D(2024, 1, 2)
    assert {r["status"]: r["checkpoint_date"] for r in W.checkpoint_from_log(log).collect()} == {
        "success": D(2024, 1, 2), "skipped": None}


def test_checkpoint_passes_over_null_dates_and_falls_back_to_the_start(spark):
    log = log_frame(spark, ("success", D(2024, 1, 1), None, 5), ("success", None, None, 0), ("failed", None, D(2025, 1, 1), 0))
    assert W.latest_checkpoint(log).first()["checkpoint_date"] == D(2024, 1, 1)
    assert W.succeeded_on(log_frame(spark, ("success", None, None, 0))).first()["rows_loaded"] == 0


# ----------------------------------------------------------------- matrix

def test_matrix_and_back(spark):
    long = frame(spark, [(D(2024, 1, 1), "b", 1.0, 1), (D(2024, 1, 1), "b", 2.0, 2), (D(2024, 1, 2), "a", 3.0, 1)],
                 "trade_date date, code string, factor_value double, ingest_seq long")
    wide = matrix.factor_matrix(long, ["b", "zz", "a", "b"])
    assert wide.columns == ["trade_date", "b", "a"]
    assert [tuple(r) for r in wide.collect()] == [(D(2024, 1, 1), 2.0, None), (D(2024, 1, 2), None, 3.0)]
    back = matrix.factor_unpivot(wide)
    assert rows(back) == [(D(2024, 1, 1), "b", 2.0), (D(2024, 1, 2), "a", 3.0)]
    assert matrix.factor_matrix(long, ["zz"]).columns == ["trade_date"]


def test_dotted_codes_in_a_wide_drop(spark):
    wide = frame(spark, [("20240101", "1.5", "NaN"), ("2024-01-02", " ", "2")], "trade_date string, `600000.SH` string, `000001.SZ` string")
    got = raw.factors(wide, "adj")
    assert rows(got) == [("adj", D(2024, 1, 1), "600000.SH", 1.5), ("adj", D(2024, 1, 2), "000001.SZ", 2.0)]
    with pytest.raises(ValueError):
        raw.factors(wide, "other")


# ----------------------------------------------------------------- bars

def test_resample(spark):
    df = bars(spark, *[(datetime(2024, 1, 5, 9, 30 + i), "a", float(i), 1) for i in range(10)])
    got = B.kline_resample(df, "min5").orderBy("trade_time").collect()
    assert [(r["trade_time"].minute, r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in got] == [
        (30, 0.0, 5.0, -1.0, 4.0, 5.0), (35, 5.0, 10.0, 4.0, 9.0, 5.0)]
    starts = {p: B.kline_resample(df, p).first()["trade_time"] for p in ("day", "week", "month", "season", "year")}
    assert starts == {"day": datetime(2024, 1, 5), "week": datetime(2024, 1, 1), "month": datetime(2024, 1, 1),
                      "season": datetime(2024, 1, 1), "year": datetime(2024, 1, 1)}
    with pytest.raises(ValueError):
        B.kline_resample(df, "min7")


def test_reject_counts_and_stats(spark):
    df = frame(spark, [("a", D(2024, 1, 1)), (None, D(2024, 1, 2)), (None, None)], "code string, d date")
    assert tuple(quality.reject_counts(df, ["code", "d"]).first()) == (2, 1, 2, 1)
    previous = frame(spark, [(D(2025, 1, 1),)], "latest_date date")
    assert tuple(quality.load_stats(df, "d", previous).first()) == (3, D(2024, 1, 1), D(2025, 1, 1))
    assert tuple(quality.load_stats(df.limit(0), "d").first()) == (0, None, None)
