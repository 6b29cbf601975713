"""The data source of per-code drops and feeds."""

import os
import pickle
import re
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan, rows
from ticklake import schemas as S
from ticklake.sources import drops, raw
from ticklake.sources.workspace import scratch_path
from ticklake.streaming.ticks import run_stream_bars

CODES = ["600000.SH", "000001.SZ", "a b/c%", "空"]


def minute_bars(spark, codes=CODES, n=30):
    made = [(c, datetime(2024, 1, 2, 9, 30) + timedelta(minutes=i), float(i), None if i % 7 == 0 else 1.5 * i) for c in codes for i in range(n)]
    return raw.normalize(spark.createDataFrame(made, "code string, trade_time timestamp_ntz, open double, close double"), "kline_minute")


@pytest.fixture(scope="module")
def drop(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("drop") / "d")
    drops.write_drop(minute_bars(spark), "kline_minute", path)
    return path


def test_a_drop_comes_back_whole(spark, drop):
    for task_bytes in (1, 1 << 20):
        got = drops.read_drop(spark, drop, task_bytes=task_bytes)
        assert rows(got) == rows(minute_bars(spark).select(*got.columns)) and got.schema.names == S.TABLES["kline_minute"].schema.names
    assert rows(drops.read_drop(spark, "file://" + drop)) == rows(minute_bars(spark))
    assert rows(drops.read_drop(spark, drop).select("close", "code").where("open = 3")) == rows(minute_bars(spark).where("open = 3"), "close", "code")


def test_filters_are_taken_by_the_reader(spark, drop):
    asked = drops.read_drop(spark, drop).where(F.col("code").isin("600000.SH", "空", "none")).where("trade_time >= timestamp_ntz'2024-01-02 09:40:00' AND open < 15")
    want = minute_bars(spark).where(F.col("code").isin("600000.SH", "空")).where("open >= 10 AND open < 15")
    assert rows(asked) == rows(want)
    text = plan(asked)
    assert "PushedFilters" in text or "Filter" not in text.split("BatchScan")[0]
    one = drops.read_drop(spark, drop).where("code = '000001.SZ'")
    assert one.count() == 30 and one.rdd.getNumPartitions() == 1
    assert drops.read_drop(spark, drop).where("code = 'none'").count() == 0
    # what the reader does not know is left to Spark
    assert drops.read_drop(spark, drop).where("close IS NULL AND code LIKE '6%'").count() == 5


def test_each_file_is_read_by_one_task(spark, drop):
    listed = drops._listed(drop, None)
    assert {c for c, _, _ in listed} == set(CODES)
    for task_bytes in (1, 2000, 1 << 30):
        files = [f for t in drops._tasks(listed, task_bytes) for f in t.files]
        assert files == [(c, f) for c, f, _ in listed]
    assert len(drops._tasks(listed, 1 << 30)) == 1 and len(drops._tasks(listed, 1)) == len(listed)
    assert drops.read_drop(spark, drop + "-none").count() == 0


def test_a_drop_is_what_spark_reads_too(spark, tmp_path):
    """A file per code and task, whole or not there; rows without a code; a code with several row groups; no second drop in its place."""
    path, n = str(tmp_path / "d"), drops.ROW_GROUP + 100
    hot = spark.range(n).selectExpr("'hot' AS code", "timestamp_ntz'2024-01-02 09:30:00' + make_dt_interval(0, 0, 0, id / 1000) AS trade_time", "double(id) AS open")
    odd = spark.createDataFrame([(None, datetime(2024, 1, 2), 1.0), ("", datetime(2024, 1, 2), 2.0), ("a b/c%", datetime(2024, 1, 3), None)], "code string, trade_time timestamp_ntz, open double")
    given = hot.unionByName(odd)
    drops.write_drop(given.selectExpr("*", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in S.TABLES["kline_minute"].schema if f.name not in given.columns]), "kline_minute", path)
    names = [os.path.join(d, f) for d, _, files in os.walk(path) for f in files if not f.endswith(".crc")]
    assert all(re.search(r"/code=[^/]+/part-\d{5}\.parquet$", f) for f in names if not f.endswith("/_SUCCESS"))
    got = drops.read_drop(spark, path)
    plain = spark.read.schema(got.schema).parquet(path)
    assert got.count() == n + 3 and got.where("code = 'hot'").selectExpr("sum(open)").first()[0] == n * (n - 1) / 2
    assert rows(got.where("code <> 'hot'"), "code", "open") == [("__HIVE_DEFAULT_PARTITION__", 1.0), ("__HIVE_DEFAULT_PARTITION__", 2.0), ("a b/c%", None)]
    assert got.where("code = ''").count() == 0
    assert plain.count() == n + 3 and rows(plain.where("code IS NULL"), "open") == [(1.0,), (2.0,)]
    with pytest.raises(AnalysisException):
        drops.write_drop(minute_bars(spark), "kline_minute", path)


def test_a_feed_reads_the_asked_columns_only(spark, drop):
    """Files of a few rows come in one batch, and a task's paths are small for the driver to keep."""
    schema = StructType([S.TABLES["kline_minute"].schema[c] for c in ("close", "code")])
    reader = drops.DropSource({"path": drop}).streamReader(schema)
    files = drops._tasks(drops._listed(drop, None), 1 << 30)
    batches = list(reader.read(files[0]))
    assert [b.schema.names for b in batches] == [["close", "code"]] and batches[0].num_rows == 30 * len(CODES)
    many = drops.Files([(f"{i:06d}.SH", f"/feed/load=1/code={i:06d}.SH/part-00000.parquet") for i in range(1000)])
    assert len(pickle.dumps(many)) < 10_000 and pickle.loads(pickle.dumps(many)) == many


def test_a_feed_goes_on_where_it_stopped(spark, tmp_path):
    """Loads that are not complete wait, with all after them; a load is read once."""
    feed, out, state = str(tmp_path / "feed"), str(tmp_path / "out"), scratch_path(spark, "stream-state")
    tick = lambda d, h: raw.normalize(spark.createDataFrame([("a", datetime(2024, 1, d, h), 1.0 + h, 2.0)], "code string, trade_time timestamp_ntz, last double, volume double"), "market_snapshot")

    def work_off():
        stream = drops.stream_feed(spark, feed, "market_snapshot").select("code", "trade_time", "last", "volume", "amount")
        return [r[0] for r in run_stream_bars(stream, out, state, available_now=False).orderBy("trade_time").select("close").collect()]

    assert work_off() == []
    drops.write_drop(tick(2, 9), "market_snapshot", f"{feed}/load=1")
    drops.write_drop(tick(2, 10), "market_snapshot", f"{feed}/load=2")
    assert work_off() == [10.0]
    drops.write_drop(tick(2, 11), "market_snapshot", f"{feed}/load=4")
    drops.write_drop(tick(2, 12), "market_snapshot", f"{feed}/load=5")
    os.rename(f"{feed}/load=4/_SUCCESS", f"{feed}/load=4/waiting")
    assert work_off() == [10.0]
    os.rename(f"{feed}/load=4/waiting", f"{feed}/load=4/_SUCCESS")
    assert work_off() == [10.0, 11.0, 12.0]
