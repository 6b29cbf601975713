import uuid
from datetime import datetime

import pytest

from conftest import plan, rows
from ticklake.operators.ranges import date_range
from ticklake.operators.dedup import latest_per_key
from ticklake.plans import views
from ticklake.sources.buckets import BucketedTable

SCHEMA = "code string, trade_time timestamp_ntz, open double, high double, low double, close double, volume double, amount double, ingest_seq bigint"
KEY = ["code", "trade_time"]


def bar(code, day, month, value, seq):
    return (code, day and datetime(2024, month, day, 15), value, value, value, value, value, None, seq)


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    own = BucketedTable(spark, f"bars_{uuid.uuid4().hex}", str(tmp_path / "bars"), schema, KEY, "trade_time", 4)
    yield own
    own.drop()


def load(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def test_last_write_of_three_loads_without_a_shuffle(spark, table):
    first = [bar(f"{c}", d, m, float(c + d), 1) for c in range(6) for d in range(1, 6) for m in (1, 2)]
    second = [bar("1", 2, 1, None, 2), bar("2", 3, 2, 7.5, 2), bar("9", 1, 1, 1.0, 2), bar(None, 4, 1, 4.0, 2), bar("3", None, 1, 3.0, 2)]
    third = [bar("2", 3, 2, 8.5, 3), bar("2", 3, 2, 8.5, 3), bar(None, 4, 1, 5.0, 4)] + [bar("5", 5, 1, float(i), 10 + i) for i in range(50)]
    for data in (first, second, third):
        table.append(load(spark, data))
    want = {}
    for r in sorted(first + second + third, key=lambda r: r[-1]):
        want[r[:2]] = r[:-1]
    got = table.latest()
    assert rows(got) == sorted(want.values(), key=repr)
    assert "Exchange" not in plan(got) and "SelectedBucketsCount: 4 out of 4" in plan(got)
    # the copies of a key collapsed before they were written
    assert table.rows().where("code = '5' AND day(trade_time) = 5 AND month = '202401'").count() == 2
    february = views.kline(table.rows(), ["2", "3"], "2024-02-01", "2024-02-28", ordered=False)
    assert rows(february, *KEY, "close") == sorted(((k[0], k[1], v[5]) for k, v in want.items() if k[0] in ("2", "3") and k[1] and k[1].month == 2), key=repr)
    assert "Exchange" not in plan(february) and "PartitionFilters: [isnotnull(month" in plan(february)
    # the same rows unbucketed do need one
    flat = latest_per_key(date_range(load(spark, first + second + third), "trade_time"), KEY, ["close"])
    assert "Exchange" in plan(flat)


def test_a_single_key(spark, table):
    table.append(load(spark, [bar(f"{c}", d, 1, 1.0, 1) for c in range(5) for d in range(1, 20)]))
    point = table.rows().where("code = '3' AND trade_time = TIMESTAMP_NTZ'2024-01-07 15:00:00'")
    assert point.count() == 1


def test_empty_loads_and_clashing_columns(spark, table):
    assert table.latest().count() == 0
    table.append(load(spark, []))
    assert table.latest(["code", "trade_time", "close"]).columns == ["code", "trade_time", "close"]
    from pyspark.sql import functions as F

    table.append(load(spark, [bar("1", 1, 1, 2.0, 1)]).withColumns({c: F.lit("x") for c in ("month", "bucket", "__rank")}))
    assert rows(table.rows(), "code", "close", "month") == [("1", 2.0, "202401")]
