"""Late rows by digests, watermarks kept with the table, rejects and their quarantine, and what loads and reads touch."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from ticklake import schemas as S
from ticklake.operators import reconcile
from ticklake.plans import loads, views
from ticklake.plans.market import MarketLake
from ticklake.sources import lake as lake_module, raw, workspace
from test_lake import DAY, kline, stored

SPEC = S.TABLES["kline_daily"]


def bars(spark, data):
    """(code, day of 2024, open, arrival) as bars."""
    made = [(datetime(2024, 1, 1) + timedelta(days=d), c, o, a) for c, d, o, a in data]
    return raw.normalize(spark.createDataFrame(made, "trade_time timestamp_ntz, code string, open double, arrival int"), "kline_daily", keep=["arrival"])


class Jobs:
    """How many jobs Spark starts while the block runs, adaptive stages included."""

    def __init__(self, spark):
        self.spark, self.tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def __enter__(self):
        self.group = f"count-{id(self)}"
        self.spark.setJobGroup(self.group, "")
        return self

    def __exit__(self, *error):
        self.n = len(self.tracker.getJobIdsForGroup(self.group))
        self.spark.setJobGroup("", "")


# ----------------------------------------------------------------- late rows

def test_rows_older_than_the_watermark_are_found(spark, lake):
    first = [("a", 0, 1.0, 1), ("a", 5, 2.0, 1), ("b", 3, None, 1), ("b", 40, 4.0, 1)]
    late = [("a", 2, 9.0, 2), ("b", 3, 7.0, 2), ("c", 1, 5.0, 2), ("a", 5, 2.0, 2), ("a", 5, 2.0, 2)]
    loads.load_kline(lake, bars(spark, first), run_date=DAY, order="arrival")
    drop = bars(spark, first + late)
    assert loads.load_kline(lake, drop, run_date=DAY, force=True, order="arrival").row_count == 1  # the new code only
    got = loads.load_late_rows(lake, "kline_daily", drop, run_date=DAY, order="arrival")
    assert (got.status, got.row_count) == ("success", 2)
    assert rows(lake.latest("kline_daily"), "code", "open") == [("a", 1.0), ("a", 2.0), ("a", 9.0), ("b", 4.0), ("b", 7.0), ("c", 5.0)]
    again = loads.load_late_rows(lake, "kline_daily", drop, run_date=DAY, force=True, order="arrival")
    assert again.row_count == 0
    assert loads.load_late_rows(lake, "kline_daily", drop, run_date=DAY).status == "skipped"
    assert loads.load_late_rows(lake, "kline_daily", drop.limit(0), run_date=DAY, force=True).row_count == 0
    with pytest.raises(ValueError):
        loads.load_late_rows(lake, "trade_calendar", drop)


def test_many_late_days_are_found_without_copies_of_them(spark, lake, monkeypatch):
    """Cells that are too many to broadcast: the same rows, no join with salted copies, and no scratch table left."""
    first = [(c, d, float(d), 1) for c in "abcd" for d in range(20)] + [(None, 3, 1.0, 1)]
    drop = bars(spark, first + [("a", 2, 9.0, 2), ("b", 3, None, 2), ("b", 3, 7.0, 1), ("e", 1, -0.0, 2), ("e", 1, -0.0, 2), (None, 4, 2.0, 2)])
    lake.append("kline_daily", bars(spark, first).where("code <> 'd'"), 1)
    view = lake.latest("kline_daily")
    call = (drop, view, SPEC.key, SPEC.values, SPEC.group, SPEC.date_column, ["arrival"])
    want = rows(reconcile.missing_rows(*call))
    assert len(want) == 23
    monkeypatch.setattr(reconcile, "lookup_join", None)
    assert rows(reconcile.missing_rows(*call, max_broadcast_bytes=0)) == want
    monkeypatch.setattr(reconcile, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(loads, "discard", lambda df, true=loads.discard: gone.append(df.settled_at) or true(df))
    gone = []
    assert loads.load_late_rows(lake, "kline_daily", drop, run_date=DAY, order="arrival").row_count == 23
    assert len(gone) == 1 and not os.path.exists(gone[0].removeprefix("file:"))


def test_a_write_leaves_no_shuffle_files(spark, lake):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString(",").split(",") if "/shuffle_" in f}

    before = shuffled()
    lake.append("kline_daily", bars(spark, [(c, d, 1.0, 1) for c in "abc" for d in range(50)]), 1)
    kept = workspace.settle(lake.read("kline_daily").repartition(7))
    assert kept.count() == 150
    left = {f for f in shuffled() - before if f.endswith(".data")}
    assert sum(os.path.getsize(f) for f in left) < 1000  # the count's
    assert spark.conf.get(workspace.SHUFFLE_CLEANUP_CONF) == "false"


def test_late_rows_of_requested_codes_and_days(spark, lake):
    class Source:
        order = ["arrival"]

        def kline(self, period):
            return bars(spark, [(c, d, 1.0 + d, 1) for c in "abc" for d in range(40)])

    lake.append("kline_daily", bars(spark, [(c, 39, 0.0, 0) for c in "abc"]), 1)
    market = MarketLake(lake, Source())
    assert market.sync_kline(["a", "b"], 20240101, 20240209) == 0
    assert market.sync_late_kline(["a", "b"], 20240101, 20240110) == 20
    assert market.sync_late_kline(["a"], None, None) == 30
    assert lake.latest("kline_daily").where("code = 'c'").count() == 1


def test_states_of_days(spark):
    old = bars(spark, [("a", 0, 1.0, 1), ("a", 1, 1.0, 1), ("a", 2, None, 1), ("b", 0, 1.0, 1)]).select(*SPEC.columns)
    new = bars(spark, [("a", 0, 1.0, 1), ("a", 1, 2.0, 1), ("a", 2, 0.0, 1), ("c", 0, 1.0, 1)]).select(*SPEC.columns)
    got = reconcile.compare_days(new, old, SPEC.group, SPEC.date_column, SPEC.columns)
    assert [(c, s) for c, _, s in rows(got, "code", "day", "state")] == [("a", "same"), ("a", "changed"), ("a", "changed"), ("b", "gone"), ("c", "new")]


def test_digests_travel_and_bars_do_not(spark, lake):
    """Months of one load: neither side sends a row through a shuffle, only a cell per task."""
    lake.append("kline_daily", bars(spark, [(c, d, 1.0, 1) for c in "ab" for d in range(20)]), 1)
    view = reconcile.stored_view(lake.read("kline_daily"), SPEC.key, SPEC.values, lake.unique_months("kline_daily"))
    text = plan(reconcile.compare_days(view, view, SPEC.group, SPEC.date_column, SPEC.columns))
    exchanges = [x for x in text.split("\n\n") if "Exchange\n" in x and "Input" in x]
    assert exchanges and all("open" not in x and "amount" not in x for x in exchanges)


# ----------------------------------------------------------------- kept watermarks

def test_a_load_of_one_code_scans_no_bars(spark, lake, monkeypatch):
    for load in range(1, 4):
        lake.append("kline_daily", bars(spark, [(c, 31 * load + d, 1.0, 1) for c in "ab" for d in range(3)]), load)
    latest, size = lake.watermarks("kline_daily")
    assert all("marks=" in f for f in latest.inputFiles()) and size > 0
    assert rows(latest) == [(c, date(2024, 1, 1) + timedelta(days=95)) for c in "ab"]
    opened = []
    monkeypatch.setattr(lake_module.Lake, "_open", lambda self, table, entries, own=lake_module.Lake._open: (
        opened.extend((table, e.month) for e in entries), own(self, table, entries))[1])
    got = loads.load_kline(lake, bars(spark, [("a", d, 2.0, 1) for d in (95, 96)]), codes=["a"], run_date=DAY)
    assert got.row_count == 1 and {t for t, _ in opened if t != "sync_task_log"} == {"kline_daily"}
    assert {m for t, m in opened if t == "kline_daily"} == {"202404"}  # the rows just written, for their own marks


def test_marks_follow_appends_and_compaction(spark, lake, monkeypatch):
    monkeypatch.setattr(lake_module, "MARK_PARTS", 3)

    def check():
        scanned = lake.read("kline_daily").groupBy("code").agg(F.max("trade_time").cast("date"))
        assert rows(lake.watermarks("kline_daily")[0]) == rows(scanned)
        return len(lake.manifest("kline_daily").content()[1])

    assert lake.watermarks("kline_daily")[0].count() == 0
    parts = []
    for load in range(1, 6):
        lake.append("kline_daily", bars(spark, [("ab"[load % 2], 20 * load, 1.0, 1)]), load)
        parts.append(check())
    assert parts == [1, 2, 3, 1, 2]
    lake.compact("kline_daily")
    lake.vacuum("kline_daily")
    assert check() == 2
    folders = [n for n in os.listdir(lake.path("kline_daily")) if n.startswith("marks=")]
    assert len(folders) == 2


def test_marks_that_lag_are_made_anew(spark, lake):
    """A table written without marks, as by an older version or by a writer that skips them."""
    for load in (1, 2):
        lake.append("kline_daily", bars(spark, [("a", load, 1.0, 1)]), load)
    manifest = lake.manifest("kline_daily")
    entries, marks = manifest.content()
    manifest.switch([*entries, *marks[:1]])
    lake.append("kline_daily", bars(spark, [("b", 9, 1.0, 1)]), 3)
    assert len(manifest.content()[1]) == 1  # nothing is added to marks with a gap
    assert rows(lake.watermarks("kline_daily")[0]) == [("a", date(2024, 1, 3)), ("b", date(2024, 1, 10))]
    assert manifest.content()[1][0].load_id == 3
    with pytest.raises(ValueError):
        lake.watermarks("code_info")


# ----------------------------------------------------------------- rejects

def bad_drop(spark):
    data = [("a", "20240102", 1.0), (None, "20240102", 2.0), ("b", "junk", 3.0), (None, None, 4.0), ("b", "20240103", 5.0)]
    return raw.normalize(spark.createDataFrame(data, "code string, trade_date string, open double"), "kline_daily")


def test_rejects_of_a_request_with_codes(spark, lake):
    class Source:
        order = ()

        def kline(self, period):
            return bad_drop(spark)

    assert MarketLake(lake, Source()).sync_kline(["a"], 20240101, 20240131) == 1
    assert rows(lake.read("sync_task_log"), "row_count", "reject_count") == [(1, 3)]
    universe = spark.createDataFrame([("b",)], "code string")
    assert MarketLake(lake, Source()).sync_kline(universe, 20240101, 20240131) == 1
    assert {r[0] for r in rows(lake.read("sync_task_log"), "reject_count")} == {3}


def test_quarantine_keeps_rows_with_their_reason_and_reads_the_drop_once(spark, lake):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    drop = bad_drop(spark)
    got = loads.load_kline(lake, drop.mapInArrow(counted, drop.schema), codes=["a", "b"], run_date=DAY, quarantine=True)
    assert (got.row_count, got.reject_count, seen.value) == (2, 3, 5)
    kept = lake.read("rejected_rows").select("target_table", "reason", F.get_json_object("row", "$.open").cast("double").alias("open"))
    assert rows(kept) == [("kline_daily", "missing code", 2.0), ("kline_daily", "missing code, trade_time", 4.0), ("kline_daily", "missing trade_time", 3.0)]
    clean = loads.load_kline(lake, drop.where("code IS NOT NULL AND trade_time IS NOT NULL"), run_date=DAY, quarantine=True)
    assert clean.reject_count == 0 and lake.read("rejected_rows").count() == 3


# ----------------------------------------------------------------- what reads and loads touch

def test_a_read_of_one_day_opens_one_month_without_a_job(spark, lake):
    for load in (1, 2, 3):
        lake.append("kline_daily", bars(spark, [("a", 30 * m, 1.0, 1) for m in range(48)]), load)
    market = MarketLake(lake)
    with Jobs(spark) as jobs:
        got = market.query_kline(["a"], 20250301, 20250301, ordered=False)
    assert jobs.n == 0
    assert {f.split("month=")[1][:6] for f in got.inputFiles()} == {"202503"}
    assert len(lake.read("kline_daily").inputFiles()) > 48
    whole = views.kline(lake.read("kline_daily"), ["a"], 20250101, 20250630, ordered=False)
    assert rows(market.query_kline(["a"], 20250101, 20250630, ordered=False)) == rows(whole)


def test_jobs_of_a_load_and_of_a_skipped_one(spark, lake):
    loads.load_kline(lake, kline(spark, range(3)), run_date=DAY)
    with Jobs(spark) as second:
        loads.load_kline(lake, kline(spark, range(5)), run_date=DAY + timedelta(days=1))
    with Jobs(spark) as skipped:
        loads.load_kline(lake, kline(spark, range(5)), run_date=DAY + timedelta(days=1))
    with Jobs(spark) as again:
        loads.load_kline(lake, kline(spark, range(5)), run_date=DAY + timedelta(days=1))
    assert again.n == 1 and skipped.n <= 2 and second.n <= 12, (second.n, skipped.n, again.n)
    assert lake.read("sync_task_log").where("status = 'skipped'").count() == 1
    assert len(stored(lake)) == 10
