"""Every operator as a query over the sample tables: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators import bars as B, matrix, membership, quality, ranges, reconcile, watermarks as W
from ticklake.operators.dedup import latest_per_key, union_latest
from ticklake.operators.lookup import distinct_in_order, only_codes, with_position
from ticklake.plans import loads, views
from ticklake.plans.market import MarketLake
from ticklake.sources import drops, raw, sample_tables as T
from ticklake.sources.buckets import BucketedTable
from ticklake.sources.lake import Lake
from ticklake.sources.workspace import scratch_path, settle
from ticklake.streaming.ticks import run_stream_bars, stream_into_lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BEGIN, END = "1996-01-01", "2000-12-31"
SPLIT = "1998-06-30"
TICK_BEGIN, TICK_END = "2024-01-02", "2024-01-29"
BAR_KEY = ["code", "trade_time"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"))


# ----------------------------------------------------------------- range reads

@query
def kline_daily_range(spark, sf):
    return views.kline(T.daily_bars(spark, sf), T.part_codes(spark, sf), BEGIN, END, ordered=False)


@query
def kline_bucketed_range(spark, sf):
    """Bars of three loads into a bucketed table, the last write of each key: without a shuffle."""
    bars = T.daily_bars(spark, sf).select(*S.KLINE_FIELDS, S.INGEST_SEQ)
    path = scratch_path(spark, "buckets")
    table = BucketedTable(spark, f"bars_{path.rsplit('/', 1)[1]}", path, bars.schema, BAR_KEY, "trade_time", 4)
    for load in range(3):
        table.append(bars.where(F.pmod(S.INGEST_SEQ, F.lit(3)) == load))
    return views.kline(table.rows(), None, BEGIN, END, ordered=False)


@query
def kline_daily_ordered(spark, sf):
    return views.kline(T.daily_bars(spark, sf), T.part_codes(spark, sf), BEGIN, END, ordered=True)


@query
def kline_minute_range(spark, sf):
    return views.kline(
        T.minute_bars(spark, sf), T.user_codes(spark, sf), TICK_BEGIN, TICK_END, 930, 1500, ordered=False
    )


@query
def kline_time_of_day(spark, sf):
    return ranges.bar_time_of_day(T.minute_bars(spark, sf), 930, 1130).select(*S.KLINE_FIELDS, "ingest_seq")


@query
def snapshot_range(spark, sf):
    return views.snapshot(
        T.ticks(spark, sf), T.user_codes(spark, sf), TICK_BEGIN, TICK_END, 93000000, 150000000, ordered=False
    )


@query
def snapshot_time_of_day(spark, sf):
    kept = ranges.snapshot_time_of_day(T.ticks(spark, sf), 93000000, 113000000)
    return kept.select("code", "trade_time", "last", N.time_hhmmssmmm("trade_time").cast("bigint").alias("at"))


def _layout(kind: str) -> Query:
    return lambda spark, sf: views.snapshot(
        T.ticks(spark, sf), None, TICK_BEGIN, TICK_END, kind=kind, ordered=False
    )


for _kind in T.SNAPSHOT_KINDS:
    QUERIES[f"{_kind.replace('snapshot', 'snapshot_layout', 1)}"] = _layout(_kind)


@query
def price_factor_long(spark, sf):
    rows = T.factors(spark, sf)
    adj, back = (views.factors(rows, t).withColumn("factor_type", F.lit(t)) for t in S.FACTOR_TYPES)
    return adj.unionByName(back)


@query
def factor_matrix(spark, sf):
    return views.factor_matrix(T.line_factors(spark, sf), "adj", ["7", "3", "1", "2", "4", "5", "6", "9"])


@query
def factor_unpivot(spark, sf):
    wide = views.factor_matrix(T.line_factors(spark, sf), "adj", [str(i) for i in range(1, 8)])
    return matrix.factor_unpivot(wide)


@query
def stock_basic_asof(spark, sf):
    return views.stock_basic(T.stock_basic(spark, sf), T.customer_codes(spark, sf))


@query
def history_stock_status(spark, sf):
    return views.stock_status(T.status(spark, sf), T.customer_codes(spark, sf), BEGIN, None)


@query
def request_order(spark, sf):
    """Codes of the request that have status rows, with their position."""
    latest = W.latest_by_group(T.status(spark, sf), ["market_code"], "trade_date")
    return with_position(latest, T.customer_codes(spark, sf), "market_code").orderBy("pos")


# ----------------------------------------------------------------- calendar, codes, universe

@query
def trade_calendar(spark, sf):
    return views.calendar(T.calendar(spark, sf), "SH")


@query
def trade_calendar_datetime(spark, sf):
    return views.calendar(T.calendar(spark, sf), "SZ", "datetime")


@query
def latest_calendar_date(spark, sf):
    return W.latest_by_group(T.calendar(spark, sf), ["market"], "trade_date")


@query
def latest_membership_date(spark, sf):
    return W.latest_by_group(T.membership(spark, sf), ["security_type"], "trade_date")


@query
def latest_trade_date(spark, sf):
    return W.latest_or_today(T.calendar(spark, sf))


@query
def hist_code_list(spark, sf):
    return views.hist_codes(T.membership(spark, sf), "1-URGENT", BEGIN, END)


@query
def membership_daily(spark, sf):
    days = raw.trading_days(T.calendar(spark, sf).where("market = 'SH'"), BEGIN, END)
    return raw.membership_daily(T.membership_intervals(spark, sf), days)


@query
def code_info_latest(spark, sf):
    spec = S.TABLES["code_info"]
    kept = T.code_info(spark, sf).where(N.keep_code("code", "security_type"))
    return latest_per_key(kept, spec.key, spec.values).select(*spec.columns)


@query
def code_info_view(spark, sf):
    return views.code_info(T.code_info(spark, sf), "EXTRA_STOCK_A")


@query
def security_universe(spark, sf):
    return views.universe(T.code_info(spark, sf), "EXTRA_STOCK_A")


@query
def code_universe_filter(spark, sf):
    return T.code_info(spark, sf).select(
        "security_type", "code", N.keep_code("code", "security_type").alias("keep")
    )


@query
def universe_sample(spark, sf):
    return views.universe_sample(T.code_info(spark, sf), 100)


@query
def codes_in_request_order(spark, sf):
    requested = T.table(spark, sf, "events").select(
        F.concat(F.lit(" "), T.user_code()).alias("code"), F.col("event_id").alias("pos")
    )
    return distinct_in_order(requested)


@query
def normalize_codes(spark, sf):
    words = F.split(F.concat("p_name", F.lit(" ,, "), "p_type", F.lit(" , "), "p_name"), ",")
    return T.table(spark, sf, "part").select("p_partkey", F.concat_ws("|", N.normalize_codes(words)).alias("codes"))


@query
def codes_available(spark, sf):
    """Requested codes that have bars."""
    return only_codes(T.part_codes(spark, sf), T.daily_bars(spark, sf).select("code")).distinct()


@query
def status_labels(spark, sf):
    flags = T.code_info(spark, sf).select(
        "ingest_seq", F.explode(N.status_flags("security_status_raw")).alias("flag")
    )
    return flags.select("ingest_seq", "flag", N.label("flag", S.SECURITY_STATUS_LABELS).alias("label"))


@query
def listed_labels(spark, sf):
    return T.stock_basic(spark, sf).select(
        "snapshot_date", "market_code", "is_listed", N.label("is_listed", S.LISTED_LABELS).alias("label"),
        N.label("is_listed", S.STATEMENT_TYPE_LABELS).alias("statement"),
        N.label("is_listed", S.DIVIDEND_PROGRESS_LABELS).alias("dividend"), "ingest_seq",
    )


# ----------------------------------------------------------------- watermarks

@query
def latest_date_map(spark, sf):
    """Parts asked of the customers' status rows, so some codes have no history."""
    codes = T.part_codes(spark, sf).withColumnRenamed("code", "market_code")
    return W.latest_date_map(T.status(spark, sf), codes, "market_code", "trade_date")


@query
def incremental_start(spark, sf):
    codes = T.part_codes(spark, sf).withColumnRenamed("code", "market_code")
    latest = W.latest_date_map(T.status(spark, sf), codes, "market_code", "trade_date")
    begin = F.lit("2001-06-01").cast("date")
    return latest.select(
        "market_code", N.incremental_start("latest_date", begin).alias("start_date"),
        N.incremental_start("latest_date", None).alias("open_start"),
        N.incremental_start("latest_date", begin, lookback_days=3).alias("lookback_start"),
    )


def _other_codes(rows: DataFrame, column: str) -> DataFrame:
    """A request that is not the table's own codes: those with a 7 in them."""
    return rows.select(F.col(column).alias("code")).where("code LIKE '%7%'").distinct()


@query
def common_watermark_kline(spark, sf):
    return W.common_watermark(T.daily_bars(spark, sf), _other_codes(T.daily_bars(spark, sf), "code"), date_column="trade_time")


@query
def common_watermark_minute(spark, sf):
    return W.common_watermark(T.minute_bars(spark, sf), T.user_codes(spark, sf), date_column="trade_time")


@query
def common_watermark_snapshot(spark, sf):
    return W.common_watermark(T.ticks(spark, sf), T.user_codes(spark, sf), date_column="trade_time")


@query
def common_watermark_factor(spark, sf):
    rows = T.factors(spark, sf).where("factor_type = 'backward'")
    return W.common_watermark(rows, _other_codes(rows, "code"))


@query
def common_watermark_stock_basic(spark, sf):
    return W.common_watermark(
        T.stock_basic(spark, sf), T.customer_codes(spark, sf), "market_code", "snapshot_date"
    )


@query
def common_watermark_status(spark, sf):
    rows = T.status(spark, sf)
    return W.common_watermark(rows, _other_codes(rows, "market_code"), "market_code")


@query
def common_watermark_missing(spark, sf):
    codes = T.part_codes(spark, sf).withColumnRenamed("code", "market_code")
    return W.common_watermark(T.status(spark, sf), codes, "market_code")


@query
def incremental_select(spark, sf):
    """Per-code watermark taken from the shipped lines, applied to all lines."""
    rows = T.daily_bars(spark, sf)
    stored = rows.where("l_linestatus = 'F'")
    return W.incremental_select(rows, stored, ["code"], "trade_time", BEGIN, END).select(
        "code", "trade_time", "close", "volume", "ingest_seq"
    )


@query
def incremental_lookback(spark, sf):
    rows = T.daily_bars(spark, sf)
    stored = rows.where("l_linestatus = 'F'")
    return W.incremental_select(rows, stored, ["code"], "trade_time", BEGIN, END, lookback_days=30).select(
        "code", "trade_time", "close", "volume", "ingest_seq"
    )


@query
def latest_checkpoint(spark, sf):
    return W.latest_checkpoint(T.sync_log(spark, sf))


@query
def checkpoint_from_log(spark, sf):
    return W.checkpoint_from_log(T.sync_log(spark, sf))


@query
def succeeded_today(spark, sf):
    return W.succeeded_on(T.sync_log(spark, sf))


@query
def load_stats(spark, sf):
    previous = W.latest_date(T.calendar(spark, sf))
    return quality.load_stats(T.daily_bars(spark, sf), "trade_time", previous)


# ----------------------------------------------------------------- normalisation

@query
def normalize_dates(spark, sf):
    text = T.dirty_text(spark, sf)
    day = N.text_to_date("date_text")
    return text.select(
        "event_id", day.alias("day"), N.date_to_int(day).alias("as_int"), N.date_to_text(day).alias("as_text"),
        N.date_to_midnight(day).alias("midnight"), N.month_key(day).alias("month"),
        N.int_to_date(N.date_to_int(day)).alias("round_trip"),
    )


@query
def normalize_timestamps(spark, sf):
    return T.dirty_text(spark, sf).select("event_id", N.text_to_time("time_text").alias("at"))


@query
def normalize_numbers(spark, sf):
    return T.dirty_text(spark, sf).select(
        "event_id", N.clean_text("number_text").alias("as_text"), N.text_to_double("number_text").alias("as_double"),
        N.text_to_long("number_text").alias("as_long"),
    )


@query
def reject_counts(spark, sf):
    return quality.reject_counts(raw.normalize(T.raw_bars(spark, sf), "kline_daily"), ["code", "trade_time"])


@query
def raw_kline(spark, sf):
    return raw.kline(T.raw_bars(spark, sf))


@query
def raw_snapshot(spark, sf):
    rows = raw.snapshot(T.raw_ticks(spark, sf))
    return rows.select(
        "trade_time", "code", "last", "ask_volume1", "pre_settle", "underlying_security_code", "expire_date"
    )


@query
def raw_status(spark, sf):
    return raw.status(T.raw_status(spark, sf)).select(
        "trade_date", "market_code", "preclose", "is_st_sec", "is_susp_sec", "is_wd_sec"
    )


@query
def raw_calendar(spark, sf):
    return raw.calendar(T.dirty_text(spark, sf).select(F.col("date_text").alias("TRADE_DATE")), "SH")


@query
def raw_code_info(spark, sf):
    return raw.code_info(T.raw_info(spark, sf), "EXTRA_STOCK_A")


@query
def raw_stock_basic(spark, sf):
    return raw.stock_basic(T.raw_basic(spark, sf), date(2024, 1, 2))


@query
def raw_factors(spark, sf):
    """A wide text drop (one column per line number) to long rows."""
    wide = views.factor_matrix(T.line_factors(spark, sf), "adj", [str(i) for i in range(1, 8)])
    dated = wide.withColumn("trade_date", N.date_to_int("trade_date"))
    as_text = dated.select("trade_date", *[F.col(c).cast("string").alias(c) for c in wide.columns[1:]])
    return raw.factors(as_text, "backward")


@query
def scope_key(spark, sf):
    words = F.split("p_name", " ")
    key = N.scope_key(
        F.lit("task=get_stock_basic"), words, ("begin_date", F.lit(None)), ("brand", "p_brand"), ("size", "p_size")
    )
    return T.table(spark, sf, "part").select("p_partkey", key.alias("scope_key"))


@query
def natural_days(spark, sf):
    start, end = F.col("in_date"), F.col("out_date")
    return T.membership_intervals(spark, sf).select("security_type", "code", N.natural_days(start, end).alias("day"))


# ----------------------------------------------------------------- writing

def _two_loads(spark, sf) -> Lake:
    lake, rows = _lake(spark), T.daily_bars(spark, sf)
    lake.append("kline_daily", rows.where("l_linestatus = 'O'"), 1, "ingest_seq")
    lake.append("kline_daily", rows.where("l_linestatus <> 'O'"), 2, "ingest_seq")
    return lake


@query
def append_rows(spark, sf):
    """Two loads; a key may be stored once per load."""
    return _two_loads(spark, sf).read("kline_daily").select(*S.KLINE_FIELDS, "ingest_seq", "month")


@query
def union_old_new(spark, sf):
    rows = T.daily_bars(spark, sf)
    old, new = rows.where("l_linestatus = 'O'"), rows.where("l_linestatus <> 'O'")
    return union_latest(old, new, BAR_KEY, [f for f in S.KLINE_FIELDS if f not in BAR_KEY])


@query
def compact_month(spark, sf):
    lake = _two_loads(spark, sf)
    lake.compact("kline_daily")
    return lake.read("kline_daily").select(*S.KLINE_FIELDS, "ingest_seq", "month")


@query
def kline_after_compaction(spark, sf):
    """Two loads, all but the last months compacted: those are scanned without a shuffle."""
    lake = _two_loads(spark, sf)
    lake.compact("kline_daily", [f"{year}{month:02d}" for year in range(1995, 2001) for month in range(1, 13)])
    return views.kline(
        lake.read("kline_daily"), T.part_codes(spark, sf), BEGIN, "2001-12-31", ordered=False,
        unique_months=lake.unique_months("kline_daily", BEGIN, "2001-12-31"),
    )


@query
def append_new(spark, sf):
    """Key-only table: the second load adds just the days the first one did not have."""
    lake, rows = _lake(spark), T.calendar(spark, sf)
    lake.append("trade_calendar", rows.where("o_orderpriority = '1-URGENT'"), 1)
    lake.append("trade_calendar", rows, 2)
    return lake.read("trade_calendar")


def _in_two_windows(lake: Lake, table: str, load, rows: DataFrame, date_column: str, **options) -> DataFrame:
    """Rows up to the split arrive first, then the whole drop again; the watermark takes the rest."""
    load(lake, ranges.date_range(rows, date_column, None, SPLIT), run_date=date(2024, 1, 1), **options)
    load(lake, rows, run_date=date(2024, 1, 2), **options)
    load(lake, rows, run_date=date(2024, 1, 2), **options)  # same day: skipped
    return lake.latest(table)


@query
def load_calendar(spark, sf):
    rows = T.calendar(spark, sf)
    return _in_two_windows(_lake(spark), "trade_calendar", loads.load_calendar, rows, "trade_date", market=None)


@query
def load_code_info(spark, sf):
    lake, rows = _lake(spark), T.code_info(spark, sf)
    for day in (1, 2):
        loads.load_code_info(lake, rows, None, run_date=date(2024, 1, day), order="ingest_seq")
    return lake.latest("code_info")


@query
def load_membership(spark, sf):
    rows = T.membership(spark, sf)
    return _in_two_windows(
        _lake(spark), "hist_code_daily", loads.load_membership, rows, "trade_date", security_type=None
    )


@query
def load_adj_factor(spark, sf):
    rows = T.factors(spark, sf).where("factor_type = 'adj'")
    return _in_two_windows(_lake(spark), "price_factor", loads.load_factor, rows, "trade_date",
                           factor_type="adj", order="ingest_seq")


@query
def load_backward_factor(spark, sf):
    rows = T.factors(spark, sf).where("factor_type = 'backward'")
    return _in_two_windows(_lake(spark), "price_factor", loads.load_factor, rows, "trade_date",
                           factor_type="backward", order="ingest_seq")


@query
def load_stock_basic(spark, sf):
    """One load per snapshot day."""
    lake, rows = _lake(spark), T.stock_basic(spark, sf)
    for day in (2, 3, 4):
        taken = date(2024, 1, day)
        loads.load_stock_basic(lake, rows.where(F.col("snapshot_date") == F.lit(taken)), run_date=taken, order="ingest_seq")
    return lake.latest("stock_basic")


@query
def load_status(spark, sf):
    rows = T.status(spark, sf)
    return _in_two_windows(
        _lake(spark), "history_stock_status", loads.load_status, rows, "trade_date", order="ingest_seq"
    )


@query
def load_kline_daily(spark, sf):
    rows = T.daily_bars(spark, sf)
    return _in_two_windows(_lake(spark), "kline_daily", loads.load_kline, rows, "trade_time", order="ingest_seq")


@query
def load_kline_minute(spark, sf):
    lake, rows = _lake(spark), T.minute_bars(spark, sf)
    loads.load_kline(lake, rows, "min1", end="2024-01-15", run_date=date(2024, 2, 1), order="ingest_seq")
    loads.load_kline(lake, rows, "min1", run_date=date(2024, 2, 2), order="ingest_seq")
    return lake.latest("kline_minute")


@query
def load_snapshot(spark, sf):
    lake, rows = _lake(spark), T.ticks(spark, sf)
    loads.load_snapshot(lake, rows, end="2024-01-15", run_date=date(2024, 2, 1), order="ingest_seq")
    loads.load_snapshot(lake, rows, run_date=date(2024, 2, 2), order="ingest_seq")
    return views.snapshot(lake.read("market_snapshot"), None, None, None, ordered=False)


@query
def load_audit(spark, sf):
    """The log of two loads and a skipped repeat, as checkpoints."""
    lake, rows = _lake(spark), T.status(spark, sf)
    _in_two_windows(lake, "history_stock_status", loads.load_status, rows, "trade_date", order="ingest_seq")
    return W.checkpoint_from_log(lake.read("sync_task_log")).select(
        "task_name", "scope_key", "run_date", "status", "target_table", "checkpoint_date", "row_count"
    )


# ----------------------------------------------------------------- bars

def _rounded(df: DataFrame) -> DataFrame:
    """Sums of money depend on the order of addition in the last digits."""
    return df.withColumn("amount", F.round("amount", 2))


def _resample(period: str, daily: bool) -> Query:
    def run(spark, sf):
        source = T.daily_bars(spark, sf) if daily else T.minute_bars(spark, sf)
        return _rounded(B.kline_resample(views.kline(source, None, None, None, ordered=False), period))
    return run


for _p in S.PERIODS[1:]:
    QUERIES[f"kline_resample_{_p}"] = _resample(_p, daily=_p in ("week", "month", "season", "year"))


@query
def ticks_to_bars(spark, sf):
    return _rounded(B.ticks_to_bars(T.ticks(spark, sf), 5))


@query
def tick_stream_to_bars(spark, sf):
    """The events as a file stream; bars whose end the watermark has passed."""
    schema = T.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    return _rounded(run_stream_bars(T.tick_columns(stream), out, state, minutes=5))


def _with_copies(ticks: DataFrame) -> DataFrame:
    """Every tick once more, as it first came: with another price and less volume, both put right by the later row."""
    wrong = {"last": F.col("last") * 3 + 1, "volume": F.col("volume") / 2, "amount": F.lit(None).cast("double")}
    first = ticks.withColumns(wrong).withColumn("arrival", F.lit(0))
    return first.unionByName(ticks.withColumn("arrival", F.lit(1)))


@query
def ticks_with_copies_to_bars(spark, sf):
    return _rounded(B.ticks_to_bars(_with_copies(T.ticks(spark, sf)), 5, order=["arrival"]))


@query
def tick_stream_with_copies_to_lake(spark, sf):
    """The same as a stream into the lake's minute bars, read back through the front door."""
    schema = T.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    lake = _lake(spark)
    stream_into_lake(_with_copies(T.tick_columns(stream)), lake, scratch_path(spark, "stream-state"), minutes=5, order=["arrival"])
    return _rounded(MarketLake(lake).query_kline_minute(T.user_codes(spark, sf), None, None, ordered=False))


def _totals(spark, sf) -> DataFrame:
    """Ticks as a level-1 feed gives them, with running totals of the day; each comes twice, first with another price and less volume."""
    ticks = T.ticks(spark, sf).select("code", "trade_time", "last", "volume", "amount")
    upto = Window.partitionBy("code", F.col("trade_time").cast("date")).orderBy("trade_time")
    return _with_copies(ticks.withColumns({c: F.sum(c).over(upto) for c in ("volume", "amount")}))


@query
def tick_totals_to_bars(spark, sf):
    return _rounded(B.total_ticks_to_bars(_totals(spark, sf), 5, order=["arrival"]))


@query
def tick_stream_totals_to_bars(spark, sf):
    """The same feed as a file stream."""
    feed = settle(_totals(spark, sf), "totals")
    stream = spark.readStream.schema(feed.schema).parquet(feed.settled_at)
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    return _rounded(run_stream_bars(stream, out, state, minutes=5, order=["arrival"], totals=True))


# ----------------------------------------------------------------- per-code drops as a data source

def _minute_drop(spark, sf) -> str:
    path = scratch_path(spark, "drop")
    spec = S.TABLES["kline_minute"]
    drops.write_drop(latest_per_key(T.minute_bars(spark, sf), spec.key, spec.values), "kline_minute", path)
    return path


@query
def source_kline(spark, sf):
    """A drop with a folder per code through the data source; codes and dates are filters of its reader."""
    rows = drops.read_drop(spark, _minute_drop(spark, sf), task_bytes=1 << 16)
    codes = [r[0] for r in T.user_codes(spark, sf).where("code < '000100'").collect()]  # a request by list
    return ranges.date_range(rows.where(F.col("code").isin(codes)), "trade_time", TICK_BEGIN, TICK_END)


@query
def source_kline_whole(spark, sf):
    return drops.read_drop(spark, _minute_drop(spark, sf))


@query
def source_stream_to_bars(spark, sf):
    """The ticks as a feed of three loads through the same source, stopped after the second one and started again."""
    path, out, state = (scratch_path(spark, x) for x in ("feed", "stream", "stream-state"))
    ticks = T.ticks(spark, sf)
    bounds = ["2024-01-11", "2024-01-21", None]
    bars, begin = None, None
    for n, end in enumerate(bounds, 1):
        of_load = ticks if begin is None else ticks.where(F.col("trade_time") >= F.lit(begin).cast("timestamp_ntz"))
        of_load = of_load if end is None else of_load.where(F.col("trade_time") < F.lit(end).cast("timestamp_ntz"))
        drops.write_drop(of_load, "market_snapshot", f"{path}/load={n}")
        begin = end
        if n > 1:
            feed = drops.stream_feed(spark, path, "market_snapshot", ["code", "trade_time", "last", "volume", "amount"])
            bars = run_stream_bars(feed, out, state, minutes=5, available_now=False)
    return _rounded(bars)


# ----------------------------------------------------------------- through the front door

class _Drop:
    """A source of bars and factors over given rows."""

    def __init__(self, rows: DataFrame, order=()):
        self.rows, self.order = rows, order

    def kline(self, period: str) -> DataFrame:
        return self.rows

    def factors(self, factor_type: str) -> DataFrame:
        return self.rows


def _parts(spark, sf, test: str) -> DataFrame:
    return T.table(spark, sf, "part").where(test).select(F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" ")).alias("code"))


@query
def kline_for_universe(spark, sf):
    """A frame of codes, untrimmed, goes straight into a query that loads first."""
    market = MarketLake(_lake(spark), _Drop(T.daily_bars(spark, sf), ["ingest_seq"]))
    return market.query_kline(_parts(spark, sf, "p_partkey % 3 = 0"), "1996-01-01", "1996-12-31", ordered=False)


@query
def load_two_frames(spark, sf):
    """Two frames of codes on one day: both are loaded, the repeat of one is not."""
    lake = _lake(spark)
    market = MarketLake(lake, _Drop(T.daily_bars(spark, sf), ["ingest_seq"]))
    for part in (0, 1, 0):
        market.sync_kline(_parts(spark, sf, f"p_partkey % 4 = {part}"), None, None)
    return lake.latest("kline_daily")


@query
def load_kline_corrections(spark, sf):
    """A drop with differing copies of a key, some of them with NULL values: the one that came last is stored, whole."""
    close = F.when(F.col("l_linenumber") % 2 != 0, F.col("l_extendedprice") / F.col("l_quantity"))
    drop = T.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("code"), F.col("l_shipdate").cast("date").alias("trade_date"), close.alias("close"),
        F.col("l_extendedprice").alias("amount"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival"))
    lake = _lake(spark)
    MarketLake(lake, _Drop(raw.kline(drop, keep=["arrival"]), ["arrival"])).sync_kline(_parts(spark, sf, "true"), None, None)
    return lake.latest("kline_daily").select("code", "trade_time", "close", "amount")


@query
def load_minute_then_full_day(spark, sf):
    """A request for some minutes of two days, then for the days: nothing is missing from the second."""
    market = MarketLake(_lake(spark), _Drop(T.minute_bars(spark, sf), ["ingest_seq"]))
    market.query_kline_minute(T.user_codes(spark, sf), "2024-01-01", "2024-01-03", 930, 1130)
    return market.query_kline_minute(T.user_codes(spark, sf), "2024-01-01", "2024-01-03", ordered=False)


@query
def load_one_factor_type(spark, sf):
    """A drop of both factor types: a load of one stores one."""
    lake = _lake(spark)
    loads.load_factor(lake, T.factors(spark, sf), "adj", run_date=date(2024, 1, 2), order="ingest_seq")
    return lake.latest("price_factor")


def _drop_with_rejects(spark, sf) -> DataFrame:
    """Line 7 comes without a code, full lots without a day."""
    code, day = F.when(F.col("l_linenumber") != 7, F.col("l_partkey").cast("string")), F.when(F.col("l_quantity") != 50, F.col("l_shipdate").cast("date"))
    drop = T.table(spark, sf, "lineitem").select(code.alias("code"), day.alias("trade_date"), F.col("l_tax").alias("open"))
    return raw.normalize(drop, "kline_daily")


@query
def load_rejects(spark, sf):
    """Rows without a code or a time are left out, and counted in the log: also for a request of some codes at the front door."""
    lake = _lake(spark)
    MarketLake(lake, _Drop(_drop_with_rejects(spark, sf))).sync_kline(_parts(spark, sf, "p_partkey % 3 = 0"), None, None)
    return lake.read("sync_task_log").select("status", "row_count", "reject_count")


@query
def load_quarantine(spark, sf):
    """The same rows by reason, kept as they came."""
    lake = _lake(spark)
    loads.load_kline(lake, _drop_with_rejects(spark, sf), run_date=date(2024, 1, 2), quarantine=True)
    kept = F.get_json_object("row", "$.open").cast("double")
    return lake.read("rejected_rows").select("run_date", "target_table", "task_name", "reason", kept.alias("open"))


def _bars_that_came_early(spark, sf) -> DataFrame:
    """Every third line is not there yet, some have a wrong price."""
    rows = T.daily_bars(spark, sf)
    return rows.where("ingest_seq % 3 <> 1").withColumn("close", F.when(F.col("ingest_seq") % 5 == 0, F.lit(0.0)).otherwise(F.col("close")))


@query
def load_late_rows(spark, sf):
    """Days loaded while incomplete: the watermark takes nothing more, the digests find what came late or was put right."""
    lake, rows = _lake(spark), T.daily_bars(spark, sf)
    loads.load_kline(lake, _bars_that_came_early(spark, sf), run_date=date(2024, 1, 2), order="ingest_seq")
    loads.load_kline(lake, rows, run_date=date(2024, 1, 3), order="ingest_seq")
    loads.load_late_rows(lake, "kline_daily", rows, run_date=date(2024, 1, 3), order="ingest_seq")
    return lake.latest("kline_daily")


@query
def compare_days(spark, sf):
    """State of every code and day of a drop against the table."""
    spec = S.TABLES["kline_daily"]
    new, old = (latest_per_key(rows, spec.key, spec.values) for rows in (T.daily_bars(spark, sf), _bars_that_came_early(spark, sf)))
    return reconcile.compare_days(new, old.where("code NOT LIKE '%7'"), spec.group, spec.date_column, spec.columns)


@query
def watermark_state(spark, sf):
    """Latest dates kept with the table, after three loads and a compaction; no bar is read."""
    lake, rows = _lake(spark), T.daily_bars(spark, sf)
    for part in range(3):
        lake.append("kline_daily", rows.where(F.col("ingest_seq") % 3 == part), part + 1, "ingest_seq")
        if part == 1:
            lake.compact("kline_daily")
    return lake.watermarks("kline_daily")[0]


@query
def membership_open(spark, sf):
    """Members whose code ends in 3 have no end."""
    open_ended = T.membership_intervals(spark, sf).withColumn("out_date", F.when(~F.col("code").endswith("3"), F.col("out_date")))
    days = raw.trading_days(T.calendar(spark, sf).where("market = 'SH'"), BEGIN, "1996-01-31")
    return raw.membership_daily(open_ended, days)


@query
def membership_natural_days(spark, sf):
    """A calendar without days in the range: every natural day counts."""
    days = raw.trading_days(T.calendar(spark, sf).where("market = 'NONE'"), "1996-02-01", "1996-02-10")
    return raw.membership_daily(T.membership_intervals(spark, sf), days)


def _traded_days(spark, sf) -> DataFrame:
    """Days on which SH orders came, without those whose number ends in 7, so that stretches are cut."""
    return T.calendar(spark, sf).where("market = 'SH' AND dayofmonth(trade_date) % 10 <> 7")


@query
def membership_intervals(spark, sf):
    """Daily members folded into stretches of trading days."""
    days = _traded_days(spark, sf)
    daily = raw.membership_daily(T.membership_intervals(spark, sf), days.where("trade_date < DATE '1997-01-01'"))
    return membership.fold(daily, days)


@query
def members_on_days(spark, sf):
    """Members on the first trading days of months, by time bins; some memberships are open."""
    days = T.calendar(spark, sf).where("market = 'SH' AND dayofmonth(trade_date) <= 2 AND trade_date >= DATE '1996-01-01'")
    open_ended = T.membership_intervals(spark, sf).withColumn("out_date", F.when(~F.col("code").endswith("33"), F.col("out_date")))
    return membership.members_on(open_ended, days)


@query
def factor_blocks(spark, sf):
    """The factors of all parts in blocks of 64 codes, and back."""
    rows = T.factors(spark, sf).where("factor_type = 'backward'")
    blocks, index = matrix.factor_blocks(rows, T.part_codes(spark, sf), 64)
    return matrix.cells_of(blocks, index)


@query
def factor_block_index(spark, sf):
    """How many values each block of a date holds."""
    rows = T.factors(spark, sf).where("factor_type = 'adj'")
    blocks, _ = matrix.factor_blocks(rows, T.part_codes(spark, sf), 64)
    filled = F.size(F.filter("factors", lambda v: v.isNotNull()))
    return blocks.select("trade_date", "block", F.size("factors").alias("places"), filled.alias("filled"))


def _sessions(minutes: int) -> Query:
    return lambda spark, sf: _rounded(B.kline_resample_sessions(views.kline(T.minute_bars(spark, sf), None, None, None, ordered=False), minutes))


for _n in (5, 60, 90, 120):
    QUERIES[f"kline_resample_sessions_{_n}"] = _sessions(_n)


@query
def split_codes(spark, sf):
    text = F.concat("p_name", F.lit(" ,, "), "p_type", F.lit(","), "p_name")
    return T.table(spark, sf, "part").select("p_partkey", F.concat_ws("|", N.split_codes(text)).alias("codes"))
