"""The lake's tables expressed over the sample star schema (lineitem, orders, part, customer, events).

Used by the registered queries, the benchmark and the tests; the SQL twins are in
``ticklake.plans.oracle``. Every adapter reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticklake.functions import normalize as N
from ticklake.schemas import INGEST_SEQ, SNAPSHOT_LAYOUTS, TABLES


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _none(kind: str = "double") -> Column:
    return F.lit(None).cast(kind)


def exchange(number: Column) -> Column:
    rest = number % 3
    return F.when(rest == 0, ".SH").when(rest == 1, ".SZ").otherwise(".BJ")


def market_of(status: Column) -> Column:
    return F.when(status == "O", "SH").when(status == "F", "SZ").otherwise("BJ")


def daily_bars(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        _text("l_partkey").alias("code"), F.col("l_shipdate").alias("trade_time"),
        (price * (1 - F.col("l_discount"))).alias("open"), (price * (1 + F.col("l_tax"))).alias("high"),
        (price * (1 - F.col("l_discount"))).alias("low"), price.alias("close"),
        F.col("l_quantity").alias("volume"), F.col("l_extendedprice").alias("amount"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias(INGEST_SEQ), "l_linestatus",
    )


def part_codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(_text("p_partkey").alias("code"))


def user_code() -> Column:
    return F.concat(F.lpad(_text("user_id"), 6, "0"), exchange(F.col("user_id")))


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots: the columns of the widest layout that the events can fill, the others NULL."""
    events = table(spark, sf, "events")
    return tick_columns(events)


def tick_columns(events: DataFrame) -> DataFrame:
    lots = F.get_json_object("props", "$.k").cast("bigint")
    filled = {
        "trade_time": F.col("ts"), "code": user_code(), "last": F.col("value"), "open": F.col("value"),
        "high": F.col("value"), "low": F.col("value"), "close": F.col("value"),
        "volume": lots.cast("double"), "amount": F.col("value") * lots, "num_trades": F.lit(1.0),
        "trading_phase_code": F.upper(F.substring("event_type", 1, 1)),
        **{f"ask_price{i}": F.col("value") + i for i in range(1, 6)},
        **{f"bid_price{i}": F.col("value") - i for i in range(1, 6)},
        **{f"{side}_volume{i}": lots + i for side in ("ask", "bid") for i in range(1, 6)},
        "open_interest": lots * 10, "contract_type": F.col("event_type"), "trading_day": N.date_to_text("ts"),
        "nominal_price": F.col("value") * 2,
    }
    spec = TABLES["market_snapshot"]
    return events.select(
        *[filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema.fields],
        F.col("event_id").alias(INGEST_SEQ),
    )


def minute_bars(spark: SparkSession, sf: str) -> DataFrame:
    lots = F.get_json_object("props", "$.k").cast("double")
    value = F.col("value")
    return table(spark, sf, "events").select(
        user_code().alias("code"),
        F.expr("ts - make_dt_interval(0, 0, 0, extract(SECOND FROM ts))").alias("trade_time"),
        value.alias("open"), (value + 1).alias("high"), (value - 1).alias("low"), value.alias("close"),
        lots.alias("volume"), (value * lots).alias("amount"), F.col("event_id").alias(INGEST_SEQ),
    )


def user_codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(user_code().alias("code")).distinct()


def code_info(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("p_type")
    return table(spark, sf, "part").select(
        F.when(kind == "ECONOMY", "EXTRA_STOCK_A").when(kind == "STANDARD", "SH_A").when(kind == "PROMO", "EXTRA_ETF")
        .when(kind == "SMALL", "EXTRA_KZZ").when(kind == "MEDIUM", "EXTRA_INDEX_A").otherwise("BJ_A")
        .alias("security_type"),
        F.concat(F.rpad(_text("p_partkey"), 6, "0"), exchange(F.col("p_size"))).alias("code"),
        F.col("p_name").alias("symbol"),
        F.concat_ws(",", (F.col("p_size") % 17).cast("string"), (57 + F.col("p_size") % 12).cast("string"))
        .alias("security_status_raw"),
        F.col("p_retailprice").alias("pre_close"), (F.col("p_retailprice") * 1.1).alias("high_limited"),
        (F.col("p_retailprice") * 0.9).alias("low_limited"), F.lit(0.01).alias("price_tick"),
        F.col("p_partkey").alias(INGEST_SEQ),
    )


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        market_of(F.col("o_orderstatus")).alias("market"), F.col("o_orderdate").cast("date").alias("trade_date"),
        "o_orderpriority",
    )


def membership(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("trade_date"), F.col("o_orderpriority").alias("security_type"),
        _text("o_custkey").alias("code"),
    )


def membership_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Each order opens a membership of six days."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("security_type"), _text("o_custkey").alias("code"),
        day.alias("in_date"), F.date_add(day, 5).alias("out_date"),
    )


def factors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "adj").otherwise("backward").alias("factor_type"),
        F.col("l_shipdate").cast("date").alias("trade_date"), _text("l_partkey").alias("code"),
        (1 - F.col("l_discount")).alias("factor_value"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias(INGEST_SEQ),
    )


def line_factors(spark: SparkSession, sf: str) -> DataFrame:
    """Factors of seven codes (the line numbers), with many rows per date and code."""
    return table(spark, sf, "lineitem").select(
        F.lit("adj").alias("factor_type"), F.col("l_shipdate").cast("date").alias("trade_date"),
        _text("l_linenumber").alias("code"), (1 - F.col("l_discount")).alias("factor_value"),
        (F.col("l_orderkey").cast("decimal(20,0)") * F.lit(10**12).cast("decimal(13,0)") + F.col("l_partkey"))
        .cast("decimal(38,0)").alias(INGEST_SEQ),
    )


def stock_basic(spark: SparkSession, sf: str) -> DataFrame:
    """Three snapshot days; customers in debt miss the last one. Each profile arrives twice, the
    second time corrected."""
    days = F.array(*[F.lit(d).cast("date") for d in ("2024-01-02", "2024-01-03", "2024-01-04")])
    stamped = table(spark, sf, "customer").select("*", F.explode(days).alias("snapshot_date"))
    kept = stamped.where((F.col("snapshot_date") < F.lit("2024-01-04").cast("date")) | (F.col("c_acctbal") >= 0))
    versions = kept.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    return versions.select(
        "snapshot_date", _text("c_custkey").alias("market_code"),
        F.when(F.col("version") == 2, F.upper("c_name")).otherwise(F.col("c_name")).alias("security_name"),
        F.col("c_name").alias("comp_name"), F.lower(F.substring("c_name", 1, 3)).alias("pinyin"),
        F.when(F.col("version") == 1, F.col("c_name")).alias("comp_name_eng"),
        (20000101 + F.col("c_nationkey")).cast("int").alias("list_date"), _none("int").alias("delist_date"),
        F.col("c_mktsegment").alias("listplate_name"), _none("string").alias("comp_sname_eng"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(3).alias("is_listed"),
        F.col("version").cast("bigint").alias(INGEST_SEQ),
    )


def customer_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Request order: highest customer number first."""
    return table(spark, sf, "customer").select(
        _text("c_custkey").alias("market_code"), (-F.col("c_custkey")).alias("pos")
    )


def status(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("trade_date"), _text("o_custkey").alias("market_code"),
        F.col("o_totalprice").alias("preclose"), (F.col("o_totalprice") * 1.1).alias("high_limited"),
        (F.col("o_totalprice") * 0.9).alias("low_limited"), F.lit(0.1).alias("price_high_lmt_rate"),
        F.lit(-0.1).alias("price_low_lmt_rate"), F.substring("o_orderpriority", 1, 1).alias("is_st_sec"),
        F.col("o_orderstatus").alias("is_susp_sec"), _none("string").alias("is_wd_sec"),
        _none("string").alias("is_xr_sec"), F.col("o_orderkey").alias(INGEST_SEQ),
    )


def sync_log(spark: SparkSession, sf: str) -> DataFrame:
    event, day = F.col("event_id"), F.col("ts").cast("date")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("task_name"), F.concat(F.lit("user="), _text("user_id")).alias("scope_key"),
        day.alias("run_date"),
        F.when(event % 3 == 0, "success").when(event % 3 == 1, "failed").otherwise("skipped").alias("status"),
        F.lit("kline_daily").alias("target_table"),
        F.when(event % 10 != 0, F.date_sub(day, 1)).alias("start_date"), F.when(event % 5 != 0, day).alias("end_date"),
        (event % 100).alias("row_count"), F.col("props").alias("message"),
        F.col("ts").alias("started_at"), F.col("ts").alias("finished_at"),
    )


# ----------------------------------------------------------------- dirty drops

def dirty_text(spark: SparkSession, sf: str) -> DataFrame:
    """Dates, times and numbers in every spelling a drop may use, good and bad, by event number."""
    event, ts = F.col("event_id"), F.col("ts")

    def form(choices: list[Column]) -> Column:
        pick = F.when(event % len(choices) == 0, choices[0])
        for i, c in enumerate(choices[1:], 1):
            pick = pick.when(event % len(choices) == i, c)
        return pick

    def stamp(pattern: str) -> Column:
        return F.date_format(ts, pattern)

    day, number = stamp("yyyyMMdd"), _text("value")
    return table(spark, sf, "events").select(
        "event_id",
        form([day, stamp("yyyy-MM-dd"), F.concat(F.lit(" "), stamp("yyyy/MM/dd"), F.lit(" ")), F.lit(""),
              F.substring(day, 1, 7), F.concat(F.substring(day, 1, 4), F.lit("0230")), _none("string"), day])
        .alias("date_text"),
        form([day, stamp("yyyyMMddHHmm"), stamp("yyyyMMddHHmmss"), stamp("yyyyMMddHHmmssSSS"),
              stamp("yyyy-MM-dd HH:mm:ss"), F.lit(" "), F.concat(day, F.lit("9")), stamp("yyyy/MM/dd HH.mm.ss.SSS")])
        .alias("time_text"),
        form([number, F.concat(F.lit(" "), number, F.lit(" ")), F.lit(" "), F.lit("x"), _none("string"),
              F.lit("NaN"), F.concat(F.lit("-"), number)]).alias("number_text"),
    )


def raw_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as delivered: upper-case names, text values, some rows without a code or a time."""
    shipped = F.date_format("l_shipdate", "yyyyMMdd")
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.concat(F.lit(" "), _text("l_partkey"))).alias("CODE"),
        F.when(F.col("l_quantity") != 50, shipped).otherwise("0").alias("KLINE_TIME"),
        _text("l_discount").alias("OPEN"), _text("l_tax").alias("HIGH"), F.lit("NaN").alias("LOW"),
        F.concat(_text("l_quantity"), F.lit(" ")).alias("CLOSE"), _text("l_orderkey").alias("VOLUME"),
        _text("l_suppkey").alias("AMOUNT"),
    )


def raw_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots with the scanned manual's column names."""
    return table(spark, sf, "events").select(
        user_code().alias("MARKET_CODE"), F.date_format("ts", "yyyyMMddHHmmssSSS").alias("snapshot_time"),
        _text("value").alias("LAST"), _text("event_id").alias("ask _volume1"), F.lit("1.5").alias("pre_settle:"),
        F.col("event_type").alias("underlying_security_cod"),
    )


def raw_status(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        _text("o_custkey").alias("MARKET_CODE"), F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("TRADE_DATE"),
        _text("o_totalprice").alias("PRE_CLOSE"), F.col("o_orderstatus").alias("IS_SUSP_SEC"),
        F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority")).alias("IS_ST_SEC"),
    )


def raw_info(spark: SparkSession, sf: str) -> DataFrame:
    """Master data with a list of status flags and alternative names."""
    return table(spark, sf, "part").select(
        F.concat(F.lit(" "), F.rpad(_text("p_partkey"), 6, "0"), exchange(F.col("p_size"))).alias("CODE"),
        F.when(F.col("p_type") != "PROMO", F.col("p_name")).otherwise("  ").alias("SYMBOL"),
        F.array((F.col("p_size") % 17).cast("string"), F.lit("62")).alias("SECURITY_STATUS"),
        _text("p_retailprice").alias("PRECLOSE"), F.lit("x").alias("HIGH_LIMITED"),
    )


def raw_basic(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 0, _text("c_custkey")).alias("MARKET_CODE"), F.col("c_name").alias("SECURITY_NAME"),
        (20000101 + F.col("c_nationkey")).cast("string").alias("LISTDATE"), F.col("c_acctbal").alias("DELISTDATE"),
        F.lit("1.0").alias("IS_LISTED"),
    )


SNAPSHOT_KINDS = tuple(SNAPSHOT_LAYOUTS)
