"""Read views over table frames. Each returns a lazy DataFrame; sorting is asked for at the edge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators import matrix, ranges, watermarks as W
from ticklake.operators.dedup import latest_per_key
from ticklake.operators.lookup import only_codes, with_position
from ticklake.schemas import INGEST_SEQ

Codes = Sequence[str] | DataFrame


class NoData(LookupError):
    """Asked for rows and found none."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Opt-in check; runs a job that stops at the first row."""
    if df.isEmpty():
        raise NoData(f"no data: {what}")
    return df


def calendar(rows: DataFrame, market: str = "SH", data_type: str = "str") -> DataFrame:
    """Distinct trading days of a market, sorted: ``YYYYMMDD`` text or midnight timestamps."""
    if data_type not in ("str", "datetime"):
        raise ValueError("data_type is 'str' or 'datetime'")
    days = rows.where(F.col("market") == market).select("trade_date").distinct()
    shape = N.date_to_text if data_type == "str" else N.date_to_midnight
    return days.select(shape("trade_date").alias("trade_date")).orderBy("trade_date")


def code_info(rows: DataFrame, security_type: str = S.UNIVERSE_TYPES["security"], order=INGEST_SEQ) -> DataFrame:
    """Latest master data per code of one security type, under the universe rule, by code."""
    kind = S.SECURITY_TYPE_ALIASES.get(security_type, security_type)
    chosen = rows.where((F.col("security_type") == kind) & N.keep_code("code", "security_type"))
    spec = S.TABLES["code_info"]
    latest = latest_per_key(chosen, ["code"], spec.values, order)
    return latest.withColumnRenamed("security_status_raw", "security_status").orderBy("code")


def universe(rows: DataFrame, security_type: str = S.UNIVERSE_TYPES["security"]) -> DataFrame:
    """Codes of one security type; only key columns are read."""
    kind = S.SECURITY_TYPE_ALIASES.get(security_type, security_type)
    chosen = rows.where((F.col("security_type") == kind) & N.keep_code("code", "security_type"))
    return chosen.select("code").distinct().orderBy("code")


def universe_sample(codes: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` distinct codes in code order (all without ``n``); a top-n, not a full sort."""
    distinct = codes.select("code").distinct().orderBy("code")
    return distinct.limit(n) if n else distinct


def stock_basic(rows: DataFrame, codes: Codes, order=INGEST_SEQ) -> DataFrame:
    """Profiles at the common snapshot date, vendor names, request order.

    The common date is the earliest of the codes' latest snapshot dates; it is empty, and so is the
    result, unless every requested code has a profile.
    """
    # the date is read first: as a value it prunes months and files of the wide scan
    asof = W.common_watermark(rows, codes, "market_code", "snapshot_date").first()[0]
    dated = ranges.date_range(rows, "snapshot_date", asof, asof) if asof else rows.where("false")
    at_date = with_position(dated, codes, "market_code")
    values = [c for c in S.STOCK_BASIC_NAMES.values() if c != "market_code"]
    latest = latest_per_key(at_date, ["market_code", "pos"], values, order).orderBy("pos")
    return latest.select(*[F.col(c).alias(vendor) for vendor, c in S.STOCK_BASIC_NAMES.items()])


def stock_status(rows: DataFrame, codes: Codes, begin=None, end=None, order=INGEST_SEQ, ordered: bool = True) -> DataFrame:
    """Daily trading status, vendor names, dates as YYYYMMDD, request order then date (``ordered=False``: any order)."""
    chosen = with_position(ranges.date_range(rows, "trade_date", begin, end), codes, "market_code")
    key = ["market_code", "trade_date"]
    values = [c for c in S.STATUS_NAMES.values() if c not in key]
    latest = latest_per_key(chosen, [*key, "pos"], values, order)
    latest = latest.orderBy("pos", "trade_date") if ordered else latest
    return latest.withColumn("trade_date", N.date_to_text("trade_date")).select(
        *[F.col(c).alias(vendor) for vendor, c in S.STATUS_NAMES.items()]
    )


def hist_codes(rows: DataFrame, security_type: str, begin, end) -> DataFrame:
    """Codes that were members on any day of the range, by code."""
    members = ranges.date_range(rows.where(F.col("security_type") == security_type), "trade_date", begin, end)
    return members.select("code").distinct().orderBy("code")


def factors(rows: DataFrame, factor_type: str, codes: Codes | None = None, order=INGEST_SEQ) -> DataFrame:
    """Long factors, one row per date and code."""
    chosen = only_codes(rows.where(F.col("factor_type") == factor_type), codes)
    return latest_per_key(chosen, ["trade_date", "code"], ["factor_value"], order)


def factor_matrix(rows: DataFrame, factor_type: str, codes: Sequence[str], order: str = INGEST_SEQ) -> DataFrame:
    return matrix.factor_matrix(rows.where(F.col("factor_type") == factor_type), codes, order)


def kline(rows: DataFrame, codes: Codes | None, begin, end, begin_time: int | None = None,
          end_time: int | None = None, ordered: bool = True, order=INGEST_SEQ,
          unique_months: Sequence[str] = ()) -> DataFrame:
    """Bars in one long frame keyed by (code, trade_time); dates and HHMM times are inclusive.

    ``ordered=False`` saves the range shuffle when the result feeds another job, ``unique_months``
    (see ``Lake.unique_months``) the dedup shuffle.
    """
    got = ranges.range_read(
        rows, ["code", "trade_time"], S.KLINE_FIELDS, codes, begin, end,
        time_filter=lambda df: ranges.bar_time_of_day(df, begin_time, end_time), order=order,
        unique_months=unique_months,
    )
    return got.orderBy("code", "trade_time") if ordered else got


def snapshot(rows: DataFrame, codes: Codes | None, begin, end, begin_time: int | None = None,
             end_time: int | None = None, kind: str = "snapshot", ordered: bool = True,
             order=INGEST_SEQ, unique_months: Sequence[str] = ()) -> DataFrame:
    """Snapshots in the column layout of one instrument kind; times are HHMMSSmmm.

    Only the layout's columns are read and shuffled.
    """
    got = ranges.range_read(
        rows, ["code", "trade_time"], S.SNAPSHOT_LAYOUTS[kind], codes, begin, end,
        time_filter=lambda df: ranges.snapshot_time_of_day(df, begin_time, end_time), order=order,
        unique_months=unique_months,
    )
    return got.orderBy("code", "trade_time") if ordered else got
