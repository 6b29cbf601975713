"""Raw vendor drops to table rows.

A drop is any DataFrame. Column names are resolved while the plan is built, so cleaning a drop is a
single narrow ``select`` however many spellings the vendor uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators.lookup import lookup_join
from ticklake.operators.matrix import factor_unpivot
from ticklake.operators.ranges import as_date, date_range

CODE_NAMES = ("code", "market_code")
TIME_NAMES = ("trade_time", "kline_time", "snapshot_time", "trade_date", "date", "datetime")
# further spellings per stored column
NAMES = {
    "pre_close": ("pre_close", "preclose"),
    "preclose": ("preclose", "pre_close"),
    "security_status_raw": ("security_status_raw", "security_status"),
    "list_date": ("list_date", "listdate"),
    "delist_date": ("delist_date", "delistdate"),
    "market_code": ("market_code", "code"),
    "code": CODE_NAMES,
    "trade_time": TIME_NAMES,
}


def clean_names(raw: DataFrame) -> DataFrame:
    """Scanning noise in column names (``ask _volume1``, ``pre_settle:``) to clean names."""
    return raw.withColumnsRenamed({k: v for k, v in S.FIELD_NAME_ALIASES.items() if k in raw.columns})


def find_column(raw: DataFrame, names: Sequence[str]) -> str | None:
    """First candidate present, each tried as given, in upper and in lower case."""
    return next((n for name in names for n in (name, name.upper(), name.lower()) if n in raw.columns), None)


def with_path_code(raw: DataFrame, pattern: str = r"([0-9A-Za-z]+\.[A-Z]{2,3})[^/]*$") -> DataFrame:
    """Code of a one-file-per-code drop taken from the file path, where the rows do not name it."""
    from_path = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit(""))
    present = find_column(raw, CODE_NAMES)
    if present is None:
        return raw.select("*", from_path.alias("code"))
    return raw.withColumn(present, F.coalesce(N.clean_text(F.col(present).cast("string")), from_path))


def normalize(raw: DataFrame, table: str, fixed: dict[str, Column] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """All columns of ``table``, cleaned and typed; absent ones are NULL. Keeps every row, and the columns ``keep`` as they are, such
    as the drop's order of arrival."""
    fixed = fixed or {}
    raw = clean_names(raw)
    columns = []
    for field in S.TABLES[table].schema.fields:
        source = find_column(raw, NAMES.get(field.name, (field.name,)))
        if field.name in fixed:
            value = fixed[field.name].cast(field.dataType)
        elif source is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = N.typed(F.col(f"`{source}`"), raw.schema[source].dataType, field.dataType)
        columns.append(value.alias(field.name))
    return raw.select(*columns, *[F.col(f"`{c}`") for c in keep])


def accepted(rows: DataFrame, table: str) -> DataFrame:
    """Rows with every mandatory field; see ``quality.reject_counts`` for how many are not."""
    for column in S.TABLES[table].key:
        rows = rows.where(F.col(column).isNotNull())
    return rows


# ----------------------------------------------------------------- one reader per drop

def calendar(raw: DataFrame, market: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    fixed = {"market": F.lit(market)} if market else {}
    return accepted(normalize(raw, "trade_calendar", fixed, keep), "trade_calendar")


def code_info(raw: DataFrame, security_type: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    fixed = {"security_type": F.lit(security_type)} if security_type else {}
    rows = accepted(normalize(raw, "code_info", fixed, keep), "code_info")
    return rows.where(N.keep_code("code", "security_type"))


def membership(raw: DataFrame, security_type: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    fixed = {"security_type": F.lit(security_type)} if security_type else {}
    return accepted(normalize(raw, "hist_code_daily", fixed, keep), "hist_code_daily")


def factors(raw_wide: DataFrame, factor_type: str, date_column: str = "trade_date") -> DataFrame:
    """Wide date x code drop to long rows."""
    if factor_type not in S.FACTOR_TYPES:
        raise ValueError(f"unknown factor type: {factor_type!r}")
    rows = factor_unpivot(raw_wide, date_column).withColumnRenamed(date_column, "trade_date")
    return accepted(normalize(rows, "price_factor", {"factor_type": F.lit(factor_type)}), "price_factor")


def stock_basic(raw: DataFrame, snapshot_date, keep: Sequence[str] = ()) -> DataFrame:
    """Stock profiles are stamped with the day they were taken."""
    fixed = {"snapshot_date": F.lit(snapshot_date)}
    return accepted(normalize(raw, "stock_basic", fixed, keep), "stock_basic")


def status(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return accepted(normalize(raw, "history_stock_status", keep=keep), "history_stock_status")


def _need_time(raw: DataFrame) -> None:
    if find_column(clean_names(raw), TIME_NAMES) is None:
        raise ValueError(f"no time column among {raw.columns}")


def kline(raw: DataFrame, period: str = "day", keep: Sequence[str] = ()) -> DataFrame:
    _need_time(raw)
    table = {"day": "kline_daily", "min1": "kline_minute"}[period]
    return accepted(normalize(raw, table, keep=keep), table)


def snapshot(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    _need_time(raw)
    return accepted(normalize(raw, "market_snapshot", keep=keep), "market_snapshot")


# ----------------------------------------------------------------- membership per trading day

def trading_days(calendar_rows: DataFrame, begin, end) -> DataFrame:
    """Distinct trading days in the range, or every natural day if the calendar has none there."""
    days = date_range(calendar_rows, "trade_date", begin, end).select("trade_date").distinct()
    if not days.isEmpty():
        return days
    bounds = calendar_rows.sparkSession.createDataFrame([(as_date(begin), as_date(end))], "b date, e date")
    return bounds.select(N.natural_days(F.col("b"), F.col("e")).alias("trade_date"))


def membership_daily(intervals: DataFrame, days: DataFrame) -> DataFrame:
    """One row per trading day and member, from membership intervals (``in_date`` .. ``out_date``, both included).

    A member without ``out_date`` is still one, a member without ``in_date`` always was. Intervals are cut to the first and
    last asked day (two dates that the driver reads) and then opened into days, which turns the range join into an
    equi-join on the date without a row for any day that nobody asked for.
    """
    days = days.select("trade_date").distinct()
    first, last = days.agg(F.min("trade_date"), F.max("trade_date")).first()
    if first is None:
        return intervals.sparkSession.createDataFrame([], "trade_date date, security_type string, code string")
    start, end = (F.lit(d).cast("date") for d in (first, last))
    cut = intervals.select("security_type", "code", F.greatest(F.coalesce("in_date", start), start).alias("a"), F.least(F.coalesce("out_date", end), end).alias("b"))
    opened = cut.where("a <= b").select("security_type", "code", N.natural_days(F.col("a"), F.col("b")).alias("trade_date"))
    joined = lookup_join(opened, days, ["trade_date"], "left_semi")
    return joined.select("trade_date", "security_type", "code").distinct()
