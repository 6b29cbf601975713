"""Range reads: codes, inclusive dates, inclusive times of day, one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ticklake.functions import normalize as N
from ticklake.operators.dedup import latest_per_key
from ticklake.operators.lookup import only_codes
from ticklake.schemas import INGEST_SEQ, MONTH


def as_date(value: date | int | str | None) -> date | None:
    """20240327, '20240327', '2024-03-27' or a date; anything else is a ValueError."""
    if value is None or type(value) is date:
        return value
    if hasattr(value, "date"):
        return value.date()
    digits = f"{value:08d}" if isinstance(value, int) else "".join(ch for ch in value if ch in "0123456789")
    if len(digits) != 8:
        raise ValueError(f"not a date: {value!r}")
    return date(int(digits[:4]), int(digits[4:6]), int(digits[6:]))


def date_range(df: DataFrame, column: str, begin=None, end=None) -> DataFrame:
    """Inclusive on both ends, each end optional.

    The bounds are put on the bare column (``< end + 1 day`` for times) so they reach the Parquet
    scan, and on ``month`` where the table has it so whole partitions are skipped.
    """
    begin, end = as_date(begin), as_date(end)
    is_time = isinstance(df.schema[column].dataType, (T.TimestampNTZType, T.TimestampType))
    c, kind = F.col(column), df.schema[column].dataType
    if begin is not None:
        df = df.where(c >= F.lit(begin).cast(kind))
        if MONTH in df.columns:
            df = df.where(F.col(MONTH) >= f"{begin:%Y%m}")
    if end is not None:
        upper = F.lit(end)
        df = df.where(c < F.date_add(upper, 1).cast(kind)) if is_time else df.where(c <= upper)
        if MONTH in df.columns:
            df = df.where(F.col(MONTH) <= f"{end:%Y%m}")
    return df


def _between(value: Column, low: int | None, high: int | None) -> Column | None:
    tests = ([value >= low] if low is not None else []) + ([value <= high] if high is not None else [])
    return None if not tests else tests[0] if len(tests) == 1 else tests[0] & tests[1]


def bar_time_of_day(df: DataFrame, begin_time: int | None, end_time: int | None, column="trade_time") -> DataFrame:
    """Times as HHMM; both ends kept."""
    test = _between(N.time_hhmm(column), begin_time, end_time)
    return df if test is None else df.where(test)


def snapshot_time_of_day(df: DataFrame, begin_time: int | None, end_time: int | None, column="trade_time") -> DataFrame:
    """Times as HHMMSSmmm; both ends kept."""
    test = _between(N.time_hhmmssmmm(column), begin_time, end_time)
    return df if test is None else df.where(test)


def range_read(
    table: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    codes: Sequence[str] | DataFrame | None = None,
    begin=None,
    end=None,
    code_column: str = "code",
    date_column: str = "trade_time",
    time_filter=None,
    order: str | Sequence[str] = INGEST_SEQ,
    unique_months: Sequence[str] = (),
) -> DataFrame:
    """All filters act on key columns, so they run before the dedup shuffle; only ``fields`` travel.

    Rows of ``unique_months`` (see ``Lake.unique_months``) hold each key once and are not shuffled
    at all; with every month of the range among them the read is a plain scan.
    """
    df = date_range(table, date_column, begin, end)
    if time_filter is not None:
        df = time_filter(df)
    df = only_codes(df, codes, code_column)

    def collapse(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, keys, [f for f in fields if f not in keys], order).select(*fields)

    if not unique_months:
        return collapse(df)
    unique = F.coalesce(F.col(MONTH).isin(list(unique_months)), F.lit(False))
    plain = df.where(unique).select(*fields)
    if _covers(unique_months, begin, end):
        return plain
    return plain.unionByName(collapse(df.where(~unique)))


def _covers(months: Sequence[str], begin, end) -> bool:
    """Whether the months include every month of the range."""
    begin, end = as_date(begin), as_date(end)
    if begin is None or end is None:
        return False
    wanted = {f"{y}{m:02d}" for y in range(begin.year, end.year + 1) for m in range(1, 13)}
    return {m for m in wanted if f"{begin:%Y%m}" <= m <= f"{end:%Y%m}"} <= set(months)
