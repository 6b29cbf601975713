"""High watermarks: latest date per group, common watermark, rows past the watermark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators.dedup import latest_per_key
from ticklake.operators.lookup import codes_frame, lookup_bytes, lookup_join, only_clean, only_codes
from ticklake.operators.ranges import date_range
from ticklake.sources.workspace import settle


def latest_by_group(table: DataFrame, group: Sequence[str], date_column: str, alias: str = "latest_date") -> DataFrame:
    """One row per group. The partial aggregation leaves at most one row per group and input task,
    so the size of the shuffle depends on the number of groups, not on the rows."""
    return table.groupBy(*group).agg(F.max(F.col(date_column)).cast("date").alias(alias))


def latest_date(table: DataFrame, date_column: str = "trade_date", alias: str = "latest_date") -> DataFrame:
    """Single row; NULL for an empty table."""
    return table.agg(F.max(date_column).cast("date").alias(alias))


def latest_or_today(table: DataFrame, date_column: str = "trade_date", alias: str = "latest_date") -> DataFrame:
    return table.agg(F.coalesce(F.max(date_column).cast("date"), F.current_date()).alias(alias))


def _per_code(table: DataFrame, codes: Sequence[str] | DataFrame, column: str, date_column: str) -> DataFrame:
    """Every requested code with its latest date. The codes reach the scan: as an IN list, or as a range and a join."""
    spark = table.sparkSession
    asked = settle(only_clean(codes, column), "lookups") if isinstance(codes, DataFrame) else codes_frame(spark, codes, column).select(column)
    chosen = only_codes(table, asked if isinstance(codes, DataFrame) else codes, column)
    return asked.join(latest_by_group(chosen, [column], date_column), column, "left")


def latest_date_map(
    table: DataFrame, codes: Sequence[str] | DataFrame, code_column: str = "code", date_column: str = "trade_time"
) -> DataFrame:
    """Every requested code with its latest date; NULL without history or with a date before 1990."""
    per_code = _per_code(table, codes, code_column, date_column)
    return per_code.select(code_column, N.valid_watermark("latest_date").alias("latest_date"))


def common_watermark(
    table: DataFrame,
    codes: Sequence[str] | DataFrame,
    code_column: str = "code",
    date_column: str = "trade_date",
    alias: str = "common_date",
) -> DataFrame:
    """Earliest of the codes' latest dates; NULL unless every requested code has history."""
    per_code = _per_code(table, codes, code_column, date_column)
    return per_code.agg(
        F.when(F.count("latest_date") == F.count(F.lit(1)), F.min("latest_date")).alias(alias)
    )


def group_watermarks(
    target: DataFrame, wanted: DataFrame, group: Sequence[str], date_column: str, recent_since: date | None = None
) -> DataFrame:
    """Latest date of every group in ``wanted`` that has history, written once.

    The newest rows of a group sit in its newest month. With ``recent_since`` only the months from
    there on are scanned, and the older ones just for the groups not found, usually none: the cost
    follows the recent data instead of the whole table. The date only steers the scan; any value
    gives the same watermarks.
    """
    group = list(group)
    if recent_since is None or S.MONTH not in target.columns:
        return settle(latest_by_group(target, group, date_column), "watermarks")
    recent = F.col(S.MONTH) >= f"{recent_since:%Y%m}"
    found = settle(latest_by_group(target.where(recent), group, date_column), "watermarks")
    asked = wanted.select(*group).distinct()
    missing = settle(lookup_join(asked, found, group, "left_anti", lookup_bytes(found)), "watermarks")
    size = lookup_bytes(missing)
    if size == 0:
        return found
    older = lookup_join(target.where(~recent | F.col(S.MONTH).isNull()), missing, group, "left_semi", size)
    return found.unionByName(settle(latest_by_group(older, group, date_column), "watermarks"))


def incremental_select(
    raw: DataFrame,
    target: DataFrame,
    group: Sequence[str],
    date_column: str,
    begin=None,
    end=None,
    lookback_days: int = 0,
    recent_since: date | None = None,
) -> DataFrame:
    """Raw rows past their own group's watermark, from ``begin`` to ``end``, for all groups at once.

    ``lookback_days`` re-reads the last days, for days that were loaded while still incomplete; the
    read-time dedup makes the overlap harmless.
    """
    wanted = date_range(raw, date_column, begin, end)
    latest = group_watermarks(target, wanted, group, date_column, recent_since)
    return past_watermarks(raw, latest, lookup_bytes(latest), group, date_column, begin, end, lookback_days)


def past_watermarks(
    raw: DataFrame, latest: DataFrame, size: int, group: Sequence[str], date_column: str, begin=None, end=None, lookback_days: int = 0
) -> DataFrame:
    """The same with watermarks that are known, such as ``Lake.watermarks``: (group, latest_date) of at most ``size`` bytes. Runs no job."""
    wanted = date_range(raw, date_column, begin, end)
    usable = latest.where(N.valid_watermark("latest_date").isNotNull())
    joined = lookup_join(wanted, usable, group, "left", size)
    start = N.incremental_start("latest_date", None, lookback_days)
    past = F.col(date_column).cast("date") >= start
    return joined.where(F.col("latest_date").isNull() | past).select(*raw.columns)


# ----------------------------------------------------------------- audit log

def latest_checkpoint(log: DataFrame, by: Sequence[str] = ("task_name", "scope_key")) -> DataFrame:
    """Date of the last success per task and scope; successes without a date are passed over."""
    day = F.coalesce("end_date", "start_date")
    dated = log.where((F.col("status") == S.SUCCESS) & day.isNotNull())
    return dated.groupBy(*by).agg(F.max_by(day, "finished_at").alias("checkpoint_date"))


def checkpoint_from_log(log: DataFrame) -> DataFrame:
    """Checkpoints derived from the log: last entry per task, scope, day *and status*, so a skipped
    run never hides that day's success."""
    keys = ["task_name", "scope_key", "run_date", "status"]
    with_date = log.withColumn("checkpoint_date", F.coalesce("end_date", "start_date"))
    values = ["target_table", "checkpoint_date", "row_count", "message", "finished_at"]
    return latest_per_key(with_date, keys, values, "finished_at")


def succeeded_on(log: DataFrame, by: Sequence[str] = ("task_name", "scope_key", "run_date")) -> DataFrame:
    """Success flag, run count and rows per task, scope and day; ``rows_loaded = 0`` shows an empty
    fetch that still counts as a success."""
    ok = F.col("status") == S.SUCCESS
    return log.groupBy(*by).agg(
        (F.count_if(ok) > 0).alias("succeeded"),
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum(F.when(ok, F.col("row_count"))), F.lit(0)).alias("rows_loaded"),
    )
