"""Load statistics and reject counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def load_stats(rows: DataFrame, date_column: str, previous: DataFrame | None = None) -> DataFrame:
    """Row count, first date, last date; the last date never falls behind ``previous.latest_date``."""
    stats = rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(date_column).cast("date").alias("min_date"),
        F.max(date_column).cast("date").alias("max_date"),
    )
    if previous is not None:
        latest = previous.select("latest_date").scalar()
        stats = stats.withColumn("max_date", F.greatest("max_date", latest))
    return stats


def reject_counts(rows: DataFrame, mandatory: Sequence[str]) -> DataFrame:
    """How many rows fail each mandatory field, and how many are kept."""
    missing = [F.col(c).isNull() for c in mandatory]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    return rows.agg(
        *[F.count_if(m).alias(f"missing_{c}") for c, m in zip(mandatory, missing)],
        F.count_if(any_missing).alias("rejected"),
        F.count_if(~any_missing).alias("kept"),
    )


def reject_reason(mandatory: Sequence[str]) -> Column:
    """Which mandatory fields a row lacks, as ``missing code, trade_time``; NULL for a good row."""
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in mandatory]))
    return F.when(F.size(lacking) > 0, F.concat(F.lit("missing "), F.array_join(lacking, ", ")))
