"""Key collapse: one row per key, the one with the highest order value, taken as a whole row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ticklake.schemas import INGEST_SEQ

# Beyond this, one order value per column in the aggregation buffer costs more than a sort (measured).
MAX_HASH_VALUES = 12
_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: str | Sequence[str] = INGEST_SEQ,
) -> DataFrame:
    """Last write per key; a NULL in the last row wins like any other value.

    Both plans shrink the copies of a key on the map side, so a key that holds a third of all rows
    sends one row per input task through the shuffle:

    * a few fixed-width values ordered by one whole-number column: ``max_by`` per value, which runs
      as hash aggregation with code generation. Every ``max_by`` compares the same order value, so
      all of them pick the same row.
    * otherwise (text values, wide rows, other or several order columns): ``row_number() = 1``, which
      Catalyst turns into a group limit before and after the shuffle. ``max_by`` over text or
      structs would fall back to sort aggregation, the slowest of the three.

    A NULL order is below all others in both; NaN is above all. Rows of equal order are interchangeable, so pass
    enough columns (``Lake.append`` adds all values).
    """
    order = [order] if isinstance(order, str) else list(order)
    if not values:
        return df.select(*keys).distinct()
    types = {f.name: f.dataType for f in df.schema.fields}
    narrow = len(order) == 1 and isinstance(types[order[0]], T.IntegralType) and len(values) <= MAX_HASH_VALUES
    if narrow and all(isinstance(types[c], _FIXED_WIDTH) for c in values):
        rank = F.col(order[0])
        if order[0] != INGEST_SEQ:  # which is never NULL; max_by passes over NULL orders, so they become the number below all longs
            rank = F.coalesce(rank.cast("decimal(20,0)"), F.lit("-9223372036854775809").cast("decimal(20,0)"))
        return df.groupBy(*keys).agg(*[F.max_by(F.col(v), rank).alias(v) for v in values])
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = df.withColumn("__rank", F.row_number().over(newest_first))
    return ranked.where("__rank = 1").select(*keys, *values)


def union_latest(
    old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str], order: str = INGEST_SEQ
) -> DataFrame:
    """Old rows plus new rows, one per key, newest wins."""
    columns = [*keys, *values, order]
    return latest_per_key(old.select(columns).unionByName(new.select(columns)), keys, values, order)


def new_keys(rows: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows whose key is not stored yet, for tables that consist of their key only.

    Both sides are made distinct first: copies collapse before the shuffle and the anti join reuses
    the partitioning of the two aggregations.
    """
    return rows.select(*keys).distinct().join(existing.select(*keys).distinct(), list(keys), "left_anti")
