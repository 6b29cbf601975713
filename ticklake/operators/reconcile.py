"""Late and corrected rows: a drop and a table compared by digests per group and day, without shuffling their rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ticklake.operators.dedup import latest_per_key
from ticklake.operators.lookup import MAX_BROADCAST_BYTES, lookup_bytes, lookup_join
from ticklake.schemas import INGEST_SEQ, MONTH
from ticklake.sources.workspace import discard, settle

DAY = "__day"
SAME, NEW, CHANGED, GONE = "same", "new", "changed", "gone"


def _row_hash(columns: Sequence[str]) -> Column:
    """NULL and NaN have hashes of their own, and 0.0 and -0.0 the same one."""
    parts = [F.coalesce(F.xxhash64(F.lit(i), c), F.lit(0)) for i, c in enumerate(columns)]
    return F.xxhash64(*parts, *[F.col(c).isNull() for c in columns])


def day_digests(rows: DataFrame, group: Sequence[str], date_column: str, columns: Sequence[str]) -> DataFrame:
    """(group, day, n, digest): number of rows and an order-free digest of them.

    Hashes are summed in two halves of 32 bits as decimals would be in one, so the sums cannot overflow; the aggregation leaves one
    row per cell and input task for the shuffle. Repeated rows count repeatedly.
    """
    keyed = rows.select(*group, F.col(date_column).cast("date").alias(DAY), _row_hash(columns).alias("__hash"))
    low, high = F.col("__hash").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("__hash", 32)
    return keyed.groupBy(*group, DAY).agg(F.count(F.lit(1)).alias("n"), F.struct(F.sum(low).alias("low"), F.sum(high).alias("high")).alias("digest"))


def stored_view(stored: DataFrame, key: Sequence[str], values: Sequence[str], unique_months: Sequence[str] = ()) -> DataFrame:
    """One row per key; rows of ``unique_months`` (see ``Lake.unique_months``) are taken as they are, without a shuffle."""
    if not unique_months or MONTH not in stored.columns:
        return latest_per_key(stored, key, values, INGEST_SEQ).select(*key, *values)
    unique = F.coalesce(F.col(MONTH).isin(list(unique_months)), F.lit(False))
    rest = latest_per_key(stored.where(~unique), key, values, INGEST_SEQ)
    return stored.where(unique).select(*key, *values).unionByName(rest.select(*key, *values))


def compare_days(drop: DataFrame, stored: DataFrame, group: Sequence[str], date_column: str, columns: Sequence[str]) -> DataFrame:
    """(group, day, n_drop, n_stored, state) of every cell that either side has: same, new (only in the drop), gone
    (only stored) or changed. Groups and days that are NULL do not compare."""
    on = [*group, DAY]
    a = day_digests(drop, group, date_column, columns).withColumnsRenamed({"n": "n_drop", "digest": "d"})
    b = day_digests(stored, group, date_column, columns).withColumnsRenamed({"n": "n_stored", "digest": "s"})
    both = a.join(b, on, "full_outer")
    state = (
        F.when(F.col("n_stored").isNull(), NEW).when(F.col("n_drop").isNull(), GONE)
        .when((F.col("n_drop") == F.col("n_stored")) & (F.col("d") == F.col("s")), SAME).otherwise(CHANGED)
    )
    return both.select(*on, "n_drop", "n_stored", state.alias("state")).withColumnRenamed(DAY, "day")


def _of_cells(rows: DataFrame, cells: DataFrame, group: Sequence[str], date_column: str, size: int) -> DataFrame:
    dated = rows.withColumn(DAY, F.col(date_column).cast("date"))
    return lookup_join(dated, cells.withColumnRenamed("day", DAY), [*group, DAY], "left_semi", size).drop(DAY)


def missing_rows(
    drop: DataFrame,
    view: DataFrame,
    key: Sequence[str],
    values: Sequence[str],
    group: Sequence[str],
    date_column: str,
    order: Sequence[str] = (),
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """The drop's rows that ``view`` (one row per key) lacks or holds with other values, one per key, whatever their date.

    Only cells (group, day) whose digests differ are looked at row by row, so the shuffle carries one small row per cell and
    task, and then the rows of the days that are really late. Copies of a key in the drop make its cell differ; the row
    comparison sees that nothing is new.

    Cells beyond ``max_broadcast_bytes`` are not joined with the rows: their copies per salt (see ``lookup_join``) would be the largest
    shuffle of all. Then every key is compared, on the key as it is, which finds the same rows: days of equal digests hold equal ones. What was
    found is written once, so that its shuffles are gone before the next ones.
    """
    columns = [*key, *values]
    cells = compare_days(drop, view, group, date_column, columns).where(F.col("state").isin(NEW, CHANGED))
    cells = settle(cells.select(*group, "day"), "late_cells")
    size = lookup_bytes(cells)
    if not size:
        return drop.select(*columns).where("false")
    by = [*order, *[v for v in values if v not in order]]
    whole = size > (MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes)
    if whole:  # groups and days that are NULL do not compare
        discard(cells)
        dated = [F.col(c).isNotNull() for c in (*group, date_column)]
        some, known = drop.where(reduce(Column.__and__, dated)), view
    else:
        some, known = (_of_cells(rows, cells, group, date_column, size) for rows in (drop, view))
    late = latest_per_key(some, key, values, by)
    old = known.select(*key, _row_hash(values).alias("__known"))
    missing = late.join(old, list(key), "left").where(~F.col("__known").eqNullSafe(_row_hash(values))).select(*columns)
    return settle(missing, "late_rows") if whole else missing  # which the caller may discard
