"""Joining large tables with a lookup that holds at most one row per code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ticklake.functions.normalize import clean_text, code_list
from ticklake.sources.workspace import settle

# An IN list stays part of the filter (and reaches Parquet); beyond it the list becomes a join and its range the filter.
MAX_IN_LIST = 500
# Bytes of a lookup that may be broadcast.
MAX_BROADCAST_BYTES = 32 << 20
SALTS = 32


def row_bytes(lookup: DataFrame) -> Column:
    """Bytes of a row as Spark keeps it: text by length, anything else as eight bytes."""
    size = F.lit(16)
    for field in lookup.schema.fields:
        size = size + (F.coalesce(F.octet_length(field.name), F.lit(0)) + 16 if isinstance(field.dataType, T.StringType) else F.lit(8))
    return size


def lookup_bytes(lookup: DataFrame) -> int:
    return lookup.agg(F.sum(row_bytes(lookup))).first()[0] or 0


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    size: int | None = None,
    max_broadcast_bytes: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left, inner, left-semi or left-anti join of ``rows`` with ``lookup`` (unique on ``on``).

    Unless its ``size`` in bytes is known, the lookup is written once and measured. Up to
    ``max_broadcast_bytes`` it is broadcast and ``rows`` are not shuffled. Beyond that the join
    shuffles on the key plus a salt taken from the input task: a code that holds a third of all rows
    spreads over ``salts`` tasks, and so do copies of one row. A task re-run after a lost executor
    repeats the same salt.
    """
    on = list(on)
    limit = MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    if size is None:
        lookup = settle(lookup, "lookups")
        size = lookup_bytes(lookup)
    if size <= limit:
        return rows.join(F.broadcast(lookup), on, how)
    salted = rows.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    # Spark sizes the copies as one lookup and would broadcast all of them through the driver: shuffle them instead.
    copies = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("shuffle_merge")
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")


def code_column(codes: DataFrame) -> str:
    """The column of a frame that holds the codes: ``code``, ``market_code`` or its only one."""
    for name in ("code", "market_code"):
        if name in codes.columns:
            return name
    if len(codes.columns) != 1:
        raise ValueError(f"no code column among {codes.columns}")
    return codes.columns[0]


def only_clean(codes: DataFrame, column: str = "code") -> DataFrame:
    """Distinct codes of a frame, trimmed, blanks out, in a column of that name."""
    clean = codes.select(clean_text(F.col(f"`{code_column(codes)}`").cast("string")).alias(column))
    return clean.where(F.col(column).isNotNull()).distinct()


def distinct_in_order(codes: DataFrame, column: str = "code") -> DataFrame:
    """Requested codes (``column``, ``pos``) trimmed, blanks out, each at its first position."""
    clean = codes.select(clean_text(column).alias(column), "pos").where(F.col(column).isNotNull())
    return clean.groupBy(column).agg(F.min("pos").alias("pos"))


def codes_frame(spark: SparkSession, codes: Iterable[str], column: str = "code") -> DataFrame:
    """Request list as rows ``(column, pos)``, cleaned and distinct, in request order."""
    items = [(c, i) for i, c in enumerate(code_list(codes))]
    return spark.createDataFrame(items, f"{column} string, pos int")


def only_codes(rows: DataFrame, codes: Sequence[str] | DataFrame | None, column: str = "code") -> DataFrame:
    """Rows of the requested codes: IN filter for a short list, left-semi join otherwise.

    The range of a long list or a frame is a filter too, so that files and row groups beyond it are not read.
    """
    if codes is None:
        return rows
    if isinstance(codes, DataFrame):
        asked = settle(only_clean(codes, column), "lookups")
        low, high = asked.agg(F.min(column), F.max(column)).first()
        return lookup_join(_between(rows, column, low, high), asked, [column], "left_semi", lookup_bytes(asked))
    codes = code_list(codes)
    if len(codes) <= MAX_IN_LIST:
        return rows.where(F.col(column).isin(codes))
    frame = codes_frame(rows.sparkSession, codes, column)
    return lookup_join(_between(rows, column, min(codes), max(codes)), frame.select(column), [column], "left_semi", _list_bytes(codes))


def _between(rows: DataFrame, column: str, low: str | None, high: str | None) -> DataFrame:
    return rows.where("false") if low is None else rows.where(F.col(column).between(low, high))


def _list_bytes(codes: Sequence[str]) -> int:
    return sum(len(c.encode()) + 40 for c in codes)


def with_position(rows: DataFrame, codes: Sequence[str] | DataFrame, column: str) -> DataFrame:
    """Rows of the requested codes with ``pos``, their place in the request; a frame without ``pos`` is in code order."""
    if isinstance(codes, DataFrame):
        if "pos" not in codes.columns:
            return only_codes(rows, codes, column).withColumn("pos", F.col(column))
        return lookup_join(rows, distinct_in_order(codes, column), [column], "inner")
    codes = code_list(codes)
    if not codes:
        return rows.where("false").withColumn("pos", F.lit(0))
    frame = codes_frame(rows.sparkSession, codes, column)
    narrowed = rows.where(F.col(column).isin(codes)) if len(codes) <= MAX_IN_LIST else _between(rows, column, min(codes), max(codes))
    return lookup_join(narrowed, frame, [column], "inner", _list_bytes(codes))
