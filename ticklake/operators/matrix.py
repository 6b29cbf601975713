"""Price factors between long and wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ticklake.functions import normalize as N
from ticklake.operators.lookup import lookup_join, only_clean, only_codes
from ticklake.schemas import INGEST_SEQ
from ticklake.sources.workspace import settle


def present_codes(factors: DataFrame, codes: Sequence[str]) -> list[str]:
    """Requested codes that have data, in request order. Never more rows than the request."""
    codes = N.code_list(codes)
    found = {r["code"] for r in only_codes(factors, codes).select("code").distinct().collect()}
    return [c for c in codes if c in found]


def factor_matrix(factors: DataFrame, codes: Sequence[str], order: str = INGEST_SEQ) -> DataFrame:
    """``trade_date`` x code, columns in request order, codes without data left out.

    The pivot groups by (date, code) first, so the last-write rule is its aggregate and needs no
    extra shuffle. Column names are part of the schema, hence the one small job for the codes.
    """
    columns = present_codes(factors, codes)
    chosen = only_codes(factors, columns)
    return (
        chosen.groupBy("trade_date").pivot("code", columns)
        .agg(F.max_by("factor_value", order)).orderBy("trade_date")
        if columns else chosen.select("trade_date").limit(0)
    )


def factor_unpivot(wide: DataFrame, date_column: str = "trade_date") -> DataFrame:
    """Wide drop to long rows; empty cells give no row. Narrow: no shuffle."""
    codes = [c for c in wide.columns if c != date_column]
    kinds = {c: wide.schema[c].dataType for c in codes}
    cells = wide.select(
        F.col(date_column), *[N.typed(F.col(f"`{c}`"), kinds[c], T.DoubleType()).alias(c) for c in codes]
    )
    return cells.unpivot([date_column], [F.col(f"`{c}`") for c in codes], "code", "factor_value").where(
        F.col("factor_value").isNotNull()
    ).withColumn("code", F.trim("code"))


def factor_blocks(factors: DataFrame, codes: DataFrame, block: int = 1024, order: str = INGEST_SEQ) -> tuple[DataFrame, DataFrame]:
    """The matrix of a whole universe in blocks of codes: (trade_date, block, factors) and (code, block, place).

    ``factors`` is an array with the value of the block's code at each place (counted from 1), NULL where there is none. The kept order
    of codes is by code, and it is data: neither the plan nor the schema grows with the codes, and no code is collected. Distinct codes are
    ranged over the tasks and numbered there; the ranges' offsets are one row per task. ``codes`` may be any frame with a code column.
    A cell is the last write of its date and code; a date has a row for each block with a value on it.
    """
    index = code_index(codes, block)
    spread = lookup_join(factors.select("trade_date", "code", "factor_value", order), index, ["code"], "inner")
    cells = spread.groupBy("trade_date", "block", "place").agg(F.max_by("factor_value", order).alias("v"))
    # at most ``block`` cells a row
    packed = cells.where(F.col("v").isNotNull()).groupBy("trade_date", "block").agg(F.map_from_entries(F.collect_list(F.struct("place", "v"))).alias("m"))
    places = F.sequence(F.lit(1), F.lit(block))
    return packed.select("trade_date", "block", F.transform(places, lambda i: F.try_element_at("m", i)).alias("factors")), index


def code_index(codes: DataFrame, block: int) -> DataFrame:
    """(code, block, place) of the distinct codes in their order; written once."""
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = only_clean(codes).repartitionByRange(parts, "code")
    ranged = settle(ranged.withColumn("range", F.spark_partition_id()), "code_ranges")
    # one row per task
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.row_number().over(Window.partitionBy("range").orderBy("code")) + F.col("before") - 1
    numbered = ranged.join(F.broadcast(sizes.select("range", before.alias("before"))), "range").select("code", number.alias("n"))
    return settle(numbered.select("code", F.floor(F.col("n") / block).cast("int").alias("block"), (F.col("n") % block + 1).cast("int").alias("place")), "code_index")


def cells_of(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """Blocks back to long rows (trade_date, code, factor_value)."""
    cells = blocks.select("trade_date", "block", F.posexplode("factors").alias("at", "factor_value")).where(F.col("factor_value").isNotNull())
    placed = cells.withColumn("place", F.col("at") + 1)
    return lookup_join(placed, index, ["block", "place"], "inner").select("trade_date", "code", "factor_value")
