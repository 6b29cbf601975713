"""Mixing sources to target weights with built-in functions only: Efraimidis-Spirakis sampling to token budgets.

A source's budget is its share of all tokens by weight, capped at a multiple of its own size; what lies above the
cap is shared again by weight. A budget is met by complete epochs first and then by a weighted sample without
replacement: documents in the order of ``-ln(u) / quality``, the shortest exponential arrival times, up to the prefix
sum that comes nearest to the rest of the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import settle
from ticklake.operators.lookup import lookup_join

#: Slices of the sampling order per source. Only the slice that holds the cut is sorted, so a sort sees about one in SLICES of a source.
SLICES = 4096
MAX_EPOCHS = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """A simple quality weight in [0.05, 1]: the share of letters among the characters."""
    letters = F.length(F.regexp_replace(text, "[^\\p{L}]+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(F.try_divide(letters, F.length(text)), F.lit(0.0)))


def uniform(*identity: Column) -> Column:
    """A number in (0, 1) that depends on the identity and the seed in it only, the same on every run."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *identity)), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def sums_before(rows: DataFrame, order: Sequence[Column], **sums: Column) -> DataFrame:
    """``rows`` with the sum of each column over all rows before a row in ``order``, which must not tie.

    No task sees all rows: Spark sorts them into ranges, sums run inside a range, and a table of one row per range has what lies before it.
    """
    ranged = settle(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix_ranges")
    totals = ranged.groupBy("range").agg(*[F.sum(c).alias(f"{n}_before") for n, c in sums.items()])
    ranges_before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("range", *[F.coalesce(F.sum(f"{n}_before").over(ranges_before), F.lit(0)).alias(f"{n}_before") for n in sums])
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = [(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"{n}_before")).alias(n) for n, c in sums.items()]
    return ranged.join(F.broadcast(starts), "range").select(*rows.columns, *found)  # one row per range, of which there are as many as shuffle partitions


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, NULL last, take ``weights`` in turn. With sources in the order of cap / weight the level
    that shares what is left after the first k caps is known from running sums; the sources before the first one
    that stays below its cap are the capped ones.
    """
    by_name = F.col("source").asc_nulls_last()
    turn = (F.col("place") % len(weights)).cast("int")
    weighted = sums_before(sizes, [by_name], place=F.lit(1)).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    weighted = weighted.withColumn("cap", F.col("source_size") * float(max_epochs)).withColumn("fill", F.col("cap") / F.col("weight"))
    weighted = settle(weighted, "mix_weights")
    words, weight = weighted.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    levels = sums_before(weighted, [F.col("fill").asc(), by_name], caps=F.col("cap"), weights=F.col("weight"))
    level = (F.lit(words or 0.0) - F.col("caps")) / (F.lit(weight or 1.0) - F.col("weights"))
    # among equal fills the first in order, which has the fewest caps before it
    common = levels.where(level * F.col("weight") <= F.col("cap")).agg(F.min(F.struct("fill", "caps", level.alias("level")))["level"]).first()[0]
    target = F.col("cap") if common is None else F.least("cap", F.lit(common) * F.col("weight"))
    return weighted.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, key: str, source: str, size: Column, quality: Column, weights: Sequence[float], max_epochs: int = MAX_EPOCHS, seed: int = 0, slices: int = SLICES, keep_rows: bool = False) -> DataFrame:
    """(key, size, source_size, target, taken): the words the mix takes of each document, repeats counted.

    One row per row of ``docs``, repeated rows and NULL keys included: rows with the same key stand side by side in the sampling
    order (ties: by size; rows that agree in that too are interchangeable). ``taken`` is a whole multiple of the
    size. The cut comes as near to the budget as the document at it allows. A NULL quality counts as the lowest, 1e-6; sizes of 0
    take nothing. Only these columns are used, so others may have any names; ``keep_rows`` adds ``row``, a struct of them all.

    Skew: a source may hold any share of the rows. Sizes are summed per slice of the sampling order before the
    shuffle; whole slices below the cut are taken without sorting, and one slice per source is sorted. What is known of a source is
    broadcast up to a measured size; beyond it the rows are joined with it by source and input task.
    """
    arrival = -F.log(uniform(F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")))) / F.greatest(F.coalesce(quality.cast("double"), F.lit(1e-6)), F.lit(1e-6))
    carried = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_rows else []
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), size.cast("long").alias("size"), arrival.alias("arrival"), *carried)
    # a slice is a step of the unit exponential's distribution function: even when qualities are alike, and in order always
    rows = settle(rows.withColumn("slice", F.least(F.lit(slices - 1), F.floor((1 - F.exp(-F.col("arrival"))) * slices)).cast("int")), "mix")
    by_slice = settle(rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), "mix_slices")
    targets = settle(source_targets(by_slice.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, max_epochs), "mix_targets")
    epochs = F.least(F.lit(max_epochs), F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("int"))
    targets = targets.withColumn("epochs", epochs).withColumn("rest", F.when(F.col("epochs") < max_epochs, F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(0.0))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    plan = by_slice.withColumn("slice_start", F.coalesce(F.sum("slice_size").over(running), F.lit(0))).join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    state = F.when(F.col("slice_start") + F.col("slice_size") <= F.col("rest"), "in").when(F.col("slice_start") >= F.col("rest"), "out").otherwise("cut")
    plan = settle(plan.withColumn("state", state), "mix_plan")
    one = plan.groupBy("source").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.max("epochs").alias("epochs"), F.max("rest").alias("rest"),
        F.min(F.when(F.col("state") == "cut", F.col("slice"))).alias("cut_slice"), F.min(F.when(F.col("state") == "cut", F.col("slice_start"))).alias("cut_start"),
        F.max(F.when(F.col("state") == "in", F.col("slice"))).alias("last_in"))
    named = [F.col("source").isNull().alias("nameless"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name")]
    known = lookup_join(rows.select("*", *named), one.select(*named, *[c for c in one.columns if c != "source"]), ["nameless", "name"], "inner").drop("nameless", "name")
    at_cut = F.col("slice").eqNullSafe(F.col("cut_slice"))
    inside = Window.partitionBy("source").orderBy("arrival", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.col("cut_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = known.where(at_cut).withColumn("more", (upto + F.col("size") / 2 <= F.col("rest")).cast("int"))
    whole = known.where(~at_cut).withColumn("more", (F.col("slice") <= F.coalesce("last_in", F.lit(-1))).cast("int"))
    mixed = whole.unionByName(cut)
    taken = (F.col("size") * (F.col("epochs") + F.col("more"))).alias("taken")
    return mixed.select(F.col("id").alias(key), "size", "source_size", "target", taken, *(["row"] if keep_rows else []))
