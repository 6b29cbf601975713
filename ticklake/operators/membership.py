"""Memberships as intervals: daily members folded into stretches of trading days, and members on given days by time bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticklake.operators.lookup import lookup_join
from ticklake.sources.workspace import settle

#: days of a time bin of the interval join
BIN_DAYS = 64
KEY = ("security_type", "code")


def numbered_days(calendar: DataFrame) -> DataFrame:
    """(trade_date, n): the calendar's distinct days, numbered in their order.

    Days are counted per month first, so that no window sees more than the months or the days of one month.
    """
    days = calendar.select("trade_date").where(F.col("trade_date").isNotNull()).distinct().withColumn("__month", F.trunc("trade_date", "month"))
    months = days.groupBy("__month").agg(F.count(F.lit(1)).alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.orderBy("__month").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = months.select("__month", before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__month").orderBy("trade_date"))
    return days.withColumn("__at", inside).join(offsets, "__month").select("trade_date", (F.col("__before") + F.col("__at")).alias("n"))


def fold(members: DataFrame, calendar: DataFrame) -> DataFrame:
    """(security_type, code, in_date, out_date) from daily members: one row per stretch of trading days without a gap.

    A stretch's days have the same difference between the day's number in the calendar and its rank among the member's days.
    Days that the calendar does not have neither cut nor make a stretch; rows with NULLs and repeated rows do not count. At rest the rows fall from one a day to
    one a change. A member's own days are one group of the window: as many as a calendar has, whatever the number of members.
    """
    days = settle(numbered_days(calendar), "numbered_days")
    daily = members.select("trade_date", *KEY).dropna().distinct()
    # a day of the calendar is one row; the join is broadcast if that is small
    known = lookup_join(daily, days, ["trade_date"], "inner")
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy("n"))
    stretches = known.withColumn("__stretch", F.col("n") - rank)
    return stretches.groupBy(*KEY, "__stretch").agg(F.min("trade_date").alias("in_date"), F.max("trade_date").alias("out_date")).drop("__stretch")


def _bin(day: str) -> Column:
    return F.floor(F.unix_date(day) / BIN_DAYS)


def members_on(intervals: DataFrame, days: DataFrame) -> DataFrame:
    """(trade_date, security_type, code): members on each of ``days``, distinct.

    Both sides go into bins of days, which makes the range join an equi-join: an interval is one row per bin that it touches
    within the asked days, and meets the bin's days as one array. Nothing is shuffled by bin while the days are few enough to be broadcast;
    beyond that the join is salted by input task, since a bin holds as many members as there are. An interval without ``out_date`` is open, one without ``in_date`` always was.
    """
    asked = days.select("trade_date").where(F.col("trade_date").isNotNull()).distinct()
    first, last = asked.agg(F.min("trade_date"), F.max("trade_date")).first()
    if first is None:
        return intervals.select(F.lit(None).cast("date").alias("trade_date"), *KEY).where("false")
    start, end = (F.lit(d).cast("date") for d in (first, last))
    cut = intervals.select(*KEY, F.greatest(F.coalesce("in_date", start), start).alias("a"), F.least(F.coalesce("out_date", end), end).alias("b")).where("a <= b")
    binned = cut.withColumn("bin", F.explode(F.sequence(_bin("a"), _bin("b"))))
    per_bin = asked.groupBy(_bin("trade_date").alias("bin")).agg(F.array_agg("trade_date").alias("days"))
    # at most BIN_DAYS days a bin
    opened = lookup_join(binned, per_bin, ["bin"], "inner").select(*KEY, "a", "b", F.explode("days").alias("trade_date"))
    return opened.where(F.col("trade_date").between(F.col("a"), F.col("b"))).select("trade_date", *KEY).distinct()
