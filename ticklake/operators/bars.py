"""Bars to longer periods, ticks to bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticklake.operators.dedup import latest_per_key

_MINUTES = {"min1": 1, "min3": 3, "min5": 5, "min10": 10, "min15": 15, "min30": 30, "min60": 60, "min120": 120}
_CALENDAR = {"week": "week", "month": "month", "season": "quarter", "year": "year"}


def period_start(period: str, column: str = "trade_time") -> Column:
    """Start of the period a time falls into; minute periods count from midnight."""
    if period in _MINUTES:
        return F.window(column, f"{_MINUTES[period]} minutes")["start"]
    day = F.col(column).cast("date")  # dates, so that the session zone plays no part
    if period == "day":
        return day.cast("timestamp_ntz")
    if period in _CALENDAR:
        return F.trunc(day, _CALENDAR[period]).cast("timestamp_ntz")
    raise ValueError(f"unknown period: {period!r}")


def kline_resample(bars: DataFrame, period: str) -> DataFrame:
    """Bars (one row per code and time) to a longer period.

    Only fixed-width buffers, so this is hash aggregation with a map-side part; a hot code sends one
    row per period and input task.
    """
    return _merged(bars.withColumn("__start", period_start(period)))


def _merged(keyed: DataFrame) -> DataFrame:
    """One bar per code and ``__start``."""
    return keyed.groupBy("code", F.col("__start").alias("period_start")).agg(
        F.min_by("open", "trade_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "trade_time").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("amount").alias("amount"),
    ).withColumnRenamed("period_start", "trade_time")


#: fixed values: trading sessions of the stock exchanges as HHMM, opening and closing auction included
SESSIONS = ((930, 1130), (1300, 1500))


def _minute_of_day(hhmm: int) -> int:
    return hhmm // 100 * 60 + hhmm % 100


def session_start(minutes: int, column: str = "trade_time", sessions: Sequence[tuple[int, int]] = SESSIONS) -> Column:
    """Start of the period of ``minutes`` traded minutes that a time falls into, counted from the day's open across the breaks.

    Breaks take no traded time: with sessions of two hours each, periods of 120 minutes are the two sessions, and one of 90
    minutes runs from 11:00 over the midday break to 14:00; it is named by its first minute. A time at a session's end belongs to its last
    period, any other time outside all sessions to none (NULL).
    """
    if minutes < 1:
        raise ValueError("a period has a minute at least")
    spans = [(_minute_of_day(a), _minute_of_day(b)) for a, b in sessions]
    if any(a >= b for a, b in spans) or any(x[1] > y[0] for x, y in zip(spans, spans[1:])):
        raise ValueError(f"sessions must follow one another: {sessions}")
    day = F.col(column).cast("date").cast("timestamp_ntz")
    clock = F.hour(column) * 60 + F.minute(column)
    exact = F.extract(F.lit("SECOND"), F.col(column)) == 0
    traded, done = F.lit(None).cast("int"), 0
    for a, b in spans:
        inside = (clock >= a) & (clock < b)
        at_end = (clock == b) & exact
        traded = F.when(inside, clock - a + done).when(at_end & traded.isNull(), F.lit(b - a + done - 1)).otherwise(traded)
        done += b - a
    first = F.floor(traded / minutes) * minutes
    start, done = F.lit(None).cast("bigint"), 0
    for a, b in spans:
        start = F.when((first >= done) & (first < done + b - a), first - done + a).otherwise(start)
        done += b - a
    return day + F.make_dt_interval(mins=start.cast("int"))


def kline_resample_sessions(bars: DataFrame, minutes: int, sessions: Sequence[tuple[int, int]] = SESSIONS) -> DataFrame:
    """Minute bars (one row per code and time) to periods of traded minutes; see ``session_start``. Bars outside the sessions are left out."""
    keyed = bars.withColumn("__start", session_start(minutes, sessions=sessions)).where(F.col("__start").isNotNull())
    return _merged(keyed)


_TICK = ("last", "volume", "amount")


def one_per_instant(ticks: DataFrame, order: Sequence[str] = (), column: str = "trade_time") -> DataFrame:
    """(code, time, last, volume, amount): of several ticks of a code at one instant the last by ``order``, as in every
    read (NULL is lowest; among equals the larger values), so a repeated or corrected tick counts once."""
    by = [*order, *[c for c in _TICK if c not in order]]
    return latest_per_key(ticks, ["code", column], _TICK, by)


def ticks_to_bars(ticks: DataFrame, minutes: int = 1, column: str = "trade_time", order: Sequence[str] = ()) -> DataFrame:
    """Ticks to bars, copies collapsed first; ``volume`` and ``amount`` are what was traded in a tick, not running totals
    of the day (see ``per_tick``)."""
    return bars_of_ticks(one_per_instant(ticks, order, column), minutes, column)


def per_tick(ticks: DataFrame, order: Sequence[str] = (), column: str = "trade_time") -> DataFrame:
    """Ticks whose ``volume`` and ``amount`` are running totals of the day, as level-1 feeds give them, to what was traded
    since the code's tick before on that day; copies collapse first. A code and day is one group."""
    day = Window.partitionBy("code", F.col(column).cast("date")).orderBy(column)
    once = one_per_instant(ticks, order, column)
    return once.select("code", column, "last", *[(F.col(c) - F.coalesce(F.lag(c).over(day), F.lit(0.0))).alias(c) for c in _TICK[1:]])


def windows_of_ticks(ticks: DataFrame, minutes: int, column: str = "trade_time", totals: bool = False) -> DataFrame:
    """Bars with their window ``w``; with ``totals`` volume and amount are the running totals at a bar's last tick."""
    traded = (lambda c: F.max_by(c, column)) if totals else F.sum
    return ticks.groupBy("code", F.window(column, f"{minutes} minutes").alias("w")).agg(
        F.min_by("last", column).alias("open"),
        F.max("last").alias("high"),
        F.min("last").alias("low"),
        F.max_by("last", column).alias("close"),
        traded("volume").alias("volume"),
        traded("amount").alias("amount"),
    )


def total_ticks_to_bars(ticks: DataFrame, minutes: int = 1, column: str = "trade_time", order: Sequence[str] = ()) -> DataFrame:
    """Ticks with running totals of the day to bars: what a bar trades is the total at its last tick less that of the code's bar before
    on that day. The window sees bars, not ticks."""
    windows = windows_of_ticks(one_per_instant(ticks, order, column), minutes, column, totals=True).withColumn("trade_time", F.col("w.start"))
    day = Window.partitionBy("code", F.col("trade_time").cast("date")).orderBy("trade_time")
    traded = [(F.col(c) - F.coalesce(F.lag(c).over(day), F.lit(0.0))).alias(c) for c in ("volume", "amount")]
    return windows.select("code", "trade_time", "open", "high", "low", "close", *traded)


def bars_of_ticks(ticks: DataFrame, minutes: int, column: str = "trade_time") -> DataFrame:
    """Ticks without copies to bars; works on batch and streaming frames alike."""
    return windows_of_ticks(ticks, minutes, column).select("code", F.col("w.start").alias("trade_time"), "open", "high", "low", "close", "volume", "amount")
