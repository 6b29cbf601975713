"""Streaming snapshots to minute bars."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ticklake.functions import normalize as N
from ticklake.operators.bars import bars_of_ticks, windows_of_ticks
from ticklake.sources.lake import Lake

WATERMARK = "5 minutes"


def stream_bars(
    ticks: DataFrame, minutes: int = 1, delay: str = WATERMARK, column: str = "trade_time", order: Sequence[str] = ()
) -> DataFrame:
    """Bars of a stream of ticks, by the same rule as in batch: of several ticks of a code at one instant the last by
    ``order`` counts. Ticks later than ``delay`` are ignored; a bar is emitted once, when the watermark has passed its
    end. State holds the ticks and open bars of the last ``delay`` only."""
    once = _one_per_instant(ticks, delay, column, order)
    return bars_of_ticks(once, minutes, column).withColumn("trade_time", N.instant_to_wall("trade_time"))


def _one_per_instant(ticks: DataFrame, delay: str, column: str, order: Sequence[str]) -> DataFrame:
    by = [*order, *[c for c in ("last", "volume", "amount") if c not in order]]
    marked = ticks.withColumn(column, N.wall_to_instant(column)).withWatermark(column, delay)
    instants = marked.groupBy("code", F.window(column, "1 microsecond").alias("at")).agg(F.max(F.struct(*by)).alias("tick"))
    return instants.select("code", F.window_time("at").alias(column), "tick.last", "tick.volume", "tick.amount")


_BAR = "code string, trade_time timestamp_ntz, open double, high double, low double, close double, volume double, amount double"
_DAY_MS = 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _SinceBarBefore(StatefulProcessor):
    """Totals of a code's finished bars to what was traded in each; keeps the last bar's day and totals."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "day string, volume double, amount double, expires long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bars = pd.concat(list(rows)).sort_values("trade_time", ignore_index=True)
        days = bars["trade_time"].dt.normalize()
        day, volume, amount, expires = self.last.get() if self.last.exists() else ("", 0.0, 0.0, 0)
        before = bars[["volume", "amount"]].shift()
        before.loc[days != days.shift()] = 0.0
        if str(days[0].date()) == day:
            before.loc[0] = [volume, amount]
        # the watermark has passed these bars, so a day past it the code's day is over
        later = timerValues.getCurrentWatermarkInMs() + _DAY_MS
        if expires:
            self.handle.deleteTimer(expires)
        self.handle.registerTimer(later)
        last = bars.iloc[-1]
        self.last.update((str(days.iloc[-1].date()), float(last["volume"]), float(last["amount"]), later))
        bars[["volume", "amount"]] -= before
        yield bars[["code", "trade_time", "open", "high", "low", "close", "volume", "amount"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_total_bars(
    ticks: DataFrame, minutes: int = 1, delay: str = WATERMARK, column: str = "trade_time", order: Sequence[str] = ()
) -> DataFrame:
    """Bars of a stream whose ``volume`` and ``amount`` are running totals of the day, as level-1 feeds give them.

    The same rules as ``stream_bars``; a bar trades its last total less that of the code's bar before on that day (nothing before
    the day's first one). A bar leaves the window when the watermark has passed its end, so a code's bars come in the order of time, also from
    batch to batch: the state is one day and two numbers per code, and goes when the watermark is a day past the code's last bar. The query
    needs the RocksDB state store (``ROCKSDB``), as all custom state does.
    """
    windows = windows_of_ticks(_one_per_instant(ticks, delay, column, order), minutes, column, totals=True)
    plain = windows.select(
        F.window_time("w").alias("at"), "code", N.instant_to_wall(F.col("w.start")).alias("trade_time"), "open", "high", "low", "close", "volume", "amount")
    return plain.groupBy("code").transformWithStateInPandas(_SinceBarBefore(), _BAR, "append", "EventTime")


def stream_into_lake(
    ticks: DataFrame, lake: Lake, checkpoint: str, minutes: int = 1, delay: str = WATERMARK, order: Sequence[str] = ()
) -> DataFrame:
    """Work off everything that has arrived and append its bars to the lake's minute bars, one load per batch.

    A batch that is repeated after a failure is a later load of the same keys, of which reads keep one. Returns the table.
    """
    def append(bars: DataFrame, batch: int) -> None:
        if not bars.isEmpty():
            lake.append("kline_minute", bars)

    query = (
        stream_bars(ticks, minutes, delay, order=order).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(append).start()
    )
    query.awaitTermination()
    return lake.read("kline_minute")


def run_stream_bars(
    ticks: DataFrame, out: str, checkpoint: str, minutes: int = 1, delay: str = WATERMARK,
    order: Sequence[str] = (), totals: bool = False, available_now: bool = True,
) -> DataFrame:
    """Work off everything that has arrived, then stop; the next run continues from ``checkpoint``. ``totals``: see ``stream_total_bars``.
    A source that cannot name what is available at the start (Python sources) takes ``available_now=False``.

    The file sink records its batches, so a repeated batch after a failure is not written twice.
    Returns the bars written so far.
    """
    spark: SparkSession = ticks.sparkSession
    bars = (stream_total_bars if totals else stream_bars)(ticks, minutes, delay, order=order)
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf, None)
    if totals:
        spark.conf.set(conf, ROCKSDB)
    try:
        writer = bars.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
        query = (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:  # a running query keeps the setting that it started with
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)
    if available_now:
        query.awaitTermination()
    else:
        query.processAllAvailable()  # the batch without data that lets the watermark close bars included
        query.stop()
    return spark.read.schema(bars.schema).parquet(out)
