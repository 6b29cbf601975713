from datetime import datetime

from ticklake.sources.workspace import scratch_path
from ticklake.streaming.ticks import run_stream_bars

SCHEMA = "code string, trade_time timestamp_ntz, last double, volume double, amount double"


def test_late_and_repeated_ticks(spark, tmp_path):
    at = lambda h, m, s=0: datetime(2024, 1, 5, h, m, s)
    batches = [
        [("a", at(9, 30, 1), 1.0, 1.0, 1.0), ("a", at(9, 30, 1), 1.0, 1.0, 1.0), ("a", at(9, 30, 59), 3.0, 1.0, 3.0)],
        [("a", at(9, 45), 5.0, 1.0, 5.0)],
        [("a", at(9, 31), 99.0, 1.0, 99.0), ("a", at(10, 30), 7.0, 1.0, 7.0)],  # 09:31 is past the watermark
    ]
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), scratch_path(spark, "stream-state")
    got = None
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        got = run_stream_bars(stream, out, state)
    bars = [tuple(r) for r in got.orderBy("trade_time").collect()]
    assert bars == [("a", at(9, 30), 1.0, 3.0, 1.0, 3.0, 2.0, 4.0), ("a", at(9, 45), 5.0, 5.0, 5.0, 5.0, 1.0, 5.0)]
