"""Membership intervals, session-anchored bars, factor blocks and running totals against plain versions."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from ticklake.operators import bars as B, lookup, matrix, membership
from ticklake.sources.workspace import scratch_path
from ticklake.streaming.ticks import run_stream_bars

D0 = date(2024, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


# ----------------------------------------------------------------- memberships

@pytest.mark.parametrize("limit", [None, 0])
def test_folding_and_opening_are_inverse(spark, limit, monkeypatch):
    if limit is not None:
        monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", limit)
    rng = random.Random(4)
    open_days = sorted(rng.sample(range(400), 260))
    held = {(k, c, day(d)) for k in "XY" for c in ("a", "b", "c") for d in open_days if rng.random() < 0.8}
    calendar = spark.createDataFrame([("SH", day(d)) for d in open_days] * 2 + [("SH", None)], "market string, trade_date date")
    closed = [(day(d), "X", "a") for d in range(400) if d not in open_days][:9]
    daily = spark.createDataFrame([(d, k, c) for k, c, d in held] * 2 + closed + [(None, "X", "a"), (day(0), None, "a")], "trade_date date, security_type string, code string")
    folded = membership.fold(daily, calendar)
    index = {day(d): i for i, d in enumerate(open_days)}
    want = set()
    for k in "XY":
        for c in "abc":
            own = sorted(index[d] for a, b, d in held if (a, b) == (k, c))
            cuts = [0, *[i for i in range(1, len(own)) if own[i] != own[i - 1] + 1], len(own)]
            want |= {(k, c, day(open_days[own[a]]), day(open_days[own[b - 1]])) for a, b in zip(cuts, cuts[1:])}
    assert set(rows(folded)) == want and folded.count() == len(want) < len(held) / 2
    assert set(rows(membership.members_on(folded, calendar))) == {(d, k, c) for k, c, d in held}
    assert membership.fold(daily.limit(0), calendar).count() == 0 == membership.members_on(folded, calendar.limit(0)).count()


def test_open_and_long_memberships(spark):
    intervals = spark.createDataFrame([
        ("X", "ever", None, None), ("X", "from", day(50), None), ("X", "till", None, day(50)), ("X", "none", day(9), day(3)), ("X", "twice", day(0), day(60)), ("X", "twice", day(40), day(90))],
        "security_type string, code string, in_date date, out_date date")
    days = spark.createDataFrame([(day(50),), (day(1000),), (day(50),), (None,)], "trade_date date")
    got = membership.members_on(intervals, days)
    assert rows(got, "trade_date", "code") == sorted([(day(50), c) for c in ("ever", "from", "till", "twice")] + [(day(1000), c) for c in ("ever", "from")], key=repr)
    assert "Cartesian" not in plan(got) and "NestedLoop" not in plan(got)


# ----------------------------------------------------------------- sessions

def plain_start(at: datetime, minutes: int):
    spans = [(570, 690), (780, 900)]
    m, done, traded = at.hour * 60 + at.minute, 0, None
    for a, b in spans:
        if a <= m < b:
            traded = m - a + done
        elif m == b and at.second == 0:
            traded = b - a + done - 1
        done += b - a
    if traded is None:
        return None
    first = traded // minutes * minutes
    return datetime(at.year, at.month, at.day) + timedelta(minutes=570 + first if first < 120 else 780 + first - 120)


@pytest.mark.parametrize("minutes", [1, 5, 7, 60, 90, 120, 240])
def test_periods_count_traded_minutes(spark, minutes):
    times = [datetime(2024, 1, 5) + timedelta(minutes=m) for m in range(1440)] + [datetime(2024, 1, 5, 11, 30, 1), datetime(2024, 1, 5, 9, 30, 59)]
    frame = spark.createDataFrame([(t,) for t in times], "trade_time timestamp_ntz")
    got = dict(rows(frame.select("trade_time", B.session_start(minutes))))
    assert got == {t: plain_start(t, minutes) for t in times}


def test_sessions_must_make_sense(spark):
    for sessions in (((1300, 1500), (930, 1130)), ((930, 930),)):
        with pytest.raises(ValueError):
            B.session_start(5, sessions=sessions)
    with pytest.raises(ValueError):
        B.session_start(0)
    bars = spark.createDataFrame([("a", datetime(2024, 1, 5, 12), 1.0)], "code string, trade_time timestamp_ntz, open double")
    whole = bars.withColumns({c: F.lit(1.0) for c in ("high", "low", "close", "volume", "amount")})
    assert B.kline_resample_sessions(whole, 5).count() == 0
    night = B.kline_resample_sessions(whole, 30, sessions=((1145, 1215),))
    assert rows(night, "trade_time") == [(datetime(2024, 1, 5, 11, 45),)]


# ----------------------------------------------------------------- blocks of codes

def test_blocks_hold_the_matrix_of_any_universe(spark):
    rng = random.Random(2)
    codes = [f"c{i:03d}" for i in range(70)]
    data = [(day(rng.randrange(5)), rng.choice(codes), rng.choice([None, 1.5, 2.5]), i) for i in range(900)]
    factors = spark.createDataFrame(data, "trade_date date, code string, factor_value double, ingest_seq bigint")
    blocks, index = matrix.factor_blocks(factors, spark.createDataFrame([(c,) for c in codes[:50] * 2], "code string"), 16)
    last = {(d, c): v for d, c, v, _ in data if c in codes[:50]}
    assert rows(matrix.cells_of(blocks, index)) == sorted(((d, c, v) for (d, c), v in last.items() if v is not None), key=repr)
    assert rows(index) == [(c, i // 16, i % 16 + 1) for i, c in enumerate(codes[:50])]
    assert {r[0] for r in rows(blocks, F.size("factors"))} == {16}
    other, _ = matrix.factor_blocks(factors, spark.createDataFrame([(c,) for c in codes], "code string"), 16)
    assert blocks.columns == other.columns and len(plan(blocks)) == pytest.approx(len(plan(other)), rel=0.1)
    assert matrix.factor_blocks(factors.limit(0), factors, 4)[0].count() == 0


# ----------------------------------------------------------------- running totals

SCHEMA = "code string, trade_time timestamp_ntz, last double, volume double, amount double"


def test_totals_give_the_bars_of_single_ticks(spark):
    rng = random.Random(1)
    single, totals = [], []
    for code in "ab":
        for d in range(3):
            volume = amount = 0.0
            for m in sorted(rng.sample(range(570, 700), 40)):
                at, price, lots = datetime(2024, 1, 2 + d) + timedelta(minutes=m), float(rng.randrange(9)), float(rng.randrange(5))
                volume, amount = volume + lots, amount + price * lots
                single.append((code, at, price, lots, price * lots))
                totals.append((code, at, price, volume, amount))
    got = B.total_ticks_to_bars(spark.createDataFrame(totals * 2, SCHEMA), 5)
    want = B.ticks_to_bars(spark.createDataFrame(single, SCHEMA), 5)
    assert rows(got) == rows(want)
    assert rows(B.ticks_to_bars(B.per_tick(spark.createDataFrame(totals, SCHEMA)), 5)) == rows(want)


def test_a_stream_of_totals_stops_and_goes_on(spark, tmp_path):
    """Repeats, a late tick, a stop after every batch, a new day and a code that comes back after days."""
    at = lambda d, h, m, s=0: datetime(2024, 1, d, h, m, s)
    batches = [
        [("a", at(5, 9, 30, 1), 1.0, 10.0, 10.0), ("a", at(5, 9, 30, 1), 1.0, 10.0, 10.0), ("b", at(5, 9, 30), 2.0, 5.0, 10.0), ("a", at(5, 9, 31), 3.0, 14.0, 22.0)],
        [("a", at(5, 9, 45), 5.0, 20.0, 52.0)],
        [("a", at(5, 9, 32), 99.0, 15.0, 99.0), ("a", at(5, 14, 59), 7.0, 21.0, 59.0)],  # 09:32 is past the watermark
        [("a", at(6, 9, 30), 4.0, 3.0, 12.0)],
        [("b", at(9, 9, 30), 2.0, 1.0, 2.0), ("a", at(9, 9, 30), 2.0, 1.0, 2.0)],
        [("c", at(12, 9, 30), 1.0, 1.0, 1.0)],
    ]
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), scratch_path(spark, "stream-state")
    got = None
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        got = run_stream_bars(spark.readStream.schema(SCHEMA).parquet(source), out, state, totals=True)
    bars = [(r["code"], r["trade_time"], r["close"], r["volume"], r["amount"]) for r in got.orderBy("trade_time", "code").collect()]
    assert bars == [
        ("a", at(5, 9, 30), 1.0, 10.0, 10.0), ("b", at(5, 9, 30), 2.0, 5.0, 10.0), ("a", at(5, 9, 31), 3.0, 4.0, 12.0), ("a", at(5, 9, 45), 5.0, 6.0, 30.0),
        ("a", at(5, 14, 59), 7.0, 1.0, 7.0), ("a", at(6, 9, 30), 4.0, 3.0, 12.0), ("a", at(9, 9, 30), 2.0, 1.0, 2.0), ("b", at(9, 9, 30), 2.0, 1.0, 2.0)]
