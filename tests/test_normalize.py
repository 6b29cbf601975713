from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators.ranges import as_date


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def each(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr("v")).collect()]


def test_dates(spark):
    texts = ["20240327", "2024-03-27", " 2024/03/27 ", "", None, "2024032", "20240230", "00000101", "202403271"]
    want = [date(2024, 3, 27)] * 3 + [None] * 6
    assert each(spark, texts, "string", N.text_to_date) == want
    assert each(spark, [20240327, 101, None], "int", N.int_to_date) == [date(2024, 3, 27), None, None]
    day = F.lit(date(2024, 3, 27))
    assert one(spark, N.date_to_int(day), N.date_to_text(day), N.date_to_midnight(day), N.month_key(day)) == (
        20240327, "20240327", datetime(2024, 3, 27), "202403")


def test_times(spark):
    texts = ["20240327", "202403270930", "20240327093001", "20240327093001123", "2024-03-27 09:30:01",
             "123456789", "", None, "20240327253001", "2024-03-27T09:30:01.007", "00000327"]
    want = [datetime(2024, 3, 27), datetime(2024, 3, 27, 9, 30), datetime(2024, 3, 27, 9, 30, 1),
            datetime(2024, 3, 27, 9, 30, 1, 123000), datetime(2024, 3, 27, 9, 30, 1), None, None, None, None,
            datetime(2024, 3, 27, 9, 30, 1, 7000), None]
    assert each(spark, texts, "string", N.text_to_time) == want


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_session_zone_plays_no_part(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on this day does not exist in New York
        wall = N.text_to_time(F.lit("20240310023000500"))
        back = N.instant_to_wall(N.wall_to_instant(wall))
        instant = F.timestamp_micros(F.lit(1711503000000000))  # 2024-03-27 01:30 UTC
        assert one(spark, wall, back, N.instant_to_time(instant), N.time_hhmm(wall), N.time_hhmmssmmm(wall)) == (
            datetime(2024, 3, 10, 2, 30, 0, 500000), datetime(2024, 3, 10, 2, 30, 0, 500000),
            datetime(2024, 3, 27, 9, 30), 230, 23000500)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_numbers(spark):
    texts = ["12.7", " 12.7 ", " ", "", "x", "NaN", None, "1e3", "-5", "1f", "inf"]
    assert each(spark, texts, "string", N.text_to_double) == [
        12.7, 12.7, None, None, None, None, None, 1000.0, -5.0, None, None]
    assert each(spark, texts, "string", N.text_to_long) == [12, 12, None, None, None, None, None, 1000, -5, None, None]
    assert each(spark, [" 9007199254740993 ", "-12.9", "1e30", "5L", "0x10"], "string", N.text_to_long) == [
        9007199254740993, -12, None, None, None]
    assert each(spark, [float("nan"), 1.5, None], "double", N.clear_nan) == [None, 1.5, None]
    assert each(spark, [" a ", "\t\n", None], "string", N.clean_text) == ["a", None, None]
    assert each(spark, [["1", "4", "62"], [], None], "array<string>", N.join_list) == ["1,4,62", "", None]


def test_codes(spark):
    raw = [[" b", "a", "", "b", "  ", "a "]]
    assert each(spark, raw, "array<string>", N.normalize_codes) == [["b", "a"]]
    assert each(spark, ["a, b,,a "], "string", N.split_codes) == [["a", "b", "a"]]
    assert N.code_list([" b", "a", "", "b"]) == ["b", "a"]
    assert N.code_list("a, b,,a ") == ["a", "b"]


@pytest.mark.parametrize("code,kind,keep", [
    ("920001.BJ", "EXTRA_STOCK_A", True), ("430001.BJ", "EXTRA_STOCK_A", False), ("430001.BJ", "BJ_A", False),
    ("430001.BJ", "BJ_INDEX", True), ("600000.SH", "SH_A", True), (" ", "SH_A", False), (None, "SH_A", False),
    ("430001.BJ", None, True),
])
def test_universe_rule(spark, code, kind, keep):
    assert one(spark, N.keep_code(F.lit(code).cast("string"), F.lit(kind).cast("string"))) == (keep,)


def test_scope_key_is_the_same_on_both_sides_and_keeps_zero_apart_from_unset(spark):
    codes = F.array(F.lit("b"), F.lit("a"))
    zero = N.scope_key(F.lit("task=q"), codes, ("begin_date", F.lit(None)), ("begin_time", F.lit(0)))
    unset = N.scope_key(F.lit("task=q"), codes, ("begin_date", F.lit(None)), ("begin_time", F.lit(None)))
    got = one(spark, zero, unset)
    assert got == (N.scope_text("task=q", ["b", "a"], begin_date=None, begin_time=0),
                   N.scope_text("task=q", ["b", "a"], begin_date=None, begin_time=None))
    assert got[0] != got[1]
    assert "codes_sha1=" + __import__("hashlib").sha1(b"a,b").hexdigest()[:12] in got[0]


@pytest.mark.parametrize("latest,begin,start", [
    (None, "2024-01-05", date(2024, 1, 5)), ("2024-01-05", None, date(2024, 1, 6)),
    ("2024-01-05", "2024-01-02", date(2024, 1, 6)), ("2024-01-05", "2024-02-01", date(2024, 2, 1)),
    (None, None, None),
])
def test_incremental_start(spark, latest, begin, start):
    d = lambda x: F.lit(x).cast("date")
    assert one(spark, N.incremental_start(d(latest), d(begin))) == (start,)


def test_labels(spark):
    assert each(spark, [62, 8, 99, None], "int", lambda c: N.label(c, S.SECURITY_STATUS_LABELS)) == [
        S.SECURITY_STATUS_LABELS[62], "恢复上市首日", None, None]
    assert each(spark, ["1, 4,x,62"], "string", N.status_flags) == [[1, 4, 62]]


def test_as_date():
    assert as_date(20240327) == as_date("2024-03-27") == as_date(datetime(2024, 3, 27, 9)) == date(2024, 3, 27)
    for bad in ("2024", 999999999):
        with pytest.raises(ValueError):
            as_date(bad)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(min_value=datetime(1990, 1, 1), max_value=datetime(2100, 1, 1)), min_size=1, max_size=20))
def test_time_text_round_trip(spark, times):
    times = [t.replace(microsecond=t.microsecond // 1000 * 1000) for t in times]
    texts = [t.strftime("%Y%m%d%H%M%S") + f"{t.microsecond // 1000:03d}" for t in times]
    assert each(spark, texts, "string", N.text_to_time) == times
