"""Column expressions that clean vendor text. Bad input becomes NULL, never an error."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F, types as T

from ticklake import schemas as S

EXCHANGE_ZONE = "Asia/Shanghai"
_BLANKS = " \t\r\n\f\v"
# there is no year 0
_DAY = r"^(?!0000)\d{8}$"
_STAMP = r"^(?!0000)(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})(\d{3})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- text and numbers

def clean_text(c: Column | str) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(_col(c), F.lit(_BLANKS)), F.lit(""))


# checked before a cast, because a failing try_cast costs an exception per row
_DECIMAL = r"^\s*+[-+0-9.eE]++\s*+$"
_WHOLE = r"^\s*+[-+0-9]++\s*+$"


def text_to_double(c: Column | str) -> Column:
    """Decimal or scientific notation; names such as NaN and Infinity and suffixes give NULL."""
    c = _col(c)
    return F.when(c.rlike(_DECIMAL), c.try_cast("double"))


def text_to_long(c: Column | str) -> Column:
    """Whole numbers exactly; decimal text is cut toward zero."""
    c = _col(c)
    return F.when(c.rlike(_WHOLE), c.try_cast("bigint")).otherwise(text_to_double(c).try_cast("bigint"))


def clear_nan(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def join_list(c: Column | str) -> Column:
    """``[1, 4, 62]`` -> ``"1,4,62"``."""
    c = _col(c)
    return F.when(c.isNotNull(), F.concat_ws(",", c))


# ----------------------------------------------------------------- dates and times

def _digits(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def text_to_date(c: Column | str) -> Column:
    """Any text whose digits are exactly YYYYMMDD."""
    digits = _digits(c)
    return F.when(digits.rlike(_DAY), F.try_to_date(digits, "yyyyMMdd"))


def int_to_date(c: Column | str) -> Column:
    return text_to_date(F.lpad(_col(c).cast("string"), 8, "0"))


def text_to_time(c: Column | str) -> Column:
    """Text with 8, 12, 14 or 17 digits (date, minute, second, millisecond) as exchange wall clock.

    The cast goes through an ISO string to ``timestamp_ntz``, so the session zone plays no part.
    """
    digits = _digits(c)
    iso = F.regexp_replace(F.rpad(digits, 17, "0"), _STAMP, "$1-$2-$3 $4:$5:$6.$7")
    return F.when(F.length(digits).isin(8, 12, 14, 17), iso.try_cast("timestamp_ntz"))


def instant_to_time(c: Column | str) -> Column:
    """An instant (``timestamp``) as exchange wall clock."""
    return F.convert_timezone(F.current_timezone(), F.lit(EXCHANGE_ZONE), _col(c).cast("timestamp_ntz"))


_DAY_MICROS = 86_400_000_000


def wall_to_instant(c: Column | str) -> Column:
    """Wall clock as the instant that shows the same digits in UTC, whatever the session zone.

    Streaming watermarks need ``timestamp``; :func:`instant_to_wall` turns the result back.
    """
    c = _col(c)
    minutes = (F.hour(c) * 60 + F.minute(c)).cast("bigint")
    micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return F.timestamp_micros(
        F.unix_date(c.cast("date")) * F.lit(_DAY_MICROS) + minutes * F.lit(60_000_000) + micros
    )


def instant_to_wall(c: Column | str) -> Column:
    micros = F.unix_micros(_col(c))
    day = F.date_from_unix_date(F.floor(micros / _DAY_MICROS).cast("int")).cast("timestamp_ntz")
    rest = F.pmod(micros, F.lit(_DAY_MICROS)).cast("decimal(18,6)") / 1_000_000
    zero = F.lit(0)
    return day + F.make_dt_interval(zero, zero, zero, rest.cast("decimal(18,6)"))


def date_to_int(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def date_to_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMMdd")


def date_to_midnight(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def month_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMM")


def time_hhmm(c: Column | str) -> Column:
    c = _col(c)
    return F.hour(c) * 100 + F.minute(c)


def time_hhmmssmmm(c: Column | str) -> Column:
    c = _col(c)
    millis = F.floor(F.extract(F.lit("SECOND"), c) * 1000).cast("int")
    return F.hour(c) * 10_000_000 + F.minute(c) * 100_000 + millis


def natural_days(start: Column, end: Column) -> Column:
    """One row per calendar day, both ends included; use inside ``select``."""
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))


def valid_watermark(c: Column | str) -> Column:
    """A latest date before 1990 comes from dirty rows and counts as no history."""
    c = _col(c)
    return F.when(c >= F.lit(S.EARLIEST_VALID_DATE).cast("date"), c)


def incremental_start(latest: Column | str, begin: Column | str | None, lookback_days: int = 0) -> Column:
    """First day to load: the day after ``latest``, not before ``begin``; NULLs drop out."""
    after = F.date_add(_col(latest), 1 - lookback_days)
    return after if begin is None else F.greatest(after, _col(begin))


def typed(c: Column | str, source: T.DataType, target: T.DataType) -> Column:
    """Convert one raw column to a table type, whatever shape the drop used."""
    c = _col(c)
    textual = isinstance(source, T.StringType)
    if isinstance(source, T.NullType):
        return c.cast(target)
    if isinstance(target, T.StringType):
        if isinstance(source, T.ArrayType):
            return join_list(c)
        if isinstance(source, T.FractionalType) and not isinstance(source, T.DecimalType):
            return F.when(~F.isnan(c), c).cast("string")
        return clean_text(c.cast("string"))
    if isinstance(source, T.FractionalType) and isinstance(target, (T.DateType, T.TimestampNTZType)):
        # whole numbers that gaps in a frame have turned into doubles
        whole = c.cast("double")
        c, source = F.when(whole == F.floor(whole), whole.try_cast("bigint")), T.LongType()
    if isinstance(target, T.DateType):
        if textual:
            return text_to_date(c)
        if isinstance(source, T.IntegralType):
            return int_to_date(c)
        return instant_to_time(c).cast("date") if isinstance(source, T.TimestampType) else c.cast("date")
    if isinstance(target, T.TimestampNTZType):
        if textual:
            return text_to_time(c)
        if isinstance(source, T.IntegralType):
            return text_to_time(c.cast("string"))
        return instant_to_time(c) if isinstance(source, T.TimestampType) else c.cast(target)
    if isinstance(target, T.DoubleType):
        return text_to_double(c) if textual else clear_nan(c.cast("double"))
    if isinstance(target, (T.IntegerType, T.LongType)):
        if textual:
            return text_to_long(c).try_cast(target)
        return (clear_nan(c) if isinstance(source, T.FractionalType) else c).try_cast(target)
    return c.cast(target)


# ----------------------------------------------------------------- codes

def normalize_codes(codes: Column | str) -> Column:
    """Array of codes: trimmed, blanks out, first occurrence kept, order kept."""
    trimmed = F.transform(_col(codes), clean_text)
    return F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull()))


def split_codes(text: Column | str) -> Column:
    """``"a, b,,c"`` -> ``[a, b, c]`` (repeats kept)."""
    parts = F.transform(F.split(_col(text), ","), clean_text)
    return F.filter(parts, lambda x: x.isNotNull())


def keep_code(code: Column | str, security_type: Column | str) -> Column:
    """Universe rule: non-blank, and a Beijing stock only if its number starts with 920."""
    text = clean_text(code)
    beijing_stock = _col(security_type).isin(*S.STOCK_TYPES) & text.endswith(".BJ")
    return text.isNotNull() & (~F.coalesce(beijing_stock, F.lit(False)) | text.startswith("920"))


def codes_digest(codes: Column | str) -> Column:
    return F.substring(F.sha1(F.array_join(F.array_sort(_col(codes)), ",")), 1, 12)


def scope_key(prefix: Column, codes: Column | str, *fields: tuple[str, Column | str]) -> Column:
    """``<prefix>|code_count=..|codes_sha1=..|name=value..``; a NULL field is written empty."""
    parts = [
        prefix,
        F.concat(F.lit("code_count="), F.size(_col(codes)).cast("string")),
        F.concat(F.lit("codes_sha1="), codes_digest(codes)),
    ]
    for name, value in fields:
        parts.append(F.concat(F.lit(f"{name}="), F.coalesce(_col(value).cast("string"), F.lit(""))))
    return F.concat_ws("|", *parts)


def scope_text(prefix: str, codes: Sequence[str] | tuple[int, str] | None = None, **fields: object) -> str:
    """Driver-side twin of :func:`scope_key` for the request of one load; ``codes`` may be the number and digest of a
    frame's codes. Without codes the scope is that of all of them."""
    parts = [prefix] if prefix else []
    if isinstance(codes, tuple):
        parts += [f"code_count={codes[0]}", f"codes_hash={codes[1]}"]
    elif codes is not None:
        digest = hashlib.sha1(",".join(sorted(codes)).encode()).hexdigest()[:12]
        parts += [f"code_count={len(codes)}", f"codes_sha1={digest}"]
    parts += [f"{k}={'' if v is None else v}" for k, v in fields.items()]
    return "|".join(parts)


def code_list(codes: Iterable[str] | str) -> list[str]:
    """Driver-side request list: trimmed, blanks out, distinct, in request order."""
    items = codes.split(",") if isinstance(codes, str) else codes
    return list(dict.fromkeys(t for t in (str(c).strip() for c in items) if t))


# ----------------------------------------------------------------- labels

def label(c: Column | str, labels: dict[int, str]) -> Column:
    """Text for an integer code from one of the fixed label tables; unknown codes give NULL."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(c).cast("int"))


def status_flags(c: Column | str) -> Column:
    """``"1,4,62"`` -> ``[1, 4, 62]``; flags are not exclusive."""
    return F.filter(
        F.transform(F.split(_col(c), ","), lambda x: text_to_long(x).cast("int")), lambda x: x.isNotNull()
    )
