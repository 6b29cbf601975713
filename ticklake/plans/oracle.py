"""SQL twins of the registered queries, for the same Parquet tables (DuckDB dialect)."""

from __future__ import annotations

from ticklake import schemas as S

# ----------------------------------------------------------------- sample tables

BARS = """bars AS (
  SELECT CAST(l_partkey AS VARCHAR) AS code, l_shipdate AS trade_time,
         l_extendedprice / l_quantity * (1 - l_discount) AS open,
         l_extendedprice / l_quantity * (1 + l_tax) AS high,
         l_extendedprice / l_quantity * (1 - l_discount) AS low,
         l_extendedprice / l_quantity AS close, l_quantity AS volume, l_extendedprice AS amount,
         l_orderkey * 8 + l_linenumber AS ingest_seq, l_linestatus
  FROM lineitem)"""

USER_CODE = """lpad(CAST(user_id AS VARCHAR), 6, '0')
         || CASE user_id % 3 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' ELSE '.BJ' END"""
LOTS = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

MINUTES = f"""minutes AS (
  SELECT {USER_CODE} AS code, date_trunc('minute', ts) AS trade_time, value AS open, value + 1 AS high,
         value - 1 AS low, value AS close, CAST({LOTS} AS DOUBLE) AS volume, value * {LOTS} AS amount,
         event_id AS ingest_seq
  FROM events)"""

_FILLED = {
    "trade_time": "ts", "code": USER_CODE, "last": "value", "open": "value", "high": "value", "low": "value",
    "close": "value", "volume": f"CAST({LOTS} AS DOUBLE)", "amount": f"value * {LOTS}",
    "num_trades": "CAST(1 AS DOUBLE)", "trading_phase_code": "upper(substr(event_type, 1, 1))",
    **{f"ask_price{i}": f"value + {i}" for i in range(1, 6)},
    **{f"bid_price{i}": f"value - {i}" for i in range(1, 6)},
    **{f"{side}_volume{i}": f"{LOTS} + {i}" for side in ("ask", "bid") for i in range(1, 6)},
    "open_interest": f"{LOTS} * 10", "contract_type": "event_type", "trading_day": "strftime(ts, '%Y%m%d')",
    "nominal_price": "value * 2",
}
_SQL_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
_TICK_COLUMNS = ", ".join(
    f"{_FILLED[f.name]} AS {f.name}" if f.name in _FILLED
    else f"CAST(NULL AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
    for f in S.TABLES["market_snapshot"].schema.fields
)
TICKS = f"ticks AS (SELECT {_TICK_COLUMNS}, event_id AS ingest_seq FROM events)"

INFO = """info AS (
  SELECT CASE p_type WHEN 'ECONOMY' THEN 'EXTRA_STOCK_A' WHEN 'STANDARD' THEN 'SH_A' WHEN 'PROMO' THEN 'EXTRA_ETF'
              WHEN 'SMALL' THEN 'EXTRA_KZZ' WHEN 'MEDIUM' THEN 'EXTRA_INDEX_A' ELSE 'BJ_A' END AS security_type,
         rpad(CAST(p_partkey AS VARCHAR), 6, '0')
         || CASE p_size % 3 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' ELSE '.BJ' END AS code,
         p_name AS symbol, (p_size % 17) || ',' || (57 + p_size % 12) AS security_status_raw,
         p_retailprice AS pre_close, p_retailprice * CAST(1.1 AS DOUBLE) AS high_limited,
         p_retailprice * CAST(0.9 AS DOUBLE) AS low_limited, CAST(0.01 AS DOUBLE) AS price_tick,
         p_partkey AS ingest_seq
  FROM part)"""
KEEP = """(NOT (security_type IN ('EXTRA_STOCK_A', 'SH_A', 'SZ_A', 'BJ_A', 'EXTRA_STOCK_A_SH_SZ')
           AND code LIKE '%.BJ') OR code LIKE '920%')"""

CALENDAR = """calendar AS (
  SELECT CASE o_orderstatus WHEN 'O' THEN 'SH' WHEN 'F' THEN 'SZ' ELSE 'BJ' END AS market,
         CAST(o_orderdate AS DATE) AS trade_date, o_orderpriority FROM orders)"""
MEMBERS = """members AS (
  SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderpriority AS security_type,
         CAST(o_custkey AS VARCHAR) AS code FROM orders)"""
FACTORS = """factors AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'adj' ELSE 'backward' END AS factor_type,
         CAST(l_shipdate AS DATE) AS trade_date, CAST(l_partkey AS VARCHAR) AS code,
         1 - l_discount AS factor_value, l_orderkey * 8 + l_linenumber AS ingest_seq FROM lineitem)"""
LINE_FACTORS = """line_factors AS (
  SELECT trade_date, code, factor_value FROM (
    SELECT CAST(l_shipdate AS DATE) AS trade_date, CAST(l_linenumber AS VARCHAR) AS code,
           1 - l_discount AS factor_value,
           row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE), l_linenumber
                              ORDER BY l_orderkey DESC, l_partkey DESC) AS rn
    FROM lineitem) WHERE rn = 1)"""
BASIC = """basic AS (
  SELECT CAST(d.day AS DATE) AS snapshot_date, CAST(c_custkey AS VARCHAR) AS market_code,
         CASE v.version WHEN 2 THEN upper(c_name) ELSE c_name END AS security_name, c_name AS comp_name,
         lower(substr(c_name, 1, 3)) AS pinyin, CASE v.version WHEN 1 THEN c_name END AS comp_name_eng,
         20000101 + c_nationkey AS list_date, CAST(NULL AS INTEGER) AS delist_date,
         c_mktsegment AS listplate_name, CAST(NULL AS VARCHAR) AS comp_sname_eng,
         CASE WHEN c_acctbal >= 0 THEN 1 ELSE 3 END AS is_listed, CAST(v.version AS BIGINT) AS ingest_seq
  FROM customer, (VALUES ('2024-01-02'), ('2024-01-03'), ('2024-01-04')) AS d(day), (VALUES (1), (2)) AS v(version)
  WHERE d.day < '2024-01-04' OR c_acctbal >= 0)"""
STATUS = """status AS (
  SELECT CAST(o_orderdate AS DATE) AS trade_date, CAST(o_custkey AS VARCHAR) AS market_code,
         o_totalprice AS preclose, o_totalprice * CAST(1.1 AS DOUBLE) AS high_limited,
         o_totalprice * CAST(0.9 AS DOUBLE) AS low_limited, CAST(0.1 AS DOUBLE) AS price_high_lmt_rate,
         CAST(-0.1 AS DOUBLE) AS price_low_lmt_rate, substr(o_orderpriority, 1, 1) AS is_st_sec,
         o_orderstatus AS is_susp_sec, CAST(NULL AS VARCHAR) AS is_wd_sec, CAST(NULL AS VARCHAR) AS is_xr_sec,
         o_orderkey AS ingest_seq FROM orders)"""
LOG = """log AS (
  SELECT event_type AS task_name, 'user=' || user_id AS scope_key, CAST(ts AS DATE) AS run_date,
         CASE event_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'skipped' END AS status,
         'kline_daily' AS target_table,
         CASE WHEN event_id % 10 <> 0 THEN CAST(ts AS DATE) - 1 END AS start_date,
         CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS end_date,
         event_id % 100 AS row_count, props AS message, ts AS started_at, ts AS finished_at FROM events)"""
DIRTY = """dirty AS (
  SELECT event_id,
    CASE event_id % 8 WHEN 0 THEN strftime(ts, '%Y%m%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d')
      WHEN 2 THEN ' ' || strftime(ts, '%Y/%m/%d') || ' ' WHEN 3 THEN '' WHEN 4 THEN substr(strftime(ts, '%Y%m%d'), 1, 7)
      WHEN 5 THEN strftime(ts, '%Y') || '0230' WHEN 7 THEN strftime(ts, '%Y%m%d') END AS date_text,
    CASE event_id % 8 WHEN 0 THEN strftime(ts, '%Y%m%d') WHEN 1 THEN strftime(ts, '%Y%m%d%H%M')
      WHEN 2 THEN strftime(ts, '%Y%m%d%H%M%S') WHEN 3 THEN strftime(ts, '%Y%m%d%H%M%S%g')
      WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 5 THEN ' ' WHEN 6 THEN strftime(ts, '%Y%m%d') || '9'
      WHEN 7 THEN strftime(ts, '%Y/%m/%d %H.%M.%S.%g') END AS time_text,
    CASE event_id % 7 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN ' ' || CAST(value AS VARCHAR) || ' '
      WHEN 2 THEN ' ' WHEN 3 THEN 'x' WHEN 5 THEN 'NaN' WHEN 6 THEN '-' || CAST(value AS VARCHAR) END AS number_text
  FROM events)"""


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def _latest(source: str, keys: str, columns: str, where: str = "true", order: str = "ingest_seq") -> str:
    """Whole-row last write per key."""
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order} DESC) AS rn "
        f"FROM {source} WHERE {where}) WHERE rn = 1"
    )


KLINE = ", ".join(S.KLINE_FIELDS)
BAR_KEY = "code, trade_time"
PERIOD = "trade_time >= DATE '1996-01-01' AND trade_time < DATE '2001-01-01'"
TICK_PERIOD = "CAST(trade_time AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-29'"
HHMM = "hour(trade_time) * 100 + minute(trade_time)"
HHMMSSMMM = "hour(trade_time) * 10000000 + minute(trade_time) * 100000 + millisecond(trade_time)"
STATUS_DB = ", ".join(c for c in S.STATUS_NAMES.values())
STATUS_VENDOR = ", ".join(
    f"strftime({c}, '%Y%m%d') AS {v}" if c == "trade_date" else f"{c} AS {v}" for v, c in S.STATUS_NAMES.items()
)
BASIC_VENDOR = ", ".join(f"{c} AS {v}" for v, c in S.STOCK_BASIC_NAMES.items())
INFO_COLUMNS = ", ".join(S.TABLES["code_info"].columns)


def _labels(labels: dict[int, str], name: str) -> str:
    return f"{name}(k, label) AS (VALUES " + ", ".join(f"({k}, '{v}')" for k, v in labels.items()) + ")"


def _common(source: str, requested: str, code: str = "code", day: str = "trade_date") -> str:
    return (
        f"SELECT CASE WHEN count(*) = count(latest) THEN min(latest) END AS common_date FROM "
        f"(SELECT DISTINCT {code} FROM {requested}) r LEFT JOIN "
        f"(SELECT {code}, CAST(max({day}) AS DATE) AS latest FROM {source} GROUP BY {code}) l USING ({code})"
    )


def _resample(source: str, start: str) -> str:
    unique = _latest(source, BAR_KEY, "*", "true")
    return (
        f"SELECT code, CAST({start} AS TIMESTAMP) AS trade_time, arg_min(open, trade_time) AS open, "
        f"max(high) AS high, min(low) AS low, arg_max(close, trade_time) AS close, sum(volume) AS volume, "
        f"round(sum(amount), 2) AS amount FROM ({unique}) GROUP BY code, {start}"
    )


def _minutes(n: int) -> str:
    return f"time_bucket(INTERVAL '{n} minutes', trade_time, TIMESTAMP '2000-01-01')"


def _incremental(lookback: int) -> str:
    return _with(BARS) + (
        "SELECT code, trade_time, close, volume, ingest_seq FROM bars LEFT JOIN "
        "(SELECT code, CAST(max(trade_time) AS DATE) AS latest FROM bars WHERE l_linestatus = 'F' GROUP BY code) w "
        f"USING (code) WHERE {PERIOD} AND (latest IS NULL OR CAST(trade_time AS DATE) >= latest + {1 - lookback})"
    )


_DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"
_DAY = f"CASE WHEN length({_DIGITS.format('date_text')}) = 8 THEN CAST(try_strptime({_DIGITS.format('date_text')}, '%Y%m%d') AS DATE) END"
_MONTH = "strftime(trade_time, '%Y%m') AS month"
_LOADED_KLINE = _latest("bars", BAR_KEY, "trade_time, code, open, high, low, close, volume, amount")
_TICK_COLS = ", ".join(S.SNAPSHOT_LAYOUTS["snapshot"])
_STREAM_BARS = """
  SELECT code, trade_time, open, high, low, close, volume, amount FROM (
    SELECT code, time_bucket(INTERVAL '5 minutes', trade_time, TIMESTAMP '2000-01-01') AS trade_time,
           arg_min(last, trade_time) AS open, max(last) AS high, min(last) AS low, arg_max(last, trade_time) AS close,
           sum(volume) AS volume, round(sum(amount), 2) AS amount
    FROM ticks GROUP BY code, time_bucket(INTERVAL '5 minutes', trade_time, TIMESTAMP '2000-01-01'))"""

ORACLE: dict[str, str] = {
    "kline_daily_range": _with(BARS) + _latest(
        "bars", BAR_KEY, KLINE, f"{PERIOD} AND code IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)"),
    "kline_bucketed_range": _with(BARS) + _latest("bars", BAR_KEY, KLINE, PERIOD),
    "kline_minute_range": _with(MINUTES) + _latest(
        "minutes", BAR_KEY, KLINE, f"{TICK_PERIOD} AND {HHMM} BETWEEN 930 AND 1500"),
    "kline_time_of_day": _with(MINUTES) + f"SELECT {KLINE}, ingest_seq FROM minutes WHERE {HHMM} BETWEEN 930 AND 1130",
    "snapshot_range": _with(TICKS) + _latest(
        "ticks", BAR_KEY, _TICK_COLS, f"{TICK_PERIOD} AND {HHMMSSMMM} BETWEEN 93000000 AND 150000000"),
    "snapshot_time_of_day": _with(TICKS) + f"SELECT code, trade_time, last, {HHMMSSMMM} AS at FROM ticks "
        f"WHERE {HHMMSSMMM} BETWEEN 93000000 AND 113000000",
    **{
        kind.replace("snapshot", "snapshot_layout", 1): _with(TICKS) + _latest("ticks", BAR_KEY, ", ".join(fields), TICK_PERIOD)
        for kind, fields in S.SNAPSHOT_LAYOUTS.items()
    },
    "price_factor_long": _with(FACTORS) + _latest(
        "factors", "factor_type, trade_date, code", "factor_type, trade_date, code, factor_value"),
    "factor_matrix": _with(LINE_FACTORS) + "SELECT trade_date, " + ", ".join(
        f"max(CASE WHEN code = '{c}' THEN factor_value END) AS \"{c}\"" for c in "7312456"
        ) + " FROM line_factors GROUP BY trade_date",
    "factor_unpivot": _with(LINE_FACTORS) + "SELECT trade_date, code, factor_value FROM line_factors",
    "stock_basic_asof": _with(BASIC) + _latest(
        "basic", "market_code", BASIC_VENDOR,
        "snapshot_date = (SELECT min(latest) FROM (SELECT max(snapshot_date) AS latest FROM basic GROUP BY market_code))"),
    "history_stock_status": _with(STATUS) + _latest(
        "status", "market_code, trade_date", STATUS_VENDOR,
        "trade_date >= DATE '1996-01-01' AND market_code IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)"),
    "request_order": _with(STATUS) + "SELECT market_code, latest_date, -c_custkey AS pos FROM "
        "(SELECT market_code, max(trade_date) AS latest_date FROM status GROUP BY market_code) "
        "JOIN customer ON market_code = CAST(c_custkey AS VARCHAR)",
    "trade_calendar": _with(CALENDAR) + "SELECT DISTINCT strftime(trade_date, '%Y%m%d') AS trade_date FROM calendar WHERE market = 'SH'",
    "trade_calendar_datetime": _with(CALENDAR) + "SELECT DISTINCT CAST(trade_date AS TIMESTAMP) AS trade_date FROM calendar WHERE market = 'SZ'",
    "latest_calendar_date": _with(CALENDAR) + "SELECT market, max(trade_date) AS latest_date FROM calendar GROUP BY market",
    "latest_membership_date": _with(MEMBERS) + "SELECT security_type, max(trade_date) AS latest_date FROM members GROUP BY security_type",
    "latest_trade_date": _with(CALENDAR) + "SELECT coalesce(max(trade_date), current_date) AS latest_date FROM calendar",
    "hist_code_list": _with(MEMBERS) + "SELECT DISTINCT code FROM members WHERE security_type = '1-URGENT' "
        "AND trade_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'",
    "membership_daily": _with(MEMBERS, CALENDAR) + "SELECT DISTINCT c.trade_date, m.security_type, m.code FROM members m JOIN "
        "(SELECT DISTINCT trade_date FROM calendar WHERE market = 'SH' AND trade_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31') c "
        "ON c.trade_date BETWEEN m.trade_date AND m.trade_date + 5",
    "code_info_latest": _with(INFO) + _latest("info", "security_type, code", INFO_COLUMNS, KEEP),
    "code_info_view": _with(INFO) + _latest(
        "info", "code", "code, symbol, security_status_raw AS security_status, pre_close, high_limited, low_limited, price_tick",
        f"security_type = 'EXTRA_STOCK_A' AND {KEEP}"),
    "security_universe": _with(INFO) + f"SELECT DISTINCT code FROM info WHERE security_type = 'EXTRA_STOCK_A' AND {KEEP}",
    "code_universe_filter": _with(INFO) + f"SELECT security_type, code, {KEEP} AS keep FROM info",
    "universe_sample": _with(INFO) + "SELECT DISTINCT code FROM info ORDER BY code LIMIT 100",
    "codes_in_request_order": f"SELECT {USER_CODE} AS code, min(event_id) AS pos FROM events GROUP BY 1",
    "normalize_codes": "SELECT p_partkey, CASE WHEN p_name = p_type THEN p_name ELSE p_name || '|' || p_type END AS codes FROM part",
    "codes_available": "SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS code FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)",
    "status_labels": _with(INFO, _labels(S.SECURITY_STATUS_LABELS, "labels")) +
        "SELECT ingest_seq, flag, label FROM (SELECT ingest_seq, CAST(unnest(string_split(security_status_raw, ',')) AS INTEGER) AS flag "
        "FROM info) f LEFT JOIN labels ON labels.k = f.flag",
    "listed_labels": _with(BASIC, _labels(S.LISTED_LABELS, "a"), _labels(S.STATEMENT_TYPE_LABELS, "b"), _labels(S.DIVIDEND_PROGRESS_LABELS, "c")) +
        "SELECT snapshot_date, market_code, is_listed, a.label AS label, b.label AS statement, c.label AS dividend, ingest_seq "
        "FROM basic LEFT JOIN a ON a.k = is_listed LEFT JOIN b ON b.k = is_listed LEFT JOIN c ON c.k = is_listed",
    "latest_date_map": _with(STATUS) + "SELECT market_code, latest_date FROM (SELECT CAST(p_partkey AS VARCHAR) AS market_code FROM part) "
        "LEFT JOIN (SELECT market_code, max(trade_date) AS latest_date FROM status GROUP BY market_code) USING (market_code)",
    "incremental_start": _with(STATUS) + "SELECT market_code, "
        "CASE WHEN latest + 1 > DATE '2001-06-01' THEN latest + 1 ELSE DATE '2001-06-01' END AS start_date, latest + 1 AS open_start, "
        "CASE WHEN latest - 2 > DATE '2001-06-01' THEN latest - 2 ELSE DATE '2001-06-01' END AS lookback_start "
        "FROM (SELECT CAST(p_partkey AS VARCHAR) AS market_code FROM part) "
        "LEFT JOIN (SELECT market_code, max(trade_date) AS latest FROM status GROUP BY market_code) USING (market_code)",
    "common_watermark_kline": _with(BARS) + _common("bars", "(SELECT * FROM bars WHERE code LIKE '%7%')", day="trade_time"),
    "common_watermark_minute": _with(MINUTES) + _common("minutes", "minutes", day="trade_time"),
    "common_watermark_snapshot": _with(TICKS) + _common("ticks", "ticks", day="trade_time"),
    "common_watermark_factor": _with(FACTORS, "back AS (SELECT * FROM factors WHERE factor_type = 'backward')") + _common("back", "(SELECT * FROM back WHERE code LIKE '%7%')"),
    "common_watermark_stock_basic": _with(BASIC) + _common("basic", "basic", "market_code", "snapshot_date"),
    "common_watermark_status": _with(STATUS) + _common("status", "(SELECT * FROM status WHERE market_code LIKE '%7%')", "market_code"),
    "common_watermark_missing": _with(STATUS, "asked AS (SELECT CAST(p_partkey AS VARCHAR) AS market_code FROM part)")
        + _common("status", "asked", "market_code"),
    "incremental_select": _incremental(0),
    "incremental_lookback": _incremental(30),
    "latest_checkpoint": _with(LOG) + "SELECT task_name, scope_key, arg_max(coalesce(end_date, start_date), finished_at) AS checkpoint_date "
        "FROM log WHERE status = 'success' AND coalesce(end_date, start_date) IS NOT NULL GROUP BY task_name, scope_key",
    "checkpoint_from_log": _with(LOG) + _latest(
        "log", "task_name, scope_key, run_date, status",
        "task_name, scope_key, run_date, status, target_table, coalesce(end_date, start_date) AS checkpoint_date, row_count, message, finished_at",
        order="finished_at"),
    "succeeded_today": _with(LOG) + "SELECT task_name, scope_key, run_date, count(*) FILTER (WHERE status = 'success') > 0 AS succeeded, "
        "count(*) AS runs, CAST(coalesce(sum(row_count) FILTER (WHERE status = 'success'), 0) AS BIGINT) AS rows_loaded "
        "FROM log GROUP BY task_name, scope_key, run_date",
    "load_stats": "SELECT count(*) AS row_count, CAST(min(l_shipdate) AS DATE) AS min_date, CAST(greatest(max(l_shipdate), "
        "(SELECT max(o_orderdate) FROM orders)) AS DATE) AS max_date FROM lineitem",
    "normalize_dates": _with(DIRTY) + "SELECT event_id, day, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS as_int, strftime(day, '%Y%m%d') AS as_text, "
        f"CAST(day AS TIMESTAMP) AS midnight, strftime(day, '%Y%m') AS month, day AS round_trip FROM (SELECT event_id, {_DAY} AS day FROM dirty)",
    "normalize_timestamps": _with(DIRTY) + "SELECT event_id, CASE length(d) WHEN 8 THEN try_strptime(d, '%Y%m%d') "
        "WHEN 12 THEN try_strptime(d, '%Y%m%d%H%M') WHEN 14 THEN try_strptime(d, '%Y%m%d%H%M%S') "
        "WHEN 17 THEN try_strptime(substr(d, 1, 14), '%Y%m%d%H%M%S') + to_milliseconds(CAST(substr(d, 15, 3) AS BIGINT)) END AS at "
        f"FROM (SELECT event_id, {_DIGITS.format('time_text')} AS d FROM dirty)",
    "normalize_numbers": _with(DIRTY) + "SELECT event_id, as_text, x AS as_double, CAST(trunc(x) AS BIGINT) AS as_long FROM "
        "(SELECT event_id, nullif(trim(number_text), '') AS as_text, "
        "CASE WHEN NOT isnan(TRY_CAST(trim(number_text) AS DOUBLE)) THEN TRY_CAST(trim(number_text) AS DOUBLE) END AS x FROM dirty)",
    "reject_counts": "SELECT count(*) FILTER (WHERE l_linenumber = 7) AS missing_code, count(*) FILTER (WHERE l_quantity = 50) AS missing_trade_time, "
        "count(*) FILTER (WHERE l_linenumber = 7 OR l_quantity = 50) AS rejected, "
        "count(*) FILTER (WHERE NOT (l_linenumber = 7 OR l_quantity = 50)) AS kept FROM lineitem",
    "raw_kline": "SELECT l_shipdate AS trade_time, CAST(l_partkey AS VARCHAR) AS code, l_discount AS open, l_tax AS high, CAST(NULL AS DOUBLE) AS low, "
        "l_quantity AS close, CAST(l_orderkey AS DOUBLE) AS volume, CAST(l_suppkey AS DOUBLE) AS amount FROM lineitem "
        "WHERE l_linenumber <> 7 AND l_quantity <> 50",
    "raw_snapshot": f"SELECT date_trunc('milliseconds', ts) AS trade_time, {USER_CODE} AS code, value AS last, event_id AS ask_volume1, "
        "CAST(1.5 AS DOUBLE) AS pre_settle, event_type AS underlying_security_code, CAST(NULL AS INTEGER) AS expire_date FROM events",
    "raw_status": "SELECT CAST(o_orderdate AS DATE) AS trade_date, CAST(o_custkey AS VARCHAR) AS market_code, o_totalprice AS preclose, "
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS is_st_sec, o_orderstatus AS is_susp_sec, "
        "CAST(NULL AS VARCHAR) AS is_wd_sec FROM orders",
    "raw_calendar": _with(DIRTY) + f"SELECT 'SH' AS market, {_DAY} AS trade_date FROM dirty WHERE {_DAY} IS NOT NULL",
    "raw_code_info": _with(INFO) + "SELECT 'EXTRA_STOCK_A' AS security_type, code, CASE WHEN p_type <> 'PROMO' THEN symbol END AS symbol, "
        "(p_size % 17) || ',62' AS security_status_raw, pre_close, CAST(NULL AS DOUBLE) AS high_limited, CAST(NULL AS DOUBLE) AS low_limited, "
        "CAST(NULL AS DOUBLE) AS price_tick FROM info JOIN part ON p_partkey = ingest_seq WHERE code NOT LIKE '%.BJ' OR code LIKE '920%'",
    "raw_stock_basic": "SELECT DATE '2024-01-02' AS snapshot_date, CAST(c_custkey AS VARCHAR) AS market_code, c_name AS security_name, "
        "CAST(NULL AS VARCHAR) AS comp_name, CAST(NULL AS VARCHAR) AS pinyin, CAST(NULL AS VARCHAR) AS comp_name_eng, "
        "20000101 + c_nationkey AS list_date, CAST(trunc(c_acctbal) AS INTEGER) AS delist_date, CAST(NULL AS VARCHAR) AS listplate_name, "
        "CAST(NULL AS VARCHAR) AS comp_sname_eng, 1 AS is_listed FROM customer WHERE c_acctbal >= 0",
    "raw_factors": _with(LINE_FACTORS) + "SELECT 'backward' AS factor_type, trade_date, code, factor_value FROM line_factors",
    "scope_key": "SELECT p_partkey, 'task=get_stock_basic|code_count=' || len(string_split(p_name, ' ')) || '|codes_sha1=' || "
        "substr(sha1(array_to_string(list_sort(string_split(p_name, ' ')), ',')), 1, 12) || '|begin_date=|brand=' || p_brand || '|size=' || p_size "
        "AS scope_key FROM part",
    "natural_days": _with(MEMBERS) + "SELECT security_type, code, trade_date + CAST(n.i AS INTEGER) AS day FROM members, range(6) AS n(i)",
    "append_rows": _with(BARS) + _latest(
        "bars", "code, trade_time, l_linestatus = 'O'",
        f"{KLINE}, CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS BIGINT) AS ingest_seq, {_MONTH}"),
    "union_old_new": _with(BARS) + _latest("bars", BAR_KEY, KLINE),
    "compact_month": _with(BARS) + _latest(
        "bars", BAR_KEY, f"{KLINE}, CAST(2 AS BIGINT) AS ingest_seq, {_MONTH}", order="l_linestatus <> 'O' DESC, ingest_seq"),
    "kline_after_compaction": _with(BARS) + _latest(
        "bars", BAR_KEY, KLINE, "trade_time >= DATE '1996-01-01' AND code IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)",
        order="l_linestatus <> 'O' DESC, ingest_seq"),
    "append_new": _with(CALENDAR) + "SELECT market, trade_date, CAST(CASE WHEN bool_or(o_orderpriority = '1-URGENT') THEN 1 ELSE 2 END AS BIGINT) "
        "AS ingest_seq, strftime(trade_date, '%Y%m') AS month FROM calendar GROUP BY market, trade_date",
    "load_calendar": _with(CALENDAR) + "SELECT DISTINCT market, trade_date FROM calendar",
    "load_code_info": _with(INFO) + _latest("info", "security_type, code", INFO_COLUMNS),
    "load_membership": _with(MEMBERS) + "SELECT DISTINCT trade_date, security_type, code FROM members",
    **{
        f"load_{kind}_factor": _with(FACTORS) + _latest(
            "factors", "factor_type, trade_date, code", "factor_type, trade_date, code, factor_value", f"factor_type = '{kind}'")
        for kind in S.FACTOR_TYPES
    },
    "load_stock_basic": _with(BASIC) + _latest("basic", "snapshot_date, market_code", "snapshot_date, " + ", ".join(S.STOCK_BASIC_NAMES.values())),
    "load_status": _with(STATUS) + _latest("status", "market_code, trade_date", STATUS_DB),
    "load_kline_daily": _with(BARS) + _LOADED_KLINE,
    "load_kline_minute": _with(MINUTES) + _latest("minutes", BAR_KEY, KLINE),
    "load_snapshot": _with(TICKS) + _latest("ticks", BAR_KEY, _TICK_COLS),
    "load_audit": _with(STATUS, "n AS (SELECT DISTINCT trade_date, market_code FROM status)") +
        "SELECT 'get_history_stock_status' AS task_name, 'task=get_history_stock_status|begin_date=|end_date=' AS scope_key, run_date, status, "
        "'history_stock_status' AS target_table, checkpoint_date, row_count FROM ("
        "SELECT DATE '2024-01-01' AS run_date, 'success' AS status, max(trade_date) AS checkpoint_date, count(*) AS row_count FROM n WHERE trade_date <= DATE '1998-06-30' "
        "UNION ALL SELECT DATE '2024-01-02', 'success', max(trade_date), count(*) FROM n WHERE trade_date > DATE '1998-06-30' "
        "UNION ALL SELECT DATE '2024-01-02', 'skipped', max(trade_date), 0 FROM n)",
    **{f"kline_resample_min{n}": _with(MINUTES) + _resample("minutes", _minutes(n)) for n in (3, 5, 10, 15, 30, 60, 120)},
    "kline_resample_day": _with(MINUTES) + _resample("minutes", "date_trunc('day', trade_time)"),
    **{
        f"kline_resample_{name}": _with(BARS) + _resample("bars", f"date_trunc('{unit}', trade_time)")
        for name, unit in {"week": "week", "month": "month", "season": "quarter", "year": "year"}.items()
    },
    "ticks_to_bars": _with(TICKS) + _STREAM_BARS,
    "tick_stream_to_bars": _with(TICKS) + _STREAM_BARS
        + " WHERE trade_time + INTERVAL '5 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '5 minutes'",
}
ORACLE["kline_daily_ordered"] = ORACLE["kline_daily_range"]

# ----------------------------------------------------------------- requests by frame, corrections, open members, copies of ticks

_SEVEN = "SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 3 = 0"
_HALVES = "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_extendedprice / l_quantity END"
_ALL_DAYS = "range(DATE '1996-02-01', DATE '1996-02-11', INTERVAL 1 DAY)"
_TRADED = """traded AS (SELECT DISTINCT trade_date FROM calendar WHERE market = 'SH' AND day(trade_date) % 10 <> 7)"""
#: traded minutes since the open of a day with sessions 9:30-11:30 and 13:00-15:00, and the time of such a minute
_TRADED_MINUTE = """CASE WHEN m >= 570 AND m < 690 THEN m - 570 WHEN m = 690 THEN 119 WHEN m >= 780 AND m < 900 THEN m - 660 WHEN m = 900 THEN 239 END"""


def _session_bars(n: int) -> str:
    return _with(MINUTES, f"u AS ({_latest('minutes', BAR_KEY, '*')})", "c AS (SELECT *, hour(trade_time) * 60 + minute(trade_time) AS m FROM u)",
                 f"t AS (SELECT *, ({_TRADED_MINUTE}) // {n} * {n} AS p FROM c)") + (
        "SELECT code, date_trunc('day', trade_time)::TIMESTAMP + to_minutes(CAST(CASE WHEN p < 120 THEN p + 570 ELSE p + 660 END AS BIGINT)) AS trade_time, "
        "arg_min(open, t.trade_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, t.trade_time) AS close, sum(volume) AS volume, "
        "round(sum(amount), 2) AS amount FROM t WHERE p IS NOT NULL GROUP BY code, date_trunc('day', t.trade_time), p")


ORACLE |= {
    "membership_intervals": _with(MEMBERS, CALENDAR, _TRADED, "numbered AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS n FROM traded)",
        "daily AS (SELECT DISTINCT security_type, code, d.trade_date, n FROM members m JOIN numbered d ON d.trade_date BETWEEN m.trade_date AND m.trade_date + 5 "
        "AND d.trade_date < DATE '1997-01-01')",
        "s AS (SELECT *, n - row_number() OVER (PARTITION BY security_type, code ORDER BY n) AS stretch FROM daily)")
        + "SELECT security_type, code, min(trade_date) AS in_date, max(trade_date) AS out_date FROM s GROUP BY security_type, code, stretch",
    "members_on_days": _with(MEMBERS, CALENDAR) + "SELECT DISTINCT c.trade_date, m.security_type, m.code FROM members m JOIN "
        "(SELECT DISTINCT trade_date FROM calendar WHERE market = 'SH' AND day(trade_date) <= 2 AND trade_date >= DATE '1996-01-01') c "
        "ON c.trade_date >= m.trade_date AND (m.code LIKE '%33' OR c.trade_date <= m.trade_date + 5)",
    "factor_blocks": _with(FACTORS) + _latest(
        "factors", "trade_date, code", "trade_date, code, factor_value", "factor_type = 'backward' AND code IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)"),
    "factor_block_index": _with(FACTORS, "i AS (SELECT CAST(p_partkey AS VARCHAR) AS code, (row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1) // 64 AS block FROM part)")
        + "SELECT trade_date, CAST(block AS INTEGER) AS block, 64 AS places, CAST(count(DISTINCT code) AS INTEGER) AS filled FROM factors JOIN i USING (code) "
          "WHERE factor_type = 'adj' GROUP BY trade_date, block",
    **{f"kline_resample_sessions_{n}": _session_bars(n) for n in (5, 60, 90, 120)},
    "kline_for_universe": _with(BARS, "daily AS (SELECT * FROM bars WHERE trade_time >= DATE '1996-01-01' AND trade_time < DATE '1997-01-01')")
        + _latest("daily", BAR_KEY, KLINE, f"code IN ({_SEVEN})"),
    "load_two_frames": _with(BARS) + _latest("bars", BAR_KEY, KLINE, "CAST(code AS BIGINT) % 4 IN (0, 1)"),
    "load_kline_corrections": _with(BARS, f"""drop_rows AS (
        SELECT CAST(l_partkey AS VARCHAR) AS code, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS trade_time, {_HALVES} AS close,
               l_extendedprice AS amount, l_orderkey * 8 + l_linenumber AS arrival FROM lineitem)""")
        + _latest("drop_rows", BAR_KEY, "code, trade_time, close, amount", order="arrival"),
    "load_minute_then_full_day": _with(MINUTES) + _latest("minutes", BAR_KEY, KLINE, "trade_time < DATE '2024-01-04'"),
    "load_one_factor_type": _with(FACTORS) + _latest("factors", "trade_date, code", "factor_type, trade_date, code, factor_value", "factor_type = 'adj'"),
    "load_rejects": """SELECT 'success' AS status,
        count(DISTINCT (l_partkey, CAST(l_shipdate AS DATE))) FILTER (WHERE l_linenumber <> 7 AND l_quantity <> 50 AND l_partkey % 3 = 0) AS row_count,
        count(*) FILTER (WHERE l_linenumber = 7 OR l_quantity = 50) AS reject_count FROM lineitem""",
    "load_quarantine": """SELECT DATE '2024-01-02' AS run_date, 'kline_daily' AS target_table, 'query_kline' AS task_name,
        'missing ' || CASE WHEN l_linenumber <> 7 THEN 'trade_time' WHEN l_quantity <> 50 THEN 'code' ELSE 'code, trade_time' END AS reason, l_tax AS open
        FROM lineitem WHERE l_linenumber = 7 OR l_quantity = 50""",
    "load_late_rows": _with(BARS) + _LOADED_KLINE,
    "compare_days": _with(BARS, f"new AS ({_latest('bars', BAR_KEY, KLINE)})", f"""old AS ({_latest(
        "(SELECT * REPLACE (CASE WHEN ingest_seq % 5 = 0 THEN 0 ELSE close END AS close) FROM bars)", BAR_KEY, KLINE, "ingest_seq % 3 <> 1 AND code NOT LIKE '%7'")})""",
        *[f"{t}_days AS (SELECT code, CAST(trade_time AS DATE) AS day, count(*) AS n_{n}, list_sort(list((trade_time, open, high, low, close, volume, amount))) AS rows "
          f"FROM {t} GROUP BY ALL)" for t, n in (("new", "drop"), ("old", "stored"))])
        + "SELECT code, day, n_drop, n_stored, CASE WHEN n_stored IS NULL THEN 'new' WHEN n_drop IS NULL THEN 'gone' WHEN a.rows = b.rows THEN 'same' "
          "ELSE 'changed' END AS state FROM new_days a FULL JOIN old_days b USING (code, day)",
    "watermark_state": _with(BARS) + "SELECT code, CAST(max(trade_time) AS DATE) AS latest_date FROM bars GROUP BY code",
    "membership_open": _with(MEMBERS, CALENDAR) + "SELECT DISTINCT c.trade_date, m.security_type, m.code FROM members m JOIN "
        "(SELECT DISTINCT trade_date FROM calendar WHERE market = 'SH' AND trade_date BETWEEN DATE '1996-01-01' AND DATE '1996-01-31') c "
        "ON c.trade_date >= m.trade_date AND (m.code LIKE '%3' OR c.trade_date <= m.trade_date + 5)",
    "membership_natural_days": _with(MEMBERS) + f"SELECT DISTINCT CAST(d AS DATE) AS trade_date, m.security_type, m.code FROM members m JOIN "
        f"(SELECT unnest({_ALL_DAYS}) AS d) ON CAST(d AS DATE) BETWEEN m.trade_date AND m.trade_date + 5",
    "split_codes": "SELECT p_partkey, array_to_string([trim(x) FOR x IN string_split(p_name || ' ,, ' || p_type || ',' || p_name, ',') IF trim(x) <> ''], '|') AS codes FROM part",
    "ticks_with_copies_to_bars": _with(TICKS) + _STREAM_BARS,
    "source_kline": _with(MINUTES) + _latest("minutes", BAR_KEY, KLINE, f"code < '000100' AND {TICK_PERIOD}"),
    "source_kline_whole": _with(MINUTES) + _latest("minutes", BAR_KEY, KLINE),
    "source_stream_to_bars": ORACLE["tick_stream_to_bars"],
    "tick_totals_to_bars": _with(TICKS) + _STREAM_BARS,
    "tick_stream_totals_to_bars": ORACLE["tick_stream_to_bars"],
    "tick_stream_with_copies_to_lake": ORACLE["tick_stream_to_bars"],
}
