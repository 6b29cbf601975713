"""Table model: schemas, keys, partition dates, column layouts and fixed code lists.

Tables are append-only Parquet. Every stored row carries ``ingest_seq`` (the id of the load that
wrote it) and, where the table has a date, a ``month`` partition column. Several rows per key are
legal at rest; reads keep the row with the highest ``ingest_seq``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DATE, TS, STR = T.DateType(), T.TimestampNTZType(), T.StringType()
DBL, INT, LONG = T.DoubleType(), T.IntegerType(), T.LongType()

INGEST_SEQ = "ingest_seq"
MONTH = "month"


def _schema(required: dict[str, T.DataType], optional: dict[str, T.DataType] | None = None) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t, False) for n, t in required.items()]
        + [T.StructField(n, t, True) for n, t in (optional or {}).items()]
    )


def _all(names: str, dtype: T.DataType) -> dict[str, T.DataType]:
    return dict.fromkeys(names.split(), dtype)


@dataclass(frozen=True)
class TableSpec:
    """One lake table.

    ``date_column`` feeds the month partition and the watermark; ``group`` is the set of columns a
    watermark is kept for (one latest date per group).
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    date_column: str | None = None
    group: tuple[str, ...] = ()
    append_only: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]

    @property
    def all_key(self) -> bool:
        return not self.values

    @property
    def stored_schema(self) -> T.StructType:
        extra = [T.StructField(INGEST_SEQ, LONG, False)]
        if self.date_column:
            extra.append(T.StructField(MONTH, STR, True))
        return T.StructType(self.schema.fields + extra)


# --------------------------------------------------------------------------- fixed values
# Codes, names and labels below are fixed by the vendor's data dictionary.

STOCK_TYPES = ("EXTRA_STOCK_A", "SH_A", "SZ_A", "BJ_A", "EXTRA_STOCK_A_SH_SZ")
INDEX_TYPES = ("EXTRA_INDEX_A_SH_SZ", "EXTRA_INDEX_A", "SH_INDEX", "SZ_INDEX", "BJ_INDEX")
ETF_TYPES = ("SH_ETF", "SZ_ETF", "EXTRA_ETF")
CONVERTIBLE_TYPES = ("SH_KZZ", "SZ_KZZ", "EXTRA_KZZ")
HK_CONNECT_TYPES = ("SH_HKT", "SZ_HKT", "EXTRA_HKT")
REVERSE_REPO_TYPES = ("SH_GLRA", "SZ_GLRA", "EXTRA_GLRA")
FUTURE_TYPES = ("EXTRA_FUTURE", "ZJ_FUTURE", "SQ_FUTURE", "DS_FUTURE", "ZS_FUTURE", "SN_FUTURE")
OPTION_TYPES = ("EXTRA_ETF_OP", "SH_OPTION", "SZ_OPTION")
SECURITY_TYPES = (
    STOCK_TYPES + INDEX_TYPES + ETF_TYPES + CONVERTIBLE_TYPES + HK_CONNECT_TYPES
    + REVERSE_REPO_TYPES + FUTURE_TYPES + OPTION_TYPES
)
SECURITY_TYPE_ALIASES = {"EXTRA_ GLRA": "EXTRA_GLRA"}

# default security type of each universe
UNIVERSE_TYPES = {
    "security": "EXTRA_STOCK_A",
    "stock": "EXTRA_STOCK_A_SH_SZ",
    "etf": "EXTRA_ETF",
    "convertible": "EXTRA_KZZ",
    "index": "EXTRA_INDEX_A_SH_SZ",
}

MARKETS = ("SH", "SZ", "BJ", "SHF", "CFE", "DCE", "CZC", "INE", "SHN", "SZN", "HK")
STOCK_MARKETS = ("SH", "SZ", "BJ")

PERIODS = (
    "min1", "min3", "min5", "min10", "min15", "min30", "min60", "min120",
    "day", "week", "month", "season", "year",
)
# vendor's numeric codes of the two stored periods
PERIOD_CODES = {"10000": "min1", "10008": "day"}

FACTOR_TYPES = ("adj", "backward")
SUCCESS, FAILED, SKIPPED = "success", "failed", "skipped"

SECURITY_STATUS_LABELS = {
    1: "停牌", 2: "除权", 3: "除息", 4: "风险警示", 5: "退市整理期", 6: "上市首日", 7: "公司再融资",
    8: "恢复上市首日", 9: "网络投票", 10: "增发股份上市", 11: "合约调整", 12: "暂停上市后协议转让",
    13: "实施双转单调整", 14: "特定债券转让", 15: "上市初期", 16: "退市整理期首日", 57: "新增股份",
    62: "是否可作为融资融券可充抵保证金证券", 63: "是否为融资标的", 64: "是否为融券标的",
    65: "是否可质押入库", 66: "是否跨市场", 67: "是否处于转股回售期",
}
LISTED_LABELS = {1: "上市交易", 3: "终止上市"}
DIVIDEND_PROGRESS_LABELS = {
    1: "董事会预案", 2: "股东大会通过", 3: "实施", 4: "未通过", 12: "停止实施", 17: "股东提议",
    19: "董事会预案预披露",
}
REPORT_MONTHS = {1: 3, 2: 6, 3: 9, 4: 12}
STATEMENT_TYPE_LABELS = {
    1: "合并报表", 2: "合并报表(单季度)", 3: "合并报表(单季度调整)", 4: "合并报表(调整)",
    5: "合并报表(更正前)", 6: "母公司报表", 7: "母公司报表(单季度)", 8: "母公司报表(单季度调整)",
    9: "母公司报表(调整)", 10: "母公司报表(更正前)", 11: "合并报表(未公开)", 12: "合并报表(调整未公开)",
    13: "合并报表(单季度未公开)", 14: "合并报表(单季度调整未公开)", 15: "母公司报表(未公开)",
    16: "母公司报表(调整未公开)", 17: "母公司报表(单季度未公开)", 18: "母公司报表(单季度调整未公开)",
    19: "合并报表(调整借壳前)", 20: "合并调整", 21: "合并报表(单季度借壳前)",
    22: "合并报表(单季度调整借壳前)", 23: "母公司报表(借壳前)", 24: "母公司报表(调整借壳前)",
    25: "母公司报表(单季度借壳前)", 26: "母公司报表(单季度调整借壳前)", 27: "合并报表(第一次更正)",
    28: "合并报表(第二次更正)", 29: "合并调整(第一次更正)", 30: "合并报表(单月度)",
    31: "合并调整(第二次更正)", 32: "母公司调整(第二次更正)", 33: "母公司调整(第一次更正)",
    34: "母公司报表(第二次更正)", 35: "母公司报表(第一次更正)", 36: "合并报表(第三次更正)",
    37: "合并调整(第三次更正)", 38: "母公司报表(第三次更正)", 39: "母公司调整(第三次更正)",
    40: "母公司报表(单月度)", 41: "合并报表(业绩快报)", 42: "合并调整(第一次)", 43: "合并调整(第二次)",
    44: "合并调整(第三次)", 45: "合并报表(第四次更正)", 46: "合并调整(第四次更正)",
    47: "母公司报表(第四次更正)", 48: "母公司调整(第四次更正)", 50: "合并调整(更正前)",
    51: "合并报表(下半年报)", 60: "母公司调整(更正前)", 70: "合并报表(借壳前)", 80: "合并报表(预测)",
    81: "合并报表(公司预测)", 90: "项目资产报表", 91: "合并报表(日历年)",
}

# vendor upper-case name -> stored name
STOCK_BASIC_NAMES = {
    "MARKET_CODE": "market_code", "SECURITY_NAME": "security_name", "COMP_NAME": "comp_name",
    "PINYIN": "pinyin", "COMP_NAME_ENG": "comp_name_eng", "LISTDATE": "list_date",
    "DELISTDATE": "delist_date", "LISTPLATE_NAME": "listplate_name",
    "COMP_SNAME_ENG": "comp_sname_eng", "IS_LISTED": "is_listed",
}
STATUS_NAMES = {
    "MARKET_CODE": "market_code", "TRADE_DATE": "trade_date", "PRECLOSE": "preclose",
    "HIGH_LIMITED": "high_limited", "LOW_LIMITED": "low_limited",
    "PRICE_HIGH_LMT_RATE": "price_high_lmt_rate", "PRICE_LOW_LMT_RATE": "price_low_lmt_rate",
    "IS_ST_SEC": "is_st_sec", "IS_SUSP_SEC": "is_susp_sec", "IS_WD_SEC": "is_wd_sec",
    "IS_XR_SEC": "is_xr_sec",
}

# names as they come out of the scanned manual -> clean names
FIELD_NAME_ALIASES = {
    **{f"{side} _volume{level}": f"{side}_volume{level}" for side in ("ask", "bid") for level in range(1, 6)},
    "pre_settle:": "pre_settle",
    "underlying_security_cod": "underlying_security_code",
}

ORDER_BOOK = [
    f"{side}_{what}{level}" for side in ("ask", "bid") for what in ("price", "volume") for level in range(1, 6)
]
KLINE_FIELDS = "code trade_time open high low close volume amount".split()
SNAPSHOT_LAYOUTS = {
    "snapshot": (
        "code trade_time pre_close last open high low close volume amount num_trades high_limited low_limited".split()
        + ORDER_BOOK + "iopv trading_phase_code".split()
    ),
    "snapshot_index": "code trade_time last pre_close open high low close volume amount".split(),
    "snapshot_option": (
        "code trade_time trading_phase_code total_long_position volume amount pre_close pre_settle "
        "auction_price auction_volume last open high low close settle high_limited low_limited".split()
        + ORDER_BOOK + "contract_type expire_date underlying_security_code exercise_price".split()
    ),
    "snapshot_hkt": (
        "code trade_time pre_close last high low volume amount nominal_price ref_price bid_price_limit_up "
        "bid_price_limit_down offer_price_limit_up offer_price_limit_down high_limited low_limited".split()
        + ORDER_BOOK + ["trading_phase_code"]
    ),
    "snapshot_future": (
        "code trade_time action_day trading_day pre_close pre_settle pre_open_interest open_interest last "
        "open high low close volume amount high_limited low_limited".split()
        + ORDER_BOOK + "average_price settle".split()
    ),
}

DEFAULT_BEGIN = "2010-01-01"
EARLIEST_VALID_DATE = "1990-01-01"

# --------------------------------------------------------------------------- tables
# Table and column names, types and keys are fixed by the data model.

_KLINE = _schema({"trade_time": TS, "code": STR}, _all("open high low close volume amount", DBL))

_SNAPSHOT = _schema(
    {"trade_time": TS, "code": STR},
    {
        **_all("pre_close last open high low close volume amount num_trades high_limited low_limited", DBL),
        **{f: LONG if "volume" in f else DBL for f in ORDER_BOOK},
        "iopv": DBL, "trading_phase_code": STR, "total_long_position": LONG, "pre_settle": DBL,
        "auction_price": DBL, "auction_volume": LONG, "settle": DBL, "contract_type": STR,
        "expire_date": INT, "underlying_security_code": STR, "exercise_price": DBL, "action_day": STR,
        "trading_day": STR, "pre_open_interest": LONG, "open_interest": LONG,
        **_all(
            "average_price nominal_price ref_price bid_price_limit_up bid_price_limit_down "
            "offer_price_limit_up offer_price_limit_down", DBL,
        ),
    },
)

TABLES = {
    t.name: t
    for t in (
        TableSpec("trade_calendar", _schema({"market": STR, "trade_date": DATE}),
                  ("market", "trade_date"), "trade_date", ("market",)),
        TableSpec("code_info",
                  _schema({"security_type": STR, "code": STR},
                          {"symbol": STR, "security_status_raw": STR,
                           **_all("pre_close high_limited low_limited price_tick", DBL)}),
                  ("security_type", "code")),
        TableSpec("hist_code_daily", _schema({"trade_date": DATE, "security_type": STR, "code": STR}),
                  ("security_type", "trade_date", "code"), "trade_date", ("security_type",)),
        TableSpec("price_factor",
                  _schema({"factor_type": STR, "trade_date": DATE, "code": STR, "factor_value": DBL}),
                  ("factor_type", "code", "trade_date"), "trade_date", ("factor_type", "code")),
        TableSpec("stock_basic",
                  _schema({"snapshot_date": DATE, "market_code": STR},
                          {"security_name": STR, "comp_name": STR, "pinyin": STR, "comp_name_eng": STR,
                           "list_date": INT, "delist_date": INT, "listplate_name": STR,
                           "comp_sname_eng": STR, "is_listed": INT}),
                  ("snapshot_date", "market_code"), "snapshot_date", ("market_code",)),
        TableSpec("history_stock_status",
                  _schema({"trade_date": DATE, "market_code": STR},
                          {**_all("preclose high_limited low_limited price_high_lmt_rate price_low_lmt_rate", DBL),
                           **_all("is_st_sec is_susp_sec is_wd_sec is_xr_sec", STR)}),
                  ("trade_date", "market_code"), "trade_date", ("market_code",)),
        TableSpec("kline_daily", _KLINE, ("code", "trade_time"), "trade_time", ("code",)),
        TableSpec("kline_minute", _KLINE, ("code", "trade_time"), "trade_time", ("code",)),
        TableSpec("market_snapshot", _SNAPSHOT, ("code", "trade_time"), "trade_time", ("code",)),
        TableSpec("sync_task_log",
                  _schema({"task_name": STR, "scope_key": STR, "run_date": DATE, "status": STR,
                           "target_table": STR},
                          {"start_date": DATE, "end_date": DATE, "row_count": LONG, "reject_count": LONG, "message": STR,
                           "started_at": TS, "finished_at": TS}),
                  ("task_name", "scope_key", "run_date", "started_at"), "run_date", append_only=True),
        TableSpec("rejected_rows",
                  _schema({"run_date": DATE, "target_table": STR, "task_name": STR, "reason": STR}, {"row": STR}),
                  ("target_table", "task_name", "run_date", "reason"), "run_date", append_only=True),
    )
}
