"""The lake's front door: load if a source is configured, then read.

Every ``get_*``/``query_*`` returns a long DataFrame. With a source, a read first runs its load (once
a day per request, then guarded by the log).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame, functions as F

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators import watermarks as W
from ticklake.operators.lookup import code_column, only_clean
from ticklake.operators.ranges import as_date
from ticklake.plans import loads, views
from ticklake.sources.lake import Lake


class Source(Protocol):
    """Raw rows of each table, already in table columns (see ``ticklake.sources.raw``).

    ``order`` names the columns that tell which of two rows of one key came later, such as drop time, file and
    row; the readers' ``keep`` carries them. Without them the row with the larger values is taken. Rows without a mandatory
    field (``raw.normalize`` keeps them, the readers do not) are left out by the load and counted in its log row.
    """

    order: Sequence[str]

    def calendar(self, market: str) -> DataFrame: ...
    def code_info(self, security_type: str) -> DataFrame: ...
    def membership(self, security_type: str) -> DataFrame: ...
    def factors(self, factor_type: str) -> DataFrame: ...
    def stock_basic(self, snapshot_date: date) -> DataFrame: ...
    def status(self) -> DataFrame: ...
    def kline(self, period: str) -> DataFrame: ...
    def snapshot(self) -> DataFrame: ...


Codes = Sequence[str] | DataFrame


def _codes(code_list: Codes) -> Codes:
    """A cleaned list, or a frame of codes such as a universe (see ``lookup.code_column``) as it is."""
    if isinstance(code_list, DataFrame):
        code_column(code_list)
        return code_list
    if not isinstance(code_list, Iterable):
        raise TypeError(f"codes are a list, a comma text or a DataFrame, not {type(code_list).__name__}")
    codes = N.code_list(code_list)
    if not codes:
        raise ValueError("code_list is empty")
    return codes


def _text(value: str, what: str) -> str:
    text = str(value).strip()
    if not text:
        raise ValueError(f"{what} is blank")
    return text


def _kind(security_type: str) -> str:
    text = _text(security_type, "security_type")
    return S.SECURITY_TYPE_ALIASES.get(text, text)


def _range(begin, end) -> tuple[date | None, date | None]:
    begin, end = as_date(begin), as_date(end)
    if begin and end and begin > end:
        raise ValueError("begin_date is after end_date")
    return begin, end


class MarketLake:
    def __init__(self, lake: Lake, source: Source | None = None, require_rows: bool = False):
        self.lake, self.source, self.require_rows = lake, source, require_rows
        self.order = list(getattr(source, "order", ())) or None

    def ensure_tables(self) -> None:
        self.lake.ensure_tables()

    def _from(self, name: str, *args):
        """Opens the source only when the load really runs."""
        return (lambda: getattr(self.source, name)(*args)) if self.source is not None else None

    def _serve(self, what: str, sync: Callable[[bool], int], view: Callable[[], DataFrame]) -> DataFrame:
        """Load, then read. With ``require_rows`` an empty result forces one more load before it is
        an error; the check runs a job, so it is off by default."""
        if self.source is not None:
            sync(False)
        df = view()
        if not self.require_rows:
            return df
        if self.source is not None and df.isEmpty():
            sync(True)
            df = view()
        return views.require_rows(df, what)

    # ------------------------------------------------------------- loads

    def sync_calendar(self, market: str = "SH", force: bool = False) -> int:
        return loads.load_calendar(self.lake, self._from("calendar", market), market, force=force, order=self.order).row_count

    def sync_code_info(self, security_type: str = S.UNIVERSE_TYPES["security"], force: bool = False) -> int:
        return loads.load_code_info(
            self.lake, self._from("code_info", security_type), security_type, force=force, order=self.order
        ).row_count

    def sync_hist_code_list(self, security_type: str, begin_date=None, end_date=None, force: bool = False) -> int:
        begin, end = _range(begin_date, end_date)
        return loads.load_membership(
            self.lake, self._from("membership", security_type), security_type, begin, end, force=force, order=self.order
        ).row_count

    def sync_adj_factor(self, code_list, force: bool = False) -> int:
        return self._sync_factor("adj", code_list, force)

    def sync_backward_factor(self, code_list, force: bool = False) -> int:
        return self._sync_factor("backward", code_list, force)

    def _sync_factor(self, factor_type: str, code_list, force: bool) -> int:
        return loads.load_factor(
            self.lake, self._from("factors", factor_type), factor_type, _codes(code_list), force=force, order=self.order
        ).row_count

    def sync_stock_basic(self, code_list, force: bool = False) -> int:
        return loads.load_stock_basic(
            self.lake, self._from("stock_basic", date.today()), _codes(code_list), force=force, order=self.order
        ).row_count

    def sync_history_stock_status(self, code_list, begin_date=None, end_date=None, force: bool = False) -> int:
        begin, end = _range(begin_date, end_date)
        return loads.load_status(
            self.lake, self._from("status"), _codes(code_list), begin, end, force=force, order=self.order
        ).row_count

    def sync_kline(self, code_list, begin_date, end_date, period="day", begin_time=None, end_time=None,
                   force: bool = False, lookback_days: int = 0) -> int:
        """Loads whole days, since a day counts as loaded afterwards; times of day are for reads and change nothing here."""
        begin, end = _range(begin_date, end_date)
        name = "min1" if loads.kline_table(period)[0] == "kline_minute" else "day"
        return loads.load_kline(
            self.lake, self._from("kline", name), name, _codes(code_list), begin, end,
            force=force, lookback_days=lookback_days, order=self.order,
        ).row_count

    def sync_kline_minute(self, code_list, begin_date, end_date, begin_time=None, end_time=None,
                          force: bool = False, lookback_days: int = 0) -> int:
        return self.sync_kline(code_list, begin_date, end_date, "min1", begin_time, end_time, force, lookback_days)

    def sync_snapshot(self, code_list, begin_date, end_date, begin_time=None, end_time=None,
                      force: bool = False, lookback_days: int = 0) -> int:
        begin, end = _range(begin_date, end_date)
        return loads.load_snapshot(
            self.lake, self._from("snapshot"), _codes(code_list), begin, end,
            force=force, lookback_days=lookback_days, order=self.order,
        ).row_count

    def sync_late_kline(self, code_list, begin_date=None, end_date=None, period="day", force: bool = False) -> int:
        """Bars of any date that came after their day was loaded, and corrections; found by digests per code and day."""
        table, _ = loads.kline_table(period)
        name = "min1" if table == "kline_minute" else "day"
        begin, end = _range(begin_date, end_date)
        return loads.load_late_rows(self.lake, table, self._from("kline", name), _codes(code_list), begin, end, force=force, order=self.order).row_count

    # ------------------------------------------------------------- reads

    def get_calendar(self, data_type: str = "str", market: str = "SH") -> DataFrame:
        market = _text(market, "market")
        return self._serve(
            f"calendar {market}", lambda force: self.sync_calendar(market, force),
            lambda: views.calendar(self.lake.read("trade_calendar"), market, data_type),
        )

    def get_code_info(self, security_type: str = S.UNIVERSE_TYPES["security"]) -> DataFrame:
        security_type = _kind(security_type)
        return self._serve(
            f"code info {security_type}", lambda force: self.sync_code_info(security_type, force),
            lambda: views.code_info(self.lake.read("code_info"), security_type),
        )

    def get_code_list(self, security_type: str = S.UNIVERSE_TYPES["security"], force: bool = False) -> DataFrame:
        """Universe of one security type."""
        security_type = _kind(security_type)
        return self._serve(
            f"universe {security_type}", lambda again: self.sync_code_info(security_type, force or again),
            lambda: self.get_universe_from_db(security_type),
        )

    def get_universe_from_db(self, security_type: str = S.UNIVERSE_TYPES["security"]) -> DataFrame:
        return views.universe(self.lake.read("code_info"), _kind(security_type))

    def get_security_universe(self, security_type=S.UNIVERSE_TYPES["security"], force=False) -> DataFrame:
        return self.get_code_list(security_type, force)

    def get_stock_universe(self, security_type=S.UNIVERSE_TYPES["stock"], force=False) -> DataFrame:
        return self.get_code_list(security_type, force)

    def get_etf_universe(self, security_type=S.UNIVERSE_TYPES["etf"], force=False) -> DataFrame:
        return self.get_code_list(security_type, force)

    def get_kzz_universe(self, security_type=S.UNIVERSE_TYPES["convertible"], force=False) -> DataFrame:
        return self.get_code_list(security_type, force)

    def get_index_universe(self, security_type=S.UNIVERSE_TYPES["index"], force=False) -> DataFrame:
        return self.get_code_list(security_type, force)

    def get_hist_code_list(self, security_type: str, start_date, end_date) -> DataFrame:
        security_type = _kind(security_type)
        begin, end = _range(start_date, end_date)
        return self._serve(
            f"members of {security_type}", lambda force: self.sync_hist_code_list(security_type, begin, end, force),
            lambda: views.hist_codes(self.lake.read("hist_code_daily", begin, end), security_type, begin, end),
        )

    def get_adj_factor(self, code_list) -> DataFrame:
        return self._factor("adj", code_list)

    def get_backward_factor(self, code_list) -> DataFrame:
        return self._factor("backward", code_list)

    def _factor(self, factor_type: str, code_list) -> DataFrame:
        codes = _codes(code_list)
        if isinstance(codes, DataFrame):  # each code is a column, so the request must fit a plan anyway
            codes = [r[0] for r in only_clean(codes).orderBy("code").collect()]
        return self._serve(
            f"{factor_type} factors", lambda force: self._sync_factor(factor_type, codes, force),
            lambda: views.factor_matrix(self.lake.read("price_factor"), factor_type, codes),
        )

    def get_stock_basic(self, code_list) -> DataFrame:
        codes = _codes(code_list)
        return self._serve(
            "stock profiles", lambda force: self.sync_stock_basic(codes, force),
            lambda: views.stock_basic(self.lake.read("stock_basic"), codes),
        )

    def get_history_stock_status(self, code_list, begin_date=None, end_date=None, ordered: bool = True) -> DataFrame:
        codes, (begin, end) = _codes(code_list), _range(begin_date, end_date)
        return self._serve(
            "trading status", lambda force: self.sync_history_stock_status(codes, begin, end, force),
            lambda: views.stock_status(self.lake.read("history_stock_status", begin, end), codes, begin, end, ordered=ordered),
        )

    def query_kline(self, code_list, begin_date, end_date, period="day", begin_time=None, end_time=None,
                    ordered: bool = True) -> DataFrame:
        codes, (begin, end) = _codes(code_list), _range(begin_date, end_date)
        table, _ = loads.kline_table(period)
        return self._serve(
            table, lambda force: self.sync_kline(codes, begin, end, period, begin_time, end_time, force),
            lambda: views.kline(
                self.lake.read(table, begin, end), codes, begin, end, begin_time, end_time, ordered,
                unique_months=self.lake.unique_months(table, begin, end),
            ),
        )

    def query_kline_minute(self, code_list, begin_date, end_date, begin_time=None, end_time=None,
                           ordered: bool = True) -> DataFrame:
        return self.query_kline(code_list, begin_date, end_date, "min1", begin_time, end_time, ordered)

    def query_snapshot(self, code_list, begin_date, end_date, begin_time=None, end_time=None,
                       kind: str = "snapshot", ordered: bool = True) -> DataFrame:
        codes, (begin, end) = _codes(code_list), _range(begin_date, end_date)
        return self._serve(
            "snapshots", lambda force: self.sync_snapshot(codes, begin, end, begin_time, end_time, force),
            lambda: views.snapshot(
                self.lake.read("market_snapshot", begin, end), codes, begin, end, begin_time, end_time, kind, ordered,
                unique_months=self.lake.unique_months("market_snapshot", begin, end),
            ),
        )

    # ------------------------------------------------------------- defaults and audit

    def get_latest_trade_date(self, market: str = "SH") -> date:
        days = self.lake.read("trade_calendar").where(F.col("market") == market)
        return W.latest_or_today(days).first()[0]

    def default_window(self, begin_date=None, end_date=None) -> tuple[date, date]:
        """From 2010 to the latest trading day, unless given."""
        window = as_date(begin_date or S.DEFAULT_BEGIN), as_date(end_date) or self.get_latest_trade_date()
        return _range(*window)

    def resolve_codes(self, codes: str = "", security_type: str = S.UNIVERSE_TYPES["security"],
                      limit: int | None = None) -> DataFrame:
        """Comma list, or the universe if blank: distinct, by code, first ``limit``."""
        listed = N.code_list(codes)
        frame = (
            self.lake.spark.createDataFrame([(c,) for c in listed], "code string")
            if listed else self.get_code_list(security_type)
        )
        return views.universe_sample(frame, limit)

    def checkpoints(self) -> DataFrame:
        return W.checkpoint_from_log(self.lake.read("sync_task_log"))

    def audit(self) -> DataFrame:
        return W.succeeded_on(self.lake.read("sync_task_log"))
