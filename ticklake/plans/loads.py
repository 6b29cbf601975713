"""Incremental, idempotent, audited loads: one set-oriented job per table and request.

Order of steps: write the rows, then one log row. A run that dies in between is repeated by the next
one; the repeated rows carry a later load id and the read view keeps one of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, functions as F

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators import quality, reconcile, watermarks as W
from ticklake.operators.lookup import only_clean, only_codes
from ticklake.operators.ranges import as_date, date_range
from ticklake.sources.lake import Lake, new_load_id, observed
from ticklake.sources.workspace import discard, settle


@dataclass(frozen=True)
class LoadResult:
    status: str
    row_count: int
    start_date: date | None = None
    end_date: date | None = None
    reject_count: int = 0


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class LogState:
    """What the audit log says before a load."""

    checkpoint: date | None  # last success of this task and scope
    last_id: int | None  # highest load id logged


def log_state(lake: Lake, task_name: str, scope_key: str) -> LogState:
    """One small aggregate over the log (one row per run)."""
    day = F.coalesce("end_date", "start_date")
    same = (F.col("status") == S.SUCCESS) & (F.col("task_name") == task_name) & (F.col("scope_key") == scope_key)
    row = lake.read("sync_task_log").agg(
        F.max(F.when(same & day.isNotNull(), F.struct("finished_at", day.alias("day")))).alias("last"),
        F.max(S.INGEST_SEQ).alias("last_id"),
    ).first()
    return LogState(row["last"]["day"] if row["last"] else None, row["last_id"])


def runs_today(lake: Lake, task_name: str, scope_key: str, run_date: date) -> DataFrame:
    """Log rows of a request on a day: a scan of one month of the log, without a shuffle."""
    log = date_range(lake.read("sync_task_log", run_date, run_date), "run_date", run_date, run_date)
    return log.where((F.col("task_name") == task_name) & (F.col("scope_key") == scope_key))


def succeeded_today(lake: Lake, task_name: str, scope_key: str, run_date: date) -> bool:
    return not runs_today(lake, task_name, scope_key, run_date).where(F.col("status") == S.SUCCESS).isEmpty()


def _sorted_out(spec: S.TableSpec, rows: DataFrame, quarantine: bool) -> tuple[DataFrame, DataFrame | None, Callable[[], int]]:
    """Good rows, rejected rows with their reason, and how many those are once the good ones have been written.

    Without a quarantine the rejects are counted on the way. With one the drop is read once: it is written to the shared
    folder in two parts, good and rejected, which the load then reads apart.
    """
    reason = quality.reject_reason(spec.key)
    rejected = Observation()
    if not quarantine:
        good = rows.observe(rejected, F.count_if(reason.isNotNull()).alias("n")).where(reason.isNull())

        def count() -> int:
            counted = observed(rejected)
            return counted["n"] if counted else rows.where(reason.isNotNull()).count()

        return good, None, count
    apart = rows.withColumn("reason", reason).withColumn("rejected", reason.isNotNull())
    apart = apart.observe(rejected, F.count_if("rejected").alias("n"))
    kept = settle(apart, "sorted_out", partition_by=["rejected"])
    return kept.where("NOT rejected").select(*rows.columns), kept.where("rejected").drop("rejected"), lambda: (observed(rejected) or {"n": 0})["n"]


def incremental_load(
    lake: Lake,
    table: str,
    raw: DataFrame | Callable[[], DataFrame] | None,
    task_name: str,
    scope: str | Callable[[], str],
    begin=None,
    end=None,
    run_date: date | None = None,
    force: bool = False,
    lookback_days: int = 0,
    order: str | Sequence[str] | None = None,
    only: Callable[[DataFrame], DataFrame] | None = None,
    quarantine: bool = False,
    late: bool = False,
) -> LoadResult:
    """Select the rows past each group's watermark, append them, write one log row.

    The log row spans from the scope's previous checkpoint (else the first new date) to the newest
    date known, so a run without new rows keeps the checkpoint.
    ``force`` lifts the once-a-day guard, not the watermark. ``raw`` may be a function, so that a
    skipped run does not touch the source; of several skipped runs on a day the first is logged. A table without a date is appended
    whole and the read view keeps the newest row per key.

    Rows without a mandatory field are left out and counted in the log, on the drop as it comes: before ``only`` picks the
    requested codes or types, since a row without a code belongs to none. With ``quarantine`` they go to
    ``rejected_rows`` with the reason.

    With ``late`` the watermark plays no part: rows of any date that the table lacks or holds with other values are found
    by digests per group and day (see ``operators.reconcile``) and appended.
    """
    spec = S.TABLES[table]
    begin, end = as_date(begin), as_date(end)
    if begin and end and begin > end:
        raise ValueError("begin is after end")
    started, run_date = _now(), run_date or date.today()
    scope_key = scope() if callable(scope) else scope
    before, load_id = None, None

    def log(status: str, rows: int = 0, first=None, last=None, message: str = "", rejects: int = 0) -> LoadResult:
        lake.write_log(
            load_id, task_name=task_name, scope_key=scope_key, run_date=run_date, status=status, target_table=table,
            start_date=first, end_date=last, row_count=rows, reject_count=rejects, message=message, started_at=started,
            finished_at=_now(),
        )
        return LoadResult(status, rows, first, last, rejects)

    if not force:
        # the runs of one request on one day are few
        today = runs_today(lake, task_name, scope_key, run_date).select("status", "end_date", "finished_at", S.INGEST_SEQ).collect()
        done = [r for r in today if r["status"] == S.SUCCESS]
        if done:
            before = max(((r["finished_at"], r["end_date"]) for r in done if r["end_date"]), default=(None, None))[1]
            if any(r["status"] == S.SKIPPED for r in today):
                return LoadResult(S.SKIPPED, 0, before, before)
            load_id = new_load_id(max(r[S.INGEST_SEQ] for r in today))
            return log(S.SKIPPED, 0, before, before, f"{task_name} already succeeded on {run_date}")
    state = log_state(lake, task_name, scope_key)
    before, load_id = state.checkpoint, new_load_id(state.last_id)
    if raw is None:
        return log(S.FAILED, 0, before, before, f"{task_name} has no source")
    try:
        rows, bad, count_rejects = _sorted_out(spec, raw() if callable(raw) else raw, quarantine)
        rows = only(rows) if only else rows
        if late:
            rows = _late_rows(lake, table, date_range(rows, spec.date_column, begin, end), begin, end, order)
        elif spec.date_column:
            latest, size = lake.watermarks(table)
            rows = W.past_watermarks(rows, latest, size, spec.group, spec.date_column, begin, end, lookback_days)
        stats = lake.append(table, rows, load_id, None if late else order)
        if late and hasattr(rows, "settled_at"):
            discard(rows)
        rejects = count_rejects()
        if bad is not None and rejects:
            _quarantine(lake, bad, table, task_name, run_date, load_id)
    except Exception as error:
        log(S.FAILED, 0, before, before, f"{task_name} failed: {error}")
        raise
    lo, hi = (stats.min_date, stats.max_date) if spec.date_column else (run_date, run_date)
    last = max((d for d in (before, hi) if d), default=None)
    return log(S.SUCCESS, stats.row_count, before or lo, last, f"{task_name} appended {stats.row_count} rows", rejects)


def _late_rows(lake: Lake, table: str, drop: DataFrame, begin, end, order) -> DataFrame:
    """What the table lacks of the drop, within the drop's own dates."""
    spec = S.TABLES[table]
    if begin is None or end is None:
        day = F.col(spec.date_column).cast("date")
        lo, hi = drop.agg(F.min(day), F.max(day)).first()
        begin, end = begin or lo, end or hi
    if begin is None:
        return drop.where("false")
    stored = date_range(lake.read(table, begin, end), spec.date_column, begin, end)
    view = reconcile.stored_view(stored, spec.key, spec.values, lake.unique_months(table, begin, end))
    by = [] if order is None else [order] if isinstance(order, str) else list(order)
    return reconcile.missing_rows(drop, view, spec.key, spec.values, spec.group, spec.date_column, by)


def _quarantine(lake: Lake, bad: DataFrame, table: str, task_name: str, run_date: date, load_id: int) -> None:
    """Rejected rows as they came, as JSON text, so that rows of every table share one."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in bad.columns if c != "reason"]))
    lake.append("rejected_rows", bad.select(
        F.lit(run_date).alias("run_date"), F.lit(table).alias("target_table"), F.lit(task_name).alias("task_name"), "reason", whole.alias("row")), load_id)


# ----------------------------------------------------------------- one function per table

def _codes_scope(prefix: str, codes, **more) -> Callable[[], str]:
    """Scope of a request, worked out when the load begins: a frame of codes takes a job for its digest."""
    return lambda: N.scope_text(prefix, codes_mark(codes) if isinstance(codes, DataFrame) else None if codes is None else N.code_list(codes), **more)


def codes_mark(codes: DataFrame) -> tuple[int, str]:
    """Number and digest of a frame's codes: the same for the same set, in whatever order and partitions."""
    clean = only_clean(codes)
    n, one, two = clean.agg(F.count("*"), F.bit_xor(F.xxhash64("code")), F.bit_xor(F.xxhash64(F.lit(1), "code"))).first()
    return n, f"{(one or 0) & (1 << 64) - 1:016x}{(two or 0) & (1 << 64) - 1:016x}"


def load_calendar(lake: Lake, raw, market: str | None = "SH", **options) -> LoadResult:
    """Rows of ``market`` only; of all markets for None."""
    return incremental_load(lake, "trade_calendar", raw, "get_calendar", f"market={market or ''}", only=_only(market=market), **options)


def load_code_info(lake: Lake, raw, security_type: str | None, **options) -> LoadResult:
    scope = f"security_type={security_type or ''}"
    return incremental_load(lake, "code_info", raw, "get_code_info", scope, only=_only(security_type=security_type), **options)


def load_membership(lake: Lake, raw, security_type: str | None, begin=None, end=None, **options) -> LoadResult:
    scope = N.scope_text(f"security_type={security_type or ''}", begin_date=as_date(begin), end_date=as_date(end))
    only = _only(security_type=security_type)
    return incremental_load(lake, "hist_code_daily", raw, "get_hist_code_list", scope, begin, end, only=only, **options)


def load_factor(lake: Lake, raw, factor_type: str, codes=None, **options) -> LoadResult:
    """``factor_type`` is ``adj`` or ``backward``; rows of the other type stay out."""
    if factor_type not in S.FACTOR_TYPES:
        raise ValueError(f"unknown factor type: {factor_type!r}")
    scope = _codes_scope(f"factor_type={factor_type}", codes)
    return incremental_load(lake, "price_factor", raw, f"get_{factor_type}_factor", scope, only=_only(codes, factor_type=factor_type), **options)


def load_stock_basic(lake: Lake, raw, codes=None, **options) -> LoadResult:
    """One profile per code and day; ``raw`` is stamped with its snapshot date."""
    task = "get_stock_basic"
    scope = _codes_scope(f"task={task}", codes, begin_date=None, end_date=None)
    return incremental_load(lake, "stock_basic", raw, task, scope, only=_only(codes, "market_code"), **options)


def load_status(lake: Lake, raw, codes=None, begin=None, end=None, **options) -> LoadResult:
    return _load_days(lake, "history_stock_status", "get_history_stock_status", raw, codes, "market_code", begin, end, options)


def load_kline(lake: Lake, raw, period: str = "day", codes=None, begin=None, end=None, **options) -> LoadResult:
    """Daily or 1-minute bars of all codes in one job; whole days, since the watermark is a day."""
    return _load_days(lake, *kline_table(period), raw, codes, "code", begin, end, options)


def load_snapshot(lake: Lake, raw, codes=None, begin=None, end=None, **options) -> LoadResult:
    """Snapshots of whole days."""
    return _load_days(lake, "market_snapshot", "query_snapshot", raw, codes, "code", begin, end, options)


def load_late_rows(lake: Lake, table: str, raw, codes=None, begin=None, end=None, **options) -> LoadResult:
    """Rows older than the watermark that came late, and corrections, for tables with a date and a watermark per code."""
    spec = S.TABLES[table]
    column = next((c for c in ("code", "market_code") if c in spec.group), None)
    if column is None or spec.all_key:
        raise ValueError(f"{table} has no late rows")
    return _load_days(lake, table, f"late_rows_{table}", raw, codes, column, begin, end, {"late": True, **options})


def _load_days(lake: Lake, table: str, task: str, raw, codes, column: str, begin, end, options: dict) -> LoadResult:
    scope = _codes_scope(f"task={task}", codes, begin_date=as_date(begin), end_date=as_date(end))
    return incremental_load(lake, table, raw, task, scope, begin, end, only=_only(codes, column), **options)


def kline_table(period: str | int) -> tuple[str, str]:
    """Stored table and task of a period; day and min1 are stored, anything else is refused."""
    text = str(period).strip()
    text = S.PERIOD_CODES.get(text, text)
    if text == "day":
        return "kline_daily", "query_kline"
    if text == "min1":
        return "kline_minute", "query_kline_minute"
    raise ValueError(f"only day and min1 bars are stored, not {period!r}")


def _only(codes=None, column: str = "code", **values: str | None) -> Callable[[DataFrame], DataFrame]:
    """Picks the requested codes and the rows of one market or type; a drop may hold others."""
    def pick(rows: DataFrame) -> DataFrame:
        for name, value in values.items():
            rows = rows if value is None else rows.where(F.col(name) == value)
        return only_codes(rows, codes, column)

    return pick
