"""The lake: Parquet folders under a manifest per table; append, read, compaction, audit log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ticklake import schemas as S
from ticklake.functions import normalize as N
from ticklake.operators.dedup import latest_per_key, new_keys
from ticklake.operators.lookup import row_bytes
from ticklake.operators.ranges import as_date
from ticklake.sources.manifest import Entry, Manifest, Marks
from ticklake.sources.workspace import freeing_shuffles

#: parts of the kept watermarks that a table may have before an append merges them into one
MARK_PARTS = 16


def new_load_id(last: int | None = None) -> int:
    """Microseconds now, but past ``last`` even if this machine's clock is behind."""
    return max(time.time_ns() // 1000, (last or 0) + 1)


def observed(seen: Observation) -> dict | None:
    """What was observed; None if adaptive execution found that no row would come and dropped that part of the plan."""
    try:
        return seen.get
    except Py4JJavaError:
        return None


def _in_months(entries: Sequence[Entry], begin, end) -> list[Entry]:
    """Entries whose month may hold dates of the range; all without bounds."""
    low, high = (None if d is None else f"{as_date(d):%Y%m}" for d in (begin, end))
    if low is None and high is None:
        return list(entries)
    return [
        e for e in entries
        if e.month is None or (e.month.isdigit() and (low is None or e.month >= low) and (high is None or e.month <= high))
    ]


def _covered(entries: Sequence[Entry], marks: Sequence[Marks]) -> bool:
    return bool(marks) and max(m.load_id for m in marks) >= max((e.load_id for e in entries), default=0)


@dataclass(frozen=True)
class WriteStats:
    row_count: int
    min_date: date | None
    max_date: date | None


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def manifest(self, table: str) -> Manifest:
        return Manifest(self.spark, self.path(table))

    def ensure_tables(self, *names: str) -> None:
        """Put empty lists for tables (all by default) that were never written."""
        for name in names or S.TABLES:
            manifest = self.manifest(name)
            if not manifest.version():
                manifest.switch([])

    def _open(self, table: str, entries: Sequence[Entry]) -> DataFrame:
        spec, root = S.TABLES[table], self.path(table)
        if not entries:
            return self.spark.createDataFrame([], spec.stored_schema)
        paths = [f"{root}/{e.write}" + (f"/{S.MONTH}={e.month}" if spec.date_column else "") for e in entries]
        stored = self.spark.read.schema(spec.stored_schema).option("basePath", root).parquet(*paths)
        return stored.select(*spec.stored_schema.names)

    def read(self, table: str, begin=None, end=None) -> DataFrame:
        """Stored rows, duplicates included; empty before the first write.

        With ``begin`` or ``end`` only folders of months in the range are opened (rows without a date belong to no range), so
        that the cost of building a query follows the range and not the table's age. Rows are not filtered.
        """
        return self._open(table, _in_months(self.manifest(table).entries(), begin, end))

    def latest(self, table: str) -> DataFrame:
        """Read view: one row per key."""
        spec = S.TABLES[table]
        return latest_per_key(self.read(table), spec.key, spec.values).select(*spec.columns)

    # ------------------------------------------------------------- writing

    def _write(self, table: str, rows: DataFrame, load_id: int, observe: Observation | None = None, one_file: bool = False) -> list[Entry]:
        """Write ``rows`` into a folder of their own; they count once the manifest names it.

        Files are ranges of (month, key): those of a month hold disjoint codes, so that footers tell which to open for a
        code, and a hot month or code is cut into several files.
        """
        spec = S.TABLES[table]
        name = f"write={load_id}-{uuid.uuid4().hex[:8]}"
        out = rows.withColumn(S.MONTH, N.month_key(spec.date_column)) if spec.date_column else rows
        order = [c for c in spec.key if c != spec.date_column] + [c for c in spec.key if c == spec.date_column]
        order = [S.MONTH, *order] if spec.date_column else order
        # a hash of the whole row last: a key that holds many rows (rejects of one reason) spreads over several tasks
        out = out if one_file else out.repartitionByRange(*order, F.xxhash64(*rows.columns))
        # observed in the final stage: a re-run task is counted once
        out = out.observe(observe, *self._metrics(spec)) if observe else out
        writer = out.sortWithinPartitions(*order).write
        with freeing_shuffles(self.spark):
            (writer.partitionBy(S.MONTH) if spec.date_column else writer).parquet(f"{self.path(table)}/{name}")
        return [Entry(name, month, load_id, not spec.append_only) for month in self.manifest(table).months_of(name)]

    @staticmethod
    def _metrics(spec: S.TableSpec):
        day = F.col(spec.date_column).cast("date") if spec.date_column else F.lit(None).cast("date")
        return F.count(F.lit(1)).alias("n"), F.min(day).alias("lo"), F.max(day).alias("hi")

    def append(
        self, table: str, rows: DataFrame, load_id: int | None = None, order: str | Sequence[str] | None = None
    ) -> WriteStats:
        """Append one load and say what was written.

        Copies of a key inside the load collapse first: the highest ``order`` wins (NULL is the lowest), among equals
        the row with the larger values, so that any repeat of the load picks the same one. Then every row gets the
        load's id, by default the time in microseconds; ids must grow from load to load.
        ``(key, ingest_seq)`` is therefore unique and the read-time rule is exact. Tables that
        consist of their key only take just the keys not stored yet.
        """
        spec = S.TABLES[table]
        if spec.append_only:
            fresh = rows.select(*spec.columns)
        elif spec.all_key:
            fresh = new_keys(rows, self._same_months(table, rows), spec.key)
        else:
            by = [] if order is None else [order] if isinstance(order, str) else list(order)
            fresh = latest_per_key(rows, spec.key, spec.values, [*by, *[v for v in spec.values if v not in by]])
        load_id = load_id or new_load_id()
        stamped = fresh.select(*spec.columns, F.lit(load_id).cast("bigint").alias(S.INGEST_SEQ))
        seen, manifest = Observation(), self.manifest(table)
        written = self._write(table, stamped, load_id, seen)
        entries, marks = manifest.content()
        manifest.switch([*entries, *written, *self._marks_after(table, entries, marks, written, load_id)])
        got = observed(seen) or {"n": 0, "lo": None, "hi": None}
        return WriteStats(got["n"], got["lo"], got["hi"])

    def _same_months(self, table: str, rows: DataFrame) -> DataFrame:
        """Stored rows of the months the load touches."""
        spec = S.TABLES[table]
        if not spec.date_column:
            return self.read(table)
        lo, hi = rows.agg(F.min(spec.date_column), F.max(spec.date_column)).first()
        return self.read(table, lo, hi) if lo else self._open(table, [])

    # ------------------------------------------------------------- kept watermarks

    def _write_marks(self, table: str, latest: DataFrame, load_id: int) -> Marks:
        """Write latest dates per group into a folder of their own; one row per group."""
        name = f"marks={load_id}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        with freeing_shuffles(self.spark):
            latest.observe(seen, F.sum(row_bytes(latest)).alias("size")).write.parquet(f"{self.path(table)}/{name}")
        return Marks(name, load_id, (observed(seen) or {}).get("size") or 0)

    def _latest_of(self, table: str, entries: Sequence[Entry]) -> DataFrame:
        spec = S.TABLES[table]
        return self._open(table, entries).groupBy(*spec.group).agg(F.max(F.col(spec.date_column)).cast("date").alias("latest_date"))

    def _open_marks(self, table: str, marks: Sequence[Marks]) -> DataFrame:
        spec = S.TABLES[table]
        schema = T.StructType([f for f in spec.schema.fields if f.name in spec.group] + [T.StructField("latest_date", T.DateType())])
        stored = self.spark.read.schema(schema).parquet(*[f"{self.path(table)}/{m.marks}" for m in marks])
        return stored.groupBy(*spec.group).agg(F.max("latest_date").alias("latest_date"))

    def _marks_after(self, table: str, entries: Sequence[Entry], marks: Sequence[Marks], written: Sequence[Entry], load_id: int) -> list[Marks]:
        """The marks to list with a write: those before and one for its rows, or one for all when there are many parts.

        Marks that do not cover the entries before, as in a table that was written without them, are worked out anew from the data
        when they are next asked for.
        """
        spec = S.TABLES[table]
        if not spec.group or not written or (entries and not _covered(entries, marks)):
            return list(marks)
        own = self._latest_of(table, written)
        if len(marks) < MARK_PARTS:
            return [*marks, self._write_marks(table, own, load_id)]
        merged = self._open_marks(table, marks).unionByName(own).groupBy(*spec.group).agg(F.max("latest_date").alias("latest_date"))
        return [self._write_marks(table, merged, load_id)]

    def watermarks(self, table: str) -> tuple[DataFrame, int]:
        """(group, latest_date) of every group, and a bound of its bytes.

        Read from the marks that every append and compaction keeps with the table, in the same switch; no stored row is scanned.
        A table whose marks lag behind its rows gets them anew from the data, once.
        """
        spec, manifest = S.TABLES[table], self.manifest(table)
        if not spec.group:
            raise ValueError(f"{table} has no watermarks")
        entries, marks = manifest.content()
        if not entries:
            return self._open(table, []).select(*spec.group, F.lit(None).cast("date").alias("latest_date")).where("false"), 0
        if not _covered(entries, marks):
            marks = [self._write_marks(table, self._latest_of(table, entries), max(e.load_id for e in entries))]
            manifest.switch([*entries, *marks])
        return self._open_marks(table, marks), sum(m.size for m in marks)

    # ------------------------------------------------------------- compaction

    def compact(self, table: str, months: Sequence[str] | None = None) -> list[str | None]:
        """Rewrite ``months`` (all by default) that consist of several writes with one row per key, as if one load had
        written them; an audit log keeps all its rows. Returns the months rewritten.

        The new files are complete before one switch of the manifest puts them in place of the old ones: a run that
        dies changes nothing, and readers keep what they opened. ``vacuum`` deletes the old files. The rows get
        the newest load id among them, which later loads exceed.
        """
        spec, manifest = S.TABLES[table], self.manifest(table)
        entries, marks = manifest.content()
        chosen = {e.month for e in entries if months is None or not spec.date_column or e.month in months}
        several = sorted((m for m in chosen if sum(e.month == m for e in entries) > 1), key=str)
        old = [e for e in entries if e.month in several]
        if not old:
            return []
        newest, stored = max(e.load_id for e in old), self._open(table, old)
        if spec.append_only:
            kept = stored.select(*spec.columns, S.INGEST_SEQ)
        else:
            kept = latest_per_key(stored, spec.key, spec.values).select(*spec.columns, F.lit(newest).cast("bigint").alias(S.INGEST_SEQ))
        written = self._write(table, kept, newest)
        # no date leaves with the copies, so the marks hold
        manifest.switch([*[e for e in entries if e not in old], *written, *marks])
        return several

    def vacuum(self, table: str) -> list[str]:
        return self.manifest(table).vacuum()

    def unique_months(self, table: str, begin=None, end=None) -> list[str]:
        """Months in the range that one write holds, so that keys are unique there; a look at the manifest, no job.

        It saves the read view its shuffle for every month that was loaded once or compacted since.
        """
        writes: dict[str, list[Entry]] = {}
        for e in _in_months(self.manifest(table).entries(), begin, end):
            if e.month and e.month.isdigit():
                writes.setdefault(e.month, []).append(e)
        return sorted(m for m, own in writes.items() if len(own) == 1 and own[0].unique)

    # ------------------------------------------------------------- audit log

    def write_log(self, load_id: int | None = None, **entry) -> None:
        spec = S.TABLES["sync_task_log"]
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        entry = {"started_at": now, "finished_at": now, "row_count": 0, **entry}
        one = self.spark.createDataFrame([tuple(entry.get(c) for c in spec.columns)], spec.schema)
        load_id = load_id or new_load_id()
        stamped = one.withColumn(S.INGEST_SEQ, F.lit(load_id).cast("bigint"))
        manifest = self.manifest("sync_task_log")
        manifest.switch([*manifest.entries(), *self._write("sync_task_log", stamped.coalesce(1), load_id, one_file=True)])
