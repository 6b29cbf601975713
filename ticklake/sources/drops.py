"""Per-code drops as a Spark data source: ``spark.read.format("ticklake_drop")`` and ``spark.readStream`` alike.

A drop is a folder with one folder per code, ``code=<code>/*.parquet``; a feed is a folder of drops ``load=<number>/``, each complete once it
holds ``_SUCCESS``, numbers growing. Options: ``path`` (any location that pyarrow's file systems or a plain path reach), ``table`` (whose columns
the files have; default kline_minute) and ``task_bytes`` (bytes of files a task reads, default 64 MB). A schema given to the reader picks
columns of the table: only those are read from the files.

Filters on the code drop files before they are opened, filters on other columns go into the Parquet scan; both are
accepted by the reader, so Spark does not test the rows again. No file is read by two tasks.
"""

from __future__ import annotations

import pickle
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual)
from pyspark.sql.types import StructType

from ticklake import schemas as S

NAME = "ticklake_drop"
TASK_BYTES = 64 << 20
#: rows of one code that a task holds before it writes them as a row group, and rows of several files that it hands to Spark at once
ROW_GROUP = 1 << 16
BATCH_ROWS = 1 << 14
#: fixed value: the folder of rows whose code is NULL or empty, as Spark's writers name it
_NO_CODE = "__HIVE_DEFAULT_PARTITION__"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
#: fixed values: characters that Spark writes as %XX in the names of partition folders, beside control characters
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f")
_COMPARE = {EqualTo: "__eq__", GreaterThan: "__gt__", GreaterThanOrEqual: "__ge__", LessThan: "__lt__", LessThanOrEqual: "__le__"}


def _place(path: str):
    """File system and path inside it."""
    from pyarrow import fs

    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))
    return fs.LocalFileSystem(), path


@dataclass
class Files(InputPartition):
    """(code, file) of one task."""

    files: list[tuple[str, str]]

    def __init__(self, files: list[tuple[str, str]]):
        super().__init__(None)
        self.files = files

    # the driver keeps the pickled tasks of a batch: thousands of paths each, alike but for the code
    def __getstate__(self) -> bytes:
        return zlib.compress(pickle.dumps(self.files), 1)

    def __setstate__(self, state: bytes) -> None:
        self.__init__(pickle.loads(zlib.decompress(state)))


def _folder(code: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in code)


def _listed(path: str, codes: set[str] | None) -> list[tuple[str, str, int]]:
    """(code, file, bytes) of a drop, by code and name."""
    from pyarrow import fs

    store, root = _place(path)
    if codes is None:  # one listing of the whole drop, not one for each of its folders
        infos = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    else:
        folders = [f"{root.rstrip('/')}/code={_folder(c)}" for c in sorted(codes)]
        infos = [i for folder in folders for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))]
    found, depth = [], root.strip("/").count("/") + 2
    for i in infos:
        place = i.path.rsplit("/", 2)
        if i.type == fs.FileType.File and place[2].endswith(".parquet") and place[1].startswith("code=") and i.path.strip("/").count("/") == depth:
            found.append((unquote(place[1][5:]), i.path, i.size))
    return sorted(found)


def _tasks(listed: list[tuple[str, str, int]], task_bytes: int) -> list[Files]:
    tasks, size = [], task_bytes
    for code, file, n in listed:
        if size >= task_bytes:
            tasks.append(Files([]))
            size = 0
        tasks[-1].files.append((code, file))
        size += n
    return tasks


class _Reading:
    """What batch and stream have in common."""

    def __init__(self, schema: StructType, options: dict):
        self.path, self.task_bytes = options["path"], int(options.get("task_bytes", TASK_BYTES))
        self.whole, self.schema = S.TABLES[options.get("table", "kline_minute")].schema, schema
        self.codes: set[str] | None = None
        self.tests: list[tuple[str, str, object]] = []

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        store, _ = _place(self.path)
        wanted, whole = to_arrow_schema(self.schema), to_arrow_schema(self.whole)
        test = None
        for column, compare, value in self.tests:
            bound = pa.scalar(value, whole.field(column).type)
            one = getattr(ds.field(column), compare)(bound)
            test = one if test is None else test & one
        inside, form = pa.schema([f for f in whole if f.name != "code"]), ds.ParquetFileFormat()
        columns, out = [f.name for f in wanted if f.name != "code"], pa.schema([f.with_nullable(True) for f in wanted])
        held, n = [], 0

        def batches(file: str) -> Iterator[pa.RecordBatch]:
            if test is None:
                with store.open_input_file(file) as opened:
                    there = pq.ParquetFile(opened)
                    if all(there.schema_arrow.get_field_index(c) >= 0 and there.schema_arrow.field(c).type == inside.field(c).type for c in columns):
                        # as in most drops; a scan that brings columns to a schema takes twice as long for a small file
                        yield from (b.select(columns) for b in there.iter_batches(ROW_GROUP, columns=columns, use_threads=False))
                        return
            yield from form.make_fragment(file, store).to_batches(schema=inside, columns=columns, filter=test, use_threads=False)

        for code, file in partition.files:
            for batch in batches(file):
                found = [pa.repeat(pa.scalar(code, pa.string()), batch.num_rows) if f.name == "code" else batch.column(f.name) for f in wanted]
                held.append(pa.RecordBatch.from_arrays(found, schema=out))
                n += batch.num_rows
                if n >= BATCH_ROWS:  # the files of most codes are small
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, n = [], 0
        if n:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class DropReader(_Reading, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and IN on the code, comparisons on the other columns; what it does not know goes back to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column == "code" and isinstance(f, (EqualTo, In)):
                asked = set(f.value) if isinstance(f, In) else {f.value}
                self.codes = asked if self.codes is None else self.codes & asked
            elif isinstance(f, IsNotNull) and column == "code":
                continue  # a folder's name is a code
            elif column in self.whole.names and column != "code" and type(f) in _COMPARE:
                self.tests.append((column, _COMPARE[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        # the folders of the asked codes are the only ones listed
        return _tasks(_listed(self.path, self.codes), self.task_bytes) or [Files([])]


class FeedReader(_Reading, DataSourceStreamReader):
    """Offsets are numbers of loads: a restart goes on after the last load of the checkpoint."""

    def _loads(self) -> list[int]:
        from pyarrow import fs

        store, root = _place(self.path)
        infos = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        numbers = sorted(int(m[1]) for i in infos if (m := re.search(r"/load=(\d+)$", i.path)))
        markers = store.get_file_info([f"{root.rstrip('/')}/load={n}/_SUCCESS" for n in numbers]) if numbers else []
        complete = []
        for n, marker in zip(numbers, markers):
            if marker.type == fs.FileType.NotFound:
                break  # loads after one that is still being written wait for it
            complete.append(n)
        return complete

    def initialOffset(self) -> dict:
        return {"load": 0}

    def latestOffset(self) -> dict:
        return {"load": max(self._loads(), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return [task for n in self._loads() if start["load"] < n <= end["load"] for task in _tasks(_listed(f"{self.path}/load={n}", None), self.task_bytes)] or [Files([])]


class DropSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return S.TABLES[self.options.get("table", "kline_minute")].schema

    def reader(self, schema: StructType) -> DropReader:
        return DropReader(schema, self.options)

    def streamReader(self, schema: StructType) -> FeedReader:
        return FeedReader(schema, self.options)


class _CodeFiles:
    """Writes the rows of a task, sorted by code, as a file per code.

    A file gets its name when it is whole, and the name follows the partition: a task that is run again, or twice at once, puts the same
    files in the same places.
    """

    def __init__(self, path: str, inside: pa.Schema, date_column: str):
        self.store, self.root = _place(path)
        # what else a footer may hold is larger than the few rows beside it
        self.options = {"store_schema": False, "use_dictionary": [f.name for f in inside if pa.types.is_string(f.type)], "write_statistics": [date_column]}
        self.inside, self.name = inside, f"part-{TaskContext.get().partitionId():05d}"
        self.code, self.held, self.n, self.writer = None, [], 0, None

    def add(self, code: str | None, rows: pa.RecordBatch) -> None:
        if self.n or self.writer:
            if code != self.code:
                self.close()
            elif self.n >= ROW_GROUP:
                self._flush()
        self.code = code
        self.held.append(rows)
        self.n += rows.num_rows

    def _flush(self) -> None:
        import pyarrow.parquet as pq

        if not self.writer:
            self.folder = f"{self.root.rstrip('/')}/code={_folder(self.code) if self.code else _NO_CODE}"
            self.store.create_dir(self.folder)
            self.draft = f"{self.folder}/.{self.name}-{uuid.uuid4().hex}.tmp"
            self.sink = self.store.open_output_stream(self.draft)
            self.writer = pq.ParquetWriter(self.sink, self.inside, **self.options)
        self.writer.write_table(pa.Table.from_batches(self.held, self.inside))
        self.held, self.n = [], 0

    def close(self) -> None:
        if self.n:
            self._flush()
        if self.writer:
            self.writer.close()
            self.sink.close()
            self.store.move(self.draft, f"{self.folder}/{self.name}.parquet")
            self.writer = None


def write_drop(rows: DataFrame, table: str, path: str) -> None:
    """Rows with the columns of ``table`` as a drop: the files of a code come from as many tasks as hold it. Rows without a code go to
    the folder that Spark's writers have for them.

    Most files hold a few rows of many columns, which Spark's Parquet writer takes some twenty times as long for as pyarrow's.
    """
    from pyarrow import fs

    schema, date_column = S.TABLES[table].schema, S.TABLES[table].date_column

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark.sql.pandas.types import to_arrow_schema

        inside = pa.schema([f.with_nullable(True) for f in to_arrow_schema(schema) if f.name != "code"])
        files = _CodeFiles(path, inside, date_column)
        for batch in batches:
            runs = pc.run_end_encode(batch.column(batch.schema.get_field_index("code")))
            plain = pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in inside], schema=inside)
            begin = 0
            for code, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                files.add(code or None, plain.slice(begin, end - begin))
                begin = end
        files.close()
        yield from ()

    store, root = _place(path)
    if store.get_file_info(root).type != fs.FileType.NotFound:
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] there is a drop already: {path}")
    store.create_dir(root)
    plain = rows.select(*S.TABLES[table].columns).repartitionByRange("code", "trade_time").sortWithinPartitions("code", "trade_time")
    plain.mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()
    store.open_output_stream(f"{root.rstrip('/')}/_SUCCESS").close()


def read_drop(spark: SparkSession, path: str, table: str = "kline_minute", **options) -> DataFrame:
    """The drop under ``path``, filters on codes and times pushed into the reader."""
    spark.dataSource.register(DropSource)
    spark.conf.set(PUSHDOWN_CONF, "true")
    return spark.read.format(NAME).options(path=path, table=table, **options).load()


def stream_feed(spark: SparkSession, path: str, table: str = "kline_minute", columns: Sequence[str] | None = None, **options) -> DataFrame:
    """The feed under ``path`` as a stream, load by load; ``columns`` (all by default) are the only ones read."""
    spark.dataSource.register(DropSource)
    stream = spark.readStream.format(NAME).options(path=path, table=table, **options)
    if columns is not None:
        stream = stream.schema(StructType([S.TABLES[table].schema[c] for c in columns]))
    return stream.load()
