"""Tables, shared files and joins that hold under skew, for the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.sources.workspace import discard, settle

__all__ = ["attach", "discard", "give_back", "in_blocks", "read_table", "settle", "small_batches", "sorted_groups"]

#: what a Python worker handles at a time; a longer text comes alone
BATCH_BYTES = 1 << 20

#: Keys that a heavy-key join broadcasts at most.
HEAVY_KEYS = 2000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach(rows: DataFrame, lookup: DataFrame, on: Sequence[str], count: str) -> DataFrame:
    """Inner join of many rows to a lookup with one row per key, safe for keys that hold any share of the rows.

    ``lookup`` (read twice: pass a settled table) names in ``count`` how many of ``rows`` each key has, about.
    Keys with more than 1/HEAVY_KEYS of all are broadcast; there are HEAVY_KEYS of them at most, whatever the input.
    No other key holds more than that share, so the rest is an ordinary shuffle join.
    """
    total = lookup.agg(F.sum(count)).first()[0] or 0
    bound = max(total / HEAVY_KEYS, 1)
    heavy = F.broadcast(lookup.where(F.col(count) > bound))
    light = lookup.where(F.col(count) <= bound)
    keys = list(on)
    return rows.join(heavy, keys).unionByName(rows.join(heavy, keys, "left_anti").join(light.hint("shuffle_merge"), keys))


def in_blocks(rows: DataFrame, count: str, member: str, size: int) -> DataFrame:
    """``rows`` of groups with ``count`` members, dealt out so that any two members of a group meet in one part of it.

    Adds ``block``, the member's block of about ``size``, and ``low`` and ``high``, the two blocks of a part; a group up to ``size``
    is one part. Pairs inside a block are due where low = high, pairs of two blocks where low < high.
    """
    blocks = F.ceil(F.col(count) / size)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(member), blocks)).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other")).drop("_other")


def small_batches(batches: Iterable[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes, so that Python objects of one batch stay few."""
    for batch in batches:
        step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
        del batch
        give_back()


def give_back() -> None:
    """Return freed memory to the system, which Arrow and the C library else keep for a worker's next task."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(own := ctypes.CDLL(None), "malloc_trim"):
        own.malloc_trim(0)


def sorted_groups(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``n_keys`` columns (not NULL) from batches that are sorted by them; one group is held at a time."""
    rest: list[pa.RecordBatch] = []
    for batch in small_batches(batches, 4 << 20):
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if rest and any(rest[-1].column(i)[-1].as_py() != batch.column(i)[0].as_py() for i in range(n_keys)):
            yield pa.Table.from_batches(rest)
            rest = []
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            rest.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)
