"""Tables whose rows lie in buckets of their key, so that a read over several loads needs no shuffle to keep the last write.

Spark's own bucketed tables: a bucket is a hash of the whole key (a hot code spreads over all of them, by its times), a month is a
folder, and each load adds a file per month and bucket. A scan reads the files of one bucket together, which is the distribution
that the collapse asks for. A scan has at most one task per bucket: choose as many buckets as an asked range needs tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ticklake.functions import normalize as N
from ticklake.operators.dedup import latest_per_key
from ticklake.schemas import INGEST_SEQ, MONTH


class BucketedTable:
    """A table of ``schema`` (key, values and ``ingest_seq``) at ``path``, known to the session's catalog as ``name``.

    Loads append; copies of a key are legal, the highest ``ingest_seq`` wins. A load that died is repeated with a newer ``ingest_seq``:
    what the first one left, if anything, loses. ``ingest_seq`` is never NULL; NULLs in a key are equal, and rows without time are not
    found by ranges of it. Other columns of a load are left out. One writer at a time.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, keys: Sequence[str], time: str, buckets: int):
        self.spark, self.name, self.keys, self.time, self.buckets = spark, name, list(keys), time, buckets
        by, fields = ", ".join(f"`{k}`" for k in keys), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({fields}, {MONTH} string) USING parquet PARTITIONED BY ({MONTH}) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
        if spark.conf.get("spark.sql.catalogImplementation") == "hive":
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")  # of a folder that another catalog wrote
        self.columns = [c for c in spark.table(name).columns if c != MONTH]

    def append(self, rows: DataFrame) -> None:
        """Add one load. Its own copies collapse first, so a key that holds any share of the rows becomes one row; then each
        task writes one bucket, a file per month."""
        values = [c for c in self.columns if c not in self.keys]
        last = latest_per_key(rows.select(*self.columns), self.keys, values)
        dealt = last.select(*self.columns, N.month_key(self.time).alias(MONTH)).repartition(self.buckets, *self.keys)
        dealt.write.insertInto(self.name)

    def rows(self) -> DataFrame:
        """All stored rows, copies included; what groups by the key finds them dealt already."""
        return self.spark.table(self.name)

    def latest(self, fields: Sequence[str] | None = None) -> DataFrame:
        """The last write of each key."""
        fields = list(fields or [c for c in self.columns if c != INGEST_SEQ])
        return latest_per_key(self.rows(), self.keys, [c for c in fields if c not in self.keys]).select(*fields)

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
