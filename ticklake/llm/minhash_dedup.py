"""Near-duplicate documents by MinHash: universal hash minima, banding, signature verification, exact confirmation on
full shingle sets and connected components.

Documents with the same set are one class from the start, its smallest key stands for it. Members of a band's bucket
are compared with the bucket's smallest member: pairs grow with the members, not with their square. That settles all pairs of two,
and mostly puts a group of near copies into one component. In buckets that still hold several components, the remaining pairs
between components (never inside one) are compared in blocks inside tasks, so no link between components is lost and
no pairs are written out.

With 42 bands of 6 minima a pair at the similarity 0.85 meets in no bucket with probability 2e-9.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.llm import words
from ticklake.llm.common import attach, discard, in_blocks, settle, small_batches, sorted_groups
from ticklake.llm.components import connected_components

SHINGLE_WORDS = 5
BANDS, BAND_ROWS = 42, 6
MINIMA = BANDS * BAND_ROWS
#: link if 100 * intersection >= PERCENT * union
PERCENT = 85
#: signatures that agree in fewer places are refused: five standard deviations below the limit
LEAST_AGREEING = int(MINIMA * (PERCENT / 100 - 5 * (PERCENT / 100 * (1 - PERCENT / 100) / MINIMA) ** 0.5))
#: members of a hub that share one copy of its set, members of a block of a large bucket
FAN, BLOCK = 500, 1024

_random = np.random.default_rng(20240229)
_FACTORS = (_random.integers(0, 1 << 32, MINIMA, dtype=np.uint32) | np.uint32(1))[:, None]
_OFFSETS = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)[:, None]
_BAND_FACTORS = _random.integers(0, 1 << 63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minima of all universal hash functions a * x + b modulo 2**32 over a set that is not empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    parts = [(_FACTORS * x[i:i + 4096] + _OFFSETS).min(axis=1) for i in range(0, len(x), 4096)]
    return parts[0] if len(parts) == 1 else np.minimum.reduce(parts)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per signature and band, the band's number mixed in."""
    rows = signatures.reshape(len(signatures), BANDS, BAND_ROWS).astype(np.uint64)
    return words.mix((rows * _BAND_FACTORS).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the members of the set only."""
    sums = (int(words.mix(shingles ^ np.uint64(salt)).sum(dtype=np.uint64)) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344))
    return tuple(s - (1 << 64) if s >> 63 else s for s in sums)


def sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n, a, b, bands, signature): set size, 128 bits of the set, its band keys and the low bytes of its minima."""

    def run(batches):
        for batch in small_batches(batches):
            sets = list(words.shingle_sets(batch.column(1), SHINGLE_WORDS))
            signatures = np.array([minima(s) if len(s) else np.zeros(MINIMA, np.uint32) for s in sets])
            keys, hashes = band_keys(signatures), [set_hash(s) for s in sets]
            low = signatures.astype(np.uint8)
            at = pa.array(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([h[0] for h in hashes], pa.int64()),
                pa.array([h[1] for h in hashes], pa.int64()), pa.ListArray.from_arrays(at, pa.array(keys.ravel())),
                pa.array([row.tobytes() for row in low], pa.binary())], schema.names)

    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType())])
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def full_sets(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """(id, shingles) of the nodes (id, a, b): sorted 64-bit hashes of the row whose set is the node's."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(nodes.hint("shuffle_merge"), "id")

    def run(batches):
        for batch in small_batches(batches):
            sets = list(words.shingle_sets(batch.column(1), SHINGLE_WORDS))
            known = zip(sets, batch.column(2).to_pylist(), batch.column(3).to_pylist())
            own = pa.array([set_hash(s) == (a, b) for s, a, b in known], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"]).filter(own)

    return rows.select("id", "text", "a", "b").mapInArrow(run, "id long, shingles binary").dropDuplicates(["id"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _agreeing(left: pa.Array, right: pa.Array) -> pa.Array:
    def matrix(column):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), MINIMA)

    return pa.array((matrix(left) == matrix(right)).sum(axis=1) >= LEAST_AGREEING)


def _confirmed(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array([similar(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)) for a, b in zip(left, right)], pa.bool_())


def _with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """``pairs`` (hub, id, members) with ``column`` of both ends; FAN members of a hub share a copy of the hub's value."""
    copies = F.ceil(F.col("members") / FAN)
    hubs = pairs.select("hub", "members").distinct().join(table.select(F.col("id").alias("hub"), F.col(column).alias("hub_value")), "hub")
    hubs = hubs.select("hub", "hub_value", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("fan"))
    fanned = pairs.withColumn("fan", F.pmod(F.xxhash64("id"), copies))
    return fanned.join(hubs, ["hub", "fan"]).join(table.select("id", F.col(column).alias("value")), "id")


def _keep(pairs: DataFrame, test) -> DataFrame:
    return pairs.where(F.arrow_udf(test, T.BooleanType())("hub_value", "value")).select("hub", "id", "members")


def _block_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components inside the blocks of a bucket: a spanning forest of them."""
    for group in sorted_groups(batches, 3):
        ids, components, block = (group[c].to_numpy() for c in ("id", "component", "block"))
        low, high, key = group["low"][0].as_py(), group["high"][0].as_py(), group["key"][0].as_py()
        bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(len(ids), BANDS)
        signatures = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(len(ids), MINIMA)
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        root = {c: c for c in components.tolist()}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        own = np.argmax(bands == key, axis=1)[0]
        left, right = [], []
        for x in np.flatnonzero(block == low):
            others = np.flatnonzero((block == high) & (components != components[x]) & ((ids > ids[x]) if low == high else True))
            fits = 100 * np.minimum(sizes[others], sizes[x]) >= PERCENT * np.maximum(sizes[others], sizes[x])
            others = others[fits]
            # a pair is compared in the first band that it shares
            others = others[np.argmax(bands[others] == bands[x], axis=1) == own] if len(others) else others
            agreeing = (signatures[others] == signatures[x]).sum(axis=1)
            others = others[agreeing >= LEAST_AGREEING]
            for y in others:
                a, b = find(components[x]), find(components[y])
                if a != b and similar(sets[x], sets[y]):
                    root[a] = b
                    left.append(ids[x])
                    right.append(ids[y])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["hub", "id"])


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every document, ``key`` being integer.

    Texts are lower-cased (A-Z) and split at ``[\\x20\\x09-\\x0D]``; a document's set holds its distinct shingles, or its whole
    sequence of words if that is shorter than a shingle. Documents without words (NULL, empty, blank) link with nothing.
    The component is the smallest key that links reach. Rows that share a key are one document, that of the largest set (ties: by set
    hash), and give one row. Rows without key link with nothing: one row each, component NULL, kept. Other columns
    do not matter.
    """
    sketches = settle(sketch(docs, key, text), "sketches")
    one = settle(sketches.where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("n", "a", "b")).alias("s")).select("id", "s.*"), "documents")
    classes = settle(one.where("n > 0").groupBy("a", "b", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = sketches.join(classes.select(F.col("rep").alias("id"), "a", "b").hint("shuffle_merge"), ["id", "a", "b"]).dropDuplicates(["id"])
    reps = settle(reps.select("id", "a", "b", "bands", "signature"), "representatives")

    # stars: every member of a bucket with the smallest one
    rows = reps.select("id", F.explode("bands").alias("key"))
    buckets = settle(rows.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1"), "buckets")
    members = settle(attach(rows, buckets, ["key"], "n"), "members")
    pairs = settle(members.where("id != hub").select("hub", "id").distinct(), "pairs")
    fans = settle(pairs.groupBy("hub").agg(F.count("*").alias("members")), "fans")
    fanned = attach(pairs, fans, ["hub"], "members")
    close = settle(_keep(_with_both(fanned, reps, "signature"), _agreeing), "close")

    crowded = members.where("n > 2").select("id")
    nodes = close.select("id").unionByName(close.select(F.col("hub").alias("id"))).unionByName(crowded).distinct()
    sets = settle(full_sets(docs, key, text, nodes.join(reps.select("id", "a", "b"), "id")), "sets")
    links = settle(_keep(_with_both(close, sets, "shingles"), _confirmed).select("hub", "id"), "links")
    found = connected_components(links, "hub", "id")

    # buckets whose members besides the hub are of several components
    open_rows = members.where("n > 2 AND id != hub").select("key", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    open_rows = settle(open_rows.select("key", "id", F.coalesce("component", "id").alias("component")), "open")
    open_keys = open_rows.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("first"), F.max("component").alias("last")).where("first != last")
    open_keys = settle(open_keys.select("key", "n"), "open_buckets")
    split = attach(open_rows, open_keys, ["key"], "n")
    split = in_blocks(split, "n", "id", BLOCK).select("key", "low", "high", "block", "id", "component")
    split = split.join(reps.select("id", "bands", "signature"), "id").join(sets, "id").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    columns = ["key", "low", "high", "block", "id", "component", "bands", "signature", "shingles"]
    more = settle(split.select(*columns).mapInArrow(_block_links, "hub long, id long"), "more_links")
    final = connected_components(found.select(F.col("component").alias("hub"), F.col("node").alias("id")).unionByName(more), "hub", "id")

    component = F.coalesce("component", "rep")
    labelled = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("a", "b", "copies", component.alias("component"))
    labelled = settle(labelled, "labelled")
    linked = attach(one.where("n > 0"), labelled, ["a", "b"], "copies").select("id", "n", "component")
    alone = one.where("n = 0").select("id", "n", F.col("id").alias("component"))
    nameless = sketches.where("id IS NULL").select("id", "n", F.col("id").alias("component"))
    result = linked.unionByName(alone).unionByName(nameless)
    result = settle(result, "near_copies")
    discard(sketches, one, classes, reps, buckets, members, pairs, fans, close, sets, links, found, open_rows, open_keys, more, final, labelled)
    return result.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), _kept().alias("kept"))


def _kept() -> Column:
    return F.coalesce(F.col("id") == F.col("component"), F.lit(True))
