"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction and holds the vectors with an inner product above a limit with it. The directions are a random
product code: a rotated vector is cut into blocks, each with its own random codewords, and a direction is one codeword
per block. List decoding finds all filters of a vector from its inner products with the few codewords.
Vectors that share a label and a filter are compared: first by sign sketches of 256 bits, which only ever refuse pairs ten
standard deviations off, then, for the few rows that are left, by the exact cosine.

A pair counts in the first filter that it shares and nowhere else, so links are counted without writing out pairs; links
for the components are a spanning forest per filter. Equal vectors of a label are one class with a size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import attach, in_blocks, settle, small_batches, sorted_groups
from ticklake.llm.components import connected_components
from ticklake.llm.vectors import usable

LEAST_COSINE = 0.93
CODE_BLOCKS = 2


class Code(NamedTuple):
    """Codewords per block, and the inner product (in units of 1 / sqrt(length)) that a filter asks for; a vector far from
    all codewords lowers it to ``best_share`` of its best filter's, so that all vectors get several filters."""

    codewords: int
    cap: float
    best_share: float


#: codes by the classes of the largest label: up to so many each. More filters with smaller caps keep the number of filters of
#: a vector, and a filter's vectors grow slower than the label (0.23 %, 0.02 % and 0.002 % of it hold one filter)
CODES = ((1 << 18, Code(128, 3.0, 0.8)), (1 << 22, Code(512, 3.75, 0.85)), (1 << 62, Code(2048, 4.4, 0.88)))
#: shorter vectors keep the first code: their few directions are all taken
LEAST_LENGTH = 32
SKETCH_BITS = 256
#: places in which sketches of a link differ at most: expected 0.12 * 256 = 31, standard deviation 5.2
SKETCH_APART = 83
BLOCK = 1024


def code_for(n_classes: int) -> Code:
    return next(code for most, code in CODES if n_classes <= most)


@lru_cache(8)
def directions_of(length: int, codewords: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotation, codewords by block, and sketch directions for vectors of a length; the same on every executor."""
    rng = np.random.default_rng(length)
    width = -(-length // CODE_BLOCKS)
    rotation = np.linalg.qr(rng.standard_normal((width * CODE_BLOCKS, width * CODE_BLOCKS)))[0][:length]
    words = rng.standard_normal((CODE_BLOCKS, codewords, width))
    words /= np.linalg.norm(words, axis=2, keepdims=True)
    return rotation, words, rng.standard_normal((length, SKETCH_BITS))


def list_decode(products: np.ndarray, limit: float) -> np.ndarray:
    """Numbers of all codeword tuples whose inner products (blocks x codewords) add up to ``limit`` at least."""
    best_rest = np.append(np.cumsum(products.max(axis=1)[::-1])[::-1][1:], 0.0)
    filters, sums = np.zeros(1, np.int64), np.zeros(1)
    for block, rest in zip(products, best_rest):
        total = sums[:, None] + block
        at, word = np.nonzero(total + rest >= limit)
        filters, sums = filters[at] * len(block) + word, total[at, word]
    return filters


def _unit(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # before squares can overflow or vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def filters_of(unit: np.ndarray, code: Code) -> list[np.ndarray]:
    """Numbers of the filters of unit vectors of one length."""
    length = unit.shape[1]
    code = code if length >= LEAST_LENGTH else CODES[0][1]
    rotation, words, _ = directions_of(length, code.codewords)
    products = (unit @ rotation).reshape(len(unit), CODE_BLOCKS, -1).transpose(1, 0, 2) @ words.transpose(0, 2, 1)
    # a direction is its codewords over sqrt(blocks)
    limit = code.cap / np.sqrt(length) * np.sqrt(CODE_BLOCKS)
    tops = products.max(axis=2).sum(axis=0)
    return [list_decode(products[:, i], min(limit, code.best_share * top)) for i, top in enumerate(tops)]


def filtered(code: Code):
    """(id, filters, sketch) of vectors of any lengths."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            lengths = batch.column(1).value_lengths().to_numpy()
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                unit = _unit(part.column(1))
                sketches = np.packbits(unit @ directions_of(int(length), code.codewords)[2] > 0, axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(filters_of(unit, code), pa.list_(pa.int64())), pa.array([s.tobytes() for s in sketches], pa.binary())], ["id", "filters", "sketch"])

    return run


def _members(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the low and of the high block, and which of their pairs are due here."""
    block, low, high = group["block"].to_numpy(), group["low"][0].as_py(), group["high"][0].as_py()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    return left, right, left[:, None] != right[None, :]


def _close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a filter that have a partner with a like sketch."""
    for group in sorted_groups(batches, 5):
        left, right, due = _members(group)
        bits = np.unpackbits(np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(group.num_rows, -1), axis=1).astype(np.float32) * 2 - 1
        like = (bits[left] @ bits[right].T >= SKETCH_BITS - 2 * SKETCH_APART) & due
        kept = np.zeros(group.num_rows, bool)
        kept[left[like.any(axis=1)]] = True
        kept[right[like.any(axis=0)]] = True
        yield from group.filter(pa.array(kept)).select(["label", "dim", "filter", "low", "high", "block", "id"]).to_batches()


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n): n = links of ``a`` that are counted here, or an edge a - b of the spanning forest."""
    for group in sorted_groups(batches, 5):
        left, right, due = _members(group)
        if not len(left) or not len(right):
            continue
        unit, ids, sizes = _unit(group["vector"].combine_chunks()), group["id"].to_numpy(), group["copies"].to_numpy()
        linked = (unit[left] @ unit[right].T >= LEAST_COSINE) & due
        lists = group["filters"].combine_chunks()
        owner, flat = np.repeat(np.arange(group.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
        earlier = flat < group["filter"][0].as_py()
        names, at = np.unique(flat[earlier], return_inverse=True)
        holds = np.zeros((group.num_rows, len(names)), np.float32)
        holds[owner[earlier], at] = 1
        first = linked & (holds[left] @ holds[right].T < 0.5)
        counts = np.zeros(group.num_rows, np.int64)
        counts[left] += first @ sizes[right]
        if group["low"][0].as_py() != group["high"][0].as_py():
            counts[right] += sizes[left] @ first
        # components inside the group: labels go down along links until none changes
        label = np.arange(group.num_rows)
        while True:
            best = np.where(linked, label[right][None, :], group.num_rows).min(axis=1)
            new = label.copy()
            new[left] = np.minimum(new[left], best)
            back = np.where(linked, new[left][:, None], group.num_rows).min(axis=0)
            new[right] = np.minimum(new[right], back)
            if (new == label).all():
                break
            label = new
        moved, counted = np.flatnonzero(label != np.arange(len(label))), np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([ids[moved], ids[counted]])), pa.array(np.concatenate([ids[label[moved]], ids[counted]])),
            pa.array(np.concatenate([np.zeros(len(moved), np.int64), counts[counted]]))], ["a", "b", "n"])


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) of every vector, ``key`` being integer.

    Vectors link if their labels are equal and not NULL and their cosine is at least LEAST_COSINE; n_links counts the other
    rows linked directly, equal vectors among them. Vectors that are NULL, empty, all zero or hold NULL or non-finite
    components link with nothing, nor do vectors of different lengths or rows without key (component NULL, kept).
    Rows that share a key are one vector, the one of smallest (label, vector), and give one row. Other columns do not matter.
    """
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    fit = F.col("label").isNotNull() & usable(F.col("vector")) & F.exists("vector", lambda x: F.coalesce(x != 0, F.lit(False)))
    # -0.0 and 0.0 are one number
    rows = rows.withColumn("vector", F.when(fit, F.transform("vector", lambda x: x + F.lit(0.0).cast(table.schema[vector].dataType.elementType))))
    one = rows.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct(F.col("vector").isNull().alias("bare"), "label", "vector")).alias("s"))
    one = settle(one.select("id", "s.label", "s.vector"), "vectors")
    classes = one.where("vector IS NOT NULL").groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = settle(classes, "classes")

    reps = classes.select(F.col("rep").alias("id"), "vector")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    decoded = settle(reps.mapInArrow(filtered(code_for(largest)), "id long, filters array<long>, sketch binary"), "filters")
    named = decoded.join(classes.select(F.col("rep").alias("id"), "label", F.size("vector").alias("dim")), "id")
    group, part = ["label", "dim", "filter"], ["label", "dim", "filter", "low", "high"]
    spread = settle(named.select("label", "dim", F.explode("filters").alias("filter"), "id", "sketch"), "spread")
    groups = settle(spread.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1"), "groups")
    dealt = in_blocks(attach(spread, groups, group, "n"), "n", "id", BLOCK).select(*part, "block", "id", "sketch")
    kinds = f"label {classes.schema['label'].dataType.simpleString()}, dim int, filter long, low long, high long, block long, id long"
    close = settle(dealt.repartition(*part).sortWithinPartitions(*part).mapInArrow(_close, kinds), "close")

    full = classes.select(F.col("rep").alias("id"), "vector", "copies").join(decoded.select("id", "filters"), "id")
    exact = close.join(full, "id").select(*part, "block", "id", "vector", "copies", "filters")
    found = settle(exact.repartition(*part).sortWithinPartitions(*part).mapInArrow(_links, "a long, b long, n long"), "links")
    components = connected_components(found.where("n = 0"), "a", "b").withColumnRenamed("node", "rep")
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))

    known = classes.join(components, "rep", "left").join(counts, "rep", "left")
    known = settle(known.select("label", "vector", "copies", F.coalesce("component", "rep").alias("component"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links")), "known")
    linked = attach(one.where("vector IS NOT NULL").select("id", "label", "vector"), known, ["label", "vector"], "copies").select("id", "links", "component")
    alone = one.where("vector IS NULL").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    nameless = rows.where("id IS NULL").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    result = linked.unionByName(alone).unionByName(nameless)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return result.select(F.col("id").alias(key), F.col("links").alias("n_links"), F.col("component").alias("component_id"), kept.alias("kept"))
