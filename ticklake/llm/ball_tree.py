"""Exact top-k inner-product search: a ball tree per shard, searched best first by upper bounds.

A node is a centre and a radius; no member scores above q * centre + |q| * radius. Nodes are opened in the order of that
bound and the search ends when the best open bound is below the query's k-th score. Every query first searches one
shard, its own; the k-th score found there is shared with all other shards, which return only what can still matter.
Queries and shards meet in bounded groups: all shards have about the same size, queries come in blocks. Rows too large for exact
doubles stay out of the tree and are searched apart, so that a few of them cost little.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import settle
from ticklake.llm.vectors import usable

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 16384, 2048, 128
#: sums of products below this are exact in doubles
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


class BallTree:
    """Flat arrays of nodes over rows in tree order; children of node i are ``child[i]`` and the next one, leaves have 0."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS):
        order, self.begin, self.end, self.child = np.argsort(ids, kind="stable"), [0], [len(ids)], [0]
        node = 0
        while node < len(self.begin):
            a, b = self.begin[node], self.end[node]
            if b - a > leaf:
                own = vectors[order[a:b]]
                axis = np.argmax(own.max(axis=0) - own.min(axis=0))
                order[a:b] = order[a:b][np.argsort(own[:, axis], kind="stable")]
                middle = (a + b) // 2
                self.child[node] = len(self.begin)
                self.begin += [a, middle]
                self.end += [middle, b]
                self.child += [0, 0]
            node += 1
        self.ids, self.vectors = ids[order], vectors[order]
        parts = [self.vectors[a:b] for a, b in zip(self.begin, self.end)]
        self.centres = np.array([p.mean(axis=0) for p in parts])
        self.radii = np.array([np.sqrt(((p - c) ** 2).sum(axis=1).max()) for p, c in zip(parts, self.centres)])

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows that score at least ``least``, but for the row ``own``; ties to smaller ids."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.child[node]:
                for x in (self.child[node], self.child[node] + 1):
                    heapq.heappush(heap, (-bounds[x], x))
                continue
            a, b = self.begin[node], self.end[node]
            found = self.vectors[a:b] @ query
            good = np.flatnonzero((found >= least) & (self.ids[a:b] != own))
            if len(good):
                ids, scores = np.concatenate([ids, self.ids[a:b][good]]), np.concatenate([scores, found[good]])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                if len(scores) == k:
                    least = max(least, scores[-1])
        return ids, scores


class Floors:
    """floor(scale * component) of some vectors: as doubles, by rows; beyond the range of doubles as whole numbers of any size."""

    def __init__(self, column: pa.ChunkedArray, scale: float):
        self.scale = scale
        self.raw = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
        with np.errstate(over="ignore"):
            self.floors = np.floor(scale * self.raw)
        # sums of products of rows below this size are exact in doubles
        self.small = np.abs(self.floors).max(axis=1) < (_EXACT / self.raw.shape[1]) ** 0.5

    def whole(self, row: int) -> list[int]:
        return [int(f) if np.isfinite(f) else math.floor(Fraction(self.scale) * Fraction(x)) for f, x in zip(self.floors[row].tolist(), self.raw[row].tolist())]

    def shrunk(self, rows: np.ndarray) -> tuple[np.ndarray, int]:
        """The floors of some rows divided by a power of two that leaves none above 1, and that power."""
        power = int(np.frexp(np.abs(self.raw[rows]).max())[1] + np.frexp(self.scale)[1]) if len(rows) else 0
        floors = self.floors[rows]
        return np.where(np.isfinite(floors), np.ldexp(floors, -power), self.raw[rows] * np.ldexp(self.scale, -power)), power


def _best_of_large(rows: Floors, at: np.ndarray, ids: np.ndarray, queries: Floors, query: int, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best of the rows ``at``: doubles with a bound of their error leave few rows, which whole numbers decide."""
    if not len(at):
        return []
    (own, p), (asked, q) = rows.shrunk(at), queries.shrunk(np.array([query]))
    about = own @ asked[0]
    error = (own.shape[1] + 4) * 2.0**-52 * (np.abs(own) @ np.abs(asked[0])) + 1e-300
    # what surely lies beyond a long is cut to its range, and then ties by id
    limit = float(np.ldexp(1.0, 63 - p - q)) if p + q > 63 else np.inf
    top, bottom = about - error > limit, about + error < -limit
    low, high = np.minimum(about - error, limit), np.minimum(about + error, limit)
    least = np.sort(low)[-k] if len(at) >= k else -np.inf
    asked_whole = queries.whole(query)
    found = []
    for i in np.flatnonzero(high >= least):
        score = _LONG if top[i] else -_LONG - 1 if bottom[i] else sum(a * b for a, b in zip(asked_whole, rows.whole(at[i])))
        found.append((min(max(score, -_LONG - 1), _LONG), int(ids[i])))
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def _search_shard(scale: float, k: int):
    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if shard.num_rows and queries.num_rows:
            rows, asked, ids = Floors(shard["vector"], scale), Floors(queries["vector"], scale), shard["vec_id"].to_numpy()
            small, large, every = np.flatnonzero(rows.small), np.flatnonzero(~rows.small), np.arange(len(ids))
            tree = BallTree(ids[small], rows.floors[small]) if len(small) else None
            for i, (own, least) in enumerate(zip(queries["query_id"].to_pylist(), queries["least"].to_pylist())):
                best: list[tuple[int, int]] = []
                if asked.small[i] and tree is not None:
                    low, query = -np.inf if least is None else float(least), asked.floors[i]
                    bounds = tree.centres @ query + np.sqrt(query @ query) * tree.radii
                    found, scores = tree.search(own, query, bounds + 1e-9 * np.abs(bounds) + 0.25, k, low)
                    best = list(zip(scores.astype(np.int64).tolist(), found.tolist()))
                # rows or a query beyond exact doubles
                rest = large if asked.small[i] else every
                rest = rest[ids[rest] != own]
                best += _best_of_large(rows, rest, ids[rest], asked, i, k)
                out += [(own, vec_id, score) for score, vec_id in sorted(best, key=lambda x: (-x[0], x[1]))[:k]]
        return pa.table({n: pa.array([x[i] for x in out], pa.int64()) for i, n in enumerate(("query_id", "vec_id", "score"))})

    return run


def top_k(table: DataFrame, key: str, vector: str, every: int, k: int, scale: float, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose (integer) key is divisible by ``every`` the k rows of largest inner
    product of floor(scale * component), its own key left out; ties go to smaller keys; fewer than k if there are fewer rows.

    Vectors that are NULL, empty or hold NULL or non-finite components, and rows without key, take no part. Of rows that
    share a key the one with the smallest vector counts. Vectors are compared with those of their own length.
    Scores outside a long are cut to its range before they are ranked. Other columns do not matter.
    """
    known = table.where(F.col(key).isNotNull() & usable(F.col(vector))).groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(vector).alias("vector"))
    known = settle(known.withColumn("dim", F.size("vector")), "vectors")
    shards = max(1, -(-known.count() // shard_rows))
    parts = max(1, -(-known.where(F.col("vec_id") % every == 0).count() // query_rows))
    known = known.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    queries = known.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    queries = queries.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "query_id"), F.lit(parts)))
    groups, schema = ["dim", "shard", "part"], "query_id long, vec_id long, score long"
    copies = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>"))).groupBy(*groups)

    def searched(asked: DataFrame) -> DataFrame:
        asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # apart from the rows that they were taken from
        return copies.cogroup(asked.groupBy(*groups)).applyInArrow(_search_shard(scale, k), schema)

    own = settle(searched(queries.withColumn("least", F.lit(None).cast("long"))), "own_shard")
    kth = own.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("n")).select("query_id", F.when(F.col("n") == k, F.col("score")).alias("least"))
    others = queries.withColumnRenamed("shard", "home").join(kth, "query_id", "left")
    others = others.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>"))).where("shard != home")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = own.unionByName(searched(others)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
