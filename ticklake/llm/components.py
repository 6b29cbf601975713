"""Connected components by alternating large-star and small-star rounds, each a few joins on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ticklake.llm.common import discard, settle


def _minima(edges: DataFrame) -> DataFrame:
    """Per node ``u`` its smallest neighbour, itself included; partial minima keep hubs small."""
    return settle(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "minima")


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Written edges, and what tells one set of edges from another."""
    seen = Observation()
    table = settle(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash")), "edges")
    return table, (seen.get["n"], seen.get["hash"])


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of all nodes that have an edge; the component is the smallest node that can be reached.

    Edges may repeat, run in either direction or be loops; NULL ends are not edges. A node may be an end of any share of the
    edges: neighbour lists are never gathered. Minima go back to the edges by a join of two written tables, whose
    skewed partitions adaptive execution splits.
    """
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges, state = _settled(ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while state[0]:
        # large star: larger neighbours move to the smallest one
        minima = _minima(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = settle(larger.join(minima, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large_star")
        discard(minima, edges)
        # small star: smaller neighbours and the node itself move to the smallest one
        minima = _minima(large)
        moved = large.join(minima, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        before = state
        edges, state = _settled(moved.unionByName(minima.select("u", F.col("m").alias("v"))).distinct())
        discard(minima, large)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = settle(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")
    discard(edges)
    return found
