"""Filter interaction audit: what each filter of a chain removes, in every order of the filters, from one pass over the rows.

Every row comes with the set of filters it fails, as bits. What a filter f removes depends only on the set S of filters
before it: the rows that fail f and none of S. Sets and the steps between them form a lattice with n * 2**(n - 1) edges
(S, S + f). Counting paths forward (orders that reach S) and backward (orders that lead on from S + f) gives the number of orders that
take an edge, so Shapley sums are sums over edges, and a step of any order is read from the edge that it takes.

Only counts per part, set of failed filters and labels go into the lattice; they are few, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.llm import words
from ticklake.llm.common import attach, discard, settle

#: the edges that carry the audit are listed in each plan; six filters have 192 of them and 720 orders
MAX_FILTERS = 6
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
#: fixed values: characters that a text must not hold
SYMBOLS = "#$%&*|"
#: names of the text filters, in the order of their bits
SHORT, REPETITIVE, CAPITALS, SYMBOL, COPY = "ABCDE"


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags are set in each row."""
    if len(offsets) == 2:
        return np.array([np.count_nonzero(flags)])
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def text_failures(column: pa.Array) -> np.ndarray:
    """Bits of the filters of the text alone (all but COPY) that each whole text fails; NULL as empty."""
    out = np.zeros(len(column), np.int32)
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS.encode())] = True
    for first, end, data, offsets in words.chunks(column):
        _, _, at, hashed = words.word_table(data, offsets)
        n = np.diff(at)
        distinct = np.array([len(np.unique(hashed[a:b])) for a, b in zip(at[:-1], at[1:])], np.int64)
        points = _per_row((data & 0xC0) != 0x80, offsets)
        capitals = _per_row((data >= ord("A")) & (data <= ord("Z")), offsets)
        failed = [n < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * capitals > CAPITAL_PERCENT * points, _per_row(symbols[data], offsets) > 0]
        out[first:end] = sum(x.astype(np.int32) << i for i, x in enumerate(failed))
    return out


def document_failures(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str, good: str, toxic: str) -> DataFrame:
    """(part, failed, good, toxic, n): how many rows of a part fail exactly the filters of ``failed``, by label.

    Filters, as bits 0 to 4: under 200 words; under 50 % distinct words; over 3 % capitals A-Z; holds a symbol; text identical to that of a row
    with a smaller key, whatever its part. Words are ``[^\\x20\\x09-\\x0D]+`` and compared by 64 bits of hash, texts by 128. NULL texts count
    as empty, a NULL part as the empty string. Rows with NULL key copy nothing and nothing copies them; rows that
    share key and text do not copy each other. A row is good or toxic if any label row of its key says 1.

    Copies are settled by groups: rows are counted first as if none were a copy, then the copies among them are moved. A
    text that a third of the rows hold is one row per task before it is shuffled.
    """
    def failures(column: pa.Array) -> pa.Array:
        return pa.array(text_failures(column))

    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(F.col(good) == 1).alias("good"), F.max(F.col(toxic) == 1).alias("toxic"))
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.arrow_udf(failures, T.IntegerType())(F.col(text)).alias("failed"),
        F.xxhash64(F.lit(1), plain).alias("a"), F.xxhash64(F.lit(2), plain).alias("b"))
    # keys spread labels evenly, but rows without one would all meet
    spread = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("-"), F.xxhash64("a", "b", "part").cast("string")))
    labelled = rows.withColumn("k", spread).join(known.select(F.col("id").cast("string").alias("k"), "good", "toxic"), "k", "left").drop("k")
    no = F.lit(False)
    labelled = settle(labelled.withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}), "audit_rows")
    repeated = settle(labelled.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1"), "audit_texts")
    group = ["part", "failed", "good", "toxic"]
    all_rows = labelled.groupBy(*group).agg(F.count("*").alias("n"))
    copies = attach(labelled, repeated, ["a", "b"], "n").where(F.col("id") > F.col("first")).groupBy(*group).agg(F.count("*").alias("n"))
    copies = copies.select("*", F.explode(F.array(F.lit(-1), F.lit(1))).alias("sign"))
    moved = copies.select("part", F.when(F.col("sign") > 0, F.col("failed").bitwiseOR(16)).otherwise(F.col("failed")).alias("failed"), "good", "toxic", (F.col("n") * F.col("sign")).alias("n"))
    counted = settle(all_rows.unionByName(moved).groupBy(*group).agg(F.sum("n").alias("n")), "audit_counts")
    discard(labelled, repeated)
    return counted


def lattice(n: int) -> list[tuple[int, int, int]]:
    """Edges (set, filter bit, orders that take the edge) of the lattice of subsets of ``n`` filters."""
    full = (1 << n) - 1
    forward, backward = [0] * (1 << n), [0] * (1 << n)
    forward[0] = backward[full] = 1
    for state in range(1, 1 << n):
        forward[state] = sum(forward[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in reversed(range(full)):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return [(s, 1 << f, forward[s] * backward[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def order_steps(filters: str) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, set before the step, filter bit) of all orders; filters have one-letter names."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    return [("".join(order), i + 1, sum(bit[f] for f in order[:i]), bit[order[i]]) for order in permutations(filters) for i in range(len(order))]


def _total(of: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, of).otherwise(0))


def audit(counts: DataFrame, filters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order of ``filters``.

    ``counts`` has (part, failed, good, toxic, n) as from ``document_failures``; several rows may agree. Every part that it holds gets all
    steps, also those that remove nothing. Without rows there are no parts.
    """
    if not 1 <= len(filters) <= MAX_FILTERS or len(set(filters)) != len(filters):
        raise ValueError(f"1 to {MAX_FILTERS} filters with different letters")
    spark = counts.sparkSession
    edges = F.array(*[F.struct(F.lit(s).alias("before"), F.lit(f).alias("own"), F.lit(w).cast("long").alias("orders")) for s, f, w in lattice(len(filters))])
    at_edges = counts.withColumn("edge", F.explode(edges)).select("*", "edge.*")
    failed, before, own, n = (F.col(c) for c in ("failed", "before", "own", "n"))
    reaches, fails = failed.bitwiseAND(before) == 0, failed.bitwiseAND(own) != 0
    measured = at_edges.groupBy("part", "before", "own", "orders").agg(
        _total(n, reaches & ~fails).alias("kept"), _total(n, reaches & fails).alias("removed"), _total(n, ~reaches & fails).alias("redundant"),
        _total(n, failed == own).alias("unique_fails"), _total(n, reaches & fails & F.col("good")).alias("good_lost"),
        _total(n, reaches & fails & F.col("toxic")).alias("toxic_lost"))
    # a part has 2**(len(filters) - 1) edges of a filter
    shapley = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "own"))
    steps = spark.createDataFrame(order_steps(filters), "filter_order string, step int, before int, own int")
    found = measured.withColumn("shapley", shapley).join(F.broadcast(steps), ["before", "own"])
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """The audit of the five text filters A to E over ``docs``; see ``document_failures`` and ``audit``."""
    filters: Sequence[str] = (SHORT, REPETITIVE, CAPITALS, SYMBOL, COPY)
    return audit(document_failures(docs, labels, key, text, part, good, toxic), "".join(filters))
