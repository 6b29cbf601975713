"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training takes a bounded sample of the labelled rows, split into shards that learn apart, one task each; the shards'
weights are averaged. L1 leaves few weights other than 0, which go to all tasks; scoring is row by row over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.llm import words
from ticklake.llm.common import small_batches

#: rows that training uses at most (about; drawn by hash), and rows of a shard
SAMPLE_ROWS, SHARD_ROWS = 32768, 8192
BITS = 22
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.1
PAIR_VALUE = 0.3
#: how often a toxic example counts
POSITIVE = 4.0
THRESHOLD = 0.3
#: second words of the pairs: next word, one skipped, two skipped
GAPS = (1, 2, 3)
#: fixed values: white space and ASCII punctuation stand between words
_BETWEEN = words.SPACES.copy()
_BETWEEN[[i for i in range(0x21, 0x7F) if not chr(i).isalnum()]] = True


def features(column: pa.Array):
    """Runs of (row, feature) arrays: hashed words and word pairs, repeats included, of whole texts.

    Features of pairs are odd numbers, those of single words even ones."""
    lowered = pc.utf8_lower(column.fill_null("").cast(pa.large_string()))
    for first, end, data, offsets in words.chunks(lowered):
        starts, ends, at = words.spans(data, offsets, _BETWEEN)
        hashed = words.word_hashes(data, starts, ends, lower=False)
        row = np.repeat(np.arange(first, end), np.diff(at))
        one, two = np.uint64(1), np.uint64(64 - BITS)
        found, rows = [(hashed >> two) & ~one], [row]
        for gap in GAPS:
            same = row[:-gap] == row[gap:]
            pair = words.mix(hashed[:-gap] * np.uint64(2 * gap + 1) + hashed[gap:] * np.uint64(0x9FB21C651E98DF25))
            found.append((pair[same] >> two) | one)
            rows.append(row[:-gap][same])
        yield np.concatenate(rows), np.concatenate(found).astype(np.int32)


@dataclass
class Ftrl:
    """FTRL-proximal with per-coordinate rates; examples are sets of features."""

    z: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1))
    n: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == 1 << BITS, 0.0, L1)  # the intercept stays free
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: float) -> None:
        weights, value = self.weights(at), values(at)
        slope = (sigmoid((weights * value).sum()) - label) * (POSITIVE if label else 1.0) * value
        n = self.n[at]
        self.z[at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA * weights
        self.n[at] = n + slope * slope


def values(at: np.ndarray) -> np.ndarray:
    """What a present feature counts: pairs, of which there are many more, count less than words."""
    return np.where(at & 1, PAIR_VALUE, 1.0)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def _train_shard(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("order", kind="stable")
    examples = [np.zeros(0, np.int32)] * len(shard)
    for rows, found in features(pa.array(shard["text"], pa.string(), from_pandas=True)):
        order = np.argsort(rows, kind="stable")
        own, begins = np.unique(rows[order], return_index=True)
        for row, part in zip(own, np.split(found[order], begins[1:])):
            examples[row] = part
    labels, model = shard["label"].to_numpy(float), Ftrl()
    examples = [np.append(np.unique(x), np.int32(1 << BITS)) for x in examples]
    for _ in range(EPOCHS):
        for at, label in zip(examples, labels):
            model.learn(at, label)
    seen = np.flatnonzero(model.n)
    weights = model.weights(seen)
    return pd.DataFrame({"feature": seen[weights != 0], "weight": weights[weights != 0]})


def held_out(key: Column) -> Column:
    """Rows that never teach: crc32 of the key as text has remainder 2 modulo 4. A NULL key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS) -> dict[int, float]:
    """Weights by feature, the intercept at 2**BITS; empty if no row teaches.

    Rows with NULL key or label teach nothing; a key with several labels counts as its largest; repeated documents count
    repeatedly. ``sample_rows`` bounds the rows drawn (by hash of the key, so alike on each run).
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key))).groupBy(key).agg(F.max(label).alias("label"))
    n = known.count()
    if not n:
        return {}
    draw = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(1 << 30))
    shards = max(1, -(-min(n, sample_rows) // shard_rows))
    sample = known.where(draw < int((1 << 30) * min(1.0, sample_rows / n))).select(F.col(key).alias("k"), "label", draw.alias("order"))
    # at most about sample_rows rows of 20 bytes
    lessons = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(sample), "k")
    taught = lessons.withColumn("shard", F.pmod(F.xxhash64(F.lit(23), "k"), F.lit(shards))).groupBy("shard").applyInPandas(_train_shard, "feature long, weight double")
    return {r["feature"]: r["total"] / shards for r in taught.groupBy("feature").agg(F.sum("weight").alias("total")).collect()}


def dense_weights(weights: dict[int, float]) -> np.ndarray:
    """What each feature adds to a score."""
    places = np.fromiter((k for k in weights if k < 1 << BITS), np.int64)
    dense = np.zeros(1 << BITS, np.float32)
    dense[places] = np.array([weights[k] for k in places]) * values(places)
    return dense


def score_array(column: pa.Array, weights: dict[int, float], dense: np.ndarray | None = None) -> np.ndarray:
    """Scores in [0, 1] of whole texts, NULL as empty. Without weights every score is 0."""
    if not weights:
        return np.zeros(len(column))
    dense = dense_weights(weights) if dense is None else dense
    total = np.full(len(column), weights.get(1 << BITS, 0.0))
    for rows, found in features(column):
        hit = dense[found] != 0
        pairs = np.unique(rows[hit].astype(np.int64) << BITS | found[hit])  # a feature counts once per text
        total += np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=len(total))
    return sigmoid(total)


def score(docs: DataFrame, text: str, weights: dict[int, float], into: str = "toxicity") -> DataFrame:
    """``docs`` with the score of every row in column ``into`` (replaced if there)."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = dense_weights(weights)  # once per task
        for column in columns:
            parts = small_batches([pa.RecordBatch.from_arrays([column], ["text"])])
            yield pa.array(np.concatenate([np.zeros(0), *[score_array(x.column(0), weights, dense) for x in parts]]))

    return docs.withColumn(into, F.arrow_udf(run, T.DoubleType())(F.col(text)))
