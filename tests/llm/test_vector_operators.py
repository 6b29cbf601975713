import math
import operator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm.corpus import smallest_reachable
from ticklake.llm import ball_tree, embedding_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed: int = 1, n: int = 900, dim: int = 24) -> list[tuple]:
    """Random vectors, groups of near copies, copies, and every kind that takes no part."""
    rng = np.random.default_rng(seed)
    data = []
    for i in range(n):
        v = rng.standard_normal(dim)
        if i % 3 == 0:
            v = data[i // 9][1] + rng.standard_normal(dim) * rng.choice([0.05, 0.2, 0.3]) if i else v
        if i % 50 == 7:
            v = np.asarray(data[i - 5][1])
        data.append((i * 2, np.asarray(v), int(i % 4)))
    out = [(i, [float(np.float32(x)) for x in v], l if i % 31 else None) for i, v, l in data]
    out += [(5001, None, 1), (5003, [], 1), (5005, [0.0] * dim, 1), (5007, [0.0, None] * (dim // 2), 1), (5020, [math.nan] * dim, 1),
            (5040, [math.inf] + [0.0] * (dim - 1), 2), (5060, [1.0, 2.0], 0), (5080, [2.0, 4.0], 0), (None, out[0][1], 0), out[4], out[4]]
    return out


DATA = vectors()


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(DATA, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "dim", "shard", "part", "vector", "filter", "copies")}).repartition(4)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def best(data, every, k, scale=64.0):
    known = {i: [math.floor(scale * x) for x in v] for i, v, _ in data if i is not None and usable(v)}
    out = []
    for q, a in known.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in known.items() if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def test_top_k(spark, table):
    want = best(DATA, 20, 20)
    got = ball_tree.top_k(table, "vec_id", "embedding", 20, 20, 64.0, shard_rows=200, query_rows=20)
    assert sorted(map(tuple, got.collect())) == want
    assert ball_tree.top_k(table.limit(0), "vec_id", "embedding", 20, 20, 64.0).count() == 0


def test_top_k_of_few_rows_ties_and_large_numbers(spark):
    few = [(0, [1.0, 1.0], 0), (20, [1.0, 1.0], 0), (3, [1.0, 1.0], 0), (5, [-1.0, 0.5], 0)]
    frame = spark.createDataFrame(few, SCHEMA)
    assert sorted(map(tuple, ball_tree.top_k(frame, "vec_id", "embedding", 20, 2, 64.0).collect())) == best(few, 20, 2)
    assert ball_tree.top_k(frame, "vec_id", "embedding", 20, 20, 64.0).count() == 6
    large = [(i, [float(np.float32(x)) for x in (1e6 + i * 64, -2e5 * i, 3.0)], 0) for i in range(30)]
    got = ball_tree.top_k(spark.createDataFrame(large, SCHEMA), "vec_id", "embedding", 10, 4, 64.0)
    assert sorted(map(tuple, got.collect())) == best(large, 10, 4)


def test_top_k_beyond_exact_doubles(spark):
    """Numbers up to the largest double, one outlier in a shard, scores beyond a long: exact, and cut to a long's range."""
    rng = np.random.default_rng(6)
    data = [(i, [float(x) for x in rng.standard_normal(4) * 10.0 ** rng.choice([0, 4, 8, 9])], 0) for i in range(120)]
    data += [(200, [1e307, -1e307, 1.0, 2.0], 0), (201, [-1.7e308, 0.0, 0.0, 1.0], 0), (220, [3.0, 5e-324, 0.0, 0.0], 0), (203, [0.0, 0.0, 1e300, -1e300], 0)]
    whole = {i: [math.floor(Fraction(64) * Fraction(x)) for x in v] for i, v, _ in data}
    want = []
    for q in whole:
        if q % 20 == 0:
            cut = sorted((-min(max(sum(map(operator.mul, whole[q], v)), -(1 << 63)), (1 << 63) - 1), i) for i, v in whole.items() if i != q)[:15]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(cut)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    for shard_rows in (30, 1000):
        got = ball_tree.top_k(frame, "vec_id", "embedding", 20, 15, 64.0, shard_rows=shard_rows, query_rows=3)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {abs(s) for *_, s in want} & {(1 << 63) - 1}


def test_an_outlier_stays_out_of_the_tree(monkeypatch):
    """One large row leaves the tree to the others; only that row is worked out in whole numbers."""
    rng = np.random.default_rng(7)
    rows_ = [[float(x) for x in v] for v in rng.standard_normal((2000, 32))]
    rows_[77][3] = 1e14
    calls = []
    whole = ball_tree.Floors.whole
    monkeypatch.setattr(ball_tree.Floors, "whole", lambda self, row: calls.append(row) or whole(self, row))
    shard = pa.table({"vec_id": range(2000), "vector": rows_})
    asked = pa.table({"query_id": range(5000, 5020), "vector": rows_[100:120], "least": pa.array([None] * 20, pa.int64())})
    found = ball_tree._search_shard(64.0, 5)(shard, asked)
    assert found.num_rows == 100 and len(calls) == 40


def test_ball_tree_prunes():
    rng = np.random.default_rng(2)
    centres = rng.integers(-600, 600, (40, 16))
    rows_ = (centres[rng.integers(0, 40, 8000)] + rng.integers(-5, 6, (8000, 16))).astype(float)
    tree = ball_tree.BallTree(np.arange(8000), rows_, 64)
    query = centres[3].astype(float)
    bounds = tree.centres @ query + np.linalg.norm(query) * tree.radii
    assert all((rows_[tree.ids[a:b]] @ query).max() <= x + 1e-6 for a, b, x in zip(tree.begin, tree.end, bounds))
    kth = np.sort(rows_ @ query)[-20]
    assert (bounds >= kth).sum() < len(bounds) / 4


def linked(data):
    known = {}
    for i, v, label in data:
        if i is not None and (i not in known):
            known[i] = (v, label) if usable(v) and any(v) and label is not None else None
    part = {i: x for i, x in known.items() if x}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, (v, _) in part.items()}
    ids = sorted(part)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if part[a][1] == part[b][1] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    counts = dict.fromkeys(known, 0)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    component = smallest_reachable(known, links)
    return sorted((i, counts[i], component[i], component[i] == i) for i in known)


@pytest.mark.parametrize("block", [1024, 8])
def test_near_vectors(table, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    want = linked(DATA)
    got = embedding_dedup.near_vectors(table)
    found = sorted(map(tuple, got.where("vec_id IS NOT NULL").collect()))
    assert found == want and sum(w[1] for w in want) > 300
    assert rows(got.where("vec_id IS NULL")) == [(None, 0, None, True)]
    if block == 8:
        assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_a_label_full_of_equal_vectors(spark):
    rng = np.random.default_rng(3)
    base = [float(np.float32(x)) for x in rng.standard_normal(16)]
    data = [(i, base if i % 3 else [x * 2 for x in base], 1) for i in range(500)] + [(900, base, 2), (901, [-x for x in base], 1), (902, [0.0, -0.0] * 8, 1)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(data, SCHEMA))
    assert sorted(map(tuple, got.collect())) == linked(data)


@pytest.mark.parametrize("code", [code for _, code in embedding_dedup.CODES], ids=str)
def test_recall_at_the_limit(code):
    """Pairs at exactly the least cosine share a filter; 99.9 % are asked for here, all are found in practice."""
    rng = np.random.default_rng(4)
    for length in (8, 64):
        x = rng.standard_normal((1500, length))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z = rng.standard_normal((1500, length))
        z -= (z * x).sum(axis=1, keepdims=True) * x
        z /= np.linalg.norm(z, axis=1, keepdims=True)

        mine, theirs = (embedding_dedup.filters_of(unit, code) for unit in (x, 0.93 * x + (1 - 0.93**2) ** 0.5 * z))
        shared = [len(np.intersect1d(a, b)) > 0 for a, b in zip(mine, theirs)]
        assert np.mean(shared) >= 0.999
        if length == 64:
            assert 20 < np.mean([len(a) for a in mine]) < 120  # as many for a larger code


def test_larger_codes_find_the_same_links(spark, monkeypatch):
    data = vectors(n=400, dim=40)
    monkeypatch.setattr(embedding_dedup, "CODES", ((1, embedding_dedup.CODES[0][1]), (1 << 62, embedding_dedup.CODES[1][1])))
    got = embedding_dedup.near_vectors(spark.createDataFrame(data, SCHEMA))
    assert sorted(map(tuple, got.where("vec_id IS NOT NULL").collect())) == linked(data)


def test_list_decoding_finds_all_tuples():
    rng = np.random.default_rng(5)
    products = rng.standard_normal((3, 7))
    sums = products[0][:, None, None] + products[1][None, :, None] + products[2][None, None, :]
    assert sorted(embedding_dedup.list_decode(products, 1.5)) == np.flatnonzero(sums.ravel() >= 1.5).tolist()
