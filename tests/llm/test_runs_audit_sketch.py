"""Periodic runs, the filter audit and scaled sketches against plain versions, and their queries against SQL."""

import hashlib
import os
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import plan, rows
from llm.corpus import SCHEMA, corpus, words_of
from oracle_check import compare, duck
from ticklake.llm import filter_audit, periodic_runs, scaled_sketch, words

CORPUS = corpus()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    clashing = ["key", "doc", "next", "tie", "range", "part", "failed", "n", "id", "runs", "collapsed", "sketch", "a", "b", "good"]
    return spark.createDataFrame(CORPUS, SCHEMA).withColumns({c: F.lit("other") for c in clashing}).repartition(5)


def plain_runs(w: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) by trying every lag."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            own = w[start:i + q]
            if len(own) >= max(6, 4 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                out.add((start, len(own), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(w: list[str]) -> str:
    gone = {i for s, n, q in plain_runs(w) for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repetitive(rng: random.Random) -> list[str]:
    """Words with runs of many periods, runs inside runs, and stretches just too short."""
    k, w = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randrange(1, 12)):
        unit = [f"w{rng.randrange(k)}é" for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 32, 33, 64, 100]))]
        if rng.random() < 0.3:
            unit = [x for y in unit[:4] for x in [y] * rng.randrange(1, 7)]
        w += [unit[i % len(unit)] for i in range(int(len(unit) * rng.choice([0.5, 2, 3.9, 4, 4.1, 6.5, 9])))]
    return w


def found_runs(texts: list) -> list[tuple]:
    out = []
    for _, _, n, runs, kept in periodic_runs._analyse(pa.array(texts, pa.string()), 4, 6):
        out += zip(n.to_pylist(), [[tuple(r.values()) for r in x] for x in runs.to_pylist()], kept.to_pylist())
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_all_found(seed):
    rng = random.Random(seed)
    lists = [repetitive(rng) for _ in range(60)] + [[], ["x"]]
    texts = [rng.choice(["", " "]) + rng.choice([" ", "\n", " \t "]).join(w) + rng.choice(["", " \n"]) for w in lists]
    assert found_runs(texts) == [(len(w), plain_runs(w), plain_collapsed(w)) for w in lists]


def test_long_periods_and_long_texts(monkeypatch):
    rng = random.Random(5)
    unit = [f"u{rng.randrange(40)}" for _ in range(1300)]
    w = [f"v{i}" for i in range(77)] + unit * 4 + unit[:1] + ["end"] * 5
    (got,) = found_runs([" ".join(w)])
    assert got[1] == [(77, 5201, 1300)] and got[2] == " ".join(w[:77 + 1300] + w[77 + 5201:])
    assert found_runs(["ab " * 50000])[0][1:] == ([(0, 50000, 1)], "ab")
    # a text over the chunk size is looked at in pieces
    monkeypatch.setattr(words, "CHUNK_BYTES", 512)
    assert found_runs([" ".join(w), "é" * 3000, " ".join(w[:40])])[0] == got


def test_runs_of_awkward_rows(docs, spark):
    got = periodic_runs.find_runs(docs, "doc_id", "text")
    want = [(i, len(words_of(t)), [list(r) for r in plain_runs(words_of(t))], plain_collapsed(words_of(t))) for i, t, *_ in CORPUS]
    assert sorted(((r[0], r[1], [list(x) for x in r[2]], r[3]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert periodic_runs.find_runs(docs.limit(0), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(9, np.uint64), np.array([0, 9]), exponent=3)


def plain_audit(documents: list[tuple], labels: dict) -> list[tuple]:
    """Every order walked row by row."""
    texts = [(r[0], r[1] or "", r[2] or "") for r in documents]
    first: dict[str, int] = {}
    for i, t, _ in texts:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    facts = []
    for i, t, part in texts:
        w = words_of(t)
        capitals = sum("A" <= c <= "Z" for c in t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * capitals > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i}
        facts.append((part, {f for f, x in fails.items() if x}, *labels.get(i, (0, 0))))
    out = []
    for part in {f[0] for f in facts}:
        own, steps, shapley = [f for f in facts if f[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                here = [x for x in own if f in x[1] and not x[1] & set(order[:k])]
                shapley[f] += len(here)
                steps.append((
                    part, "".join(order), k + 1, sum(not x[1] & set(order[:k + 1]) for x in own), len(here), sum(f in x[1] and bool(x[1] & set(order[:k])) for x in own),
                    sum(x[1] == {f} for x in own), sum(x[2] == 1 for x in here), sum(x[3] == 1 for x in here), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out, key=repr)


def test_audit_of_all_orders(docs, spark):
    rng = random.Random(2)
    known = {r[0]: (rng.randrange(2), rng.randrange(2)) for r in CORPUS if r[0] is not None and rng.random() < 0.7}
    extra = [(9001, "A#b " * 300, "en", None, 0), (9002, "x%y", "", None, 0), (9003, "A#b " * 300, None, None, 0)]
    table = docs.unionByName(spark.createDataFrame(extra, SCHEMA), allowMissingColumns=True)
    labels = spark.createDataFrame([(i, q, t) for i, (q, t) in known.items()] + [(None, 1, 1), (12345, 1, 1)], "doc_id bigint, quality int, toxic int")
    labels = labels.unionByName(labels.where("doc_id < 100").withColumns({"quality": F.lit(0), "toxic": F.lit(None).cast("int")}))  # a 0 beside a 1 changes nothing
    got = filter_audit.audit_documents(table, labels)
    assert rows(got) == plain_audit(CORPUS + extra, known)
    assert filter_audit.audit_documents(table.limit(0), labels).count() == 0
    assert filter_audit.audit_documents(table, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_lattice_paths():
    for n in range(1, 6):
        edges = filter_audit.lattice(n)
        assert len(edges) == n * 2 ** (n - 1)
        steps = [(s, f) for _, _, s, f in filter_audit.order_steps("ABCDE"[:n])]
        assert {(s, f): w for s, f, w in edges} == {x: steps.count(x) for x in set(steps)}
    with pytest.raises(ValueError):
        filter_audit.audit(None, "AA")


def test_one_text_in_a_third_of_the_rows(spark):
    table = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    got = filter_audit.audit_documents(table, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert rows(got.where("filter_order = 'EABCD' and step = 1"), "kept", "removed", "unique_fails") == [(2001, 999, 0)]


def plain_sketch(text: str | None, scale: bool = False) -> tuple[bool, frozenset]:
    w = words_of(text)
    hashed = [hashlib.md5(" ".join(w[i:i + 5]).encode()).hexdigest()[:16] for i in range(max(1, len(w) - 4))] if w else []
    whole = len(w) <= scaled_sketch.WHOLE + 4
    return whole, frozenset(h for h in hashed if whole or h < "2")


def plain_likeness(x, y) -> float:
    (a, b) = (frozenset(h for h in own[1] if h < "2") if own[0] and not other[0] else own[1] for own, other in ((x, y), (y, x)))
    return len(a & b) / len(a | b) if a | b else float(not x[1] and not y[1])


def plain_print(x) -> str:
    return ("1:" if x[0] else "8:") + "".join(sorted(x[1]))


def test_fingerprints(docs, spark):
    unique = {}
    for i, t, *_ in CORPUS:
        unique.setdefault((i, t or ""), None)
    # rows that share a key stand in the order of Spark's hash
    pairs = spark.createDataFrame(list(unique), "i bigint, t string").orderBy(F.col("i").asc_nulls_first(), F.xxhash64("t")).collect()
    want = {}
    for (i, t), (_, after) in zip(pairs, pairs[1:] + pairs[:1]):
        n = len(t) // 4
        new = t[:len(t) - n] + after[:n]
        a, b, c = plain_sketch(t), plain_sketch(new), plain_sketch(after)
        want[i, t] = (i, len(t), new, plain_print(a), plain_print(b), plain_likeness(a, b), plain_likeness(a, c))
    got = scaled_sketch.edited_fingerprints(docs, "doc_id", "text")
    assert rows(got) == sorted((want[i, t or ""] for i, t, *_ in CORPUS), key=repr)
    assert scaled_sketch.edited_fingerprints(docs.limit(0), "doc_id", "text").count() == 0
    alone = scaled_sketch.edited_fingerprints(spark.createDataFrame([(None, "a b c d")], "doc_id bigint, text string"), "doc_id", "text")
    assert rows(alone, "doc_id", "edited_text", "near_next") == [(None, "a b c a", 1.0)]
    assert not re.search("EvalPython|EvalPandas|InArrow|InPandas", plan(got))


def test_sketches_estimate_and_merge(spark):
    rng = random.Random(1)
    long = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    texts = {"long": " ".join(long), "part": " ".join(long[500:1500]), "short": " ".join(long[:60]), "other": " ".join(f"x{i}" for i in range(3000)), "both": " ".join(long + ["|"] + [f"x{i}" for i in range(3000)])}
    one = spark.createDataFrame([tuple(texts.values())], list(texts)).select(*[scaled_sketch.sketch(F.col(c)).alias(c) for c in texts])
    c = {x: F.col(x) for x in texts}
    got = one.select(
        scaled_sketch.containment(c["part"], c["long"]), scaled_sketch.containment(c["long"], c["part"]), scaled_sketch.likeness(c["part"], c["other"]),
        scaled_sketch.containment(c["short"], c["long"]), scaled_sketch.likeness(scaled_sketch.merge(c["long"], c["other"]), c["both"]),
        scaled_sketch.likeness(scaled_sketch.merge(c["short"], c["short"]), c["short"])).first()
    assert got[0] == 1.0 and abs(got[1] - 0.25) < 0.06 and got[2] == 0.0 and got[3] == 1.0 and got[4] > 0.98 and got[5] == 1.0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no sample tables")
@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_filter_audit", "op13_scaled_sketch"])
def test_queries(spark, name):
    assert compare(spark, duck(SF), SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None
