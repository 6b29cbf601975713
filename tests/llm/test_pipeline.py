"""The pipeline against a plain version of all its stages."""

import hashlib
import math
import random
import re

import pyarrow as pa
import pytest

import corpus_pipeline
from conftest import rows
from llm.corpus import SCHEMA, corpus, near_groups, without_repeated_lines, words_of
from ticklake.llm import byte_bpe, toxicity
from ticklake.llm.queries import bpe_rules

LETTERS = re.compile(r"[^\W\d_]")


def plain(documents: list[tuple], weights: dict) -> list[tuple]:
    """(doc_id, ids) that the pipeline returns for documents with unique ids."""
    scores = toxicity.score_array(pa.array([r[1] for r in documents], pa.string()), weights)
    kept = [r for r, s in zip(documents, scores) if s < toxicity.THRESHOLD]
    cleaned = without_repeated_lines([(r[0], r[1]) for r in kept], 10)
    docs = {r[0]: (None if r[1] is None else c[3], r[3]) for r, c in zip(kept, cleaned)}
    group = near_groups({i: t for i, (t, _) in docs.items()})
    docs = {i: x for i, x in docs.items() if group[i] == i}

    size = {i: len(words_of(t)) for i, (t, _) in docs.items()}
    sources = sorted({s for _, s in docs.values()}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, (_, own) in docs.items() if own == s) for s in sources}
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sources)}
    target, free, left = {}, set(sources), float(sum(total.values()))
    while free:
        shares = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if shares[s] > 3 * total[s]}
        target |= {s: 3.0 * total[s] for s in over} if over else shares
        left -= sum(3 * total[s] for s in over)
        free = free - over if over else set()

    def arrival(i):
        u = (int(hashlib.md5(f"0|{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        text = docs[i][0]
        quality = max(0.05, len(LETTERS.findall(text)) / len(text)) if text else 0.05
        return -math.log(u) / quality

    own, out = byte_bpe.encoding(*bpe_rules()), []
    for s in sources:
        epochs = int(target[s] // total[s]) if total[s] else 0
        rest, seen = (target[s] - epochs * total[s] if epochs < 3 else 0.0), 0
        for i in sorted((i for i, x in docs.items() if x[1] == s), key=arrival):
            copies = epochs + (seen + size[i] / 2 <= rest)
            seen += size[i]
            out += [(i, own.encode_ordinary(docs[i][0] or ""))] * (copies if size[i] else 0)
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, folder = random.Random(11), str(tmp_path_factory.mktemp("tables"))
    documents = [r for n, r in enumerate(corpus(12, 260)) if r[0] is not None and r not in corpus(12, 260)[:n]]
    labels = []
    for n, r in enumerate(documents):
        if n % 5 == 0 and r[1]:
            documents[n] = (r[0], r[1] + " Scum", *r[2:4], len(r[1]) + 5)
        if rng.random() < 0.9:
            labels.append((r[0], 1, int(n % 5 == 0 and bool(r[1]))))
    spark.createDataFrame(documents, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, documents


def test_run_is_all_stages_one_after_another(spark, tables):
    folder, documents = tables
    weights = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "text", "toxic")
    got = corpus_pipeline.run(spark, folder)
    want = plain(documents, weights)
    assert rows(got, "doc_id", "ids") == want and 50 < len({i for i, _ in want}) < len(documents) - 30
    assert got.where("n_tokens <> size(ids)").count() == 0


def test_stages_keep_the_columns_and_bear_awkward_rows(spark, tables):
    """NULLs in all columns, repeated rows, and no rows at all."""
    folder, _ = tables
    for docs in (spark.createDataFrame(corpus(), SCHEMA), spark.createDataFrame([], SCHEMA)):
        docs = docs.withColumns({c: docs["lang"] for c in ("score", "rank", "row", "copy", "no_text")})
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            out = spark.createDataFrame(out.collect(), out.schema)
            if name != "byte-level BPE":
                assert out.columns == docs.columns
                assert out.where("doc_id IS NOT NULL AND n_chars IS NOT NULL AND n_chars <> length(coalesce(text, ''))").count() == 0
            if name in ("line dedup", "byte-level BPE"):
                assert out.count() == docs.count()
            if name == "near dedup" and n:
                assert out.where("doc_id IS NOT NULL").count() == out.select("doc_id").where("doc_id IS NOT NULL").distinct().count()
                assert out.where("doc_id IS NULL").count() == docs.where("doc_id IS NULL").count()
            docs = out
