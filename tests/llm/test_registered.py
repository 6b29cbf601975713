"""Registered queries without an SQL twin, on whole sample tables, against the libraries and a plain learner."""

import hashlib
import math
import os
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ticklake.llm import queries, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no sample tables")


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return sorted((r["doc_id"], r["text"] or "") for r in table)


def little(ids):
    return np.array(ids, "<u4").tobytes()


def test_op5(spark, texts):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_tiktoken_bpe(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = []
    for doc, text in texts:
        ids = own.encode_ordinary(text)
        want.append((doc, len(ids), hashlib.sha256(little(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = queries.op5_byte_bpe(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == want


def test_op6(spark, texts):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    sizes = [(doc, len(text.encode()), len(own.encode(text))) for doc, text in texts]
    got = queries.op6_token_counts(spark, SF).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert sorted(map(tuple, got.collect())) == [(*s, s[2] > 4096) for s in sizes]


def test_op8(spark, texts):
    from tokenizers import Tokenizer

    own, start, want = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0, []
    for doc, text in texts:
        ids = [*own.encode(text, add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), zlib.crc32(little(ids))))
        start += len(ids)
    got = queries.op8_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def test_op3_learns_like_a_plain_learner(spark):
    """FTRL-proximal with dicts and scalars, an example after the other, and the scores of the registered query from its weights."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    order = F.pmod(F.xxhash64(F.lit(17), F.col("doc_id")), F.lit(1 << 30))
    taught = docs.join(labels.select("doc_id", "toxic"), "doc_id").where("toxic IS NOT NULL").withColumn("order", order).collect()
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i == 1 << toxicity.BITS else toxicity.L1
        value = z.get(i, 0.0)
        return 0.0 if abs(value) <= l1 else -(value - math.copysign(l1, value)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    def present(text):
        found = [f for _, f in toxicity.features(pa.array([text], pa.string()))]
        return sorted({int(x) for part in found for x in part}) + [1 << toxicity.BITS]

    def size(i):
        return toxicity.PAIR_VALUE if i & 1 else 1.0

    lessons = [(present(r["text"]), r["toxic"]) for r in sorted(taught, key=lambda r: r["order"]) if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    for _ in range(toxicity.EPOCHS):
        for at, label in lessons:
            weights = [weight(i) for i in at]
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w * size(i) for w, i in zip(weights, at))))))
            for i, w in zip(at, weights):
                slope = (p - label) * (toxicity.POSITIVE if label else 1.0) * size(i)
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + slope - (math.sqrt(old + slope * slope) - math.sqrt(old)) / toxicity.ALPHA * w
                n[i] = old + slope * slope
    want = {i: w for i in z if (w := weight(i))}
    got = toxicity.train(docs, labels, "doc_id", "text", "toxic")
    assert want.keys() == got.keys() and all(math.isclose(got[i], w, rel_tol=1e-6, abs_tol=1e-9) for i, w in want.items())
    scores = {r["doc_id"]: (r["score"], r["predicted"], r["held_out"]) for r in queries.op3_toxicity(spark, SF).collect()}
    for r in docs.select("doc_id", "text").collect():
        total = sum(want.get(i, 0.0) * size(i) for i in present(r["text"]))
        score, predicted, held = scores[r["doc_id"]]
        assert math.isclose(score, 1 / (1 + math.exp(-total)), abs_tol=1e-5) and predicted == int(score >= 0.3)
        assert held == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
