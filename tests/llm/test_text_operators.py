import hashlib
import os
import random
import re
import subprocess
import sys
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from llm.corpus import SCHEMA, corpus, near_groups, shingles, without_repeated_lines, words_of
from ticklake.llm import byte_bpe, line_dedup, minhash_dedup, mixing, substring_dedup, token_counts, token_files, toxicity, words
from ticklake.llm.components import connected_components
from ticklake.llm.queries import bpe_rules
from ticklake.operators import lookup

CORPUS = corpus()
PYTHON = re.compile("EvalPython|EvalPandas|InArrow|InPandas")


@pytest.fixture(scope="module")
def docs(spark):
    """Clashing names stand beside the columns that count."""
    frame = spark.createDataFrame(CORPUS, SCHEMA)
    clashing = ["row", "ids", "id", "component", "size", "slice", "key", "hash", "line_stats", "document", "chunk", "start", "n"]
    return frame.withColumns({c: F.lit("other") for c in clashing}).repartition(5)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def test_words_and_windows():
    texts = ["a  b\tc", None, "", " x", "É\x1cé a", "b\x0bc\x0c", "a  b c " * 1000, "tail"]
    found = []
    for first, end, data, offsets in words.chunks(pa.array(texts), 64):
        starts, ends, at = words.spans(data, offsets)
        assert len(words.word_hashes(data, starts, ends, True)) == len(starts)
        found += [[data[a:b].tobytes().decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(at, at[1:])]
    assert found == [words_of(t) for t in texts]
    hashed = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    again = np.concatenate([hashed[50:80], hashed])
    assert words.window_hashes(again, 30)[0] == words.window_hashes(hashed, 30)[50] and len(words.window_hashes(hashed, 300)) == 0
    assert list(words.chunks(pa.array([], pa.string()))) == []


def test_shingle_sets_of_all_texts():
    texts = [r[1] for r in CORPUS]
    assert [len(s) for s in words.shingle_sets(pa.array(texts), 5)] == [len(shingles(t)) for t in texts]


def test_near_copies(docs, nothing):
    texts = {}
    for i, t, *_ in CORPUS:
        if i is not None:
            texts[i] = t
    want = near_groups(texts)
    got = minhash_dedup.near_copies(docs)
    assert rows(got.where("doc_id IS NOT NULL")) == sorted(((i, len(shingles(texts[i])), c, c == i) for i, c in want.items()), key=repr)
    assert len(set(want.values())) < len(want) - 6
    assert rows(got.where("doc_id IS NULL"), "component_id", "kept") == [(None, True)] * 3
    assert minhash_dedup.near_copies(nothing).count() == 0


def test_near_copies_in_crowded_buckets(spark, monkeypatch):
    """A group of many variants, some far from its centre: links between components are found in blocks of buckets."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 160):
        own, at = list(base), rng.randrange(0, 90)
        for j in range(at, at + rng.randrange(0, 50)):
            own[j] = f"x{at // 15}-{j}"
        texts[i] = " ".join(own)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 24)
    got = minhash_dedup.near_copies(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    want = near_groups(texts)
    assert dict(rows(got, "doc_id", "component_id")) == want and 1 < len(set(want.values())) < 150


def test_keys_with_several_texts_are_one_document(spark):
    data = [(1, "a b c d e f"), (1, "a b"), (2, "a b c d e f"), (3, "a b")]
    got = minhash_dedup.near_copies(spark.createDataFrame(data, "doc_id bigint, text string"))
    assert rows(got, "doc_id", "n_shingles", "component_id") == [(1, 2, 1), (2, 2, 1), (3, 1, 3)]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7), (None, 3)]
    links += [(9, 600 + i) for i in range(300)]  # a hub
    nodes = {x for a, b in links if a is not None and a != b for x in (a, b)}
    from llm.corpus import smallest_reachable

    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")
    assert dict(rows(got)) == smallest_reachable(nodes, [(a, b) for a, b in links if a in nodes and b in nodes])
    assert connected_components(spark.createDataFrame([(1, 1)], "a bigint, b bigint"), "a", "b").count() == 0


def test_lines_in_many_documents_go(docs, nothing):
    got = line_dedup.drop_repeated_lines(docs, min_docs=10)
    want = without_repeated_lines([(r[0], r[1]) for r in CORPUS], 10)
    assert rows(got, "doc_id", "line_stats.n_lines", "line_stats.n_dropped", "text") == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 50 and set(got.columns) == set(docs.columns)
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    assert not PYTHON.search(plan(got))


def test_a_line_in_every_document(spark):
    """Keys that most rows hold are joined apart from the others."""
    data = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("Same\nown "), "id", F.lit("\nhalf "), F.col("id") % 2).alias("text"))
    got = line_dedup.drop_repeated_lines(data).select("text", "line_stats.n_dropped")
    assert got.where("n_dropped <> 2 OR NOT text LIKE 'own %'").count() == 0 and got.count() == 3000


def test_byte_bpe(docs, nothing):
    own = byte_bpe.encoding(*bpe_rules())
    for packed in (False, True):
        encoded = byte_bpe.encode(docs, "doc_id", "text", *bpe_rules(), packed=packed, piece_chars=100)
        got = rows(byte_bpe.decode(encoded, "doc_id", "ids", *bpe_rules()))
        form = (lambda ids: bytearray(np.array(ids, "<u4").tobytes())) if packed else list
        want = [(r[0], form(own.encode_ordinary(r[1] or "")), bytearray((r[1] or "").encode())) for r in CORPUS]
        assert got == sorted(want, key=repr)
    assert byte_bpe.encode(nothing, "doc_id", "text", *bpe_rules()).count() == 0


def test_pieces_never_change_the_ids():
    own, rng = byte_bpe.encoding(*bpe_rules()), random.Random(5)
    parts = ["a", "B1", "'s", " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "é", "日", "!", "?!", "12", " 't", "\r\n", "🙂"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        cut = list(byte_bpe.pieces(text, rng.randrange(1, 6)))
        assert "".join(cut) == text
        assert [i for p in cut for i in own.encode_ordinary(p)] == own.encode_ordinary(text)


def test_raw_bytes_may_cut_characters(spark):
    own = byte_bpe.encoding(*bpe_rules())
    ids = own.encode_ordinary("🙂")
    frame = spark.createDataFrame([(1, ids[:1]), (2, None), (3, [])], "k bigint, x array<int>")
    assert rows(byte_bpe.decode(frame, "k", "x", *bpe_rules()), "k", "decoded") == [(1, bytearray(own.decode_bytes(ids[:1]))), (2, bytearray()), (3, bytearray())]


def test_token_counts(docs, nothing):
    path = P.path("piece_bpe_32k.model")
    own, proven = token_counts.model(path)
    want = [(r[0], len((r[1] or "").encode()), len(own.encode(r[1] or ""))) for r in CORPUS]
    assert proven and rows(token_counts.count_tokens(docs, "doc_id", "text", path)) == sorted(want, key=repr)
    assert rows(token_counts.count_tokens(docs, "doc_id", "text", path, huge_bytes=50)) == sorted(want, key=repr)
    assert token_counts.count_tokens(nothing, "doc_id", "text", path).count() == 0


def test_overlaps_are_spliced_where_nothing_merges():
    own, rng = token_counts.model(P.path("piece_bpe_32k.model"))[0], random.Random(6)
    parts = ["a", "the", " ", "  ", "\n", "▁", "é", "日本", ".", "***", "<s>", "\x00", "word", " word", "🙂"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(200))) for _ in range(300)] + ["a" * 3000, " " * 2000, "é" * 2000, "ab " * 2000]
    for text in texts:
        for chunk, overlap in ((20, 4), (100, 10), (400, 30)):
            assert token_counts.count_huge(own, text.encode(), chunk, overlap) == len(own.encode(text))


def _without_repeats(texts: list[tuple], window: int) -> list[tuple]:
    first: dict[tuple, int] = {}
    for i, t in texts:
        w = words_of(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k:k + window])] = min(i, first.get(tuple(w[k:k + window]), i))
    out = []
    for i, t in texts:
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("window", [50, 51, 7])
def test_repeated_passages_go(docs, nothing, window, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_ROWS", 9)
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(substring_dedup, "CELL_BYTES", 30_000)
    want = _without_repeats([(r[0], r[1]) for r in CORPUS], window)
    got = rows(substring_dedup.remove_repeats(docs, window=window))
    assert got == sorted(want, key=repr) and sum(w[2] for w in want) > 1000
    if window == 50:
        hashed = substring_dedup.remove_repeats(docs, digest=True)
        assert rows(hashed, "doc_id", "kept") == sorted(((w[0], hashlib.sha256(w[3].encode()).hexdigest()) for w in want), key=repr)
        assert substring_dedup.remove_repeats(nothing).count() == 0


def test_token_files(spark, docs, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 2000)
    monkeypatch.setattr(token_files, "TOGETHER_IDS", 9000)
    path, out = P.path("word_bpe_49k.json"), str(tmp_path / "ids")
    own = token_files.tokenizer(path)[0]
    ids = {r[1]: [*own.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in CORPUS}
    token_files.write_ids(docs, "doc_id", "text", path, 1, out, parts=3)
    got = token_files.read_ids(spark, out, "doc_id").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in CORPUS), key=lambda i: (i is not None, i))
    sizes = [len(r["ids"]) // 4 for r in got]
    assert [r["start"] for r in got] == [sum(sizes[:i]) for i in range(len(sizes))]
    assert sorted(bytes(r["ids"]) for r in got) == sorted(np.array(ids[r[1]], "<u4").tobytes() for r in CORPUS)
    texts = {r[0]: r[1] for r in CORPUS}
    assert all(bytes(r["ids"]) == np.array(ids[texts[r["doc_id"]]], "<u4").tobytes() for r in got if r["doc_id"] is not None)
    assert token_files.stored_ids(nothing, "doc_id", "text", path, 1).count() == 0


def test_damaged_blocks_are_found(spark, tmp_path):
    data = spark.createDataFrame([(1, "some words here " * 50)], "doc_id bigint, text string")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    token_files.write_ids(data, "doc_id", "text", P.path("word_bpe_49k.json"), 1, good)
    spark.read.parquet(good).withColumn("block_crcs", F.transform("block_crcs", lambda x: x + 1)).write.parquet(bad)
    with pytest.raises(Exception, match="is damaged"):
        token_files.read_ids(spark, bad, "doc_id").collect()


def test_runs_give_the_ids_of_the_whole_text():
    encoder, rng = token_files.Encoder(P.path("word_bpe_49k.json")), random.Random(8)
    parts = ["a", "B", "É", "é", "́", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "　", "'s", "'T", "1", "23", "!", "<|endoftext|>", "日", "Σ", "İ", "ß", "</w>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(15))) for _ in range(1500)]
    found, sizes = encoder.encode(pa.array([*texts, None]), 1)
    assert encoder.by_runs
    for text, part in zip([*texts, ""], np.split(found, np.cumsum(sizes)[:-1])):
        assert part.tolist() == [*encoder.own.encode(text, add_special_tokens=False).ids, 1]


def test_range_coder_round_trip():
    from ticklake.llm import range_coder

    rng = np.random.default_rng(9)
    for top in (1, 2, 60, 65536, 1 << 20, 1 << 32):
        blocks = [rng.integers(0, top, n) for n in (0, 1, 5, 700, 701, 64)] + [np.repeat(top - 1, 500), rng.integers(0, min(top, 300), 90)]
        coded = range_coder.encode(blocks)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, range_coder.decode(coded, [len(b) for b in blocks])))
        assert coded[3] == range_coder.encode([blocks[3]])[0]  # blocks do not depend on each other
    repeated = np.tile(rng.integers(0, 40000, 50), 40).astype(np.int32)
    assert len(range_coder.encode([repeated])[0]) < len(repeated) // 2
    assert range_coder.encode([]) == [] and range_coder.decode([], []) == []
    for wrong in (1 << 32, -1):
        with pytest.raises(ValueError):
            range_coder.encode([np.array([wrong])])


def test_range_coder_halves_full_rows():
    """Ids that the contexts never guess and that share their upper bits fill a row of frequencies."""
    from ticklake.llm import range_coder

    blocks = [np.random.default_rng(12).integers(0, 16, 9000)]
    assert 24 * 9000 > 1 << 16
    coded = range_coder.encode(blocks)
    assert (range_coder.decode(coded, [9000])[0] == blocks[0]).all()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no sample tables")
def test_range_coder_is_shorter_than_zlib():
    """On blocks of the same ids, by a tenth at least, and below what frequencies of whole ids alone give to a block."""
    import pyarrow.parquet as pq

    from ticklake.llm import range_coder

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column(0).combine_chunks()
    ids = token_files.Encoder(P.path("word_bpe_49k.json")).encode(texts, 1)[0]
    for size in (1024, token_files.BLOCK_IDS):
        blocks = [ids[i:i + size] for i in range(0, len(ids), size)]
        coded = range_coder.encode(blocks)
        assert sum(map(len, coded)) < 0.9 * sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks)


def test_toxicity(spark, docs, nothing):
    rng = random.Random(10)
    clean = [f"word{i}" for i in range(300)]
    data, labels = [], []
    for i in range(1200):
        text = [rng.choice(clean) for _ in range(rng.randrange(3, 80))]
        toxic = i % 8 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["Scum!", "moron,", "idiot"])
        data.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame([*data, (None, "scum"), (9999, None), (9998, "")], "doc_id bigint, text string")
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (77777, 1)], "doc_id bigint, toxic int")
    weights = toxicity.train(frame, known, "doc_id", "text", "toxic")
    scored = toxicity.score(frame.withColumn("toxicity", F.lit("other")), "text", weights).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    assert {r["doc_id"] for r in scored if r["out"]} == {i for i, _ in data if zlib.crc32(str(i).encode()) % 4 == 2} | {i for i in (9998, 9999) if zlib.crc32(str(i).encode()) % 4 == 2}
    tested = [(r["toxicity"] >= toxicity.THRESHOLD, r["doc_id"] % 8 == 0) for r in scored if r["out"] and r["doc_id"] < 1200]
    assert sum(a == b for a, b in tested) >= 0.95 * len(tested)
    assert all(0 <= r["toxicity"] <= 1 for r in scored)
    assert toxicity.train(frame, known.limit(0), "doc_id", "text", "toxic") == {}
    assert {r["toxicity"] for r in toxicity.score(docs, "text", {}).collect()} == {0.0}
    assert toxicity.score(nothing, "text", weights).count() == 0


def _targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Shares by weight, capped at three times the size, the excess shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return target


def test_mixing(docs, nothing):
    size = mixing.count_words(F.col("text"))
    mixed = mixing.mix(docs, "doc_id", "source", size, mixing.letter_share(F.col("text")), (5, 2, 1), slices=16, keep_rows=True)
    got = mixed.select("doc_id", "row.source", "size", "source_size", "target", "taken").collect()
    assert sorted((r[0], r[2]) for r in got if r[0] is not None) == sorted((r[0], len(words_of(r[1]))) for r in CORPUS if r[0] is not None)
    sizes = {}
    for r in CORPUS:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words_of(r[1]))
    target = _targets(sizes)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]} and all(abs(r["target"] - target[s]) < 1e-6 * (1 + target[s]) for r in own)
        assert all(r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"]) for r in own)
        assert abs(sum(r["taken"] for r in own) - target[s]) <= max(r["size"] for r in own)
        epochs = {r["taken"] // r["size"] for r in own if r["size"]}
        assert max(epochs) - min(epochs) <= 1  # complete epochs come first
    again = mixing.mix(docs.repartition(3), "doc_id", "source", size, mixing.letter_share(F.col("text")), (5, 2, 1))
    assert rows(again) == rows(mixed.drop("row"))  # reruns agree, whatever the partitions and slices
    assert mixing.mix(nothing, "doc_id", "source", size, F.lit(1.0), (5, 2, 1)).count() == 0
    assert not PYTHON.search(plan(again))


def test_documents_of_better_quality_are_taken_first(spark):
    data = spark.range(20000).select("id", (F.col("id") % 2).cast("string").alias("source"), F.lit(10).alias("n"), F.when(F.col("id") % 4 < 2, 1.0).otherwise(0.1).alias("q"))
    mixed = mixing.mix(data, "id", "source", F.col("n"), F.col("q"), (3, 1)).where("id % 2 = 1")  # half of its words
    taken = dict(rows(mixed.groupBy((F.col("id") % 4 < 2).cast("int")).agg(F.sum("taken"))))
    assert abs(taken[0] + taken[1] - 50000) <= 10 and taken[1] > 3 * taken[0]


def test_skewed_sources_are_shared_again(spark):
    for sizes in ([100, 1, 1], [1, 100, 1, 1, 50], [5], [0, 7], [0, 0], [3, 3, 3, 3, 300, 3]):
        data = spark.createDataFrame([(chr(97 + i), n) for i, n in enumerate(sizes)], "source string, source_size bigint")
        want = _targets({chr(97 + i): n for i, n in enumerate(sizes)}) if sum(sizes) else {chr(97 + i): 0.0 for i in range(len(sizes))}
        got = dict(rows(mixing.source_targets(data, (5, 2, 1), 3), "source", "target"))
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 * (1 + want[s]) for s in want)


def test_many_sources(spark, monkeypatch):
    """100,000 sources: no task sorts them all, and what is known of them is joined beyond the size that may be broadcast."""
    sizes = {f"s{i:06d}": i * 7919 % 1000 + 1 for i in range(100_000)}
    data = spark.range(200_000).select(
        "id", F.format_string("s%06d", (F.col("id") / 2).cast("int")).alias("source"), F.when(F.col("id") % 2 == 0, (F.col("id") / 2).cast("long") * 7919 % 1000 + 1).otherwise(0).alias("n"))
    want = _targets(sizes)
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", 1 << 20)
    mixed = mixing.mix(data, "id", "source", F.col("n"), F.lit(1.0), (5, 2, 1), slices=4)
    found = mixed.where("id % 2 = 0").select("id", "target", "taken", "size").toPandas()
    expected = np.array([want[f"s{i // 2:06d}"] for i in found["id"]])
    assert len(found) == 100_000 and np.abs(found["target"] - expected).max() < 1e-6
    assert (np.abs(found["taken"] - expected) <= found["size"]).all() and mixed.where("id % 2 = 1 AND taken <> 0").count() == 0


def test_the_queries_are_registered_without_gaps():
    from ticklake.llm.queries import QUERIES

    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert os.path.exists(P.path("word_bpe_49k.json"))


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 900, 3000))
    texts = [text, "x" * 5000, text + " é" * 700, "a b"]
    whole = [s.tolist() for s in words.shingle_sets(pa.array(texts), 5)]
    monkeypatch.setattr(words, "CHUNK_BYTES", 256)
    assert [s.tolist() for s in words.shingle_sets(pa.array(texts), 5)] == whole
    assert [s.tolist() for s in words.shingle_sets(pa.array(texts[::-1]), 5)] == whole[::-1]


def test_a_text_of_50_mb_needs_little_memory():
    """Shingles of one huge text in a process of its own: beside the text and its set, only word-level arrays grow."""
    code = (
        "import resource, numpy as np, pyarrow as pa\n"
        "from ticklake.llm import words\n"
        "t = pa.array([' '.join(map(str, range(6_600_000)))], pa.large_string())\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "n = sum(len(s) for s in words.shingle_sets(t, 5))\n"
        "print(t.nbytes >> 20, n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)\n")
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    size, n, more = map(int, run.stdout.split())
    assert size >= 45 and n == 6_600_000 - 4 and more < 500, run.stdout


def test_documents_of_many_repeated_lines(spark):
    """Lines are looked up in order: the time does not grow with the square of a document's lines."""
    def made(n):
        rows = [(i, "\n".join(f"line {j}" for j in range(n)) + f"\nown {i}") for i in range(12)]
        return spark.createDataFrame(rows, "doc_id bigint, text string")

    got = line_dedup.drop_repeated_lines(made(300), min_docs=10)
    assert rows(got, "doc_id", "text", "line_stats.n_dropped") == sorted(((i, f"own {i}", 300) for i in range(12)), key=repr)
    start = time.perf_counter()
    assert rows(line_dedup.drop_repeated_lines(made(8000), min_docs=10), "text") == sorted(((f"own {i}",) for i in range(12)), key=repr)
    assert time.perf_counter() - start < 20
