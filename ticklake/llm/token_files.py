"""Token-id files: texts are encoded with the tokenizers library, the ids range-coded in checksummed blocks, in the order
of the document keys, and read back.

The file format is a Parquet table of segments. A segment holds the ids of a run of documents: their keys and
numbers of ids, and the ids themselves cut into blocks, each with its number of ids, the CRC-32 of these ids as little-endian
unsigned 32-bit integers, and its bytes from the range coder. Blocks are independent; a damaged block is found by its
checksum and named. Segments carry their part (a range of keys) and the ids before them in the part; parts are numbered in the
order of the keys.

The library is asked once per distinct run of non-space characters (and per punctuation mark after a letter) and worker: its
normalizer and splitter never join or look across white space, so the ids of a text are those of its runs one after another. ``independent_runs`` checks on
load that a tokenizer is of that kind; another one gets whole texts.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.llm import range_coder
from ticklake.llm.common import small_batches
from ticklake.sources.workspace import scratch_path

SEGMENT_IDS, BLOCK_IDS = 1 << 20, 2048
#: ids that are coded side by side, and distinct runs that a task remembers
TOGETHER_IDS, KNOWN_RUNS = 1 << 22, 1 << 19
_SEGMENT = "part int, seq int, start long, keys array<bigint>, n_ids array<int>, block_ids array<int>, block_crcs array<bigint>, blocks array<binary>"
_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("keys", pa.list_(pa.int64())), ("n_ids", pa.list_(pa.int32())),
    ("block_ids", pa.list_(pa.int32())), ("block_crcs", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary()))])


def independent_runs(spec: dict) -> bool:
    """Whether white space is dropped between words and nothing reaches across it."""
    def steps(x: dict | None, name: str) -> list[dict]:
        return [] if x is None else [y for z in x[name] for y in steps(z, name)] if x["type"] == "Sequence" else [x]

    splits = steps(spec["pre_tokenizer"], "pretokenizers")
    first = splits[0] if splits else {}
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "[^\\s" in first["pattern"].get("Regex", "")
    plain = all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"} and x["content"] == " " for x in steps(spec["normalizer"], "normalizers"))
    adds = any(t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])
    return bool(drops and plain and not adds and not spec["truncation"] and not spec["padding"])


@lru_cache(2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        return own, independent_runs(json.load(file))


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """The worker's encoder, which keeps what it knows from task to task."""
    return Encoder(path)


class Encoder:
    """Texts to ids; remembers the ids of the runs that it has seen."""

    def __init__(self, path: str):
        self.own, self.by_runs = tokenizer(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.at, self.sizes, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def _learn(self, runs: list[str]) -> None:
        found = [e.ids for e in self.own.encode_batch_fast(runs, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        first, total = len(self.known), int(sizes.sum())
        while first + len(runs) > len(self.at):
            self.at, self.sizes = np.resize(self.at, 2 * len(self.at)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used:self.used + total] = [i for x in found for i in x]
        self.at[first:first + len(runs)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:first + len(runs)] = sizes
        self.used += total
        self.known.update((x, first + i) for i, x in enumerate(runs))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, ``end_id`` after each text, and the number of ids of each text."""
        texts = texts.fill_null("")
        if not self.by_runs:
            found = [[*e.ids, end_id] for e in self.own.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for x in found for i in x], np.int32), np.array([len(x) for x in found], np.int64)
        if len(self.known) > KNOWN_RUNS:
            self.forget()
        # the splitter always cuts between an ASCII letter and these marks; fewer distinct runs are left
        runs = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, r"([A-Za-z])([.,;:!?])", r"\1 \2"))
        per_text, flat = runs.value_lengths().to_numpy().astype(np.int64), runs.flatten()
        # so do those that differ by case; not where the normalizer could compose, nor in what may be a special token
        plain = pc.and_(pc.string_is_ascii(flat), pc.invert(pc.match_substring(flat, "<")))
        coded = pc.if_else(plain, pc.ascii_lower(flat), flat).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [x for x in distinct if x not in self.known]
        if new:
            self._learn(new)
        places = np.array([self.known[x] for x in distinct], np.int64)
        run = places[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        # blank ends of a text give empty runs, which have no ids; an end id follows the last run of a text
        sizes = self.sizes[run]
        ends = np.cumsum(np.concatenate([[0], sizes]))
        text_ids = np.diff(ends[np.concatenate([[0], np.cumsum(per_text)])])
        offset = np.repeat(self.at[run] - ends[:-1], sizes) + np.arange(ends[-1])
        return np.insert(self.flat[offset], np.cumsum(text_ids), end_id), text_ids + 1


def _segments(part: int, keys: list, sizes: np.ndarray, ids: np.ndarray, seq: int, start: int) -> pa.Table:
    """Segments of whole documents of about SEGMENT_IDS ids; all their blocks are coded at once."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    cuts = [0]
    while cuts[-1] < len(keys):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(edges, edges[cuts[-1]] + SEGMENT_IDS, "right")) - 1))
    rows, blocks = [], []
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        own = ids[edges[a]:edges[b]]
        parts = [own[j:j + BLOCK_IDS] for j in range(0, len(own), BLOCK_IDS)]
        blocks += parts
        rows.append({
            "part": part, "seq": seq + i, "start": start + int(edges[a]), "keys": keys[a:b], "n_ids": sizes[a:b].tolist(),
            "block_ids": [len(x) for x in parts], "block_crcs": [zlib.crc32(x.astype("<u4").tobytes()) for x in parts]})
    coded = iter(range_coder.encode(blocks))
    return pa.Table.from_pylist([row | {"blocks": [next(coded) for _ in row["block_ids"]]} for row in rows], _ARROW)


def write_ids(docs: DataFrame, key: str, text: str, tokenizer_file: str, end_id: int, path: str, parts: int | None = None) -> None:
    """Write the ids of all rows in ascending order of ``key`` (integer, NULL first; rows that share a key by text), each with ``end_id`` after
    its own. NULL and empty texts have the end id alone. Other columns do not matter."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    ordered = rows.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie", "text").select("key", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, seq, start = TaskContext.get().partitionId(), encoder(tokenizer_file), 0, 0
        keys, sizes, ids = [], [], []

        def flush() -> pa.Table:
            return _segments(part, keys, np.concatenate(sizes), np.concatenate(ids), seq, start)

        for batch in small_batches(batches):
            found, counts = known.encode(batch.column(1), end_id)
            keys += batch.column(0).to_pylist()
            sizes.append(counts)
            ids.append(found)
            if sum(map(len, ids)) >= TOGETHER_IDS:
                table = flush()
                yield from table.to_batches()
                seq, start = seq + table.num_rows, start + sum(map(len, ids))
                keys, sizes, ids = [], [], []
        if keys:
            yield from flush().to_batches()

    # the coder's bytes cannot be compressed further
    ordered.mapInArrow(run, _SEGMENT).write.option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, start, ids) of every document in the files: the number of ids of all documents before it, and its own ids packed as
    little-endian unsigned 32-bit integers. A block that does not match its checksum is an error."""
    segments = spark.read.parquet(path)
    # one row per part
    sizes = segments.groupBy("part").agg(F.sum(F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = sizes.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    read_as = ["part", key, "start", "ids"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                waiting += batch.slice(i, 1).to_pylist()
                if sum(sum(x["block_ids"]) for x in waiting) >= TOGETHER_IDS:
                    yield from _documents(waiting, read_as)
                    waiting = []
        yield from _documents(waiting, read_as)

    read = segments.mapInArrow(run, T.StructType([T.StructField("part", T.IntegerType()), T.StructField(key, T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())]))
    return read.join(F.broadcast(before), F.col("part") == F.col("p")).select(key, (F.col("start") + F.col("before")).alias("start"), "ids")


def _documents(segments: list[dict], names: list[str]) -> Iterator[pa.RecordBatch]:
    sizes = [n for s in segments for n in s["block_ids"]]
    blocks = range_coder.decode([b for s in segments for b in s["blocks"]], sizes)
    at = 0
    for segment in segments:
        own = blocks[at:at + len(segment["blocks"])]
        at += len(own)
        for i, (block, crc) in enumerate(zip(own, segment["block_crcs"])):
            if zlib.crc32(block.astype("<u4").tobytes()) != crc:
                raise ValueError(f"block {i} of part {segment['part']}, segment {segment['seq']} is damaged")
        ids = np.concatenate([np.zeros(0, np.uint32), *own]).astype("<u4")
        edges = np.concatenate([[0], np.cumsum(segment["n_ids"], dtype=np.int64)])
        packed = [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
        n = len(packed)
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment["part"]] * n, pa.int32()), pa.array(segment["keys"], pa.int64()), pa.array(edges[:-1] + segment["start"]), pa.array(packed, pa.binary())],
            names)


def stored_ids(docs: DataFrame, key: str, text: str, tokenizer_file: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the files (to a fresh folder of the shared one unless ``path`` is given) and read them back."""
    path = path or scratch_path(docs.sparkSession, "token_ids")
    write_ids(docs, key, text, tokenizer_file, end_id, path)
    return read_ids(docs.sparkSession, path, key)
