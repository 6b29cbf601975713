"""Exact substring dedup by fixed-block anchors.

A window is ``window`` consecutive words. Every window holds a whole block of ``window // 2`` words that begins at a multiple of
that length in its document. So the non-overlapping blocks of all documents are an index, and every rolling
block-sized window of all documents is a probe: a window that two documents share has an anchor, a block of the one that
a probe of the other hits. Around anchors alone the windows themselves are looked up, each finding the smallest
document that holds it; neighbouring covered windows make up the maximal repeats.

Hashes travel packed: a chunk of documents sends each cell of the hash range one sorted array with every hash
once, so text that many documents share costs one entry per chunk, and a cell sends back what a chunk needs to know. Anchors
travel as short fragments, since a false anchor costs only a look-up; windows are compared by 95 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm import words
from ticklake.llm.common import discard, settle, small_batches, sorted_groups

WINDOW_WORDS = 50
#: a chunk holds so many rows and bytes of text at most (a longer text is one of its own), a cell the hashes of about so many bytes
CHUNK_ROWS, CHUNK_BYTES, CELL_BYTES = 4096, 16 << 20, 32 << 20
_FRAGMENT_BITS = 30
_INDEXED, _SHARED = 1, 2
#: a window on its way to its cell: hash, second hash with the lowest bit for "in several documents of the chunk", smallest document
WINDOW_ENTRY = np.dtype([("hash", "<u8"), ("check", "<u4"), ("doc", "<i8")])
_RESULT = "kind int, chunk long, cell int, doc_id long, n_words long, n_removed long, kept string, text string, entries binary"
_DONE, _OPEN, _ENTRIES = 0, 1, 2


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)


def _anchor_keys(hashes: np.ndarray, cells: int) -> np.ndarray:
    """Cell and fragment of block hashes in one number."""
    return _cells(hashes, cells) << _FRAGMENT_BITS | (hashes & np.uint64((1 << _FRAGMENT_BITS) - 1)).astype(np.int64)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _documents(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(row, bytes, word hashes) of each text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    for first, end, data, offsets in words.chunks(column):
        _, _, at, hashed = words.word_table(data, offsets)
        for i in range(end - first):
            yield first + i, data[offsets[i]:offsets[i + 1]].tobytes(), hashed[at[i]:at[i + 1]]


def _in_chunks(max_rows: int, max_bytes: int):
    """Numbers the rows of a task by chunk, in their order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, n_rows, n_bytes = TaskContext.get().partitionId() << 33, 0, 0
        for whole in batches:
            for batch in small_batches([whole], 4 << 20):
                numbers = []
                for size in batch["size"].to_pylist():
                    if n_rows and (n_rows >= max_rows or n_bytes + size > max_bytes):
                        chunk, n_rows, n_bytes = chunk + 1, 0, 0
                    n_rows, n_bytes = n_rows + 1, n_bytes + size
                    numbers.append(chunk)
                yield batch.append_column("chunk", pa.array(numbers, pa.int64()))

    return run


def anchors(batches: Iterable[pa.RecordBatch], block: int, cells: int) -> Iterator[pa.RecordBatch]:
    """(cell, chunk, entries): per chunk and cell the sorted fragments of all probes, each with its marks."""
    for group in sorted_groups(batches, 1):
        group = group.filter(pa.compute.is_valid(group["doc_id"]))
        keys, docs, indexed = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, bool)]
        for row, _, hashed in _documents(group["text"]):
            probes = words.window_hashes(hashed, block)
            keys.append(_anchor_keys(probes, cells))
            docs.append(np.full(len(probes), row, np.int32))
            indexed.append(np.arange(len(probes)) % block == 0)
        keys, docs, indexed = map(np.concatenate, (keys, docs, indexed))
        if not len(keys):
            continue
        order = np.argsort(keys, kind="stable")
        keys, docs, indexed = keys[order], docs[order], indexed[order]
        at = _runs(keys)
        last = np.append(at[1:], len(keys)) - 1
        marks = np.where(np.logical_or.reduceat(indexed, at), _INDEXED, 0) | np.where(docs[at] != docs[last], _SHARED, 0)
        keys = keys[at]
        entries = ((keys & ((1 << _FRAGMENT_BITS) - 1)) << 2 | marks).astype("<u4")
        yield _by_cell(group["chunk"][0].as_py(), keys >> _FRAGMENT_BITS, entries)


def _by_cell(chunk: int, cell: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
    at = _runs(cell)
    blobs = [part.tobytes() for part in np.split(entries, at[1:])] if len(at) else []
    return pa.RecordBatch.from_arrays([pa.array(cell[at].astype(np.int32)), pa.array(np.full(len(at), chunk, np.int64)), pa.array(blobs, pa.binary())], ["cell", "chunk", "entries"])


def _received(batches: Iterable[pa.RecordBatch], kind: np.dtype) -> tuple[np.ndarray, np.ndarray, int | None]:
    """Entries of a cell, the chunk of each, and the cell."""
    parts, chunks, cell = [np.zeros(0, kind)], [np.zeros(0, np.int64)], None
    for batch in batches:
        for own, chunk, blob in zip(*(batch.column(c).to_pylist() for c in ("cell", "chunk", "entries"))):
            cell = own
            parts.append(np.frombuffer(blob, kind))
            chunks.append(np.full(len(parts[-1]), chunk, np.int64))
    return np.concatenate(parts), np.concatenate(chunks), cell


def _answers(cell: int, chunks: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
    """Entries back to their chunks."""
    order = np.argsort(chunks, kind="stable")
    chunks, entries = chunks[order], entries[order]
    at = _runs(chunks)
    blobs = [part.tobytes() for part in np.split(entries, at[1:])] if len(at) else []
    return pa.RecordBatch.from_arrays([pa.array(chunks[at]), pa.array(np.full(len(at), cell, np.int32)), pa.array(blobs, pa.binary())], ["chunk", "cell", "entries"])


def hit_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, cell, entries): fragments that are a block of some document and stand in two or more documents."""
    entries, chunks, cell = _received(batches, np.dtype("<u4"))
    if cell is None:
        return
    order = np.argsort(entries >> 2, kind="stable")
    entries, chunks = entries[order], chunks[order]
    at = _runs(entries >> 2)
    marks = np.bitwise_or.reduceat(entries & 3, at)
    several = np.diff(np.append(at, len(entries))) > 1
    hit = np.repeat((marks & _INDEXED > 0) & (several | (marks & _SHARED > 0)), np.diff(np.append(at, len(entries))))
    yield _answers(cell, chunks[hit], entries[hit] >> 2)


def _windows(hashed: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    check = (words.window_hashes(hashed, window, words.WINDOW_BASES[1]) >> np.uint64(32)).astype(np.uint32)
    return words.window_hashes(hashed, window), check & np.uint32(0xFFFFFFFE)


def _sha(parts: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(parts)).hexdigest()


def _rows(kind: int, chunk: int, **columns: list) -> pa.Table:
    n = len(next(iter(columns.values())))
    types = {"cell": pa.int32(), "doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string(), "text": pa.string(), "entries": pa.binary()}
    out = {"kind": pa.array([kind] * n, pa.int32()), "chunk": pa.array([chunk] * n, pa.int64())}
    return pa.table(out | {k: pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in types.items()})


def _extend(window: int, cells: int, digest: bool):
    """For each chunk: texts without a window around an anchor are done, the others stay open and send their windows."""
    block = window // 2

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = (group if group.num_rows else answers)["chunk"][0].as_py()
        known = [np.zeros(0, np.int64)]
        for cell, blob in zip(answers["cell"].to_pylist(), answers["entries"].to_pylist()):
            known.append(np.frombuffer(blob, "<u4").astype(np.int64) | cell << _FRAGMENT_BITS)
        known = np.unique(np.concatenate(known))
        ids, texts = group["doc_id"].to_pylist(), group["text"]
        done, left, entries = ([], [], []), [], [np.zeros(0, WINDOW_ENTRY)]
        for row, text, hashed in _documents(texts):
            found = np.zeros(0, np.int64)
            if len(hashed) >= window and len(known) and ids[row] is not None:
                probes = _anchor_keys(words.window_hashes(hashed, block), cells)
                hits = known[np.minimum(np.searchsorted(known, probes), len(known) - 1)] == probes
                before = np.concatenate([[0], np.cumsum(hits)])
                reach = window - block + 1  # places of a block inside a window
                found = np.flatnonzero(before[reach:] - before[:-reach] > 0) if hits.any() else found
            if len(found):
                hashes, check = _windows(hashed, window)
                own = np.zeros(len(found), WINDOW_ENTRY)
                own["hash"], own["check"], own["doc"] = hashes[found], check[found], ids[row]
                entries.append(own)
                left.append(row)
            else:
                done[0].append(ids[row])
                done[1].append(len(hashed))
                done[2].append(_kept(text.split(), digest))
        entries = np.concatenate(entries)
        entries = entries[np.lexsort((entries["doc"], entries["check"], entries["hash"]))]
        at = _runs(entries[["hash", "check"]])
        if len(at):
            last = entries["doc"][np.append(at[1:], len(entries)) - 1]
            entries = entries[at]
            entries["check"] |= (last != entries["doc"]).astype(np.uint32)
        sent = _by_cell(chunk, _cells(entries["hash"], cells), entries)
        return pa.concat_tables([
            _rows(_DONE, chunk, doc_id=done[0], n_words=done[1], n_removed=[0] * len(done[0]), kept=done[2]),
            _rows(_OPEN, chunk, doc_id=[ids[r] for r in left], text=texts.take(pa.array(left, pa.int64())).to_pylist()),
            _rows(_ENTRIES, chunk, cell=sent["cell"].to_pylist(), entries=sent["entries"].to_pylist())])

    return run


def _kept(parts: list[bytes], digest: bool) -> str:
    return _sha(parts) if digest else b" ".join(parts).decode()


def first_documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, cell, entries): windows that stand in two or more documents, with the smallest of all documents."""
    entries, chunks, cell = _received(batches, WINDOW_ENTRY)
    if cell is None:
        return
    check = entries["check"] & np.uint32(0xFFFFFFFE)
    order = np.lexsort((check, entries["hash"]))
    entries, chunks, check = entries[order], chunks[order], check[order]
    at = np.flatnonzero(np.concatenate([[True], (entries["hash"][1:] != entries["hash"][:-1]) | (check[1:] != check[:-1])]))
    sizes = np.diff(np.append(at, len(entries)))
    several = np.repeat((sizes > 1) | (np.bitwise_or.reduceat(entries["check"] & 1, at) > 0), sizes)
    entries = entries.copy()
    entries["doc"] = np.repeat(np.minimum.reduceat(entries["doc"], at), sizes)
    entries["check"] = check
    yield _answers(cell, chunks[several], entries[several])


def _remove(window: int, digest: bool):
    """For each chunk's open texts: drop the words of windows that a smaller document holds too."""

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        known = np.concatenate([np.zeros(0, WINDOW_ENTRY), *[np.frombuffer(x, WINDOW_ENTRY) for x in answers["entries"].to_pylist()]])
        known = known[np.argsort(known["hash"], kind="stable")]
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
        ids = group["doc_id"].to_pylist()
        for row, text, hashed in _documents(group["text"]):
            hashes, check = _windows(hashed, window)
            first = np.searchsorted(known["hash"], hashes)
            repeated = np.zeros(len(hashes), bool)
            live = np.flatnonzero(first < len(known))
            step = 0  # equal hashes with unequal checks stand side by side
            while len(live):
                live = live[first[live] + step < len(known)]
                live = live[known["hash"][first[live] + step] == hashes[live]]
                match = known[first[live] + step]
                repeated[live] |= (match["check"] == check[live]) & (match["doc"] < ids[row])
                live, step = live[match["check"] != check[live]], step + 1
            edges = np.zeros(len(hashed) + 1, np.int64)
            edges[:len(hashes)] += repeated
            edges[window:window + len(hashes)] -= repeated
            gone = np.cumsum(edges)[:-1] > 0
            parts = text.split()
            out["doc_id"].append(ids[row])
            out["n_words"].append(len(parts))
            out["n_removed"].append(int(gone.sum()))
            out["kept"].append(_kept([p for p, g in zip(parts, gone) if not g] if gone.any() else parts, digest))
        return pa.table(out, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS, digest: bool = False, cells: int | None = None) -> DataFrame:
    """(key, n_words, n_removed, kept): the words that stay, joined by single spaces, or with ``digest`` their SHA-256.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if it is covered by a window whose words also stand, one
    after the other, in a document with a smaller (integer) key; all windows are judged on the input. One row per row of ``docs``. NULL text: no
    words. Rows with the same key are the same document and never remove words of each other. Rows without key
    stay whole and remove nothing. Other columns do not matter.

    The number of cells follows the bytes of all texts, so that a cell, which is one task, stays as large as it is.
    """
    sized = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size"))
    chunks = settle(sized.mapInArrow(_in_chunks(CHUNK_ROWS, CHUNK_BYTES), "doc_id long, text string, size long, chunk long"), "chunks")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    cells = cells or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // CELL_BYTES))
    rows = chunks.select("doc_id", "text", "chunk")
    block = window // 2

    sent = rows.select("chunk", "doc_id", "text").mapInArrow(lambda batches: anchors(batches, block, cells), "cell int, chunk long, entries binary")
    hits = settle(sent.repartitionById(cells, "cell").mapInArrow(hit_anchors, "chunk long, cell int, entries binary"), "anchors")
    extended = rows.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(_extend(window, cells, digest), _RESULT)
    extended = settle(extended, "extended")
    discard(chunks, hits)
    windows = extended.where(F.col("kind") == _ENTRIES).select("cell", "chunk", "entries")
    first = windows.repartitionById(cells, "cell").mapInArrow(first_documents, "chunk long, cell int, entries binary")
    left = extended.where(F.col("kind") == _OPEN).select("chunk", "doc_id", "text")
    reduced = left.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(_remove(window, digest), "doc_id long, n_words long, n_removed long, kept string")
    result = extended.where(F.col("kind") == _DONE).select("doc_id", "n_words", "n_removed", "kept").unionByName(reduced)
    return result.select(F.col("doc_id").alias(key), "n_words", "n_removed", "kept")
