"""Byte-level BPE with the tiktoken library and a local rank file: encode texts to ids, decode ids to raw bytes.

Long texts are cut before the library sees them. A cut stands before a space or line feed that follows a
non-space character: no match of the split pattern crosses such a place (a match that holds a non-space character
never goes on with white space, and look-ahead only concerns white-space runs), so the pieces give exactly the ids
of the whole text. A text without such a place is encoded in one go.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.llm.common import small_batches

PIECE_CHARS = 1 << 16
_SAFE = re.compile(r"\S(?=[ \n])")


@lru_cache(2)
def encoding(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Parts of ``text`` of at least ``limit`` characters (but for the last), cut at safe places only."""
    start = 0
    while len(text) - start > limit and (found := _SAFE.search(text, start + limit - 1)):
        yield text[start:found.end()]
        start = found.end()
    yield text[start:]


def encode(docs: DataFrame, key: str, text: str, rank_file: str, pattern: str, packed: bool = False, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(key, ids) of every row: array<int>, or with ``packed`` binary of little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids. Rows are not joined or grouped, so repeated rows and NULL keys just pass; other
    columns are dropped, and one called ``ids`` is no trouble.
    """
    key_type = docs.schema[key].dataType

    def run(batches):
        own = encoding(rank_file, pattern)
        for batch in small_batches(batches):
            ids, last = [], None
            for x in batch.column(1).to_pylist():
                # copies that a mix puts one after another are encoded once
                ids.append(ids[-1] if ids and x == last else np.array([i for piece in pieces(x or "", piece_chars) for i in own.encode_ordinary(piece)], "<u4"))
                last = x
            column = pa.array([x.tobytes() for x in ids], pa.binary()) if packed else _as_lists(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), column], [key, "ids"])

    ids_type = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    return docs.select(key, text).mapInArrow(run, T.StructType([T.StructField(key, key_type), T.StructField("ids", ids_type)]))


def _as_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))


def decode(encoded: DataFrame, key: str, ids: str, rank_file: str, pattern: str) -> DataFrame:
    """(key, ids, decoded binary) from ids in either form: raw bytes, which may begin or end inside a character. NULL ids
    give no bytes."""
    rows = encoded.select(key, F.col(ids).alias("ids"))
    packed = isinstance(rows.schema["ids"].dataType, T.BinaryType)

    def run(batches):
        own = encoding(rank_file, pattern)
        for batch in small_batches(batches):
            lists = (np.frombuffer(x or b"", "<u4").tolist() if packed else x or [] for x in batch.column(1).to_pylist())
            decoded = pa.array([own.decode_bytes(x) for x in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [key, "ids", "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))
