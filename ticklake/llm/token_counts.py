"""Token counts of whole texts with the sentencepiece library, huge documents by overlap resynchronisation.

A huge document is encoded in overlapping chunks with byte offsets. Two neighbours are spliced at a stable
boundary: a place inside the overlap where both put a token edge and where the vocabulary proves that no merge can
reach across. Such a place is a space after a non-space character: if no piece holds the space mark after another
character, symbols left and right of it never merge, so both sides are encoded as in the whole text. When an overlap has
no such place, it is widened, at last to the whole rest of the document. The proof is read off the vocabulary at
load time; a model that does not allow it gets its texts encoded whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ticklake.llm.common import small_batches

HUGE_BYTES = 1 << 17
CHUNK_BYTES = 1 << 16
OVERLAP_BYTES = 256
_MARK = "▁"
_INNER_MARK = re.compile(f"[^{_MARK}]{_MARK}")
_EDGE = re.compile(rb"[0-9A-Za-z,.;:](?= )")


@lru_cache(2)
def model(path: str):
    """The processor, and whether its pieces prove that a space after a non-space character is a stable boundary."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    spec = proto.ModelProto()
    spec.ParseFromString(own.serialized_model_proto())
    plain = spec.normalizer_spec.name == "identity" and not spec.normalizer_spec.precompiled_charsmap and not spec.normalizer_spec.remove_extra_whitespaces
    bpe = spec.trainer_spec.model_type == proto.TrainerSpec.BPE and not any(p.type == proto.ModelProto.SentencePiece.USER_DEFINED for p in spec.pieces)
    return own, plain and bpe and not any(_INNER_MARK.search(p.piece) for p in spec.pieces)


def _edges(own, text: bytes, start: int, end: int) -> list[int]:
    """Byte offsets in the document at which the tokens of text[start:end] begin, in order."""
    return [start + piece.begin for piece in own.encode(text[start:end].decode(), return_type="proto").pieces]


def _character(text: bytes, at: int) -> int:
    """The last place up to ``at`` where a character begins (or the end of the text)."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(text))


def count_huge(own, text: bytes, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> int:
    """Tokens of ``text`` as one encode of the whole would count them."""
    total, begin = 0, 0  # tokens that begin before ``begin`` are in ``total``
    base, end = 0, _character(text, chunk)  # of the chunk that ``edges`` is of
    edges = _edges(own, text, base, end)
    while end < len(text):
        beyond = _character(text, end + chunk)
        width, splice = overlap, None
        while splice is None:
            start = _character(text, max(begin, end - width))
            following = _edges(own, text, start, beyond)
            stable = {found.end() for found in _EDGE.finditer(text, start, end)}
            # after ``start``: the first token of a chunk is the mark that the library puts before any text
            splice = max((x for x in stable.intersection(edges, following) if x > start), default=None)
            if splice is None and start == begin:
                break  # nothing proves a boundary: this chunk and the next are one
            width *= 4
        if splice is not None:
            total += sum(begin <= x < splice for x in edges)
            base, begin, edges = start, splice, following
        else:
            chunk *= 2
            edges = _edges(own, text, base, beyond)
        end = beyond
    return total + sum(x >= begin for x in edges)


def count_tokens(docs: DataFrame, key: str, text: str, model_path: str, huge_bytes: int = HUGE_BYTES) -> DataFrame:
    """(key, n_bytes, n_tokens) of every row. NULL and empty texts have 0 of both. Row by row: repeated rows and NULL keys pass,
    other columns are dropped, whatever their names."""
    kind = docs.schema[key].dataType

    def run(batches):
        own, proven = model(model_path)
        for batch in small_batches(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            raw = [x.encode() for x in texts]
            huge = [i for i, x in enumerate(raw) if proven and len(x) > huge_bytes]
            rest = sorted(set(range(len(texts))).difference(huge))
            counts = np.zeros(len(texts), np.int64)
            counts[rest] = [len(x) for x in own.encode([texts[i] for i in rest], num_threads=1)]
            counts[huge] = [count_huge(own, raw[i]) for i in huge]
            sizes = pa.array([len(x) for x in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts)], [key, "n_bytes", "n_tokens"])

    fields = [T.StructField(key, kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return docs.select(key, text).mapInArrow(run, T.StructType(fields))
