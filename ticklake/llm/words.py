"""Word hashing of whole Arrow string columns with numpy: no Python loop over words.

A word is ``[^\\x20\\x09-\\x0D]+``. Words and word windows are 64-bit polynomial hashes modulo 2**64 with a
final mix; a window hash depends on its words only, never on where it stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = "\\x20\\x09-\\x0D"  # body of a regular-expression class
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE_BASE = 0x9E3779B97F4A7C15
#: odd bases of the window hashes; two of them together are a 128-bit hash
WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: bytes that are worked on at a time: temporary arrays and the kept tables of powers have about this many entries
CHUNK_BYTES = 1 << 18


def _table(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


_kept_table = lru_cache(8)(_table)


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` for i < n modulo 2**64; a worker keeps one table of the size of a chunk per base."""
    return _kept_table(base, CHUNK_BYTES)[:n] if n <= CHUNK_BYTES else _table(base, n)


@lru_cache(16)
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; NULL counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and len(raw) else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    data, offsets = text_buffer(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words (runs of bytes not in ``between``), and the index of each row's first word (one entry more than rows)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~between[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # a word never runs over into the next row
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    codes = (_LOWER[data] if lower else data).astype(np.uint64)
    codes += np.uint64(1)
    codes *= powers(_BYTE_BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_inverse(_BYTE_BASE), len(data))[starts])


def word_table(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, the index of each row's first word (one entry more than rows), and the words' hashes.

    The bytes of a long row are looked at a chunk at a time, cut at white space, so that only word-level arrays grow with it.
    """
    if len(data) <= 2 * CHUNK_BYTES or len(offsets) > 2:
        starts, ends, at = spans(data, offsets)
        return starts, ends, at, word_hashes(data, starts, ends, lower)
    parts, begin = [], 0
    while begin < len(data):
        end = cut_at_space(data, begin + CHUNK_BYTES)
        piece = data[begin:end]
        starts, ends, _ = spans(piece, np.array([0, len(piece)]))
        parts.append((starts + begin, ends + begin, word_hashes(piece, starts, ends, lower)))
        begin = end
    starts, ends, hashed = (np.concatenate(x) for x in zip(*parts))
    return starts, ends, np.array([0, len(starts)]), hashed


def cut_at_space(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where a white-space byte stands; the end if there is none."""
    while at < len(data):
        found = np.flatnonzero(SPACES[data[at:at + CHUNK_BYTES]])
        if len(found):
            return at + int(found[0])
        at += CHUNK_BYTES
    return len(data)


def window_hashes(words: np.ndarray, length: int, base: int = WINDOW_BASES[0]) -> np.ndarray:
    """Hash of the ``length`` words from each position on; empty when there are fewer words."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    if n > CHUNK_BYTES + length:  # in pieces, for bounded temporary arrays
        return np.concatenate([window_hashes(words[i:i + CHUNK_BYTES + length - 1], length, base) for i in range(0, n - length + 1, CHUNK_BYTES)])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(base, n), out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * powers(_inverse(base), n)[:n - length + 1])


def shingle_sets(column: pa.Array, length: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its ``length``-word shingles; with fewer words the whole
    sequence is the only one, without words the set is empty."""
    for first, end, data, offsets in chunks(column):
        _, _, at, hashed = word_table(data, offsets, lower)
        windows = window_hashes(hashed, length)
        for row in range(end - first):
            a, b = at[row], at[row + 1]
            if b - a >= length:
                yield np.unique(windows[a:b - length + 1])
            else:
                yield window_hashes(hashed[a:b], max(1, b - a))
