"""Periodic runs in texts: maximal stretches of words that repeat with a period, found by minimizers at many scales.

A run is a stretch of words with smallest period q and at least ``exponent`` times q words that neither neighbour extends.

* Periods below ``SHORT`` are found by comparing the words with those q further on, for each such lag q.
* Periods in [W, 2W), for W = SHORT, 2 SHORT, 4 SHORT and so on: of every window of W positions the position with the
  least hash of the W words from it on is its minimizer. Two windows of a run that stand one period apart hold the same words, so
  their minimizers stand one period apart too. Pairs of equal minimizers at a distance in [W, 2W) are candidates; each is
  extended, word by word, to the whole stretch in which words agree at that distance.

Why no run is missed. W words that lie inside a run of a period up to W / 4 are no minimizers. A run of a period q >= W holds
W words other than that within every q positions (else it would have that shorter period itself), and has room for two
windows a period apart that hold them, as it has four periods. Equal W words that are no part of a run of a period
up to W / 4 start more than W / 4 apart, so at most 7 steps lead from one to the next a period (less than 2W) later: steps up to ``STEPS`` are tried.
A stretch of a multiple of its smallest period has the same start and length as the run itself and goes.

Words are compared by 64 bits of hash. A text is handled as a whole, with about 60 bytes of memory per word at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ticklake.llm import words
from ticklake.llm.common import small_batches

#: the least period that minimizers look for; a power of two
SHORT = 8
STEPS = 7
MIN_EXPONENT, MIN_LENGTH = 4, 6
_NONE = np.uint64((1 << 64) - 1)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _stretches(agree: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], agree, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _agreement(hashed: np.ndarray, lag: int, at: int, low: int, high: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` in low..high - lag where words equal those ``lag`` further on; in growing steps."""
    end, step = at, 64
    while end < high - lag:
        stop = min(end + step, high - lag)
        differ = hashed[end:stop] != hashed[end + lag:stop + lag]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, 2 * step
    start, step = at, 64
    while start > low:
        stop = max(start - step, low)
        differ = (hashed[stop:start] != hashed[stop + lag:start + lag])[::-1]
        if differ.any():
            start -= int(differ.argmax())
            break
        start, step = stop, 2 * step
    return start, end


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return words.mix(left * np.uint64(0x9FB21C651E98DF25) + right)


def _minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the least of a window of ``width`` positions; _NONE is never one."""
    place = np.uint64((1 << int(len(grams)).bit_length()) - 1)
    least = np.where(grams == _NONE, _NONE, grams & ~place | np.arange(len(grams), dtype=np.uint64))
    step = 1
    while step < width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    found = least[np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))]
    return (found[found != _NONE] & place).astype(np.int64)


def runs_of(hashed: np.ndarray, at: np.ndarray, exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs in documents whose words ``hashed[at[i]:at[i + 1]]`` are, by start and period; starts
    count through all documents. ``exponent`` must be 4 at least."""
    if exponent < 4:
        raise ValueError("runs of fewer than four periods need other candidates")
    counts = np.diff(at)
    document = np.repeat(np.arange(len(counts)), counts)
    found: list[tuple[np.ndarray, np.ndarray, int] | tuple[int, int, int]] = []
    for lag in range(1, min(SHORT, len(hashed))):
        starts, ends = _stretches((hashed[:-lag] == hashed[lag:]) & (document[:-lag] == document[lag:]), max(min_length, exponent * lag) - lag)
        found += [(s, e + lag - s, lag) for s, e in zip(starts.tolist(), ends.tolist())]
    known = _primitive(found)

    width, place, own, grams = SHORT, np.arange(len(hashed)), at, hashed
    for half in (1, 2, 4):
        grams = _mixed(grams[:-half], grams[half:]) if len(grams) > half else grams[:0]
    while len(own) > 1:
        # only documents that can hold a run of this scale go on
        enough = np.diff(own) >= exponent * width
        stays = np.repeat(enough, np.diff(own))
        if not stays.any():
            break
        if not enough.all():
            short_by = len(stays) - len(grams)
            grams = np.concatenate([grams, np.full(short_by, _NONE)])[stays]
            place, own = place[stays], np.concatenate([[0], np.cumsum(np.diff(own)[enough])])
        grams = grams[:len(place) - width + 1]
        ends = np.repeat(own[1:], np.diff(own))[:len(grams)]
        free = np.arange(len(grams)) + width <= ends
        inside = known[(known[:, 2] <= width // 4) & (known[:, 1] >= width)]
        if len(inside):
            first = np.searchsorted(place, inside[:, 0])  # of documents that went on or of the next one
            there = first < len(place)
            there[there] = place[first[there]] == inside[there, 0]
            step = np.zeros(len(place) + 1, np.int32)
            np.add.at(step, first[there], 1)
            np.add.at(step, first[there] + inside[there, 1] - width + 1, -1)
            free &= np.cumsum(step)[:len(grams)] == 0
        chosen = _minimizers(np.where(free, grams, _NONE), width) if len(grams) >= width else np.zeros(0, np.int64)
        found = _extended(hashed, at, document, place[chosen], grams[chosen], width, exponent, min_length)
        if found:
            known = _primitive([*map(tuple, known.tolist()), *found])
        grams = _mixed(grams[:-width], grams[width:]) if len(grams) > width else grams[:0]
        width *= 2
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def _extended(hashed, at, document, positions: np.ndarray, grams: np.ndarray, width: int, exponent: int, min_length: int) -> list[tuple[int, int, int]]:
    """Stretches that pairs of equal minimizers at a distance of ``width`` to 2 * ``width`` belong to."""
    order = np.argsort(grams, kind="stable")
    gram, position = grams[order], positions[order]
    pairs = []
    for step in range(1, STEPS + 1):
        apart = position[step:] - position[:-step]
        fits = (gram[step:] == gram[:-step]) & (apart >= width) & (apart < 2 * width)
        fits[fits] = document[position[step:][fits]] == document[position[:-step][fits]]
        pairs.append(np.stack([apart[fits], position[:-step][fits]], axis=1))
    candidates = np.concatenate(pairs)
    found, done = [], (0, -1)
    for lag, place in candidates[np.lexsort((candidates[:, 1], candidates[:, 0]))].tolist():
        if done[0] == lag and place < done[1]:
            continue
        own = document[place]
        start, end = _agreement(hashed, lag, place, int(at[own]), int(at[own + 1]))
        done = lag, end
        if end - start + lag >= max(min_length, exponent * lag):
            found.append((start, end - start + lag, lag))
    return found


def _primitive(found: list[tuple[int, int, int]]) -> np.ndarray:
    """Of stretches with equal start and length the one with the least period."""
    table = np.array(found, np.int64).reshape(-1, 3)
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    first = np.ones(len(table), bool)
    first[1:] = (table[1:, :2] != table[:-1, :2]).any(axis=1)
    return table[first]


def collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the kept words of each document, joined by one space."""
    kept = np.flatnonzero(keep)
    row = np.searchsorted(at, kept, "right") - 1
    # the white-space byte after a word goes with it, unless it is the last one kept of its document
    more = np.zeros(len(kept), bool)
    more[:-1] = row[1:] == row[:-1]
    taken = np.zeros(len(data) + 2, np.int8)
    taken[starts[kept]] = 1
    stops = ends[kept] + more
    taken[stops] -= 1  # a word never starts where another one's share ends before it; where it does at once, the sum stays 1
    taken = np.cumsum(taken[:-2], dtype=np.int8).astype(bool)
    out = data[taken]
    sizes = np.zeros(len(at) - 1, np.int64)
    np.add.at(sizes, row, ends[kept] - starts[kept] + more)
    return np.where(words.SPACES[out], np.uint8(32), out), np.concatenate([[0], np.cumsum(sizes)])


def _analyse(column: pa.Array, exponent: int, min_length: int) -> Iterator[tuple[int, int, pa.Array, pa.Array, pa.Array]]:
    """(first row, end row, numbers of words, runs, collapsed texts) of runs of rows."""
    for first, end, data, offsets in words.chunks(column):
        starts, ends, at, hashed = words.word_table(data, offsets)
        runs = runs_of(hashed, at, exponent, min_length)
        drop = np.zeros(len(hashed) + 1, np.int32)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
        text, edges = collapsed(data, starts, ends, at, np.cumsum(drop[:-1]) == 0)
        row = np.searchsorted(at, runs[:, 0], "right") - 1
        fields = [pa.array(runs[:, 0] - at[row]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
        listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(end - first + 1)).astype(np.int32)), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
        texts = pa.StringArray.from_buffers(end - first, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(text))
        yield first, end, pa.array(np.diff(at)), listed, texts


def find_runs(docs: DataFrame, key: str, text: str, exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """(key, n_words, runs, collapsed) of every row.

    ``runs`` is an array of struct(start, length, period), all in words, by start and then period: every maximal
    stretch of max(``min_length``, ``exponent`` * period) words or more. ``collapsed`` is the text without the words that a run
    holds after its first period, joined by one space. NULL, empty and blank texts have no words, no runs and an empty
    ``collapsed``. Rows are looked at one by one, so repeated rows and NULL keys just pass; other columns are dropped.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(f.name, T.LongType()) for f in _RUN]))), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for first, end, n, runs, texts in _analyse(batch.column(1), exponent, min_length):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), n, runs, texts], schema.names)

    return docs.select(key, text).mapInArrow(run, schema)
