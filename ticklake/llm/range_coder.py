"""Adaptive context-mixing range coder for sequences of unsigned 32-bit ids, many blocks at a time.

The model mixes predictions of order 0 to 2. The last two ids and the last id each name an id that followed them
before, with a confidence; how often the two come true, learnt for each pair of confidences and for agreement, is the weight of each
in the mixture. The rest of the probability is order 0's: adaptive frequencies of whole ids, the highest byte first and then
four bits at a time, given the bits above. Order 0 learns the ids that the contexts missed. Every block starts with an empty
model, so blocks are coded side by side (a numpy lane each) and read independently.

The coder keeps 48 bits. It puts out 16 bits whenever its range falls below 2**32, and cuts the range at a multiple of 2**32
where a carry could still reach bits that are out already.
"""

from __future__ import annotations

import numpy as np

MAX_ID = (1 << 32) - 1
_TOTAL_BITS, _HEAD_BITS = 16, 12
_CONTEXT_BITS = 10  # of each of the two context tables
_ROW_BITS = 11  # rows of order-0 frequencies below the highest byte, found by hash
_GAIN, _FULL = 24, 1 << 15  # what a seen id adds to a frequency, and where a row of them is halved
_REBUILD = 128  # steps between two looks at the highest bytes' counts
_TOP = np.uint64(1 << 48)
_LOW_MASK, _WORD_MASK = np.uint64((1 << 32) - 1), np.uint64((1 << 48) - 1)
_HALF, _WORD, _TOTAL = np.uint64(32), np.uint64(16), np.uint64(_TOTAL_BITS)
#: what a hit or a miss does to an entry's confidence (0 to 3), by 4 * hit + confidence; a miss at 0 puts a new id there
_STEP = np.array([0, -1, -2, -2, 1, 1, 1, 0])
#: what each four bits add to a row of 16 running sums of 16 bits, in words of 64 bits
_LEARN = ((np.arange(16) >= np.arange(16)[:, None]) * np.uint16(_GAIN)).astype(np.uint16).view(np.uint64)
#: first weight of a guess by confidence, in 1 / 2**16
_RATES = np.array([500, 8000, 24000, 40000])


class _Model:
    """State of all lanes; ``predict`` and ``update`` go step by step over all of them.

    Row 0 of the arrays with two rows is for the context of the last id, row 1 for that of the last two. An entry of the
    context tables is an id and its confidence in the low two bits. ``width`` is the number of bytes of the ids, 2 to 4.
    """

    def __init__(self, lanes: int, width: int):
        self.lanes, self.low_bits = lanes, 8 * (width - 1)
        self.shifts = range(self.low_bits - 4, -1, -4)  # of the four-bit parts of an id
        self.table = np.zeros(2 * lanes << _CONTEXT_BITS, np.int64)
        self.base = (np.arange(2 * lanes) << _CONTEXT_BITS).reshape(2, lanes)
        # weights per lane and (agreement, confidence of order 2, of order 1); those of order 1 where order 2 is wrong
        self.weight2 = np.tile(np.concatenate([np.repeat(_RATES, 4), np.maximum.outer(_RATES, _RATES).ravel()]), lanes)
        self.weight1 = np.tile(_RATES, 8 * lanes)
        self.cells = np.arange(lanes) * 32
        self.counts = np.ones(lanes * 256, np.int64)
        self.row = np.arange(lanes) * 256
        self.sums = np.tile(np.arange(1, 17, dtype=np.uint16), lanes << _ROW_BITS)
        self.context = np.zeros((2, lanes), np.int64)
        self.steps = 0
        self.rebuild()

    def rebuild(self) -> None:
        counts = self.counts[:self.lanes * 256].reshape(-1, 256)
        share = 1 + counts * ((1 << _HEAD_BITS) - 256) // counts.sum(axis=1, keepdims=True)
        share[np.arange(self.lanes), share.argmax(axis=1)] += (1 << _HEAD_BITS) - share.sum(axis=1)
        self.share, self.end = share.ravel(), np.cumsum(share, axis=1).ravel()
        self.slots = None

    def slot(self, lanes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Highest byte at a place of its scale; for decoding."""
        if self.slots is None:
            self.slots = np.repeat(np.tile(np.arange(256, dtype=np.uint8), self.lanes), self.share)
        return self.slots[(lanes << _HEAD_BITS) + at].astype(np.int64)

    def predict(self) -> None:
        self.at = self.base + (self.context >> 5 & ((1 << _CONTEXT_BITS) - 1))
        self.entry = self.table[self.at]
        self.guess, self.sure = self.entry >> 2, self.entry & 3
        same = self.guess[0] == self.guess[1]
        self.cell = self.cells + (same * 16 + self.sure[1] * 4 + self.sure[0])
        self.rate2, self.rate1 = self.weight2[self.cell], self.weight1[self.cell]
        # shares of 2**16, of which order 0 keeps 2**_HEAD_BITS at least
        self.share2 = (self.rate2 * 239 >> 8) + 1
        self.share1 = ((self.rate1 * (65536 - self.rate2) >> 16) * 239 >> 8) + 1
        self.share1[same] = 0
        self.given = self.share1 + self.share2
        self.rest = (1 << _TOTAL_BITS) - self.given

    def head(self, lanes: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and share of a highest byte in what the guesses leave; order 0 learns it."""
        at = self.row[lanes] + high
        end, rest = self.end[at], self.rest[lanes]
        left = (end - self.share[at]) * rest >> _HEAD_BITS
        self.counts[at] += _GAIN
        return self.given[lanes] + left, (end * rest >> _HEAD_BITS) - left

    def rows(self, lanes: np.ndarray, above: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of running sums for the four bits at ``shift``, given the bits above, and their totals."""
        rows = (lanes << _ROW_BITS) + ((above * 0x9E3779B1 + shift * 0x85EBCA6B >> 15) & ((1 << _ROW_BITS) - 1))
        return rows, self.sums.take(rows * 16 + 15).astype(np.int64)

    def find(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which four bits hold a place of the rows' scales; for decoding."""
        first = rows * 16 - 1
        place = first.copy()
        for half in (8, 4, 2, 1):
            place += (self.sums.take(place + half) <= at) * half
        return place - first

    def part(self, rows: np.ndarray, totals: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and share of four bits in their rows, which learn them."""
        at = rows * 16 + bits
        end = self.sums.take(at).astype(np.int64)
        start = np.where(bits > 0, self.sums.take(at - 1, mode="wrap"), 0)
        words = self.sums.view(np.uint64).reshape(-1, 4)
        words[rows] = words.take(rows, axis=0) + _LEARN.take(bits, axis=0)
        if totals.max(initial=0) > _FULL:
            full, own = rows[totals > _FULL], self.sums.reshape(-1, 16)
            own[full] = np.cumsum(np.diff(own[full], axis=1, prepend=np.uint16(0)) >> 1 | 1, axis=1)
        return start, end - start

    def update(self, ids: np.ndarray) -> None:
        right = self.guess == ids
        case = right * 4 + self.sure
        self.table[self.at] = np.where(case == 0, ids << 2 | 1, self.entry + _STEP[case])
        self.weight2[self.cell] = self.rate2 + (right[1] * 65535 - self.rate2 >> 4)
        self.weight1[self.cell] = np.where(right[1], self.rate1, self.rate1 + (right[0] * 65535 - self.rate1 >> 4))
        self.context[1] = self.context[0] * 3
        self.context[0] = ids * 40503
        self.context[1] += self.context[0]
        self.steps += 1
        if self.steps % _REBUILD == 0 or self.steps in (16, 32, 64):
            self.rebuild()

    def keep(self, lanes: int) -> None:
        """Go on with the first lanes only."""
        self.lanes, self.slots = lanes, None
        self.base, self.context = (x[:, :lanes].copy() for x in (self.base, self.context))
        self.row, self.cells = self.row[:lanes], self.cells[:lanes]
        self.share, self.end = self.share[:lanes * 256], self.end[:lanes * 256]


class _Range:
    """The coder's interval, for all lanes; ``exchange`` puts out or takes in 16 bits of the lanes that it gets."""

    def __init__(self, lanes: int, exchange):
        self.low, self.size = np.zeros(lanes, np.uint64), np.full(lanes, _TOP - np.uint64(1), np.uint64)
        self.exchange = exchange

    def narrow(self, lanes: np.ndarray | slice, unit: np.ndarray, start: np.ndarray, share: np.ndarray) -> None:
        self.low[lanes] += unit * start.astype(np.uint64)
        size = unit * share.astype(np.uint64)
        self.size[lanes] = size
        short = np.flatnonzero(size <= _LOW_MASK)
        lanes = short if isinstance(lanes, slice) else lanes[short]
        while len(lanes):
            low = self.low[lanes]
            room = _LOW_MASK + np.uint64(1) - (low & _LOW_MASK)
            size = np.minimum(self.size[lanes], room) << _WORD
            self.size[lanes] = size
            self.exchange(lanes, low)
            self.low[lanes] = low << _WORD & _WORD_MASK
            lanes = lanes[size <= _LOW_MASK]


def _lanes(sizes: list[int], widths: list[int], width: int) -> tuple[list[int], np.ndarray]:
    """Blocks of a width, longest first, and their sizes."""
    order = sorted((i for i, n in enumerate(sizes) if n and widths[i] == width), key=lambda i: -sizes[i])
    return order, np.array([sizes[i] for i in order], np.int64)


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The coded bytes of each block of ids."""
    sizes, widths = [len(b) for b in blocks], []
    for block in blocks:
        low, high = (int(block.min()), int(block.max())) if len(block) else (0, 0)
        if low < 0 or high > MAX_ID:
            raise ValueError("ids must be in 0..2**32 - 1")
        widths.append(max(2, -(-high.bit_length() // 8)))
    coded = [b""] * len(blocks)
    for width in set(widths):
        order, own = _lanes(sizes, widths, width)
        if order:
            for i, found in zip(order, _encode([blocks[i] for i in order], own, width)):
                coded[i] = found
    return coded


def _encode(blocks: list[np.ndarray], sizes: np.ndarray, width: int) -> list[bytes]:
    n = int(sizes[0])
    ids = np.zeros((n, len(blocks)), np.uint32)
    for lane, block in enumerate(blocks):
        ids[:len(block), lane] = block
    out, filled = np.zeros((len(blocks), n + 8), np.uint16), np.zeros(len(blocks), np.int64)

    def put(lanes: np.ndarray, ends: np.ndarray) -> None:
        nonlocal out
        places = filled[lanes]
        if places.max() >= out.shape[1]:
            out = np.concatenate([out, np.zeros_like(out)], axis=1)
        out[lanes, places] = ends >> _HALF
        filled[lanes] = places + 1

    model, coder = _Model(len(blocks), width), _Range(len(blocks), put)
    for step in range(n):
        lanes = int(np.searchsorted(-sizes, -step, "left"))
        if lanes < model.lanes:
            model.keep(lanes)
        own, some = ids[step, :lanes].astype(np.int64), slice(lanes)
        model.predict()
        is1, is2 = model.guess == own
        share = np.where(is2, model.share2, model.share1)
        start = np.where(is2, 0, model.share2)
        plain = np.flatnonzero(~(is1 | is2))
        missed = own[plain]
        start[plain], share[plain] = model.head(plain, missed >> model.low_bits)
        coder.narrow(some, coder.size[some] >> _TOTAL, start, share)
        for shift in model.shifts:
            rows, totals = model.rows(plain, missed >> shift + 4, shift)
            start, share = model.part(rows, totals, missed >> shift & 15)
            coder.narrow(plain, coder.size[plain] // totals.astype(np.uint64), start, share)
        model.update(own)
    coded = []
    for lane in range(len(blocks)):
        tail = [(int(coder.low[lane]) >> s) & 0xFFFF for s in (32, 16, 0)]
        coded.append(bytes([width]) + np.concatenate([out[lane, :filled[lane]], np.array(tail, np.uint16)]).astype("<u2").tobytes())
    return coded


def decode(coded: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block from its bytes and its number of ids."""
    widths = [b[0] if n else 2 for b, n in zip(coded, sizes)]
    found = [np.zeros(0, np.uint32)] * len(coded)
    for width in set(widths):
        order, own = _lanes(sizes, widths, width)
        if order:
            for i, ids in zip(order, _decode([coded[i] for i in order], own, width)):
                found[i] = ids
    return found


def _decode(coded: list[bytes], sizes: np.ndarray, width: int) -> list[np.ndarray]:
    n = int(sizes[0])
    words = np.zeros((len(coded), max(map(len, coded)) // 2 + 8), np.uint16)
    for lane, block in enumerate(coded):
        words[lane, :len(block) // 2] = np.frombuffer(block, "<u2", offset=1)
    first = words[:, :3].astype(np.uint64)
    code = first[:, 0] << _HALF | first[:, 1] << _WORD | first[:, 2]
    taken = np.full(len(coded), 3, np.int64)
    last = words.shape[1] - 1
    ids = np.zeros((n, len(coded)), np.uint32)

    def take(lanes: np.ndarray, ends: np.ndarray) -> None:
        # a damaged block may ask for more; its checksum tells
        code[lanes] = (code[lanes] << _WORD | words[lanes, np.minimum(taken[lanes], last)].astype(np.uint64)) & _WORD_MASK
        taken[lanes] += 1

    model, coder = _Model(len(coded), width), _Range(len(coded), take)
    for step in range(n):
        lanes = int(np.searchsorted(-sizes, -step, "left"))
        if lanes < model.lanes:
            model.keep(lanes)
        some = slice(lanes)
        model.predict()
        unit = coder.size[some] >> _TOTAL
        at = np.minimum((code[some] - coder.low[some]) // unit, np.uint64((1 << _TOTAL_BITS) - 1)).astype(np.int64)
        is2 = at < model.share2
        own = np.where(is2, model.guess[1], model.guess[0])
        share = np.where(is2, model.share2, model.share1)
        start = np.where(is2, 0, model.share2)
        plain = np.flatnonzero(at >= model.given)
        missed = model.slot(plain, (((at[plain] - model.given[plain] + 1) << _HEAD_BITS) - 1) // model.rest[plain])
        start[plain], share[plain] = model.head(plain, missed)
        coder.narrow(some, unit, start, share)
        for shift in model.shifts:
            rows, totals = model.rows(plain, missed, shift)
            unit = coder.size[plain] // totals.astype(np.uint64)
            bits = model.find(rows, np.minimum(((code[plain] - coder.low[plain]) // unit).astype(np.int64), totals - 1))
            start, share = model.part(rows, totals, bits)
            coder.narrow(plain, unit, start, share)
            missed = missed << 4 | bits
        own[plain] = missed
        ids[step, :lanes] = own
        model.update(own)
    return [ids[:size, lane].copy() for lane, size in enumerate(sizes)]
