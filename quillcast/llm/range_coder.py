"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block starts with empty models, so it decodes on its own. Three predictions are mixed:
the id that last followed the previous two ids (order 2), the one that last followed the
previous id (order 1), and the frequencies of ids so far (order 0). How far orders 2
and 1 are trusted is learnt per pair of their confidences: this says which share of the
coder's interval goes to "as order 2 says", "as order 1 says" and "as order 0 says". In the
last share the id follows in four digits of four bits, three by adaptive frequencies and
the last one even.

All blocks of a batch advance together, one id each per step, so a step is a fixed number of
array operations whatever the number of blocks.
"""

from __future__ import annotations

import numpy as np

SLOTS = 1024  # remembered contexts per order and block
CONTEXTS = 32  # pairs of confidences, and whether both orders agree
LIMIT = 500  # of a frequency table's total; four of them and a digit fit into the coder's 40 bits
TRUST, GAIN = 20, 12  # added to what occurred
ROW = np.dtype((np.void, 32))  # a digit's 16 cumulated frequencies, moved as one item
TOP, WINDOW = np.uint64(40), np.uint64(56)  # the interval stays over 2 ** TOP and at most 2 ** WINDOW
_ONE, _16 = np.uint64(1), np.uint64(16)
#: What a digit adds to a row of cumulated frequencies.
_STEPS = (np.arange(16)[None, :] >= np.arange(16)[:, None]).astype(np.uint16) * np.uint16(GAIN)
_EVEN = np.arange(1, 17, dtype=np.uint16)


class _Models:
    """The predictors of all blocks. Tables are flat: numpy moves single items fastest."""

    def __init__(self, blocks: int):
        self.lane = np.arange(blocks, dtype=np.int64)
        self.order1 = np.zeros(blocks * SLOTS, dtype=np.uint32)
        self.order2 = np.zeros(blocks * SLOTS, dtype=np.uint32)
        # Cumulated from 0: the shares of order 2, order 1 and order 0, four numbers in one item.
        self.trust = np.tile(np.array([0, 1, 2, 12], dtype=np.uint16), blocks * CONTEXTS).view(np.uint64)
        self.digits = [np.tile(_EVEN, blocks * size).view(ROW) for size in (1, 16, 256)]
        self.last = np.zeros(blocks, dtype=np.uint32)
        self.before = np.zeros(blocks, dtype=np.uint32)

    def predict(self) -> None:
        last, before = self.last, self.before
        mixed = last * np.uint32(2654435761)
        self.at1 = self.lane * SLOTS + (mixed >> np.uint32(22))
        self.at2 = self.lane * SLOTS + ((mixed ^ (before * np.uint32(2246822520))) * np.uint32(3266489917) >> np.uint32(22))
        self.e1, self.e2 = self.order1.take(self.at1), self.order2.take(self.at2)
        self.id1, self.id2 = self.e1 >> 2, self.e2 >> 2
        context = ((self.e2 & 3) << 3) | ((self.e1 & 3) << 1) | (self.id1 == self.id2)
        self.at = self.lane * CONTEXTS + context
        self.shares = self.trust.take(self.at).view(np.uint16)
        self.whole = self.shares[3::4].astype(np.uint64)

    def share(self, way: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the share that a way has."""
        at = self.lane * 4 + way
        return self.shares.take(at).astype(np.uint64), self.shares.take(at + 1).astype(np.uint64)

    def learn(self, ids: np.ndarray, way: np.ndarray) -> None:
        """``way`` is 0 for order 2, 1 for order 1, 2 for order 0."""
        shares = self.shares + _TRUSTED.take(way).view(np.uint16)
        over = np.flatnonzero(shares[3::4] > LIMIT)
        if len(over):
            rows = shares.reshape(-1, 4)
            rows[over, 1:] = _halved(rows[over, 1:])
        self.trust[self.at] = shares.view(np.uint64)
        for table, at, entry, guess in ((self.order1, self.at1, self.e1, self.id1), (self.order2, self.at2, self.e2, self.id2)):
            sure = entry & 3
            table[at] = np.where(guess == ids, entry + (sure < 3), np.where(sure > 1, entry - 1, (ids << 2) | 1))
        self.before, self.last = self.last, ids


_TRUSTED = np.array([[0, TRUST, TRUST, TRUST], [0, 0, TRUST, TRUST], [0, 0, 0, TRUST]], dtype=np.uint16).view(np.uint64).ravel()


def _halved(rows: np.ndarray) -> np.ndarray:
    """Cumulated frequencies halved, none below one."""
    counts = np.diff(rows.astype(np.int64), axis=1, prepend=0)
    return np.cumsum(counts - counts // 2, axis=1).astype(np.uint16)


def _bounds(rows: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of a digit in its row of cumulated frequencies; rows lie flat."""
    at = np.arange(0, len(rows), 16) + digit
    return (rows.take(np.maximum(at - 1, 0)) * (digit > 0)).astype(np.uint64), rows.take(at).astype(np.uint64)


def _store(table: np.ndarray, at: np.ndarray, rows: np.ndarray, digit: np.ndarray) -> None:
    rows = rows + _STEPS.take(digit, axis=0).ravel()
    over = np.flatnonzero(rows[15::16] > LIMIT)
    if len(over):
        square = rows.reshape(-1, 16)
        square[over] = _halved(square[over])
    table[at] = rows.view(ROW)


def encode(ids: np.ndarray) -> list[bytes]:
    """Code words of blocks of equal length; ``ids`` has a row per place and a column per block, values below 2 ** 16."""
    places, blocks = ids.shape
    models = _Models(blocks)
    low = np.zeros(blocks, dtype=np.uint64)
    width = np.full(blocks, _ONE << WINDOW, dtype=np.uint64)
    out = np.zeros((blocks, 3 * places + 16), dtype=np.uint16)  # words of 16 bits, at most 40 bits an id
    filled = np.zeros(blocks, dtype=np.int64)
    edge, mask = _ONE << TOP, (_ONE << TOP) - _ONE
    for place in range(places):
        symbol = ids[place].astype(np.uint32)
        models.predict()
        way = np.where(models.id2 == symbol, 0, 2 - (models.id1 == symbol))
        begin, end = models.share(way)
        unit = width // models.whole
        low += unit * begin
        width = unit * (end - begin)
        miss = np.flatnonzero(way == 2)
        if len(miss):
            value, some_low, some_width = symbol.take(miss).astype(np.int64), low.take(miss), width.take(miss)
            for table, size, shift in zip(models.digits, (1, 16, 256), (12, 8, 4), strict=True):
                at = miss * size + (value >> (shift + 4))
                digit = (value >> shift) & 15
                rows = table.take(at).view(np.uint16)
                begin, end = _bounds(rows, digit)
                unit = some_width // rows[15::16]
                some_low += unit * begin
                some_width = unit * (end - begin)
                _store(table, at, rows, digit)
            some_width >>= np.uint64(4)
            some_low += some_width * (value & 15).astype(np.uint64)
            low[miss], width[miss] = some_low, some_width
        models.learn(symbol, way)
        carry = np.flatnonzero(low >> WINDOW)
        if len(carry):
            low[carry] -= _ONE << WINDOW
            back = filled[carry] - 1
            while len(carry):
                out[carry, back] += np.uint16(1)
                on = out[carry, back] == 0
                carry, back = carry[on], back[on] - 1
        while len(small := np.flatnonzero(width <= edge)):
            value, to = low.take(small), filled.take(small)
            out[small, to] = (value >> TOP).astype(np.uint16)
            filled[small] = to + 1
            low[small] = (value & mask) << _16
            width[small] = width.take(small) << _16
    # The interval's low end, all of it.
    for shift in (40, 24, 8):
        out[models.lane, filled] = (low >> np.uint64(shift)).astype(np.uint16)
        filled += 1
    out[models.lane, filled] = ((low << np.uint64(8)) & np.uint64(0xFFFF)).astype(np.uint16)
    filled += 1
    return [out[block, : filled[block]].astype(">u2").tobytes() for block in range(blocks)]


def decode(codes: list[bytes], places: int) -> np.ndarray:
    """The inverse of ``encode``: a row per place, a column per block."""
    blocks = len(codes)
    longest = max(len(code) for code in codes) // 2 + 4
    words = np.zeros((blocks, longest), dtype=np.uint64)
    for block, code in enumerate(codes):
        words[block, : len(code) // 2] = np.frombuffer(code, dtype=">u2")
    models = _Models(blocks)
    lane = models.lane
    # 56 bits are three and a half words: the rest of the fourth stays behind for later.
    ahead = (words[:, 0] << np.uint64(40)) | (words[:, 1] << np.uint64(24)) | (words[:, 2] << np.uint64(8)) | (words[:, 3] >> np.uint64(8))
    # From here on a word is the half left over with the half that follows.
    words = (((words[:, :-1] & np.uint64(0xFF)) << np.uint64(8)) | (words[:, 1:] >> np.uint64(8))).astype(np.uint16)
    taken = np.full(blocks, 3, dtype=np.int64) + lane * words.shape[1]
    words = words.ravel()
    width = np.full(blocks, _ONE << WINDOW, dtype=np.uint64)
    edge = _ONE << TOP
    ids = np.empty((places, blocks), dtype=np.uint16)
    for place in range(places):
        models.predict()
        unit = width // models.whole
        value = ahead // unit
        way = (value >= models.shares[1::4]).astype(np.int64) + (value >= models.shares[2::4])
        begin, end = models.share(way)
        ahead = ahead - unit * begin
        width = unit * (end - begin)
        symbol = np.where(way == 0, models.id2, models.id1)
        miss = np.flatnonzero(way == 2)
        if len(miss):
            prefix = np.zeros(len(miss), dtype=np.int64)
            some_ahead, some_width = ahead.take(miss), width.take(miss)
            for table, size in zip(models.digits, (1, 16, 256), strict=True):
                at = miss * size + prefix
                rows = table.take(at).view(np.uint16)
                whole = rows[15::16]
                unit = some_width // whole
                value = np.minimum(some_ahead // unit, whole - 1).astype(np.uint16)
                below = np.bitwise_count((rows.reshape(-1, 16) <= value[:, None]).view(np.uint64).ravel())
                digit = (below[::2] + below[1::2]).astype(np.int64)
                begin, end = _bounds(rows, digit)
                some_ahead -= unit * begin
                some_width = unit * (end - begin)
                _store(table, at, rows, digit)
                prefix = (prefix << 4) | digit
            some_width >>= np.uint64(4)
            digit = np.minimum(some_ahead // some_width, np.uint64(15))
            some_ahead -= some_width * digit
            symbol[miss] = (prefix << 4) | digit.astype(np.int64)
            ahead[miss], width[miss] = some_ahead, some_width
        ids[place] = symbol
        models.learn(symbol, way)
        while len(small := np.flatnonzero(width <= edge)):
            at = taken.take(small)
            ahead[small] = (ahead.take(small) << _16) | words.take(at)
            width[small] = width.take(small) << _16
            taken[small] = at + 1
    return ids
