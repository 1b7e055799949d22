"""An adaptive context-mixing range coder for token ids.

Ids are coded in blocks, each with a model of its own and checksummed, so any block can be
read alone. Four orders predict the next id. Order 2 and order 1 each name the id that followed
most often on the two ids, or the one id, before; order 0 knows how often each id was met;
below it all ids are equally likely. The mixture's weights are learned apart for how sure the
two named ids are and whether they agree. An id's share of the range is its largest term of the
mixture, not the sum of its terms.

A block is cut into lanes of ``STEPS`` ids, which are coded side by side: every step takes the
next id of each lane. The model learns between rounds of steps, of which each is as long as all
before it, from the ids that the round had, so reader and writer have the same one; within a
round all ids are independent of each other but for their contexts. Each lane has a range coder
of 64-bit state that moves 32 bits at a time. Ids are coded as 16-bit halves where one of them
needs more.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

STEPS = 512  # ids of a lane
PIECE = 1 << 14  # ids whose shares are worked out at once
HEAD = "<IIBI"  # ids, their crc32 as little-endian unsigned 32-bit integers, symbols an id, crc32 of these and the code
HEAD_BYTES = struct.calcsize(HEAD)
SYMBOLS = 1 << 16
TWO_BITS, PAIR_BITS = 17, 20  # contexts of order 2, and ids on contexts, that a block tells apart at most
SLOT_BITS, SHARE_BITS = 17, 12  # order 0 has so many slots, the orders so many shares
SURE = 8  # degrees of how sure a named id is; 0: none is named

U64, U32 = np.uint64, np.uint32
_SLOT, _ALL, _WORD, _LEAST = U64(SLOT_BITS), U64(SLOT_BITS + SHARE_BITS), U64(32), U64(1 << 32)
_LAST, _LOW16 = U64((1 << SLOT_BITS + SHARE_BITS) - 1), U64(SYMBOLS - 1)
_PLACE, _SIZE = U64(32), U64((1 << 32) - 1)  # of an id in order 0: its first slot above the number of them
_KINDS = np.arange(SURE * SURE * 2)
_PRIOR = np.stack([_KINDS >> 4, (_KINDS >> 1 & SURE - 1) * (1 - (_KINDS & 1)), np.full(len(_KINDS), 4), np.ones(len(_KINDS), np.int64)], axis=1)
_IDS = np.arange(SYMBOLS, dtype=np.int64)
_FLAT = 1 << SLOT_BITS - 16  # slots of an id below order 0


class _Names:
    """The id that followed most often on each context, with the degree of how sure it is
    moved up by ``shift`` bits above the id."""

    def __init__(self, contexts: int, pairs: int, shift: int):
        self.best, self.met = np.zeros(contexts, U32), np.zeros(contexts, U32)
        self.pairs = np.zeros(pairs, U32)
        self.named, self.shift = np.zeros(contexts, U32), 16 + shift

    def learn(self, context: np.ndarray, ids: np.ndarray) -> None:
        pair = ((context << 16 | ids) * 0x2545F4914F6CDD1D >> 31) & len(self.pairs) - 1
        np.add.at(self.pairs, pair, U32(1))
        np.maximum.at(self.best, context, np.minimum(self.pairs[pair], U32(SYMBOLS - 1)) << U32(16) | ids.astype(U32))
        np.add.at(self.met, context, U32(1))
        some = context if len(context) < len(self.best) else np.flatnonzero(self.met)
        best, met = self.best[some], np.minimum(self.met[some], U32(SYMBOLS - 1))
        sure = U32(1) + np.minimum((best >> U32(16)) * U32(SURE - 1) // (met + U32(1)), U32(SURE - 2))
        self.named[some] = best & U32(SYMBOLS - 1) | sure << U32(self.shift)


class _Model:
    """What both sides know at the start of a round."""

    def __init__(self, n: int):
        two, pairs = (1 << min(bits, n.bit_length() + 2) for bits in (TWO_BITS, PAIR_BITS))
        self.one, self.two = _Names(SYMBOLS, pairs, 1), _Names(two, pairs, 4)
        self.times = np.zeros(SYMBOLS, np.int64)
        # Of order 0, and of all ids that it doesn't know.
        self.slots = np.concatenate([np.zeros(1 << SLOT_BITS, U32), np.repeat(_IDS.astype(U32), _FLAT)])
        self.places = (_IDS * _FLAT << 32 | _FLAT).view(U64)
        self.order = np.full(SYMBOLS, 3, np.uint8)
        self.chosen = np.zeros((len(_KINDS), 4), np.int64)
        self.shares = np.full(len(_KINDS), 1 << 16 | 2 << 32 | 3 << 48, U64)

    def context(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return ((before << 16 | last) * 0x1E3779B97F4A7C15 >> 33) & len(self.two.named) - 1

    def kinds(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The named ids of order 2 and 1, and how the two stand."""
        two, one = self.two.named[self.context(before, last)], self.one.named[last]
        name_two, name_one = two & U32(SYMBOLS - 1), one & U32(SYMBOLS - 1)
        return name_two, name_one, ((two | one) >> U32(16) | (name_two == name_one)).astype(np.int64)

    def orders(self, before: np.ndarray, last: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How the named ids stand, and the order that codes each id: 0 for order 2, 1 for
        order 1, 2 for order 0, 3 for none."""
        name_two, name_one, kind = self.kinds(before, last)
        known = ids.astype(U32)
        order = self.order[ids]
        order[name_one == known] = 1
        order[name_two == known] = 0
        return kind, order

    def spans(self, before: np.ndarray, last: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the share of each id starts, and its size."""
        kind, order = self.orders(before, last, ids)
        start, size = _shares(self.shares[kind], order)
        place = self.places[ids]
        place[order < 2] = 1 << SLOT_BITS
        return (start << _SLOT) + size * (place >> _PLACE), size * (place & _SIZE)

    def learn(self, before: np.ndarray, last: np.ndarray, ids: np.ndarray) -> None:
        for at in range(0, len(ids), PIECE):
            some = slice(at, at + PIECE)
            kind, order = self.orders(before[some], last[some], ids[some])
            self.chosen += np.bincount(kind << 2 | order, minlength=self.chosen.size).reshape(self.chosen.shape)
            self.two.learn(self.context(before[some], last[some]), ids[some])
            self.one.learn(last[some], ids[some])
        weight = self.chosen * 8 + _PRIOR
        ends = np.cumsum(1 + weight * ((1 << SHARE_BITS) - 4) // weight.sum(axis=1, keepdims=True), axis=1)
        self.shares = (ends[:, 0] << 16 | ends[:, 1] << 32 | ends[:, 2] << 48).view(U64)
        self.times += np.bincount(ids, minlength=SYMBOLS)
        seen = np.flatnonzero(self.times)
        times, slots = self.times[seen], 1 << SLOT_BITS
        size, goal = np.maximum(times * slots // times.sum(), 1), slots
        while (over := int(size.sum()) - slots) > 0:
            goal -= over
            size = np.maximum(times * max(goal, 0) // times.sum(), 1)
        self.order[seen], self.places[seen] = 2, (np.cumsum(size) - size << 32 | size).view(U64)
        filled = np.repeat(seen.astype(U32), size)
        self.slots[: len(filled)] = filled


def _shares(share: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first share of an order and the number of them; the last order ends with all."""
    share = share >> (order.astype(U64) << U64(4))
    start = share & _LOW16
    return start, (share >> U64(16)) - start & U64((1 << SHARE_BITS) - 1)


def _lanes(n: int) -> tuple[int, int, int]:
    """How many lanes, the steps of the longest, and how many are as long."""
    lanes = max(1, n // STEPS)
    steps = -(-n // lanes)
    return lanes, steps, n - lanes * (steps - 1)


def _rounds(steps: int):
    at, end = 0, 1
    while at < steps:
        yield at, min(end, steps)
        at, end = end, 2 * end


def _write(ids: np.ndarray) -> bytes:
    """Counts of the lanes' words, and the words."""
    lanes, steps, full = _lanes(len(ids))
    grid = np.zeros((steps + 2, lanes), np.int64)  # a row for each step, behind two of zeros
    grid[2:, :full] = ids[: full * steps].reshape(full, steps).T
    grid[2 : steps + 1, full:] = ids[full * steps :].reshape(lanes - full, steps - 1).T
    low, span = np.zeros(lanes, U64), np.full(lanes, (1 << 64) - 1, U64)
    words, at = np.zeros((steps + 1) * lanes, U64), np.arange(lanes)
    model = _Model(len(ids))
    for first, end in _rounds(steps):
        contexts = grid[first:end].ravel(), grid[first + 1 : end + 1].ravel(), grid[first + 2 : end + 2].ravel()
        start, size = (x.reshape(-1, lanes) for x in _pieces(model, contexts))
        for k in range(end - first):
            m = lanes if first + k + 1 < steps else full
            unit = span[:m] >> _ALL
            moved = unit * start[k, :m]
            low[:m] += moved
            span[:m] = unit * size[k, :m]
            over = np.flatnonzero(low[:m] < moved)
            words[at[over] - lanes] += U64(1)
            out = np.flatnonzero(span[:m] < _LEAST)
            words[at[out]] = low[out] >> _WORD
            at[out] += lanes
            low[out] <<= _WORD
            span[out] <<= _WORD
        if end < steps:
            model.learn(*contexts)
    # The last word is the least that lies within the span, whatever follows it.
    last = low + (_LEAST - U64(1))
    over = np.flatnonzero(last < low)
    words[at[over] - lanes] += U64(1)
    words[at] = last >> _WORD
    words = words.reshape(steps + 1, lanes)
    for k in range(steps, 0, -1):
        words[k - 1] += words[k] >> _WORD
    used = at // lanes + 1
    flat = words.astype("<u4").T[np.arange(steps + 1) < used[:, None]]
    return used.astype("<u2").tobytes() + flat.tobytes()



def _pieces(model: _Model, contexts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    start, size = np.empty(len(contexts[2]), U64), np.empty(len(contexts[2]), U64)
    for at in range(0, len(start), PIECE):
        start[at : at + PIECE], size[at : at + PIECE] = model.spans(*(c[at : at + PIECE] for c in contexts))
    return start, size


def _read(code: bytes, n: int) -> np.ndarray:
    lanes, steps, full = _lanes(n)
    used = np.frombuffer(code, "<u2", lanes).astype(np.int64)
    words = np.append(np.frombuffer(code, "<u4", offset=2 * lanes), np.zeros(2, "<u4")).astype(U64)
    ends = np.cumsum(used)
    at = ends - used
    # Behind its last word a lane reads zeros.
    zero = len(words) - 1
    value = words[at] << _WORD | words[np.where(used > 1, at + 1, zero)]
    at += 2
    grid, span = np.zeros((steps + 2, lanes), np.int64), np.full(lanes, (1 << 64) - 1, U64)
    model = _Model(n)
    for first, end in _rounds(steps):
        for k in range(first, end):
            m = lanes if k + 1 < steps else full
            unit = span[:m] >> _ALL
            aim = np.minimum(value[:m] // unit, _LAST)
            name_two, name_one, kind = model.kinds(grid[k, :m], grid[k + 1, :m])
            share, top = model.shares[kind], aim >> _SLOT
            order = (top >= (share >> U64(16) & _LOW16)).astype(np.uint8)
            order += top >= (share >> U64(32) & _LOW16)
            order += top >= share >> U64(48)
            start, size = _shares(share, order)
            got = np.where(order == 0, name_two, name_one)
            rest = np.flatnonzero(order >= 2)
            some = size[rest]
            start <<= _SLOT
            slot = (aim[rest] - start[rest]) // some
            ids = model.slots[slot.view(np.int64) + (order[rest] == 3) * (1 << SLOT_BITS)]
            place = model.places[ids]
            got[rest] = ids
            start[rest] += some * (place >> _PLACE)
            size <<= _SLOT
            size[rest] = some * (place & _SIZE)
            grid[k + 2, :m] = got
            value[:m] -= unit * start
            span[:m] = unit * size
            out = np.flatnonzero(span[:m] < _LEAST)
            place = at[out]
            value[out] = value[out] << _WORD | words[np.where(place < ends[out], place, zero)]
            at[out] = place + 1
            span[out] <<= _WORD
        if end < steps:
            model.learn(grid[first:end].ravel(), grid[first + 1 : end + 1].ravel(), grid[first + 2 : end + 2].ravel())
    return np.concatenate([grid[2:, :full].T.ravel(), grid[2 : steps + 1, full:].T.ravel()])


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids below 2**32 as ``HEAD`` and the code."""
    out = []
    for block in blocks:
        raw = np.asarray(block, "<u4")
        halves = 2 if len(raw) and int(raw.max()) >= SYMBOLS else 1
        code = _write((raw.view("<u2") if halves == 2 else raw).astype(np.int64)) if len(raw) else b""
        head = struct.pack(HEAD, len(raw), zlib.crc32(raw.tobytes()), halves, 0)[:-4]
        out.append(head + struct.pack("<I", zlib.crc32(code, zlib.crc32(head))) + code)
    return out


def decode(codes: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a block that is damaged raises ValueError."""
    out = []
    for block in codes:
        if len(block) < HEAD_BYTES:
            raise ValueError("a block is cut off")
        n, ids_crc, halves, crc = struct.unpack_from(HEAD, block)
        code = memoryview(block)[HEAD_BYTES:]
        if zlib.crc32(code, zlib.crc32(block[: HEAD_BYTES - 4])) != crc:
            raise ValueError("a block's checksum is wrong")
        got = _read(code, n * halves) if n else np.empty(0, np.int64)
        got = got.astype("<u2").view("<u4") if halves == 2 else got.astype("<u4")
        if zlib.crc32(got.tobytes()) != ids_crc:
            raise ValueError("a block's ids don't have the checksum they had")
        out.append(got)
    return out


_POLYNOMIAL = 0xEDB88320  # fixed value: of crc32, lowest power first


def _product(a: int, b: int) -> int:
    """Of two polynomials over bits, the highest bit for power 0, reduced by the crc's."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings one after the other, of their crc32 and the second's size."""
    power, square = 1 << 31, 1 << 23  # one, and the power for a byte
    while size:
        power = _product(square, power) if size & 1 else power
        square, size = _product(square, square), size >> 1
    return _product(power, first) ^ second
