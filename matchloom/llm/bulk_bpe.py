"""Byte-level BPE of many texts at once, over arrays of their bytes.

The texts lie one after the other, each with a byte ``END`` behind it that no UTF-8 has. They
are cut into the words of the pre-tokenizer, and the different words are merged side by side:
every round makes, in each word, the one merge that is due. Texts with special strings or
characters from U+0250 on, and words of over ``LONG`` bytes, are encoded by ``trie_bpe``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .trie_bpe import _DIGIT, _LETTER, _SPACE, _bytes_of_symbols, codec

LONG = 128  # bytes of a word that is merged here
GROUP = 8_000_000  # bytes of texts taken at once; a longer text is a group of its own
U32 = np.uint32
END = 0xFF
_OTHER, _SPACES, _LETTERS, _DIGITS, _BORDER = range(5)


def _kinds() -> np.ndarray:
    out = np.zeros(0x250, np.uint8)
    for kind, characters in ((_SPACES, _SPACE), (_LETTERS, _LETTER), (_DIGITS, _DIGIT)):
        out[[k for k in range(0x250) if re.match(f"[{characters}]", chr(k))]] = kind
    return out


_KIND = _kinds()
_OF_BYTE = np.zeros(256, np.uint8)
_OF_BYTE[:128], _OF_BYTE[END] = _KIND[:128], _BORDER
_IN_TEXT = np.zeros(256, bool)  # bytes behind an apostrophe that may be a shortened word
_IN_TEXT[list(b"stmdrvl")] = True


def beyond(raw: np.ndarray) -> np.ndarray:
    """Where a character from U+0250 on starts."""
    at = np.flatnonzero((raw >= 0xC9) & (raw != END))
    return at[(raw[at] > 0xC9) | (raw[at + 1] >= 0x90)]


def cuts(raw: np.ndarray) -> np.ndarray:
    """Where each word starts; each ``END`` is a word of its own, and the last byte is one."""
    kind = _OF_BYTE[raw]
    wide = np.flatnonzero((raw >= 0xC2) & (raw != END))
    if len(wide):
        kind[wide] = kind[wide + 1] = _KIND[(raw[wide].astype(np.int64) & 0x1F) << 6 | raw[wide + 1] & 0x3F]
    inner = np.zeros(len(raw), bool)  # bytes inside a character
    inner[wide + 1] = True
    before = np.empty_like(kind)
    before[0], before[1:] = _BORDER, kind[:-1]
    new = kind != before
    # A blank goes with the word behind it, and any other space stands alone there.
    space = np.flatnonzero(new[1:] & (before[1:] == _SPACES) & (kind[1:] != _BORDER)) + 1  # words behind a space
    blank = raw[space - 1] == 32
    new[space[blank]] = False
    last = space - 1 - inner[space - 1]
    new[last] = True
    # An apostrophe that starts a word and is followed by the end of a shortened word.
    at = np.flatnonzero(raw[:-1] == 39)
    at = at[new[at] & _IN_TEXT[raw[at + 1]]]
    if len(at):
        one, two = raw[at + 1], raw[np.minimum(at + 2, len(raw) - 1)]
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)  # re, ve, ll
        short = (one != 114) & (one != 118) & (one != 108)
        new[at[long | short] + 1] = False
        new[at[short] + 2] = True
        new[at[long] + 3] = True
    new[raw == END] = True
    return np.flatnonzero(new)


_NONE = np.int32((1 << 24) - 1)  # the rank of two ids that don't merge
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64).view(np.int64)
_TABLE_BITS = 18


@lru_cache(maxsize=4)
def merger(path: str) -> Merger:
    """One for each file in a worker."""
    return Merger(path)


class Merger:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.special, byte_of = path, [t["content"].encode() for t in spec["added_tokens"]], _bytes_of_symbols()
        vocabulary = spec["model"]["vocab"]
        if max(vocabulary.values()) >= 1 << 20 or len(spec["model"]["merges"]) >= _NONE:
            raise ValueError("ids have to be below 2**20")
        self.of_byte = np.zeros(256, np.int32)
        for symbol, byte in byte_of.items():
            self.of_byte[byte] = vocabulary[symbol]
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in spec["model"]["merges"]]
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        # Pairs by their hash, those whose place is taken by another one's next.
        keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        left, self.tables = np.arange(len(keys)), []
        for factor in _FACTORS:
            table = np.full(1 << _TABLE_BITS, -1, np.int64)
            place = self._place(keys[left], factor)
            table[place[::-1]] = (keys[left] << 24 | left)[::-1]
            left = left[table[place] & _NONE != left]
            self.tables.append(table)
        self.more = np.sort(keys[left] << 24 | left)

    @staticmethod
    def _place(keys: np.ndarray, factor: np.int64) -> np.ndarray:
        return keys * factor >> 30 & (1 << _TABLE_BITS) - 1

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or ``_NONE``."""
        keys = a.astype(np.int64) << 20 | b
        found = self.tables[0][self._place(keys, _FACTORS[0])]
        hit = found >> 24 == keys
        out = np.where(hit, (found & _NONE).astype(np.int32), _NONE)
        left = np.flatnonzero(~hit & (found >= 0))  # the place is another pair's
        for table, factor in zip(self.tables[1:], _FACTORS[1:], strict=True):
            found = table[self._place(keys[left], factor)]
            hit = found >> 24 == keys[left]
            out[left[hit]] = found[hit] & _NONE
            left = left[~hit & (found >= 0)]
        if len(self.more) and len(left):
            found = self.more[np.minimum(np.searchsorted(self.more, keys[left] << 24), len(self.more) - 1)]
            hit = found >> 24 == keys[left]
            out[left[hit]] = found[hit] & _NONE
        return out

    def merged(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that lie one after the other, and the number of each word's ids."""
        counts, done = np.zeros(len(sizes), np.int64), []
        ids, words = self.of_byte[raw], np.arange(len(sizes))
        ranks = np.full(len(ids), _NONE)
        if len(ids):
            ranks[:-1] = self.ranks(ids[:-1], ids[1:])
            ranks[np.cumsum(sizes) - 1] = _NONE
        while len(words):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks, starts)
            due = least < _NONE
            if not due.all():
                stays = np.repeat(due, sizes)
                counts[words[~due]] = sizes[~due]
                done.append((words[~due], ids[~stays]))
                ids, ranks, words, sizes, least = ids[stays], ranks[stays], words[due], sizes[due], least[due]
                if not len(words):
                    break
                starts = np.cumsum(sizes) - sizes
            # The leftmost place of each word's least rank.
            hit = np.flatnonzero(ranks == np.repeat(least, sizes))
            place = hit[np.searchsorted(hit, starts)]
            ids[place] = self.made[least]
            stays = np.ones(len(ids), bool)
            stays[place + 1] = False
            last = place + 1 == starts + sizes - 1
            ids, ranks = ids[stays], ranks[stays]
            place = place - np.arange(len(place))  # a place is gone in each word before
            sizes = sizes - 1
            ranks[place[last]] = _NONE
            at = place[~last]
            ranks[at] = self.ranks(ids[at], ids[at + 1])
            at = place[place > starts - np.arange(len(starts))] - 1
            ranks[at] = self.ranks(ids[at], ids[at + 1])
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), U32)
        for some, flat in done:
            out[_places(starts[some], counts[some])] = flat
        return out, counts

    def learn(self, raw: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``merged`` of words of any size, one of which may be ``END``."""
        sizes = np.diff(ends)
        long = np.flatnonzero(sizes > LONG)
        short = np.repeat(sizes <= LONG, sizes)
        ids, counts = self.merged(raw[ends[0] : ends[-1]][short], sizes[sizes <= LONG])
        if len(long):
            found = [raw[ends[k] : ends[k + 1]].tobytes().decode() for k in long]
            learned = codec(self.path).learn(found)
            found = [np.frombuffer(learned[w], "<u4") for w in found]
            every = np.zeros(len(sizes), np.int64)
            every[sizes <= LONG], every[long] = counts, [len(x) for x in found]
            starts, out = np.cumsum(every) - every, np.empty(int(every.sum()), U32)
            out[_places(starts[sizes <= LONG], counts)] = ids
            out[_places(starts[long], every[long])] = np.concatenate(found)
            ids, counts = out, every
        mark = np.flatnonzero((sizes == 1) & (raw[ends[:-1]] == END))
        ids[(np.cumsum(counts) - counts)[mark]] = end_id
        return ids, counts

    def _group(self, raw: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        at = cuts(raw)
        words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw))), pa.py_buffer(raw)]).dictionary_encode()
        different, which = words.dictionary, words.indices.to_numpy()
        ends = np.frombuffer(different.buffers()[1], np.int64)[different.offset : different.offset + len(different) + 1]
        ids, counts = self.learn(np.frombuffer(different.buffers()[2], np.uint8), ends, end_id)
        starts, sizes = np.cumsum(counts) - counts, counts[which]
        return ids[_places(starts[which], sizes)].astype("<u4", copy=False), np.cumsum(sizes)[raw[at] == END]

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of some texts at a time, in order: their ids, ``end_id`` behind each (a null text has
        it alone), and the number of ids of each text."""
        texts.validate(full=True)  # bytes that aren't UTF-8 would be taken for borders
        whole = pc.fill_null(texts.cast(pa.large_binary()), b"")
        joined = pc.binary_join_element_wise(whole, pa.scalar(bytes([END]), pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        bounds = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        raw = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
        strange = np.zeros(len(texts), bool)
        for special in self.special:
            strange |= pc.count_substring(whole, special).to_numpy() > 0
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + GROUP, "right")) - 1)
            some, ends = raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
            odd = strange[first:last].copy()
            odd[np.searchsorted(ends, beyond(some), "right") - 1] = True
            if odd.any():  # they are empty here, and put in between afterwards
                keep = np.repeat(~odd, np.diff(ends))
                keep[ends[1:] - 1] = True
                some = some[keep]
            ids, to = self._group(some, end_id)
            n = np.diff(to, prepend=0)
            if odd.any():
                at = np.flatnonzero(odd)
                found = [np.frombuffer(x, "<u4") for x in codec(self.path).encode([texts[first + int(k)].as_py() for k in at])]
                parts = np.split(ids, to[at] - 1)
                ids = np.concatenate([parts[0], *(x for pair in zip(found, parts[1:], strict=True) for x in pair)])
                n[at] += [len(x) for x in found]
            yield ids, n
            first = last


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that start at ``starts``, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
