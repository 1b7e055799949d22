"""Words and shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space and the five control characters 9 to 13, which
is ``[^\\x20\\x09-\\x0D]+`` on the text. Hashes are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
PIECE = 1 << 20  # bytes hashed at once; a longer text is taken in several pieces
_BASE = U64(0x9E3779B97F4A7C55)
_INVERSE = U64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_spans(piece: bytes, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends, and its hash; ``outside`` says which bytes are of none."""
    raw = np.frombuffer(piece, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~outside[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _power_tables(max(len(raw), PIECE))
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * up[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return starts, ends, mixed(hashes ^ ((ends - starts).astype(U64) << U64(48)))


def _hashed_piece(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash."""
    starts, _, hashes = word_spans(piece, _IS_SPACE)
    return starts, hashes


def word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the text, hashes of its words in order), for each text.

    Short texts are joined and hashed together; a text longer than ``PIECE`` is cut at
    spaces, so memory stays bounded whatever the length of a text.
    """
    at = 0
    while at < len(texts):
        if len(texts[at]) > PIECE:
            yield at, _long_text(texts[at])
            at += 1
            continue
        first, size = at, 0
        while at < len(texts) and size + len(texts[at]) <= PIECE:
            size += len(texts[at]) + 1
            at += 1
        group = texts[first:at]
        starts, hashes = _hashed_piece(b"\n".join(group))
        bounds = np.cumsum([0] + [len(t) + 1 for t in group])
        cuts = np.searchsorted(starts, bounds)
        for k in range(len(group)):
            yield first + k, hashes[cuts[k] : cuts[k + 1]]


def _long_text(text: bytes) -> np.ndarray:
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not _IS_SPACE[text[end]]:
            end += 1
        parts.append(_hashed_piece(text[at:end])[1])
        at = end
    return np.concatenate(parts)


_STEPS = [U64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order; of a shorter text its whole sequence."""
    if len(words) == 0:
        return words
    size = min(n, len(words))
    total = np.zeros(len(words) - size + 1, U64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * _STEPS[k % 5] + U64(k // 5)
    return mixed(total ^ U64(size))
