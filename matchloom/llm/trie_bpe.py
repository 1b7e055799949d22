"""Byte-level BPE by a prefix-sharing trie.

The distinct words of a batch are put in sorted order, which is the depth-first order of
their trie, and walked with a stack that holds, for each byte of the current path, the last
token of the encoding of the path so far. A word takes over the states of the prefix that it
shares with the word before; only the bytes behind it are worked out.

That the last token is enough as a state is a property of BPE: an encoding without its last
token is the encoding of the text without that token's bytes, and a sequence is an encoding
when all its adjacent pairs are. So the last token at a byte is the one vocabulary suffix that
stands next to the last token before it as the merges would leave them. Which vocabulary suffixes a
path has is told by an automaton over the vocabulary (Aho and Corasick), so the work at a byte
doesn't depend on where in the word it is.

Only words that recur are remembered between batches, up to ``KNOWN_BYTES``, and a task forgets
them at its end.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workers import release

KNOWN_BYTES = 64_000_000  # of words remembered; past it, all are forgotten
SEEN = 1 << 22  # places, by a word's hash, that tell whether it may have been met before
FITS = 400_000  # pairs of tokens remembered
BATCH_WORDS = 200_000  # words cut from texts before the unknown ones among them are encoded
ROWS = 2_000  # rows of a batch taken at once

#: The pre-tokenizer's pattern with its letters and digits below U+0250 spelled out.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGIT = "0-9²³¹¼½¾"
_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"
_PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One for each file in a worker, so that its words are remembered between batches."""
    return Codec(path)


class Codec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _bytes_of_symbols()
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.bytes_of = [b""] * (max([*self.id_of.values(), *self.special.values()]) + 1)
        for raw, i in [*self.id_of.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes_of[i] = raw
        # Tokens by age: the bytes come first, then the merges in the order of the file.
        self.age = {self.id_of[bytes([b])]: b for b in range(256)}
        self.halves = [(b, b) for b in range(256)]
        self.joins: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            a, b = (bytes(byte_of[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
            pair = (self.age[self.id_of[a]], self.age[self.id_of[b]])
            self.joins[pair] = self.age[self.id_of[a + b]] = len(self.halves)
            self.halves.append(pair)
        self.ahead, self.endings, self.back = _automaton(self.id_of)
        self.fast = re.compile(_PATTERN).findall
        self.beyond = re.compile("[^\x00-ɏ]").search
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.fits: dict[int, bool] = {}
        self.most_steps = len(self.ahead) + FITS
        self.known: dict[str | int, bytes] = {}
        self.seen, self.n_seen, self.n_bytes = bytearray(SEEN), 0, 0

    def adjacent(self, a: int, b: int) -> bool:
        """Whether the merges leave the bytes of the tokens a and b as just these two.

        Both are taken apart again, the younger first: what stood at the border at each
        moment must not have had a merge that was due before the next one that happened.
        """
        got = self.fits.get(key := a << 20 | b)
        if got is None:
            x, y, due, got = self.age[a], self.age[b], 1 << 30, True
            while self.joins.get((x, y), due) >= due:
                if max(x, y) < 256:
                    break
                if x > y:
                    due, x = x, self.halves[x][1]
                else:
                    due, y = y + 1, self.halves[y][0]
            else:
                got = False
            self.fits[key] = got
        return got

    def step(self, state: int, byte: int) -> int:
        """The automaton's next state, remembered as if it were a step of the vocabulary's trie."""
        ahead, at = self.ahead, state
        while (to := ahead.get(at << 8 | byte)) is None:
            at = self.back[at]
        if len(ahead) < self.most_steps:
            ahead[state << 8 | byte] = to
        return to

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Encodes different words together."""
        adjacent, fits, ahead, endings, step = self.adjacent, self.fits, self.ahead, self.endings, self.step
        before, out = b"", {}
        last, size, states = [-1], [0], [0]  # of the path's first k bytes: last token, its bytes, state
        for word, raw in sorted(((w, w.encode()) for w in words), key=lambda x: x[1]):
            keep = len(commonprefix((before, raw)))
            del last[keep + 1 :], size[keep + 1 :], states[keep + 1 :]
            state = states[keep]
            for end in range(keep + 1, len(raw) + 1):
                byte = raw[end - 1]
                to = ahead.get(state << 8 | byte)
                state = step(state, byte) if to is None else to
                for n, token in endings[state]:
                    if n == end:
                        break
                    a = last[end - n]
                    fit = fits.get(a << 20 | token)
                    if fit or fit is None and adjacent(a, token):
                        break
                last.append(token)
                size.append(n)
                states.append(state)
            ids, at = [], len(raw)
            while at:
                ids.append(last[at])
                at -= size[at]
            ids.reverse()
            out[word] = struct.pack(f"<{len(ids)}I", *ids)
            before = raw
        return out

    def words(self, text: str) -> list[str]:
        return self.fast(text) if not self.beyond(text) else [text[a:b] for _, (a, b) in self.split(text)]

    def pieces(self, text: str) -> list[str | int]:
        """Words, and the ids of special strings that stand in the text."""
        if not self.specials or not any(s in text for s in self.special):
            return self.words(text)
        return [w for part in self.specials.split(text) if part for w in ([self.special[part]] if part in self.special else self.words(part))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out, group, n = [], [], 0
        for text in texts:
            group.append(self.pieces(text or ""))
            n += len(group[-1])
            if n >= BATCH_WORDS:
                out += self._joined(group)
                group, n = [], 0
        return out + self._joined(group)

    def _joined(self, group: list[list]) -> list[bytes]:
        known, seen = self.known, self.seen
        new = set().union(*group).difference(known)
        for x in [x for x in new if isinstance(x, int)]:
            known[x] = struct.pack("<I", x)
            new.remove(x)
        found = self.learn(list(new))
        known.update(found)
        out = [b"".join(map(known.__getitem__, words)) for words in group]
        for word, ids in found.items():
            if seen[place := hash(word) & SEEN - 1]:
                self.n_bytes += len(ids) + 2 * len(word) + 200
            else:
                seen[place] = 1
                self.n_seen += 1
                del known[word]
        if self.n_bytes > KNOWN_BYTES:
            known.clear()
            self.n_bytes = 0
        if self.n_seen > SEEN // 2:
            self.seen, self.n_seen = bytearray(SEEN), 0
        if len(self.fits) > FITS:
            self.fits.clear()
        return out

    def forget(self) -> None:
        """Frees the words of the texts so far."""
        self.known, self.seen, self.n_seen, self.n_bytes = {}, bytearray(SEEN), 0, 0

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _automaton(vocabulary: dict[bytes, int]) -> tuple[dict[int, int], list[tuple], list[int]]:
    """Steps (state * 256 + byte -> state) of the vocabulary's trie, and of its root for every
    byte; for each state the (length, token) of all tokens that end there, the longest first;
    and the state of the longest proper suffix."""
    steps, endings, back, level = {}, [()], [0], {b"": 0}
    by_length: dict[int, list[bytes]] = {}
    for prefix in {raw[:n] for raw in vocabulary for n in range(1, len(raw) + 1)}:
        by_length.setdefault(len(prefix), []).append(prefix)
    for n in sorted(by_length):
        at, level = level, {}
        for prefix in sorted(by_length[n]):
            state = level[prefix] = len(endings)
            steps[at[prefix[:-1]] << 8 | prefix[-1]] = state
            suffix = back[at[prefix[:-1]]]
            while n > 1 and (to := steps.get(suffix << 8 | prefix[-1])) is None:
                suffix = back[suffix]
            back.append(to if n > 1 else 0)
            own = ((n, vocabulary[prefix]),) if prefix in vocabulary else ()
            endings.append(own + endings[back[state]])
    for byte in range(256):
        steps.setdefault(byte, 0)
    return steps, endings, back


def _bytes_of_symbols() -> dict[str, int]:
    """The printable symbol of each byte in the vocabulary file: itself where it is printable
    in Latin-1, else the next free one from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _over(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))


def in_slices(batches, tokenizer: str, made) -> Iterator[pa.RecordBatch]:
    """``made(codec, slice)`` of some rows at a time; what the codec has learned of the task's
    texts goes at its end."""
    c = codec(tokenizer)
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield made(c, batch.slice(at, ROWS))
    finally:
        c.forget()
        release()


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; a null or empty text has no ids. Rows are taken one
    by one, so repeated rows and null ids come out as they went in."""

    def made(c: Codec, rows: pa.RecordBatch) -> pa.RecordBatch:
        flat = c.encode(rows.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array([np.frombuffer(x, "<i4") for x in flat], pa.list_(pa.int32()))], names=["id", "ids"])

    return _over(docs, id_col, text_col).mapInArrow(lambda batches: in_slices(batches, tokenizer, made), "id long, ids array<int>")


def decoded(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(id, text) of (id, ids); null ids give an empty text. Bytes that are not UTF-8 become
    U+FFFD."""

    def made(c: Codec, rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = [c.decode(np.asarray(x or [], "<u4").tobytes()) for x in rows.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return tokens.select("id", "ids").mapInArrow(lambda batches: in_slices(batches, tokenizer, made), "id long, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every row and decodes the ids: (id, n_tokens, ids_sha256, decoded_sha256,
    ids_crc32). A null text counts as empty, with the digests of nothing."""

    def made(c: Codec, rows: pa.RecordBatch) -> pa.RecordBatch:
        flat = c.encode(rows.column(1).to_pylist())
        columns = [
            rows.column(0),
            pa.array([len(x) // 4 for x in flat], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in flat], pa.string()),
            pa.array([hashlib.sha256(c.decode(x).encode()).hexdigest() for x in flat], pa.string()),
            pa.array([zlib.crc32(x) for x in flat], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids_crc32"])

    return _over(docs, id_col, text_col).mapInArrow(lambda batches: in_slices(batches, tokenizer, made), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids_crc32 long")
