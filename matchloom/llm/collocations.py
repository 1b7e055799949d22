"""Phrase collocations by SON partitioning.

The texts of each language are dealt into ``SHARDS`` shards. A phrase that all texts have
``min_count`` times is, in one shard at least, as frequent as that shard's share of the words
asks for. So each shard is mined completely at its own lowered support, level by level (a
phrase is looked at only where the phrases one word shorter in it are frequent in the shard);
what is frequent in any shard is a candidate; and candidates are counted in all texts, by
their words. Mining works on 64-bit hashes, which can only add candidates, counting on phrases.

The shards are few, whatever the input: with more of them than ``min_count`` a phrase found
once in a shard would have to be a candidate. A shard is itself mined by many tasks, and its
counts are sums by phrase, added up before they are shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bits import bit_filter, passes
from .store import discard, written
from .words import U64, mixed, shingle_hashes, word_spans
from .workers import tidy

SHARDS = 4
CHUNK = 1 << 20  # bytes of a language's and shard's texts counted at once
HELD = 1 << 25  # bytes of texts after which all that wait are counted
MIN_COUNT, INSIDE, TOP, LONGEST = 10, 50, 2000, 3

_BREAKS = b".,;:!?\n\v\f\r"
_is_break, _is_outside = np.zeros(256, bool), np.zeros(256, bool)
_is_break[list(_BREAKS)] = True
_is_outside[list(_BREAKS + b" \t")] = True
_next_outside = re.compile(b"[.,;:!?\n\v\f\r \t]").search
_gaps = re.compile(b"[ \t]{2,}|\t").sub
_last_piece = re.compile(b"[^.,;:!?\n\v\f\r]*\\Z").search
_SHARD_MARK = [int(x) for x in mixed(np.arange(1, SHARDS + 1, dtype=U64)).view(np.int64)]


def _chunks(texts: list[bytes], carried: int) -> Iterator[tuple[bytes, int]]:
    """Texts joined to bytes of bounded size, and the number of words at their beginning that
    were there before: of a text that is cut, the last ones come again."""
    short = [t for t in texts if len(t) <= CHUNK]
    if short:
        yield b"\n".join(short), 0
    for text in texts:
        if len(text) <= CHUNK:
            continue
        at, before = 0, []
        while at < len(text):
            end = min(len(text), at + CHUNK)
            found = _next_outside(text, end)
            end = found.start() if found else len(text)
            part = b" ".join([*before, text[at:end]])
            yield part, len(before)
            before, at = _last_piece(part)[0].split()[-carried:] if carried else [], end


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def cell_of(lang: str, shard: int, size: int = 0) -> int:
    """A number for a language, a shard and a length, signed. The lowest byte has the last two;
    languages of one hash would be mined together, which loses no candidate."""
    x = _lang_hash(lang) & ~255 | shard << 4 | size
    return x - (1 << 64) if x >> 63 else x


class Phrases:
    """The words of a chunk: where they are, and the keys of the phrases that begin with each."""

    def __init__(self, chunk: bytes, carried: int, lang: str) -> None:
        chunk = _gaps(b" ", chunk)
        self.chunk, self.carried = chunk, carried
        self.lang = U64(_lang_hash(lang))
        self.starts, self.ends, self.hashes = word_spans(chunk, _is_outside)
        self.piece = np.cumsum(_is_break[np.frombuffer(chunk, np.uint8)])[self.starts] if len(self.starts) else self.starts

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words, keys) of all phrases of so many words."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, U64)
        inside = self.piece[:n] == self.piece[size - 1 :]
        inside[: max(0, self.carried - size + 1)] = False
        at = np.flatnonzero(inside)
        return at, mixed(shingle_hashes(self.hashes, size)[at] ^ self.lang)

    def every_key(self, size: int) -> np.ndarray:
        """The key of the words from each place on, wherever pieces end."""
        return mixed(shingle_hashes(self.hashes, size) ^ self.lang)

    def texts(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases that begin at the given words, one space between words."""
        starts, ends = self.starts[at], self.ends[at + size - 1]
        bounds = np.concatenate(([0], np.cumsum(ends - starts)))
        places = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], ends - starts)
        data = np.frombuffer(self.chunk, np.uint8)[places]
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]).cast(pa.string())


def _by_cell(batches, carried: int) -> Iterator[tuple[str, int, Phrases]]:
    """(lang, shard, phrases) of all texts in chunks."""
    waiting: dict[tuple[str, int], list[bytes]] = {}
    size: dict[tuple[str, int], int] = {}
    held = 0  # bytes since all waiting texts went

    def flush(cell):
        size.pop(cell)
        for chunk, before in _chunks(waiting.pop(cell), carried):
            yield *cell, Phrases(chunk, before, cell[0])

    for batch in batches:
        for lang, shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            cell = (lang, shard)
            waiting.setdefault(cell, []).append(text.lower())
            size[cell] = size.get(cell, 0) + len(text) + 1
            if size[cell] >= CHUNK:
                yield from flush(cell)
            held += len(text) + 1
            if held >= HELD:
                held = 0
                for x in list(size):
                    yield from flush(x)
    for cell in list(size):
        yield from flush(cell)


def _texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    shard = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string"), text), F.lit(SHARDS)).cast("int")
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), shard.alias("shard"), text.alias("body"))


_MINED = "cell long, key long, n long"


def _mined_batch(lang: str, shard: int, size: int, keys: np.ndarray) -> pa.RecordBatch:
    key, n = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), cell_of(lang, shard, size))), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["cell", "key", "n"])


def _word_count(text: bytes) -> int:
    n, after_gap = 0, True
    for at in range(0, len(text), CHUNK):
        outside = _is_outside[np.frombuffer(text[at : at + CHUNK], np.uint8)]
        n += int(np.count_nonzero(~outside[1:] & outside[:-1])) + bool(after_gap and not outside[0])
        after_gap = bool(outside[-1])
    return n


def totals(texts: DataFrame) -> DataFrame:
    """(lang, cell, words): number of words of each language and shard."""

    def run(batches):
        found: dict[tuple[str, int], int] = {}
        for batch in batches:
            for lang, shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                found[lang, shard] = found.get((lang, shard), 0) + _word_count(text)
        if found:
            yield pa.RecordBatch.from_pylist([{"lang": lang, "cell": cell_of(lang, s), "words": n} for (lang, s), n in found.items()], schema=pa.schema([("lang", pa.string()), ("cell", pa.int64()), ("words", pa.int64())]))

    return texts.mapInArrow(tidy(run), "lang string, cell long, words long").groupBy("lang", "cell").agg(F.sum("words").alias("words"))


def _frequent(counts: DataFrame, least: DataFrame) -> DataFrame:
    """(cell, key) of what is frequent in its shard."""
    sums = counts.groupBy("cell", "key").agg(F.sum("n").alias("n"))
    return sums.join(least, F.col("cell").bitwiseAND(F.lit(~15)) == F.col("shard_cell")).where("n >= least").select("cell", "key")


def mined(texts: DataFrame, words: DataFrame, min_count: int, longest: int) -> list[DataFrame]:
    """What is frequent in any shard, with its shard: a table for each level."""
    by_cell = words.groupBy(F.col("cell").alias("shard_cell")).agg(F.sum("words").alias("words")).where("words > 0").withColumn("hash", F.col("shard_cell").bitwiseAND(F.lit(~255)))
    whole = by_cell.groupBy("hash").agg(F.sum("words").alias("all"))
    # The share of min_count that falls to the shard by its words, rounded up.
    least = by_cell.join(whole, "hash").select("shard_cell", F.expr(f"cast(ceil({min_count} * cast(words as decimal(20, 0)) / all) as bigint)").alias("least"))
    least = written(least, "least")

    def first_two(batches):
        for lang, shard, phrases in _by_cell(batches, 1):
            for size in (1, 2):
                keys = phrases.keys(size)[1]
                if len(keys):
                    yield _mined_batch(lang, shard, size, keys)

    out = [written(_frequent(texts.mapInArrow(tidy(first_two), _MINED), least), "mined")]
    shard = F.shiftright(F.col("cell").bitwiseAND(F.lit(255)), 4).cast("int")
    mark = F.element_at(F.lit(_SHARD_MARK), shard + 1)
    for size in range(3, longest + 1):
        shorter = out[-1].where(F.col("cell").bitwiseAND(F.lit(15)) == size - 1).select(F.col("key").bitwiseXOR(mark).alias("key"))
        bits = texts.sparkSession.sparkContext.broadcast(bit_filter(shorter, "key"))

        def next_level(batches, size=size, bits=bits):
            for lang, shard, phrases in _by_cell(batches, size - 1):
                at, keys = phrases.keys(size)
                if len(at):
                    known = passes(bits.value, (phrases.every_key(size - 1) ^ np.array(_SHARD_MARK[shard]).view(U64)).view(np.int64))
                    keys = keys[known[at] & known[at + 1]]
                    if len(keys):
                        yield _mined_batch(lang, shard, size, keys)

        out.append(written(_frequent(texts.mapInArrow(tidy(next_level), _MINED), least), "mined"))
    discard(least)
    return out


def counted(texts: DataFrame, candidates: list[DataFrame], longest: int) -> DataFrame:
    """(lang, size, phrase, f): all occurrences of the candidates; others may be among them."""
    keys = candidates[0].select("key")
    for more in candidates[1:]:
        keys = keys.union(more.select("key"))
    bits = texts.sparkSession.sparkContext.broadcast(bit_filter(keys, "key"))

    def run(batches):
        for lang, _, phrases in _by_cell(batches, longest - 1):
            for size in range(1, longest + 1):
                at, keys = phrases.keys(size)
                keep = passes(bits.value, keys.view(np.int64))
                _, first, n = np.unique(keys[keep], return_index=True, return_counts=True)
                at = at[keep][first]
                for k in range(0, len(at), 50_000):
                    found = phrases.texts(at[k : k + 50_000], size)
                    m = len(found)
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), m), pa.repeat(pa.scalar(size, pa.int32()), m), found, pa.array(n[k : k + m].astype(np.int64))], names=["lang", "size", "phrase", "n"])

    found = texts.mapInArrow(tidy(run), "lang string, size int, phrase string, n long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))


def scored(counts: DataFrame, inside: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of several words that aren't mere parts of
    longer ones. Counts are taken to be below 10**15, so that products fit into 38 digits."""
    counts = counts.select("lang", "size", "phrase", F.col("f").alias("a"))
    several = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    joined = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    size = F.col("size")
    cuts = several.select("lang", "phrase", "a", F.inline(F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(k.alias("k"), joined(F.lit(1), k).alias("left"), joined(k + 1, size - k).alias("right")))))
    side = lambda part, f: counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(f))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    whole = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    cuts = cuts.withColumns({"p": F.lit(1_000_000).cast("decimal(7,0)") * whole("a", 15) * whole("a", 15), "q": whole("l", 19) * whole("r", 19)})
    cuts = cuts.select("lang", "phrase", "a", F.struct(F.expr("p div q").alias("score"), "k", "l", "r").alias("cut"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    spans: Column = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: joined(at, n))))
    parts = several.where("size > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("longer"))
    within = parts.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return best.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, inside: int = INSIDE, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """The best ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases of 2 to ``longest`` words, found ``min_count`` times within pieces between marks of
    punctuation and line ends, A-Z taken as a-z; a is how often. Of all cuts in two that one
    counts whose score 1000000 a a / (l r), rounded down, is least, l and r being how often its
    parts are found; of equal ones the first. A phrase is left out if a longer one that has
    its words is found in ``inside`` of a hundred of its places. n is the number of words of
    the language. Ties go by a, the larger first, then by the phrase's bytes.

    A null text counts as empty, a null language is ``und``. Repeated rows count as often as
    they are there, rows without an id like any other. An empty table gives no row. Other
    columns aren't read.
    """
    texts = _texts(docs, id_col, text_col, lang_col)
    words = written(totals(texts), "totals")
    candidates = mined(texts, words, min_count, longest)
    counts = written(counted(texts, candidates, longest).where(F.col("f") >= min_count), "counts")
    discard(*candidates)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(counts, inside).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    n = words.groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
