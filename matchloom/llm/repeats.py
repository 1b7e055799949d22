"""Removal of byte strings that occur again, by a Burrows-Wheeler transform.

Every ``length``-byte string has an anchor: the place in it of the least hash of ``GRAM``
bytes. Strings that are equal have the same anchor, so they meet where runs of neighbouring
strings are grouped by a hash of the bytes around it that all strings of a run hold. A group
in which all runs are equal, by two 64-bit hashes of different bytes, is decided by counting.
The different runs of the other groups are dealt into buckets, and in each bucket common prefixes are derived from the
Burrows-Wheeler transform of the runs: intervals of suffixes are extended backward, breadth
first, so prefix lengths come out in increasing order, and the expansion stops at ``length``.
Suffixes that are then still not told apart from a neighbour start a repeated string.

A group of more than ``HOT`` different runs could outgrow a task. Its runs are cut into
overlapping windows of starts, and each window is grouped by the bytes that all its strings
hold, which are more than the group had in common; windows go the same way as runs. A window
of a single start has all its bytes in common, so in the end no group is too large.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bit_filter, passes
from .columns import all_named, free, mapped, named, others
from .store import discard, tasks, written
from .words import PIECE, U64, _power_tables, mixed
from .workers import tidy

LENGTH = 200
GRAM = 16
HOT = 2_000
WIDTHS = (8, 1)  # starts of a window, one level after the other
BUCKET_BYTES = 1_500_000


class Runs:
    """The runs of the joined texts: their first string, number of strings, key and digest."""

    def __init__(self, buf: bytes, bounds: list[tuple[int, int]], length: int):
        raw = np.frombuffer(buf, np.uint8)
        n, core = len(raw), (length + GRAM) // 2
        up, down = _power_tables(max(n + 1, PIECE + 2 * LENGTH))
        sums = np.zeros(n + 1, U64)
        np.cumsum((raw.astype(U64) + U64(1)) * up[:n], out=sums[1:])

        def digest(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return mixed((sums[high] - sums[low]) * down[low] ^ ((high - low).astype(U64) << U64(44)))

        valid = np.zeros(n + 1, np.int8)
        for low, high in bounds:
            if high - low >= length:
                valid[low] += 1
                valid[high - length + 1] -= 1
        at = np.flatnonzero(np.cumsum(valid[: max(0, n - length + 1)], dtype=np.int8))
        self.first = self.size = np.empty(0, np.int64)
        self.key = self.run = self.ahead = np.empty(0, np.int64)
        if not len(at):
            return
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
        order = grams >> U64(24) << U64(24) | np.arange(len(grams), dtype=U64)
        anchor = (_sliding_least(order, length - GRAM + 1)[at] & U64((1 << 24) - 1)).astype(np.int64)
        left = anchor - at > core - GRAM - 1
        new = np.flatnonzero(np.diff(anchor, prepend=-1).astype(bool) | np.diff(left.astype(np.int8), prepend=2).astype(bool) | (np.diff(at, prepend=-2) != 1))
        self.first, self.size = at[new], np.diff(np.append(new, len(at)))
        a, is_left = anchor[new], left[new]
        self.ahead = a - self.first  # bytes before the anchor
        low = np.where(is_left, a - core + GRAM, a)
        self.key = (digest(low, low + core) ^ np.where(is_left, U64(0x5851F42D4C957F2D), U64(0))).view(np.int64)
        self.run = mixed(digest(self.first, self.first + self.size - 1 + length) + self.ahead.astype(U64)).view(np.int64)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, U64)
    padded[: len(x)] = x
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _pieces(texts: list[bytes], length: int):
    """(buffer, bounds, [(text, offset in it)]): several short texts or part of a long one."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > PIECE:
            for low in range(0, len(texts[at]) - length + 1, PIECE):
                part = texts[at][low : low + PIECE + length - 1]
                yield part, [(0, len(part))], [(at, low)]
            at += 1
            continue
        first, size, bounds = at, 0, []
        while at < len(texts) and size + len(texts[at]) <= PIECE:
            bounds.append((size, size + len(texts[at])))
            size += len(texts[at])
            at += 1
        yield b"".join(texts[first:at]), bounds, [(k, 0) for k in range(first, at)]


def _found(texts: list[bytes], length: int):
    """(buffer, runs, text of each run, place of each run in its text)."""
    for buf, bounds, where in _pieces(texts, length):
        runs = Runs(buf, bounds, length)
        if len(runs.first):
            which = np.searchsorted([b for b, _ in bounds], runs.first, "right") - 1
            # Empty texts begin where the next one does.
            text, offset = np.array([w[0] for w in where]), np.array([w[1] - b for w, (b, _) in zip(where, bounds, strict=True)])
            yield buf, runs, text[which], runs.first + offset[which]


def _bodies(docs: DataFrame, text_col: str) -> DataFrame:
    body = F.coalesce(named(text_col).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(body).alias("content"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("body"))


def run_rows(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(key, run, content, n_bytes, at, n) of every run of every row."""

    def run(batches):
        for batch in batches:
            content, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for _, runs, text, at in _found(batch.column(2).cast(pa.binary()).to_pylist(), length):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (runs.key, runs.run, content[text], size[text], at, runs.size)], names=["key", "run", "content", "n_bytes", "at", "n"])

    return _bodies(docs, text_col).mapInArrow(tidy(run), "key long, run long, content long, n_bytes long, at long, n long")


def run_bytes(docs: DataFrame, text_col: str, length: int, keys: DataFrame) -> DataFrame:
    """(key, run, ahead, bytes) of the different runs of the given keys."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(keys, "key"))

    def run(batches):
        for batch in batches:
            for buf, runs, _, _ in _found(batch.column(2).cast(pa.binary()).to_pylist(), length):
                keep = np.flatnonzero(passes(bits.value, runs.key))
                # Equal runs of this piece go out once.
                keep = keep[np.unique(np.stack([runs.key[keep], runs.run[keep]]), axis=1, return_index=True)[1]] if len(keep) else keep
                if len(keep):
                    parts = [buf[f : f + n - 1 + length] for f, n in zip(runs.first[keep].tolist(), runs.size[keep].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(runs.key[keep]), pa.array(runs.run[keep]), pa.array(runs.ahead[keep]), pa.array(parts, pa.binary())], names=["key", "run", "ahead", "bytes"])

    found = _bodies(docs, text_col).mapInArrow(tidy(run), "key long, run long, ahead long, bytes binary")
    return found.join(keys.select("key"), "key", "left_semi").dropDuplicates(["key", "run"])


def suffix_order(symbols: np.ndarray, end: np.ndarray, owner: np.ndarray, parts: int) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling. symbols: bytes + 1, and 0 behind
    each part; a suffix ends there, and suffixes that are equal so far go by part."""
    n = len(symbols)
    place = np.arange(n)
    pack = np.zeros(n, U64)
    for k in range(7):
        at = place + k
        pack = pack << U64(9) | np.where(at < end, symbols[np.minimum(at, n - 1)], 0).astype(U64)
    reach = 7
    while True:
        order = np.argsort(pack, kind="stable")
        step = np.empty(n, np.int64)
        step[0] = 0
        np.cumsum(pack[order[1:]] != pack[order[:-1]], out=step[1:])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            return order
        next_at = place + reach
        second = np.where(next_at > end, owner, parts + rank[np.minimum(next_at, n - 1)])
        pack = rank.astype(U64) << U64(32) | second.astype(U64)
        reach *= 2


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of some different texts: where strings of ``length`` bytes start in it that
    start anywhere else in them, too."""
    sizes = np.array([len(t) + 1 for t in texts])
    total, parts = int(sizes.sum()), len(texts)
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int64) + 1
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    ends = begins + sizes - 1
    symbols[ends] = 0
    owner = np.repeat(np.arange(parts), sizes)
    order = suffix_order(symbols, ends[owner], owner, parts)
    first = symbols[order]  # a suffix's first symbol: its row's class
    before = symbols[order - 1]  # the transform; a text's first byte follows the end of the last text
    # Last-to-first: the rows of a symbol keep their order. Ends of texts are told apart by row.
    stable = np.argsort(before, kind="stable")
    forward = np.empty(total, np.int64)
    forward[stable] = np.arange(total)
    starts_text = before == 0
    common = np.full(total + 1, -1, np.int32)  # of a row with the row before
    common[0] = common[total] = 0
    common[: parts + 1] = 0
    bounds = np.flatnonzero(np.diff(first)) + 1
    common[bounds] = 0
    low = np.concatenate((np.arange(parts), bounds))
    high = np.concatenate((np.arange(1, parts + 1), bounds[1:], [total]))
    mark = np.zeros(total, np.int64)
    for value in range(1, length):
        if not len(low):
            break
        n = high - low
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        which = np.repeat(np.arange(len(low)), n)
        inner = ~starts_text[rows]
        to, which = forward[rows[inner]], which[inner]
        if not len(to):
            break
        mark[to] = which
        to = np.sort(to)
        cut = np.flatnonzero((np.diff(to) != 1) | np.diff(mark[to]).astype(bool) | np.diff(first[to]).astype(bool)) + 1
        low, high = to[np.concatenate(([0], cut))], to[np.append(cut, len(to)) - 1] + 1
        new = common[high] < 0
        low, high = low[new], high[new]
        common[high] = value
    long = common < 0  # with the row before: length or more
    hit = long[:-1] | long[1:]
    starts = np.zeros(total, bool)
    starts[order[hit]] = True
    return [np.flatnonzero(starts[b : e - length + 1]) if e - b >= length else np.empty(0, np.int64) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of unbroken stretches."""
    new = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    return places[new], np.diff(np.append(new, len(places)))


def windows(parts: DataFrame, length: int, width: int) -> DataFrame:
    """(from_key, from_run, offset, key, run, ahead, bytes): the windows of ``width`` starts
    of each run, counted from its anchor, so that equal strings are in windows of one key."""

    def digest(*x: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"".join(x), digest_size=8).digest(), "little", signed=True)

    def run(batches):
        for batch in batches:
            for key, own, ahead, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "run", "ahead", "bytes")), strict=True):
                out, high = [], ahead
                last = ahead - (len(raw) - length)  # bytes before the anchor in the last string
                while high >= last:
                    base = high // width * width
                    low = max(base, last)
                    part = raw[ahead - high : ahead - low + length]
                    shared = raw[ahead - base : ahead - base - width + 1 + length]
                    place = b"%d %d " % (key, base)
                    out.append((key, own, ahead - high, digest(place, shared), digest(place, b"%d " % high, part), high, part))
                    high = base - 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*out, strict=True))[:6]] + [pa.array([x[6] for x in out], pa.binary())], names=_WINDOW)

    return parts.select("key", "run", "ahead", "bytes").mapInArrow(tidy(run), "from_key long, from_run long, offset long, key long, run long, ahead long, bytes binary")


_WINDOW = ["from_key", "from_run", "offset", "key", "run", "ahead", "bytes"]


def repeated_in_groups(parts: DataFrame, length: int, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(key, run, skip, n): stretches of starts of strings that occur again in the group, of
    the different runs (key, run, ahead, bytes)."""
    spark = parts.sparkSession
    load = parts.groupBy("key").agg(F.count("*").alias("different"), F.sum(F.octet_length("bytes")).alias("bytes")).withColumn("hot", F.col("different") > HOT)
    load = written(load, "load")
    total = load.where("not hot").agg(F.sum("bytes")).first()[0] or 0
    buckets = max(tasks(spark), int(total) // BUCKET_BYTES + 1)

    def by_transform(rows: pa.Table) -> pa.Table:
        key, run = rows.column("key").to_numpy(), rows.column("run").to_numpy()
        out = []
        for k, places in enumerate(repeated_starts(rows.column("bytes").to_pylist(), length)):
            if len(places):
                out += [(key[k], run[k], a, n) for a, n in zip(*_stretches(places), strict=True)]
        columns = zip(*out, strict=True) if out else [()] * 4
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("key", "run", "skip", "n"), columns, strict=True)})

    marked = parts.join(load.select("key", "hot"), "key")
    found = marked.where("not hot").groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")).applyInArrow(by_transform, "key long, run long, skip long, n long")
    found = written(found, "strings")
    if load.where("hot").isEmpty():
        return found
    cut = written(windows(marked.where("hot"), length, widths[0]), "windows")
    each = written(cut.groupBy("key", "run").agg(F.count("*").alias("times"), F.first("ahead").alias("ahead"), F.first("bytes").alias("bytes")), "each")
    # A window that is itself there again is repeated throughout.
    whole = each.where("times > 1").select("key", "run", F.lit(0).cast("long").alias("skip"), (F.octet_length("bytes") - length + 1).cast("long").alias("n"))
    several = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    if len(widths) > 1:
        whole = whole.unionByName(repeated_in_groups(written(each.join(several.select("key"), "key", "left_semi"), "several"), length, widths[1:]))
    back = cut.select("from_key", "from_run", "offset", "key", "run").join(whole, ["key", "run"])
    back = back.select(F.col("from_key").alias("key"), F.col("from_run").alias("run"), (F.col("skip") + F.col("offset")).alias("skip"), "n")
    return written(found.unionByName(back), "strings")


def repeated_strings(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(content, n_bytes, at, n): stretches of starts of repeated strings, by text."""
    spark = docs.sparkSession
    light = written(run_rows(docs, text_col, length), "runs")
    groups = written(light.groupBy("key").agg(F.count("*").alias("times"), F.min("run").alias("low"), F.max("run").alias("high")).where("times > 1").select("key", F.expr("low <> high").alias("differ")), "groups")
    bits = spark.sparkContext.broadcast(bit_filter(groups, "key"))

    def some(batches):
        for batch in batches:
            yield batch.filter(pa.array(passes(bits.value, batch.column(0).to_numpy())))

    again = written(light.mapInArrow(tidy(some), light.schema).join(groups, "key"), "again")
    discard(light)
    by_run = written(again.where("differ").groupBy("key", "run").agg(F.count("*").alias("times"), F.max("n").alias("n")), "by_run")
    parts = written(run_bytes(docs, text_col, length, groups.where("differ")), "run_bytes")
    # A run that is itself there again is repeated throughout.
    whole = by_run.where("times > 1").select("key", "run", F.lit(0).cast("long").alias("skip"), "n")
    found = repeated_in_groups(parts, length).unionByName(whole)
    differing = again.where("differ").select("key", "run", "content", "n_bytes", "at").join(found, ["key", "run"]).withColumn("at", F.col("at") + F.col("skip"))
    columns = ["content", "n_bytes", "at", "n"]
    out = written(again.where("not differ").select(*columns).unionByName(differing.select(*columns)).distinct(), "places")
    discard(groups, again, by_run, parts)
    return out


RESULTS = ("n_bytes", "n_removed", "n_spans", "kept")


def without_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text", names: tuple[str, ...] = RESULTS) -> DataFrame:
    """``docs``, all columns, with bytes, bytes removed, spans removed and what is kept
    (binary) under ``names``; columns of ``docs`` of these names are replaced by them.

    Removed is every byte that a string of ``length`` bytes covers that starts anywhere else
    in the rows' texts, too, the same text included. Strings are judged as they stand in the
    input and never cross texts. A null text counts as empty. Rows need no id; repeated rows
    repeat each other. What is kept may cut a character, so it is binary.
    """
    places = repeated_strings(docs, text_col, length).groupBy("content", "n_bytes").agg(F.collect_list(F.struct("at", "n")).alias("places"))
    columns = others(docs.columns, *names)
    own = {c: free([*columns, *names], f"__{c}") for c in ("content", "body", "places")}
    places = written(places.withColumnsRenamed({"content": own["content"], "n_bytes": names[0], "places": own["places"]}), "marks")
    body = F.coalesce(named(text_col).cast("string"), F.lit(""))
    rows = docs.select(*all_named(columns), F.xxhash64(body).alias(own["content"]), F.octet_length(body).cast("long").alias(names[0]), F.encode(body, "utf-8").alias(own["body"]))
    rows = rows.join(places, [own["content"], names[0]], "left").select(*all_named(columns), names[0], own["body"], own["places"])
    n = len(columns)

    def run(batches):
        for batch in batches:
            removed, spans, kept = [], [], []
            for raw, marks in zip(batch.column(n + 1).to_pylist(), batch.column(n + 2).to_pylist(), strict=True):
                parts, end, gone, count = [], 0, 0, 0
                for low, high in sorted((m["at"], m["at"] + m["n"] - 1 + length) for m in marks or []):
                    if low > end or not count:
                        parts.append(raw[end:low])
                        count += 1
                    if high > end:
                        gone += high - max(low, end)
                        end = high
                parts.append(raw[end:])
                removed.append(gone)
                spans.append(count)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([*batch.columns[: n + 1], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=[*batch.schema.names[: n + 1], *names[1:]])

    zero = F.lit(0).cast("long")
    schema = docs.select(*all_named(columns), *(zero.alias(c) for c in names[:3]), F.encode(F.lit(""), "utf-8").alias(names[3])).schema
    return mapped(rows, tidy(run), schema)
