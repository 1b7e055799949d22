"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order.

Different fingerprints are laid out in several arrangements: the 64 bits are cut into blocks,
and each choice of all blocks but ``MAX_BITS`` is moved to the front, as of two fingerprints
that differ in ``MAX_BITS`` bits some such choice is equal. An arrangement is sorted by Gray
rank in one range-partitioned sort: fingerprints with equal leading blocks lie side by side,
and neighbours share as many further bits as may be.

Rows of one front are cut into runs. Over a run lies a tree: a node's pattern is the bits that
all below it share, its mask says which they are. Two nodes are held against each other by the
bits both masks have; the differences are added up from level to level, and a pair of nodes
goes, with all that is below, once they are more than ``MAX_BITS``. The runs of a front that
has several are nodes of the same kind: their pairs are sorted out by their patterns, and what
is left is compared run by run. So no front has to fit into one task, however many rows it has.

A run and a pair of runs give no more links than it takes to connect what they connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .near_dup import components
from .store import discard, tasks, written
from .words import U64
from .workers import tidy

MAX_BITS = 3
RUN = 1024  # rows of a run
FAN = 16  # children of a node
SHINGLE = 3
PIECE = 1 << 20  # bytes of a text whose words are held at once
HASHED = 1 << 15  # hashes whose bits are spread at once
SIGN = U64(1 << 63)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end].split()
        at = end


def _hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, repeats included."""
    digest, carry, whole = xxhash.xxh64_intdigest, [], True
    for words in _words(text.lower()):
        words = carry + words
        if len(words) >= SHINGLE:
            whole = False
            yield np.array([digest(b"%b %b %b" % x, 42) for x in zip(words, words[1:], words[2:])], U64)
        carry = words[-(SHINGLE - 1) :]
    if whole and carry:
        yield np.array([digest(b" ".join(carry), 42)], U64)


def _bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each stretch of hashes the number of those that have each of the 64 bits, the highest bit first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints_of(texts: list[bytes | None]) -> np.ndarray:
    """A bit is set if more than half of the shingles' hashes have it; zero without words."""
    counts, n = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    waiting, owners, size = [], [], 0

    def flush() -> None:
        nonlocal waiting, owners, size
        if waiting:
            starts = np.cumsum([0] + [len(x) for x in waiting[:-1]])
            np.add.at(counts, owners, _bit_counts(np.concatenate(waiting), starts))
        waiting, owners, size = [], [], 0

    for k, text in enumerate(texts):
        for part in _hashes(text or b""):
            for at in range(0, len(part), HASHED):
                waiting.append(part[at : at + HASHED])
                owners.append(k)
                size += len(waiting[-1])
                n[k] += len(waiting[-1])
                if size >= HASHED:
                    flush()
    flush()
    return np.packbits(2 * counts > n[:, None], axis=1).view(">u8").astype(U64).reshape(-1)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, fp) of each row; fp as a signed integer."""

    def run(batches):
        for batch in batches:
            fp = fingerprints_of(batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))
    return source.mapInArrow(tidy(run), "id long, fp long")


def arrangements(n: int) -> list[list[tuple[int, int]]]:
    """Ways to lay out the bits, as (shift, width) of the blocks from the front, for so many
    fingerprints. Every way is exact; more blocks mean more copies with longer fronts."""
    blocks = 4 if n <= 1 << 22 else 5 if n <= 1 << 30 else 6
    edges = [64 * k // blocks for k in range(blocks + 1)]
    places = [(64 - edges[k + 1], edges[k + 1] - edges[k]) for k in range(blocks)]
    return [[*front, *(p for p in places if p not in front)] for front in combinations(places, blocks - MAX_BITS)]


def arranged(fp: np.ndarray, layout: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros_like(fp)
    for shift, width in layout:
        out = out << U64(width) | fp >> U64(shift) & U64((1 << width) - 1)
    return out


def restored(x: np.ndarray, layout: list[tuple[int, int]]) -> np.ndarray:
    out, at = np.zeros_like(x), 64
    for shift, width in layout:
        at -= width
        out |= (x >> U64(at) & U64((1 << width) - 1)) << U64(shift)
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the order in which followers differ by one bit."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ x >> U64(k)
    return x


def of_rank(rank: np.ndarray) -> np.ndarray:
    return rank ^ rank >> U64(1)


def levels(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(patterns, masks) from the codes themselves up to a single node."""
    out = [(x, np.full(len(x), ~U64(0)))]
    while len(out[-1][0]) > 1:
        pattern, mask = out[-1]
        starts = np.arange(0, len(pattern), FAN)
        every, some = np.bitwise_and.reduceat(pattern, starts), np.bitwise_or.reduceat(pattern, starts)
        mask = np.bitwise_and.reduceat(mask, starts) & (every | ~some)
        out.append((every & mask, mask))
    return out


def close_pairs(x: np.ndarray, y: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of codes of x and y that differ in MAX_BITS bits at most; without y, of
    x and x with i < j. Both have to be in Gray order for many to be pruned together."""
    ours, theirs = levels(x), levels(x if y is None else y)
    while len(ours) < len(theirs):
        ours.append(ours[-1])
    while len(theirs) < len(ours):
        theirs.append(theirs[-1])
    a = b = np.zeros(1, np.int64)
    apart, seen = np.zeros(1, np.int64), np.zeros(1, U64)
    for up in range(len(ours) - 1, -1, -1):
        (p, pm), (q, qm) = ours[up], theirs[up]
        common = pm[a] & qm[b]
        # The differences so far, and those in the bits that this level adds.
        apart = apart + np.bitwise_count((p[a] ^ q[b]) & common & ~seen)
        keep = apart <= MAX_BITS if y is not None else (apart <= MAX_BITS) & (a <= b if up else a < b)
        a, b, apart, seen = a[keep], b[keep], apart[keep], common[keep]
        if up:
            a, kept = _children(a, len(ours[up - 1][0]), len(p))
            b, apart, seen = b[kept], apart[kept], seen[kept]
            b, kept = _children(b, len(theirs[up - 1][0]), len(q))
            a, apart, seen = a[kept], apart[kept], seen[kept]
    return a, b


def _children(nodes: np.ndarray, below: int, here: int) -> tuple[np.ndarray, np.ndarray]:
    """Each node's children, and which node each belongs to."""
    if below == here:  # a level that was repeated
        return nodes, np.arange(len(nodes))
    child = nodes[:, None] * FAN + np.arange(FAN)
    owner = np.repeat(np.arange(len(nodes)), FAN).reshape(child.shape)
    return child[child < below], owner[child < below]


def spanning(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links (a, b) between places do, one for each place at most."""
    top = np.arange(len(node))
    while True:
        low = np.minimum(top[a], top[b])
        before = top.copy()
        np.minimum.at(top, top[a], low)
        np.minimum.at(top, top[b], low)
        top = top[top]
        if (top == before).all():
            break
    tied = np.flatnonzero(top != np.arange(len(node)))
    return node[top[tied]], node[tied]


_SCHEMA = "a long, b long, layout int, front long, run long, ranks array<long>"
_NAMES = ["a", "b", "layout", "front", "run", "ranks"]


def _linked_rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *(pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=_NAMES)


def _search(layouts):
    """For rows (layout, rank) in order: links within runs, and the runs of fronts that may go
    on elsewhere."""
    widths = [sum(w for _, w in x[:-MAX_BITS]) for x in layouts]

    def links(codes: np.ndarray, layout: int) -> Iterator[pa.RecordBatch]:
        a, b = close_pairs(codes)
        if len(a):
            yield _linked_rows(*spanning(restored(codes, layouts[layout]), a, b))

    def run(batches):
        layout, rank = np.empty(0, np.int32), np.empty(0, U64)
        part, number, opened = TaskContext.get().partitionId() << 32, 0, True  # whether the first front may have begun elsewhere

        def one_front(layout: int, ranks: np.ndarray, whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            pieces = [ranks[k : k + RUN] for k in range(0, len(ranks), RUN)]
            for piece in pieces:
                if len(piece) > 1:
                    yield from links(of_rank(piece), layout)
                if not whole or len(pieces) > 1:
                    front = int(ranks[0] >> U64(64 - widths[layout]))
                    yield pa.RecordBatch.from_pylist([{"layout": layout, "front": front, "run": part + number, "ranks": piece.view(np.int64).tolist()}], schema=_ARROW)
                    number += 1

        def fronts(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal layout, rank, opened
            front = rank >> np.array([64 - w for w in widths], U64)[layout]
            new = np.flatnonzero((front[1:] != front[:-1]) | (layout[1:] != layout[:-1])) + 1
            starts, ends = np.concatenate(([0], new)), np.concatenate((new, [len(rank)]))
            for k in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(rank))).tolist():
                s, e = starts[k], ends[k]
                if e == len(rank) and not last:
                    whole_runs = (e - s) // RUN * RUN  # full runs go now, so that no more than one is carried
                    if whole_runs:
                        yield from one_front(int(layout[s]), rank[s : s + whole_runs], False)
                        s += whole_runs
                        opened = True
                    layout, rank = layout[s:], rank[s:]
                    return
                whole = not (s == 0 and opened) and e != len(rank)
                yield from one_front(int(layout[s]), rank[s:e], whole)
                opened = opened and s != 0
            layout, rank = layout[:0], rank[:0]

        for batch in batches:
            if batch.num_rows:
                layout = np.concatenate([layout, batch.column(0).to_numpy()])
                rank = np.concatenate([rank, batch.column(1).to_numpy().view(U64) ^ SIGN])
                yield from fronts(False)
        if len(rank):
            yield from fronts(True)

    return run


_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("layout", pa.int32()), ("front", pa.int64()), ("run", pa.int64()), ("ranks", pa.list_(pa.int64()))])


def _laid_out(nodes: DataFrame, layouts) -> DataFrame:
    """(layout, rank) of each fingerprint in each arrangement; rank ordered as a signed integer."""

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(U64)
            for k, layout in enumerate(layouts):
                rank = gray_rank(arranged(fp, layout)) ^ SIGN
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(rank.view(np.int64))], names=["layout", "rank"])

    return nodes.select("fp").mapInArrow(tidy(run), "layout int, rank long")


def _runs_to_compare(runs: DataFrame) -> DataFrame:
    """(layout, x, y): pairs of runs of one front whose patterns don't differ in too many bits.
    Nodes over FAN**2 runs are paired first, then the runs below the pairs that are left."""
    code = lambda r: r.bitwiseXOR(F.shiftrightunsigned(r, 1))
    every = lambda op, none: F.aggregate("codes", F.lit(none).cast("long"), op)
    rows = runs.withColumn("codes", F.transform("ranks", code))
    both, any_ = every(lambda s, x: s.bitwiseAND(x), -1), every(lambda s, x: s.bitwiseOR(x), 0)
    rows = rows.select("layout", "front", "run", both.alias("ones"), F.bitwise_not(any_).alias("zeros"))
    above = rows.withColumn("node", F.floor(F.col("run") / FAN**2)).groupBy("layout", "front", "node").agg(F.bit_and("ones").alias("ones"), F.bit_and("zeros").alias("zeros"))

    def pairs(nodes: DataFrame, x: str) -> DataFrame:
        left = nodes.select("layout", "front", *(F.col(c).alias(f"a_{c}") for c in (x, "ones", "zeros")))
        right = nodes.select("layout", "front", *(F.col(c).alias(f"b_{c}") for c in (x, "ones", "zeros")))
        return left.join(right, ["layout", "front"]).where(F.col(f"a_{x}") <= F.col(f"b_{x}")).where(apart <= MAX_BITS)

    apart = F.bit_count(F.col("a_ones").bitwiseAND(F.col("b_zeros"))) + F.bit_count(F.col("a_zeros").bitwiseAND(F.col("b_ones")))
    upper = pairs(above, "node").select("layout", "front", "a_node", "b_node")
    low = rows.withColumn("node", F.floor(F.col("run") / FAN**2))
    side = lambda s: low.select("layout", "front", *(F.col(c).alias(f"{s}_{c}") for c in ("node", "run", "ones", "zeros")))
    found = upper.join(side("a"), ["layout", "front", "a_node"]).join(side("b"), ["layout", "front", "b_node"])
    return found.where("a_run < b_run").where(apart <= MAX_BITS).select("layout", F.col("a_run").alias("x"), F.col("b_run").alias("y"))


def links(nodes: DataFrame, n: int) -> DataFrame:
    """Links (a, b) that connect all of n different fingerprints (fp) that are close."""
    layouts = arrangements(n)
    dealt = _laid_out(nodes, layouts).repartitionByRange(tasks(nodes.sparkSession), "layout", "rank").sortWithinPartitions("layout", "rank")
    found = written(dealt.mapInArrow(tidy(_search(layouts)), _SCHEMA), "gray_runs")
    runs = found.where("ranks is not null")
    pairs = written(_runs_to_compare(runs), "run_pairs")

    def compare(batches):
        for batch in batches:
            for layout, x, y in zip(*(batch.column(c).to_pylist() for c in ("layout", "xs", "ys")), strict=True):
                x, y = of_rank(np.array(x, np.int64).view(U64)), of_rank(np.array(y, np.int64).view(U64))
                a, b = close_pairs(x, y)
                if len(a):
                    both = restored(np.concatenate([x, y]), layouts[layout])
                    p, q = spanning(both, a, b + len(x))
                    yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), pa.array(q.view(np.int64))], names=["a", "b"])

    side = lambda c, rs: runs.select(F.col("run").alias(c), F.col("ranks").alias(rs))
    tiles = pairs.join(side("x", "xs"), "x").join(side("y", "ys"), "y").select("layout", "xs", "ys")
    across = written(tiles.mapInArrow(tidy(compare), "a long, b long"), "across")
    return found.where("a is not null").select("a", "b").unionByName(across)


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fp (the fingerprint as 16 hexadecimal digits), component_id
    (the least id that links reach) and kept (whether the row has that id).

    Texts that are null or have no word have the fingerprint zero, which is linked like any
    other. Rows without an id have a fingerprint, link others through it, and have no
    component if no row that they reach has an id; they count as kept. Repeated rows of one id
    are all returned. Other columns of ``docs`` are not read, whatever their names.
    """
    found = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = written(found.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    roots = components(links(nodes, nodes.count()))
    member = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("id").alias("component_id"))
    of_node = written(member.join(least, "root").select("fp", "component_id"), "components")
    discard(nodes, roots)
    # A fingerprint may have a third of all rows: the larger side of this join can be split.
    out = found.join(of_node, "fp")
    return out.select("id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fp"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
