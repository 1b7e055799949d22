"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item in a long document has a tiny Jaccard similarity with it, so documents are
cut to the items' sizes: items are partitioned by their length, and for each size class a
document is a row of overlapping windows of two blocks, which hold any run of shingles of
that length. Between an item and a window that holds four fifths of it the similarity is
0.15 or more, whatever the document's length. The least values of ``HASHES`` hash functions
are compared one by one; an item that agrees with a window in any is a candidate, and is
verified by exact containment of its shingles in the whole document's.

Items travel to the documents in blocks of at most ``BLOCK`` shingles, so no document is
shuffled and no broadcast grows with the benchmark; more items mean more passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import free
from .store import written
from .words import U64, mixed, shingle_hashes, word_hashes
from .workers import tidy

HASHES = 64
BLOCK = 1_000_000
WHOLE = 1 << 14  # shingles of a document up to which all hash functions are taken at once

_MULTIPLY = (mixed(np.arange(5001, HASHES + 5001, dtype=U64)) | U64(1)).astype(np.uint32)
_ADD = mixed(np.arange(7001, HASHES + 7001, dtype=U64)).astype(np.uint32)
_SLOTS = np.arange(HASHES, dtype=U64) << U64(32)


def _folded(x: np.ndarray) -> np.ndarray:
    return (x >> U64(32)).astype(np.uint32) ^ x.astype(np.uint32)


def _block_minima(x: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """For each block size, the least value of each hash function in each block."""
    starts = [np.arange(0, len(x), s) for s in sizes]
    if len(x) <= WHOLE:
        values = x[None, :] * _MULTIPLY[:, None] + _ADD[:, None]
        return [np.minimum.reduceat(values, s, axis=1) for s in starts]
    out = [np.empty((HASHES, len(s)), np.uint32) for s in starts]
    for j in range(HASHES):
        values = x * _MULTIPLY[j] + _ADD[j]
        for o, s in zip(out, starts, strict=True):
            o[j] = np.minimum.reduceat(values, s)
    return out


class Index:
    """The items of one block, by size class."""

    def __init__(self, ids: list[int], runs: list[np.ndarray]):
        self.ids, self.sets = ids, [np.unique(r) for r in runs]
        sizes = np.array([max(1, len(r)) for r in runs])
        self.classes = []
        for k in np.unique(np.floor(np.log2(sizes)).astype(int)):
            members = [i for i in np.flatnonzero(np.floor(np.log2(sizes)).astype(int) == k) if len(runs[i])]
            if not members:
                continue
            marks = np.stack([_block_minima(_folded(runs[i]), [len(runs[i])])[0][:, 0] for i in members])
            keys = (marks.astype(U64) | _SLOTS[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            # A run of the class, and a quarter of it for what may have been put in between.
            self.classes.append(((2 << k) + (1 << k >> 1), keys[order], np.repeat(members, HASHES)[order]))
        self.blocks = [c[0] for c in self.classes]

    def found(self, run: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that a document holds."""
        items: set[int] = set()
        for (_, keys, owner), low in zip(self.classes, _block_minima(_folded(run), self.blocks), strict=True):
            if low.shape[1] > 1:
                low = np.minimum(low[:, :-1], low[:, 1:])
            wanted = np.unique(low.astype(U64) | _SLOTS[:, None])
            at, end = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            for a, b in zip(at[hit := end > at], end[hit], strict=True):
                items.update(owner[a:b].tolist())
        if not items:
            return []
        own = np.unique(run)
        shared = {i: int(np.isin(self.sets[i], own, assume_unique=True).sum()) for i in items}
        return sorted((i, s) for i, s in shared.items() if den * s >= num * len(self.sets[i]))


def _runs(texts: list[bytes | None], n: int):
    for k, words in word_hashes([(t or b"").lower() for t in texts]):
        if len(words):
            yield k, shingle_hashes(words, n)


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 5, least_share: tuple[int, int] = (80, 100)) -> DataFrame:
    """Pairs (id, item_id, n_shared, n_item): items of whose distinct shingles of ``n`` words
    the document's text has at least the share.

    A-Z counts as a-z. A text of fewer words has one shingle, its whole sequence, so such an
    item is found only in an equally short text. Null and wordless texts and items have none
    and pair with nothing. Rows without an id pair under a null id; repeated rows give
    repeated pairs; several items of one id are held together as one row each.
    """
    num, den = least_share

    def item_runs(batches):
        for batch in batches:
            rows = [(batch.column(0)[k].as_py(), r.view(np.int64)) for k, r in _runs(batch.column(1).cast(pa.binary()).to_pylist(), n)]
            if rows:
                ids, runs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, pa.list_(pa.int64()))], names=["item_id", "run"])

    source = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("body"))
    known = written(source.mapInArrow(tidy(item_runs), "item_id long, run array<long>"), "items")
    total = known.agg(F.sum(F.size("run"))).first()[0] or 0
    passes = -(-int(total) // BLOCK)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))
    schema = "id long, item_id long, n_shared long, n_item long"
    out = docs.sparkSession.createDataFrame([], schema)
    for turn in range(passes):
        block = known.where(F.pmod(F.xxhash64("run"), F.lit(passes)) == turn).toArrow()
        index = Index(block.column("item_id").to_pylist(), [np.asarray(x.values).view(U64) for x in block.column("run").combine_chunks()])
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            index = shared.value
            for batch in batches:
                rows = [(k, index.ids[i], s, len(index.sets[i])) for k, run in _runs(batch.column(1).cast(pa.binary()).to_pylist(), n) for i, s in index.found(run, num, den)]
                if rows:
                    at, item, s, size = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *(pa.array(x, pa.int64()) for x in (item, s, size))], names=["id", "item_id", "n_shared", "n_item"])

        found = texts.mapInArrow(tidy(search), schema)
        out = found if passes == 1 else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; rows without an id stay."""
    name = free(docs, "__hit")
    hit = contained(docs, items, id_col=id_col, **options).select(F.col("id").alias(name)).distinct()
    return docs.join(hit, F.col(id_col).cast("long") == F.col(name), "left_anti")
