"""Sharding by a histogram sort.

Rows are sorted by a 63-bit key: 39 bits of the text's hash, then 24 bits of the id's hash,
so equal texts are neighbours and one very common text can still be cut. Splitters are found
by counting, over all partitions, the exact bytes below candidate keys and narrowing each
splitter's interval until its count meets the tolerance. Then rows are exchanged once.

Equal texts are a group: a shard's border is moved to the nearest edge of the group that it
would cut, unless that makes the shards differ by more than ``GROUP_SLACK`` of a shard.

There are more splitters than shards: each shard is made of several cells, one for each sort
task, whose row counts give the place of a row in its shard without a sort of a whole shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, tasks, written
from .words import U64
from .workers import tidy

ID_BITS = 24
TOP = 1 << 63
PROBES = 7  # candidate keys for each open splitter and round
GROUP_SLACK = 0.01


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, body, size, __key."""
    text, row_id = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    body = F.coalesce(text, F.lit(""))
    key = F.shiftleft(F.xxhash64(text).bitwiseAND((1 << 39) - 1), ID_BITS).bitwiseOR(F.xxhash64(row_id).bitwiseAND((1 << ID_BITS) - 1))
    return docs.select(row_id.alias("id"), body.alias("body"), (F.octet_length(body) + 1).cast("long").alias("size"), key.alias("__key"))


def below(rows: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, rows) with a key below each probe, exact over all rows of (__key, size)."""
    marks = np.array(probes, np.uint64)

    def run(batches):
        total, count = np.zeros(len(marks) + 1, np.int64), np.zeros(len(marks) + 1, np.int64)
        for batch in batches:
            cell = np.searchsorted(marks, batch.column(0).to_numpy().astype(np.uint64), "right")
            np.add.at(total, cell, batch.column(1).to_numpy())
            count += np.bincount(cell, minlength=len(marks) + 1)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at]), pa.array(count[at])], names=["cell", "bytes", "n"])

    cells = rows.select("__key", "size").mapInArrow(tidy(run), "cell int, bytes long, n long").groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    out = np.zeros((2, len(marks) + 1), np.int64)
    for r in cells:  # as many as probes
        out[:, r["cell"]] = r["bytes"], r["n"]
    total = out.cumsum(axis=1)
    return total[0], total[1]


def splitters(rows: DataFrame, shards: int, cells: int, tolerance: float = 0.001) -> tuple[list[int], np.ndarray]:
    """Keys that cut the rows into ``shards * cells`` runs of near equal bytes, and the rows
    below each. Shard borders meet ``tolerance`` of a shard's bytes, the borders of cells
    within it a quarter of a cell's, unless a single key holds more than that; shard borders
    are then moved to an edge of their group, see above."""
    total = int(below(rows, [])[0][0])
    n = shards * cells
    target = np.array([total * k // n for k in range(1, n)], np.int64)
    border = np.arange(1, n) % cells == 0
    slack = np.where(border, total / shards * tolerance, total / n / 4)
    low, high = np.zeros(n - 1, U64), np.full(n - 1, TOP, U64)
    low_weight, high_weight = np.zeros(n - 1, np.int64), np.full(n - 1, total, np.int64)
    chosen, done = np.zeros(n - 1, U64), np.zeros(n - 1, bool)
    while not done.all():
        k = np.flatnonzero(~done)
        a, b = low[k], high[k]
        guess = a + ((b - a) * ((target[k] - low_weight[k]) / np.maximum(1, high_weight[k] - low_weight[k]))).astype(U64)
        near = np.maximum(U64(1), (b - a) >> U64(6))
        even = [a + (b - a) // U64(PROBES + 1) * U64(i) for i in range(1, PROBES + 1)]
        some = np.concatenate([*even, guess - np.minimum(near, guess), guess, guess + near])
        marks = np.unique(some[(some > np.tile(a, PROBES + 3)) & (some < np.tile(b, PROBES + 3))])
        if len(marks):
            got = below(rows, marks.tolist())[0][:-1]
            # The last mark with no more than the target below it, and the first with as much or more.
            at, to = np.searchsorted(got, target[k], "right") - 1, np.searchsorted(got, target[k], "left")
            up, down = (at >= 0) & (marks[np.maximum(at, 0)] > low[k]), (to < len(marks)) & (marks[np.minimum(to, len(marks) - 1)] < high[k])
            low[k[up]], low_weight[k[up]] = marks[at[up]], got[at[up]]
            high[k[down]], high_weight[k[down]] = marks[to[down]], got[to[down]]
        lower = target[k] - low_weight[k] <= high_weight[k] - target[k]
        off = np.where(lower, target[k] - low_weight[k], high_weight[k] - target[k])
        chosen[k] = np.where(lower, low[k], high[k])
        done[k] = (off <= slack[k]) | (high[k] - low[k] <= U64(1))
    _to_group_edges(rows, chosen, target, border, total / shards * GROUP_SLACK)
    keys = np.sort(chosen).tolist()
    return keys, below(rows, keys)[1]


def _to_group_edges(rows: DataFrame, chosen: np.ndarray, target: np.ndarray, border: np.ndarray, slack: float) -> None:
    """Moves shard borders that are inside a group to its nearer edge, within the slack."""
    inside = np.flatnonzero(border & (chosen & U64((1 << ID_BITS) - 1) > 0))
    if not len(inside):
        return
    group = chosen[inside] >> U64(ID_BITS)
    edges = np.stack([group << U64(ID_BITS), (group + U64(1)) << U64(ID_BITS)])
    marks = np.unique(edges)
    weight = below(rows, marks.tolist())[0][:-1][np.searchsorted(marks, edges)]
    off = np.abs(weight - target[inside])
    best = off.argmin(axis=0)
    fits = off.min(axis=0) <= slack
    chosen[inside[fits]] = edges[best, np.arange(len(inside))][fits]


def cell_of(key: Column, keys: list[int]) -> Column:
    """The number of splitters at or below the key. It is looked for among every so many
    splitters first and then among those between two, some root of their number each time."""
    wide = max(1, int(len(keys) ** 0.5))
    groups = [keys[k : k + wide] for k in range(0, len(keys), wide)]
    if not groups:
        return F.lit(0)
    count = lambda some: F.size(F.filter(some, lambda s: s <= key))
    coarse = count(F.lit([g[0] for g in groups]))
    inner = F.element_at(F.array(*(F.lit(g) for g in groups)), F.greatest(coarse, F.lit(1)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * wide + count(inner))


def sharded(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.001) -> DataFrame:
    """One row per input row: id, body, size, shard, slot.

    size is the text's UTF-8 bytes plus 1; shards are near equal in it. Equal texts are in one
    shard, unless their group is so large that it would put the shards more than
    ``GROUP_SLACK`` of a shard out of balance. slot is the row's place in its shard by (key,
    id, text), without gaps from 0. A null text has size 1 and an empty body; rows that are
    equal in all of these are interchangeable. Other columns are not carried along. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    cells = max(1, -(-tasks(spark) // shards))
    narrow = written(rows.select("__key", "size"), "keys")
    keys, rows_below = splitters(narrow, shards, cells, tolerance)
    discard(narrow)
    first = [0, *map(int, rows_below[:-1])]
    offset = [first[k] - first[k // cells * cells] for k in range(shards * cells)]
    # One exchange, a task for each cell.
    dealt = rows.withColumn("__cell", cell_of(F.col("__key"), keys)).repartitionById(shards * cells, "__cell")
    place = F.row_number().over(Window.partitionBy("__cell").orderBy("__key", "id", "size", "body"))
    return dealt.select("id", "body", "size", F.floor(F.col("__cell") / cells).cast("int").alias("shard"), (F.element_at(F.lit(offset), F.col("__cell") + 1) + place - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Writes the shards as folders shard=0, shard=1, ... of Parquet files with slot, id, body."""
    sharded(docs, **options).write.partitionBy("shard").parquet(path)
