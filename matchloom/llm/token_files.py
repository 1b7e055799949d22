"""Token-ID output: documents in the order of their ids, as range-coded blocks.

The format is a table of blocks (Parquet, so that a task's part appears whole or not at all,
wherever it runs): part and block number, for each document segment in it the id, the number
of token ids and the place of the document's first one, and the code of ``range_coder``. A
block ends with a document where it can; a document longer than a block has several. Texts are
encoded by ``bulk_bpe``, as many at a time as fill a block or more.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import range_coder
from .bulk_bpe import merger
from .store import tasks, written
from .workers import tidy

BLOCK = 1 << 21  # ids
BLOCKS = "part int, block long, ids array<long>, sizes array<long>, starts array<long>, whole array<boolean>, code binary"


def _segments(sizes: list[int]):
    """Blocks of (row, from, to): whole rows while they fit, long rows in pieces."""
    block, used = [], 0
    for k, n in enumerate(sizes):
        if block and used + n > BLOCK:
            yield block
            block, used = [], 0
        for at in range(0, n, BLOCK):
            block.append((k, at, min(n, at + BLOCK)))
            used += min(n, at + BLOCK) - at
            if n > BLOCK:
                yield block
                block, used = [], 0
    if block:
        yield block


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text, appends ``end_id``, and writes the ids in ascending order of
    the documents' ids (rows without an id first, rows of one id by text). A null text counts
    as empty: it has the end id only."""

    def run(batches):
        m, part, number, start = merger(tokenizer), TaskContext.get().partitionId(), 0, 0
        ids, sizes, flat = [], [], np.empty(0, "<u4")  # of the texts whose block isn't full

        def blocks_of(whole: bool) -> pa.RecordBatch:
            """The full blocks, all if ``whole``."""
            nonlocal ids, sizes, flat, number, start
            blocks, rest = list(_segments(sizes)), len(sizes)
            if not whole and blocks and blocks[-1][0][1] == 0 and blocks[-1][-1][2] == sizes[blocks[-1][-1][0]]:
                rest = blocks.pop()[0][0]
            at = np.cumsum([0, *sizes])  # of each text, in flat
            out = {
                "part": pa.array([part] * len(blocks), pa.int32()),
                "block": pa.array(range(number, number + len(blocks)), pa.int64()),
                "ids": pa.array([[ids[k] for k, _, _ in x] for x in blocks], pa.list_(pa.int64())),
                "sizes": pa.array([[b - a for _, a, b in x] for x in blocks], pa.list_(pa.int64())),
                "starts": pa.array([[start + int(at[k]) for k, _, _ in x] for x in blocks], pa.list_(pa.int64())),
                "whole": pa.array([[b - a == sizes[k] for k, a, b in x] for x in blocks], pa.list_(pa.bool_())),
                "code": pa.array(range_coder.encode([flat[at[x[0][0]] + x[0][1] : at[x[-1][0]] + x[-1][2]] for x in blocks]), pa.binary()),
            }
            number, start = number + len(blocks), start + int(at[rest])
            ids, sizes, flat = ids[rest:], sizes[rest:], flat[at[rest] :]
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            row = 0
            for some, n in m.encode(batch.column(1), end_id):
                ids += batch.column(0)[row : row + len(n)].to_pylist()
                sizes += n.tolist()
                flat, row = np.concatenate([flat, some]), row + len(n)
                if len(flat) > BLOCK:
                    yield blocks_of(False)
        yield blocks_of(True)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))
    rows = rows.repartitionByRange(tasks(docs.sparkSession), "id").sortWithinPartitions("id", "body")
    rows.mapInArrow(tidy(run), BLOCKS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the written blocks. start
    counts the ids of all documents before it. A damaged block raises."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                part, block, *lists, code = (c[0].as_py() for c in batch.slice(at, 1).columns)
                (flat,), low, out = range_coder.decode([code]), 0, []
                for i, n, start, whole in zip(*lists, strict=True):
                    out.append((part, block, i, start, n, zlib.crc32(flat[low : low + n]), whole))
                    low += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32(), *[pa.int64()] * 5, pa.bool_()], strict=True)], names=["part", "block", "id", "start", "n_tokens", "ids_crc32", "whole"])

    found = written(blocks.mapInArrow(tidy(run), "part int, block long, id long, start long, n_tokens long, ids_crc32 long, whole boolean"), "segments")

    def join(pieces: pa.Table) -> pa.Table:
        """One document's segments, a row for each block that it goes through."""
        pieces, crc, total = pieces.sort_by("block"), 0, 0
        for n, piece in zip(pieces.column("n_tokens").to_pylist(), pieces.column("ids_crc32").to_pylist(), strict=True):
            crc, total = range_coder.joined_crc(crc, piece, 4 * n), total + n
        return pa.table({"part": pieces.column("part")[:1], "id": pieces.column("id")[:1], "start": pieces.column("start")[:1], "n_tokens": pa.array([total], pa.int64()), "ids_crc32": pa.array([crc], pa.int64())})

    joined = found.where("not whole").groupBy("part", "start").applyInArrow(join, "part int, id long, start long, n_tokens long, ids_crc32 long")
    rows = found.where("whole").select("part", "id", "start", "n_tokens", "ids_crc32").unionByName(joined)
    sums = blocks.select("part", F.expr("aggregate(sizes, 0L, (a, x) -> a + x)").alias("n")).groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before, base = 0, [0] * (max((r["part"] for r in sums), default=0) + 1)  # a number for each part
    for r in sums:
        base[r["part"]], before = before, before + r["n"]
    return rows.select("id", (F.element_at(F.lit(base), F.col("part") + 1) + F.col("start")).cast("long").alias("start"), "n_tokens", "ids_crc32")
