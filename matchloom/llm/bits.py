"""A filter over 64-bit keys that may go to every task.

It has some 16 bits for each key, 2**MOST_BITS (8 MB) at most. Beyond four million keys it
lets more rows through; it only goes before an exact join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import U64, mixed
from .workers import tidy

LEAST_BITS, MOST_BITS = 16, 26


def bit_filter(keys: DataFrame, column: str) -> np.ndarray:
    """Packed bits, a power of two of them, set where a key of the column has its place."""
    keys = keys.select(F.col(column).cast("long")).where(F.col(column).isNotNull())
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * keys.count()).bit_length()))

    def run(batches):
        found = np.zeros(1 << bits - 3, np.uint8)
        for batch in batches:
            at = _places(batch.column(0).to_numpy(), bits)
            np.bitwise_or.at(found, at >> 3, _BIT[at & 7])
        words = found.view("<i8")
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(words[at], pa.int64())], names=["at", "bits"])

    rows = keys.mapInArrow(tidy(run), "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # 2**(bits - 6) rows at most
    out = np.zeros(1 << bits - 6, "<i8")
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


_BIT = np.left_shift(1, np.arange(8)).astype(np.uint8)


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys.astype(np.int64).view(U64)) >> U64(64 - bits)).astype(np.int64)


def passes(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be one of those in the filter; all of those are."""
    at = _places(keys, len(found).bit_length() + 2)
    return (found[at >> 3] & _BIT[at & 7]) > 0
