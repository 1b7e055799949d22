"""What Python workers do at the end of a task."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def release() -> None:
    """Gives freed memory back to the machine: workers stay and are used again by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and then ``release``."""

    @wraps(run)
    def with_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return with_release
