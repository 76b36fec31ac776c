"""Arrow batches in Python workers."""
from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa


def listed(column: pa.Array | pa.ChunkedArray) -> list:
    """to_pylist of texts, without an Arrow scalar for each, which costs ten times as much."""
    return column.to_numpy(zero_copy_only=False).tolist()


def uncollected(run):
    """`run` over batches without the collector of cycles: rows make none, and a task's caches hold hundreds of thousands of tuples, which
    it would walk again and again."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = gc.isenabled()
        gc.disable()
        try:
            yield from run(batches)
        finally:
            if on:
                gc.enable()

    return wrapped
