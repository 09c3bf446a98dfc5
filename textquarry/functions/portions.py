"""Rows of Arrow batches in runs of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa


def release() -> None:
    """Give freed memory back to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def rows_of(batches: Iterator[pa.RecordBatch], some: int = 64) -> Iterator[tuple]:
    """The rows of Arrow batches as Python values, a few at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, some):
            yield from zip(*(c.to_pylist() for c in batch.slice(i, some).columns), strict=True)


def portions(batches: Iterator[pa.RecordBatch], size_of, most: int, rows: int = 1 << 30) -> Iterator[list]:
    """Rows of many batches in runs of at most ``most`` by ``size_of`` and at most ``rows``, or single larger ones."""
    some, size = [], 0
    for row in rows_of(batches):
        n = size_of(row)
        if some and (size + n > most or len(some) == rows):
            yield some
            some, size = [], 0
        some.append(row)
        size += n
    if some:
        yield some
