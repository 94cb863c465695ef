"""Workers that hold little: batches are taken in small slices, and what a batch took is given back to the system."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

from qaspark.llm.words import blocks

SLICE_BYTES = 1 << 19


def give_back() -> None:
    """Return freed memory to the system; a worker lives on, idle or at other work, for many tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # another C library


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of ``batches`` in order, in batches of at most ``most`` bytes of text in ``column``, or one longer text."""
    for batch in batches:
        for a, b in blocks(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist(), most):
            yield batch.slice(a, b - a)
        give_back()
