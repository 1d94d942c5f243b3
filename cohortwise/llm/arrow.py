"""Helpers for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once, so that a task's memory does not follow the longest documents.
PIECE_BYTES = 4 << 20


def pieces(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches so that each holds about ``limit`` bytes of column ``text``; yields (batch, texts as bytes, null as empty)."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        sizes = np.cumsum(np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1])) if len(column) else []
        start = 0
        while start < len(column):
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
            yield batch.slice(start, stop - start), [t or b"" for t in column.slice(start, stop - start).to_pylist()]
            start = stop


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal neighbours."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
