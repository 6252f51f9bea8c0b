"""Small helpers over Arrow batches: texts as one flat byte buffer.

A text column of an Arrow batch already is one contiguous buffer plus
offsets.  The operators here work on those two numpy arrays, a bounded slice
of rows at a time, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows are taken in slices of about this many bytes of text; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1, from 0) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    raw = texts.buffers()
    kind = np.int64 if wide else np.int32
    if not len(texts) or raw[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(raw[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most ``limit`` bytes of text, one row at least."""
    _, ends = text_buffer(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    begins = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - begins, lengths)


def sums_by_row(values: np.ndarray, row_ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[row_ends[i]:row_ends[i + 1]]`` for each row (0 where empty)."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[row_ends[1:]] - total[row_ends[:-1]]


def as_strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives its freed memory back: Spark keeps workers for the tasks to come, of other stages too."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return go
