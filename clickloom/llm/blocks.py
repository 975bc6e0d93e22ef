"""Texts of Arrow batches as numpy bytes, in blocks of bounded size."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and the offset of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole, at.astype(np.int64)


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have up to ``limit`` bytes together, one row at least."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(rows, max(low + 1, high))
        yield low, high
        low = high


def parts(batches, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches whose texts are a block, with their bytes and the offsets of their rows from the first one."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        for low, high in blocks(offsets, limit):
            first = offsets[low]
            yield batch.slice(low, high - low), data[first:offsets[high]], offsets[low:high + 1] - first


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - skip, lengths)


def lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    """List column whose rows take that many values each."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
