"""Words of Arrow text columns as byte arrays: spans are cut on the UTF-8 bytes of many texts at once and compared by content, never by a hash."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4_000_000

# Lower-case A to Z, all other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if not len(column) or at is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array) -> Iterator[bytes]:
    """The values of a string or binary column as bytes."""
    data, offsets = bytes_of(column)
    raw, at = data.tobytes(), offsets.tolist()
    return (raw[a:b] for a, b in zip(at, at[1:]))


def slices(part: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``limit`` bytes of text; a longer text makes a slice by itself."""
    _, offsets = bytes_of(part.column(text))
    first = 0
    while first < part.num_rows:
        end = max(int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1, first + 1)
        yield part.slice(first, end - first)
        first = end


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), offsets.size - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def cut(column: pa.Array, inside: Callable[[np.ndarray], np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of the bytes that ``inside`` marks, with A to Z in lower case, as a binary array, and the row each lies in."""
    data, offsets = bytes_of(column)
    if not data.size:
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    mask = inside(data)
    first = np.zeros(data.size + 1, bool)
    first[offsets[:-1]] = True
    begins = mask.copy()
    begins[1:] &= ~mask[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    kept = FOLD[data[mask]]
    # The kept bytes stand one after the other, so a run ends where the next one begins.
    where = np.flatnonzero(begins[mask])
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return binary_array(kept, np.append(where, kept.size)), rows


def marker(outside: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """Marks all bytes but those of ``outside``."""
    table = np.ones(256, bool)
    table[outside] = False
    return lambda data: table[data]
