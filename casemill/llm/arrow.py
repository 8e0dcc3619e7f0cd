"""Helpers of operators that work on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 500


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str) -> DataFrame:
    """``mapInArrow`` with per-task state: ``make`` runs once in a task, its result on slices of at most ``ROWS`` rows.

    Workers go from task to task, so a task gives free memory back when it ends; else an executor holds the most that each of its workers ever had.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for part in parts:
            step = step or make()
            for first in range(0, part.num_rows, ROWS):
                yield from step(part.slice(first, ROWS))
        step = part = None
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give free memory back to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def with_columns(part: pa.RecordBatch, columns: dict[str, pa.Array], keep: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), *columns.values()], names=[*keep, *columns])


def unused(columns: list[str], stem: str) -> str:
    """A column name that is not among ``columns`` (names are told apart without case)."""
    taken, k = {c.lower() for c in columns}, 0
    while f"{stem}{k}" in taken:
        k += 1
    return f"{stem}{k}"


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a string column; null is the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def ragged(lengths: np.ndarray) -> np.ndarray:
    """Offsets of rows with these lengths."""
    out = np.zeros(lengths.size + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of consecutive spans, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - ragged(lengths)[:-1], lengths)
    return np.arange(total, dtype=np.int64) + shift


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
