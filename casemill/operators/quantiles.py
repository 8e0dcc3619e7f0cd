"""Exact quantiles of a column without ordering a share of it."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BITS = 12  # binary digits that a pass over the values settles
BRACKET = 10_000  # distinct values of a bracket that are looked at one by one


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Numbers as unsigned integers in the same order; both zeros are one, undefined numbers come last."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def from_bits(bits: int) -> float:
    bits = bits & ~(1 << 63) if bits >> 63 else ~bits & (1 << 64) - 1
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def histogram(values: DataFrame, prefixes: list[int], known: int) -> dict[int, np.ndarray]:
    """Of the values that begin with each prefix of ``known`` digits, how many go on with each of the next digits."""
    width = min(BITS, 64 - known)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.array(prefixes, np.uint64)
        total = np.zeros((len(prefixes), 1 << width), np.int64)
        for batch in batches:
            head = ordered_bits(batch.column(0).to_numpy(zero_copy_only=False)) >> np.uint64(64 - known - width)
            place = head >> np.uint64(width)
            at = np.minimum(np.searchsorted(wanted, place), len(prefixes) - 1)
            use = wanted[at] == place
            digits = (head[use] & np.uint64((1 << width) - 1)).astype(np.int64)
            total += np.bincount(at[use] << width | digits, minlength=total.size).reshape(total.shape)
        row, digit = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int32()), pa.array(digit, pa.int32()), pa.array(total[row, digit])], names=["prefix", "digit", "n"])

    counted = values.mapInArrow(body, "prefix int, digit int, n long").groupBy("prefix", "digit").agg(F.sum("n").alias("n")).collect()
    found = {p: np.zeros(1 << width, np.int64) for p in prefixes}
    for row in counted:  # at most 4,096 rows for each prefix
        found[prefixes[row["prefix"]]][row["digit"]] = row["n"]
    return found


def values_within(values: DataFrame, prefixes: list[int], known: int) -> dict[int, list[tuple[int, int]]]:
    """The values that begin with each prefix and how often each occurs, in order. Called for brackets of few rows."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.array(prefixes, np.uint64)
        for batch in batches:
            bits = ordered_bits(batch.column(0).to_numpy(zero_copy_only=False))
            found, n = np.unique(bits[np.isin(bits >> np.uint64(64 - known), wanted)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["bits", "n"])

    rows = values.mapInArrow(body, "bits long, n long").groupBy("bits").agg(F.sum("n").alias("n")).collect()
    found: dict[int, list[tuple[int, int]]] = {p: [] for p in prefixes}
    for bits, n in sorted((r["bits"] & (1 << 64) - 1, r["n"]) for r in rows):
        found[bits >> (64 - known)].append((bits, n))
    return found


def ranked_values(values: DataFrame, ranks: Sequence[int], total: int) -> dict[int, float]:
    """The values at these ranks (from 0): each pass counts the rows of a bracket by their next binary digits, and goes on in the one that holds the rank.

    A bracket of at most ``BRACKET`` rows is read. Six passes settle all 64 digits, so it does not matter how the values are spread.
    """
    result: dict[int, float] = {}
    open_ = {r: (0, r, total) for r in ranks}  # rank: prefix, rank within it, its rows
    known = 0
    while open_:
        small = {p for p, _, n in open_.values() if n <= BRACKET}
        if small and known:
            read = values_within(values, sorted(small), known)
            for rank, (p, inside, _) in [(r, o) for r, o in open_.items() if o[0] in small]:
                upto = np.cumsum([n for _, n in read[p]])
                result[rank] = from_bits(read[p][int(np.searchsorted(upto, inside, side="right"))][0])
                del open_[rank]
        if not open_:
            break
        if known == 64:
            result |= {rank: from_bits(p) for rank, (p, _, _) in open_.items()}
            break
        counts = histogram(values, sorted({p for p, _, _ in open_.values()}), known)
        width = min(BITS, 64 - known)
        for rank, (p, inside, _) in open_.items():
            upto = np.cumsum(counts[p])
            digit = int(np.searchsorted(upto, inside, side="right"))
            before = int(upto[digit] - counts[p][digit])
            open_[rank] = (p << width | digit, inside - before, int(counts[p][digit]))
        known += width
    return result


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """``(probability, quantile)`` with linear interpolation between neighbours; no rows for a column without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    total = values.count()
    spots = {float(p): p * (total - 1) for p in probabilities} if total else {}
    found = ranked_values(values, sorted({r for s in spots.values() for r in (math.floor(s), math.ceil(s))}), total)
    rows = [(p, found[math.floor(s)] + (found[math.ceil(s)] - found[math.floor(s)]) * (s - math.floor(s))) for p, s in spots.items()]
    return df.sparkSession.createDataFrame(rows, "probability double, quantile double")
