"""Low-rank models of document vectors: truncated SVD and non-negative factorisation.

Documents stay distributed as sparse rows ``(key, idx, x)``. A model is a (terms x components) matrix; terms are
limited by ``max_features``, so the matrix has a fixed bound and lives on the driver between passes, like the
coefficients of any Spark ML model. A pass broadcasts it, every task reduces its documents to one partial sum per
term, and Spark adds the partial sums. Nothing carries over between passes but the model, so there is no lineage to
cut and a lost task is simply run again.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casemill.session import discard, freed_shuffles, materialize

CELLS = 4_000_000  # floats a chunk may expand to inside a task
WIDE, WIDE_CELLS = 32, 250_000  # columns from which a chunk is kept so small that the processor's cache holds it
BLOCK = 65_536  # floats per block of a partial sum


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, whatever Spark sends."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


class SparseRows:
    """A chunk of sparse rows in compressed form; every row has at least one entry."""

    def __init__(self, idx: np.ndarray, x: np.ndarray, lengths: np.ndarray):
        self.idx, self.x, self.lengths = idx, x, lengths
        self.starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)

    def times(self, dense: np.ndarray) -> np.ndarray:
        """Rows times a (terms x width) matrix."""
        return np.add.reduceat(dense[self.idx] * self.x[:, None], self.starts, axis=0)

    def add_transposed(self, right: np.ndarray, total: np.ndarray) -> None:
        """Add rows-transposed times ``right`` to a (terms x width) total."""
        if len(self.idx) >= len(total):  # more entries than terms: counting by term costs less than sorting
            for j in range(right.shape[1]):
                total[:, j] += np.bincount(self.idx, np.repeat(right[:, j], self.lengths) * self.x, len(total))
            return
        spread = np.repeat(right, self.lengths, axis=0) * self.x[:, None]
        order = np.argsort(self.idx, kind="stable")
        terms, first = np.unique(self.idx[order], return_index=True)
        total[terms] += np.add.reduceat(spread[order], first, axis=0)


def chunks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[slice, SparseRows]]:
    """Row ranges of an Arrow batch whose expansion to ``width`` columns stays small."""
    lengths = batch.column("idx").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    idx, x = batch.column("idx").flatten().to_numpy(), batch.column("x").flatten().to_numpy()
    ends = np.cumsum(lengths)
    entries = max((WIDE_CELLS if width >= WIDE else CELLS) // width, 1)
    begin = 0
    while begin < len(lengths):
        offset = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, offset + entries, side="right")))
        yield slice(begin, end), SparseRows(idx[offset:ends[end - 1]], x[offset:ends[end - 1]], lengths[begin:end])
        begin = end


def sum_by_term(vectors: DataFrame, n_rows: int, width: int, add: Callable[..., None], columns: Sequence[str] = ()) -> np.ndarray:
    """Sum of what ``add`` puts into a (n_rows x width) array over all documents; it gets the rows, the array, and further columns of the rows.

    Tasks hand on their partial sums as blocks of rows. The blocks are spread by number and added up as they stream
    in, so a reducer holds its own blocks only, whatever the number of tasks. A partial sum is as large as the whole, so there is one for each core, not one for each
    split of the documents, and the blocks go from disk when they are added up.
    """
    height = max(1, BLOCK // width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_rows, width))
        for batch in batches:
            for part, rows in chunks(batch, width):
                add(rows, total, *(batch.column(c).to_numpy(zero_copy_only=False)[part] for c in columns))
        for block in range(-(-n_rows // height)):
            part = total[block * height:(block + 1) * height]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()])], names=["block", "data"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                part = np.frombuffer(data.as_buffer())
                if block in sums:
                    sums[block] += part
                else:
                    sums[block] = part.copy()
        for block, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()])], names=["block", "data"])

    schema = "block int, data binary"
    spark = vectors.sparkSession
    rows = vectors.select("idx", "x", *columns).coalesce(spark.sparkContext.defaultParallelism)
    with freed_shuffles(spark):
        table = rows.mapInArrow(partial, schema).repartition("block").mapInArrow(combine, schema).toArrow()
    result = np.zeros((n_rows, width))
    for block, data in zip(table.column("block").to_pylist(), table.column("data")):
        part = np.frombuffer(data.as_buffer()).reshape(-1, width)
        result[block * height:block * height + len(part)] = part
    return result


@dataclass(frozen=True)
class Singular:
    """Largest singular values, right singular vectors (terms x k), and the squared length of all documents that the vectors leave unexplained, as a share."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float


def right_singular(vectors: DataFrame, n_terms: int, k: int, passes: int = 2, oversample: int = 10, seed: int = 42) -> Singular:
    """The k largest singular values and right singular vectors by a random sketch.

    Every pass multiplies the documents with a (terms x width) matrix and back; tasks add up their sums, which merge block by block. The first pass sketches the space
    of the documents with random directions, each further one turns the sketch towards the largest singular vectors, and the last one also gives the small
    (width x width) matrix of which the values follow. ``residual`` is measured, not estimated: documents have a total squared length, and what lies in
    the space of the vectors is the sum of the squared values. The best k vectors leave at least what ``passes`` more would.
    """
    width = min(k + oversample, n_terms)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
    sc = vectors.sparkSession.sparkContext
    for step in range(passes + 1):
        shared = sc.broadcast(basis)

        def add(rows: SparseRows, total: np.ndarray) -> None:
            rows.add_transposed(rows.times(shared.value), total[:n_terms])
            total[n_terms, 0] += (rows.x ** 2).sum()

        sums = sum_by_term(vectors, n_terms + 1, width, add)
        shared.destroy()
        image, length = sums[:n_terms], float(sums[n_terms, 0])
        if step < passes:
            basis = np.linalg.qr(image)[0]
    squared, mix = np.linalg.eigh(basis.T @ image)
    largest = np.argsort(squared)[::-1][:k]
    directions = basis @ mix[:, largest]
    # Fix the sign, which the decomposition leaves open.
    directions *= np.where(directions[np.abs(directions).argmax(axis=0), range(directions.shape[1])] < 0, -1.0, 1.0)
    explained = np.clip(squared[largest], 0.0, None)
    return Singular(np.sqrt(explained), directions, max(0.0, 1.0 - float(explained.sum()) / length) if length else 0.0)


def with_column(batch: pa.RecordBatch, found: np.ndarray, values: pa.Array, name: str) -> pa.RecordBatch:
    """The batch with a further column: a value for each of the found rows, null for the others."""
    at = np.full(batch.num_rows, -1)
    at[found] = np.arange(found.size)
    column = values.take(pa.array(at, mask=at < 0))
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def known_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.RecordBatch]:
    """(positions of the rows with a known term, these rows)."""
    found = np.flatnonzero(batch.column("idx").is_valid().to_numpy(zero_copy_only=False))
    return found, batch if found.size == batch.num_rows else batch.take(pa.array(found))


def with_projection(vectors: DataFrame, basis: np.ndarray) -> DataFrame:
    """The rows with ``dense`` as last column: documents times the basis, scaled to unit length; null for rows without known terms, whose ``idx`` is null."""
    shared = vectors.sparkSession.sparkContext.broadcast(basis)
    width = basis.shape[1]

    def to_dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found, known = known_rows(batch)
            dense = np.zeros((found.size, width))
            for part, rows in chunks(known, width):
                dense[part] = rows.times(shared.value)
            norm = np.linalg.norm(dense, axis=1, keepdims=True)
            dense = np.divide(dense, norm, out=np.zeros_like(dense), where=norm > 0)
            offsets = pa.array(np.arange(0, dense.size + 1, width, dtype=np.int32))
            yield with_column(batch, found, pa.ListArray.from_arrays(offsets, dense.ravel()), "dense")

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(to_dense, f"{fields}, dense array<double>")


def project(vectors: DataFrame, key: str, basis: np.ndarray) -> DataFrame:
    """``(key, dense)``: documents times the basis, scaled to unit length."""
    return with_projection(vectors.select(key, "idx", "x"), basis).select(key, "dense")


def fit_weights(target: np.ndarray, gram: np.ndarray, start: np.ndarray | None = None, sweeps: int = 200, tol: float = 1e-6) -> np.ndarray:
    """Non-negative least squares for many rows at once, by coordinate descent.

    Minimises ``|row . H - x|`` per row given ``target`` = x H' and ``gram`` = H H'.
    """
    result = np.zeros_like(target) if start is None else start.copy()
    scale = np.abs(target).max() if target.size else 0.0
    for _ in range(sweeps):
        moved = 0.0
        for j in range(gram.shape[0]):
            if gram[j, j] <= 0:
                continue
            new = np.maximum(result[:, j] + (target[:, j] - result @ gram[:, j]) / gram[j, j], 0.0)
            moved = max(moved, np.abs(new - result[:, j]).max(initial=0.0) * gram[j, j])
            result[:, j] = new
        if moved <= tol * scale:
            break
    return result


def initial_components(vectors: DataFrame, n_terms: int, n_docs: int, k: int, seed: int) -> np.ndarray:
    """Starting components (k x terms) from the singular vectors: per component the heavier of its positive and
    negative part, zeros replaced by the mean of the matrix."""
    found = right_singular(vectors, n_terms, k, seed=seed)
    values, directions = found.values, found.vectors
    shared = vectors.sparkSession.sparkContext.broadcast(directions)

    def add(rows: SparseRows, total: np.ndarray) -> None:
        left = rows.times(shared.value)
        total[0] += (np.maximum(left, 0.0) ** 2).sum(axis=0)
        total[1] += (np.minimum(left, 0.0) ** 2).sum(axis=0)
        total[2, 0] += rows.x.sum()

    sums = sum_by_term(vectors, 3, directions.shape[1], add)
    shared.unpersist()
    components = np.zeros((k, n_terms))
    for j in range(directions.shape[1]):
        if j == 0:
            components[0] = np.sqrt(values[0]) * np.abs(directions[:, 0])
            continue
        best, weight = max(
            ((np.maximum(sign * directions[:, j], 0.0), np.sqrt(sums[row, j])) for row, sign in ((0, 1.0), (1, -1.0))),
            key=lambda side: np.linalg.norm(side[0]) * side[1],
        )
        length = np.linalg.norm(best)
        if length > 0:
            # Singular value times the norms of both parts; the weight is the document side's norm times the value already.
            components[j] = np.sqrt(length * weight) * best / length
    components[components < 1e-6] = 0.0
    components[components == 0.0] = sums[2, 0] / (n_docs * n_terms)
    return components


@dataclass(frozen=True)
class FactorSums:
    """What components are updated from: weights times weights, documents times weights, and the documents' squared length. Sums of disjoint documents add up."""

    gram: np.ndarray
    products: np.ndarray
    length: float

    def __add__(self, other: FactorSums) -> FactorSums:
        return FactorSums(self.gram + other.gram, self.products + other.products, self.length + other.length)

    def __sub__(self, other: FactorSums) -> FactorSums:
        return FactorSums(self.gram - other.gram, self.products - other.products, self.length - other.length)

    def error(self, components: np.ndarray) -> float:
        """Squared error of the documents, with the weights they had, under these components."""
        return float(self.length - 2 * (self.products * components.T).sum() + (self.gram * (components @ components.T)).sum())

    def updated(self, components: np.ndarray) -> np.ndarray:
        """The components with the smallest error for these sums."""
        return fit_weights(self.products, self.gram, components.T).T


def factor_sums(vectors: DataFrame, components: np.ndarray) -> FactorSums:
    """Sums of the documents, each with its best weights for the components: one pass, no stored state."""
    k, n_terms = components.shape
    shared = vectors.sparkSession.sparkContext.broadcast((np.ascontiguousarray(components.T), components @ components.T))

    def add(rows: SparseRows, total: np.ndarray) -> None:
        by_term, gram = shared.value
        doc_weights = fit_weights(rows.times(by_term), gram)
        rows.add_transposed(doc_weights, total[:n_terms])
        total[n_terms:n_terms + k] += doc_weights.T @ doc_weights
        total[n_terms + k, 0] += (rows.x ** 2).sum()

    sums = sum_by_term(vectors, n_terms + k + 1, k, add)
    shared.destroy()
    return FactorSums(sums[n_terms:n_terms + k], sums[:n_terms], float(sums[n_terms + k, 0]))


BATCHES = 4


def in_batches(vectors: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The vectors as a written table, dealt into batches by their content."""
    return materialize(vectors.withColumn("batch", F.pmod(F.xxhash64("idx", "x"), F.lit(batches)).cast("int")), "factor_batches", "batch")


def nmf_components(vectors: DataFrame, n_terms: int, n_docs: int, k: int, max_iter: int = 400, tol: float = 1e-4,
                   seed: int = 42, batches: int = BATCHES) -> tuple[np.ndarray, list[float], FactorSums]:
    """Components (k x terms) of a non-negative factorisation, the squared error after every round, and the sums they follow from.

    Documents are dealt into batches by their content. A round visits the batches one after the other: a batch's sums for the current components take the place of
    its earlier ones, and the components are updated at once, so a round moves them ``batches`` times for one reading of the documents. Neither step can raise the
    error. Stops when a round improves it by less than ``tol`` of the first error. Vectors that :func:`in_batches` has written are read as they are.
    """
    dealt = vectors if "batch" in vectors.columns else in_batches(vectors.select("idx", "x"), batches)
    components = initial_components(dealt, n_terms, n_docs, k, seed)
    known: dict[int, FactorSums] = {}
    total = FactorSums(np.zeros((k, k)), np.zeros((n_terms, k)), 0.0)
    errors: list[float] = []
    for _ in range(max_iter):
        for batch in range(batches):
            new = factor_sums(dealt.where(F.col("batch") == batch), components)
            total = total + new - known[batch] if batch in known else total + new
            known[batch] = new
            components = total.updated(components)
        errors.append(total.error(components))
        if len(errors) > 1 and errors[-2] - errors[-1] < tol * errors[0]:
            break
        if len(errors) == max_iter:
            warnings.warn(f"the factorisation still improved after {max_iter} rounds", stacklevel=2)
    if dealt is not vectors:
        discard(dealt)
    return components, errors, total


def assign_components(vectors: DataFrame, key: str, components: np.ndarray, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, *keep, topic_id, topic_score)``: the component with the largest weight of every document; both are null for rows without known terms, whose ``idx`` is null."""
    shared = vectors.sparkSession.sparkContext.broadcast((np.ascontiguousarray(components.T), components @ components.T))
    width, names = components.shape[0], [key, *keep]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_term, gram = shared.value
        for batch in sliced(batches):
            found, known = known_rows(batch)
            best, score = np.zeros(found.size, np.int32), np.zeros(found.size)
            for part, rows in chunks(known, width):
                weights = fit_weights(rows.times(by_term), gram)
                best[part], score[part] = weights.argmax(axis=1), weights.max(axis=1)
            rows = with_column(with_column(batch, found, pa.array(best), "topic_id"), found, pa.array(score), "topic_score")
            yield rows.select([*names, "topic_id", "topic_score"])

    fields = ", ".join(f"`{n}` {vectors.schema[n].dataType.simpleString()}" for n in names)
    return vectors.select(*names, "idx", "x").mapInArrow(assign, f"{fields}, topic_id int, topic_score double")
