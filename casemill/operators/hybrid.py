"""Hybrid retrieval: filtered lexical and dense scores, min-max scaled per question and fused, in one pass over the documents.

Documents are scored where they lie, as matrix products with the questions at hand. The scale of a question's scores is known only when all its candidates
have been seen, but whatever it is, a document that k others equal or beat in both scores is not among the k best. So each task returns, per question, the
score ranges and the documents that fewer than k others beat: a band of about k log n rows. Ranges and bands meet in a join of small tables. No
(question, document) pair leaves a task unless it can be among the best, and a question that matches every document costs no more to shuffle than any other.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from casemill.fixed import DENSE_WEIGHT, LEXICAL_WEIGHT
from casemill.functions.filters import EQUALITY_FIELDS
from casemill.functions.text import narratives
from casemill.operators import lowrank, tfidf
from casemill.operators.search import SCORE_DIGITS, top_k
from casemill.operators.tfidf import INDEX, TfidfSpec
from casemill.session import delete_folder, discard, materialize, scratch_path, write_scratch

BATCH = 256  # questions that are scored together in a task
PASS = 1_024  # questions of a pass: they are broadcast, so their number is bounded
FILTER_COLUMNS = [*EQUALITY_FIELDS, "date_received"]
QUESTION_FIELDS = [*EQUALITY_FIELDS, "date_start", "date_end"]
RANGES = ["lexical_low", "lexical_high", "dense_low", "dense_high"]  # of the scores of a question's candidates


@dataclass
class Questions:
    """Questions as arrays: term numbers and weights of each, the dense matrix, and for each question the number of its filters."""

    ids: list
    numbers: list[np.ndarray]
    weights: list[np.ndarray]
    dense: np.ndarray
    group: np.ndarray

    @staticmethod
    def of(rows: Sequence[Row]) -> tuple[Questions, list[dict]]:
        width = max((len(r["dense"]) for r in rows if r["dense"]), default=0)
        dense = np.zeros((width, len(rows)))
        for j, r in enumerate(rows):
            if r["dense"]:
                dense[:, j] = r["dense"]
        wanted = [{f: r[f] for f in QUESTION_FIELDS if r[f]} for r in rows]
        filters = [dict(items) for items in sorted({tuple(sorted(w.items())) for w in wanted})]
        group = np.array([filters.index(w) for w in wanted], dtype=np.int64)
        lists = ([np.asarray(r[c] or [], dtype=kind) for r in rows] for c, kind in (("idx", np.int64), ("x", float)))
        return Questions([r["question"] for r in rows], *lists, dense, group), filters

    @cached_property
    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        """The terms in use, and their weights as a (terms x questions) matrix; made for a batch of questions in a task."""
        terms = np.unique(np.concatenate([np.zeros(0, np.int64), *self.numbers]))
        lexical = np.zeros((len(terms), len(self.ids)))
        for j, (numbers, weights) in enumerate(zip(self.numbers, self.weights)):
            lexical[np.searchsorted(terms, numbers), j] = weights
        return terms, lexical

    def parts(self) -> Iterator[tuple[int, Questions]]:
        """(first position, questions) in batches."""
        for first in range(0, len(self.ids), BATCH):
            some = slice(first, first + BATCH)
            yield first, Questions(self.ids[some], self.numbers[some], self.weights[some], self.dense[:, some], self.group[some])

    def candidates(self, batch: pa.RecordBatch) -> np.ndarray:
        """Rows x questions: whether the document passes the question's filters."""
        groups = batch.column("passes").flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(batch.num_rows, -1)
        return groups[:, self.group]

    def scores(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Lexical and dense score of every row and question; dense is NaN where a row has no vector."""
        column = batch.column("idx")
        lengths = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False)
        idx, x = column.flatten().to_numpy(), batch.column("x").flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), lengths)
        lexical = np.zeros((batch.num_rows, len(self.ids)))
        terms, weights = self.matrix
        if len(terms):
            at = np.minimum(np.searchsorted(terms, idx), len(terms) - 1)
            known = np.flatnonzero(terms[at] == idx)
            step = max(lowrank.CELLS // len(self.ids), 1)
            for begin in range(0, len(known), step):
                use = known[begin:begin + step]
                rows, first = np.unique(row[use], return_index=True)
                lexical[rows] += np.add.reduceat(weights[at[use]] * x[use][:, None], first, axis=0)
        dense = np.full((batch.num_rows, len(self.ids)), np.nan)
        column = batch.column("dense")
        valid = pc.is_valid(column).to_numpy(zero_copy_only=False)
        if valid.any() and self.dense.size:
            dense[valid] = column.flatten().to_numpy().reshape(valid.sum(), -1) @ self.dense
        return lexical, dense


class Band:
    """Per question the candidates seen so far that fewer than k others beat in both scores, and the score ranges.

    Another candidate beats a document if neither score is lower and it goes first whatever the scale: its key is smaller, or a score is higher by more than
    ``margin``, so that it shows in the rounded sum. Unknown dense scores are below all others.
    """

    def __init__(self, n: int, k: int, lexical_weight: float, dense_weight: float):
        self.k, self.lexical_weight, self.dense_weight = k, lexical_weight, dense_weight
        # Scores of unit vectors span 2 at most, so a step of the margin moves the sum by more than its last rounded digit.
        self.margin = 4 * 10.0 ** -SCORE_DIGITS / (dense_weight or lexical_weight or 1.0)
        self.count = np.zeros(n, np.int64)
        self.low, self.high = np.full((2, n), np.inf), np.full((2, n), -np.inf)
        self.rows: list[tuple] = [(np.zeros(0), np.zeros(0), None)] * n

    def add(self, first: int, mask: np.ndarray, lexical: np.ndarray, dense: np.ndarray, keys: pa.Array) -> None:
        some = slice(first, first + mask.shape[1])
        self.count[some] += mask.sum(axis=0)
        for i, values in enumerate((lexical, dense)):
            known = mask & np.isfinite(values)
            self.low[i, some] = np.minimum(self.low[i, some], np.where(known, values, np.inf).min(axis=0, initial=np.inf))
            self.high[i, some] = np.maximum(self.high[i, some], np.where(known, values, -np.inf).max(axis=0, initial=-np.inf))
        for j in range(mask.shape[1]):
            at = np.flatnonzero(mask[:, j])
            if not at.size:
                continue
            old_lexical, old_dense, old_keys = self.rows[first + j]
            new = (np.concatenate([old_lexical, lexical[at, j]]), np.concatenate([old_dense, dense[at, j]]))
            of = keys.take(pa.array(at)) if old_keys is None else pa.concat_arrays([old_keys, keys.take(pa.array(at))])
            keep = self.open(*new, of)
            self.rows[first + j] = (new[0][keep], new[1][keep], of.take(pa.array(keep)))

    def open(self, lexical: np.ndarray, dense: np.ndarray, keys: pa.Array) -> np.ndarray:
        """Positions of the band. In order of falling lexical score, a document is out if k before it have a dense score that is higher by the margin; of equal pairs
        of scores the k smallest keys stay."""
        lexical = lexical if self.lexical_weight else np.zeros_like(lexical)
        dense = np.where(np.isfinite(dense), dense, -np.inf) if self.dense_weight else np.zeros_like(dense)
        if not self.dense_weight:
            lexical, dense = dense, lexical
        rank = pc.rank(keys, sort_keys="ascending", tiebreaker="first").to_numpy().astype(np.int64)
        order = np.lexsort((rank, -dense, -lexical))
        lexical, dense = lexical[order], dense[order]
        fresh = np.concatenate([[True], (lexical[1:] != lexical[:-1]) | (dense[1:] != dense[:-1])])
        starts = np.flatnonzero(fresh)
        twin = np.arange(order.size) - np.repeat(starts, np.diff(np.append(starts, order.size)))
        stay = twin < self.k
        border, best, first, step = -np.inf, np.zeros(0), 0, max(16, self.k)
        while first < order.size:
            part = slice(first, first + step)
            stay[part] &= ~(dense[part] < border - self.margin)
            best = np.concatenate([best, dense[part][stay[part]]])
            if best.size > self.k:
                best = np.partition(best, best.size - self.k)[best.size - self.k:]
            if best.size == self.k:
                border = best.min()
            first, step = first + step, 2 * step
        return order[stay]


def _band(shared, key: str, kind: pa.DataType):
    """Task body: ranges and bands of all questions."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, k, lexical_weight, dense_weight = shared.value
        asked = Questions(**fields)
        band, parts = Band(len(asked.ids), k, lexical_weight, dense_weight), list(asked.parts())
        for batch in tfidf.sliced(batches, 2_000):
            for first, some in parts:
                band.add(first, some.candidates(batch), *some.scores(batch), batch.column(key))
        n = len(asked.ids)
        names = ["position", key, "lexical_score", "dense_score", "n", "lexical_low", "lexical_high", "dense_low", "dense_high"]
        ranges = [pa.array(band.count), *(pa.array(v) for v in (band.low[0], band.high[0], band.low[1], band.high[1]))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.nulls(n, kind), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), *ranges], names=names)
        for j, (lexical, dense, keys) in enumerate(band.rows):
            if keys is not None:
                nothing = [pa.nulls(len(keys), c.type) for c in ranges]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), j, np.int32)), keys, pa.array(lexical), pa.array(dense, mask=~np.isfinite(dense)), *nothing], names=names)

    return body


def passing(wanted: dict) -> Column:
    """Whether a document passes a question's filters; unknown values pass none."""
    tests = [F.lower(field) == value.lower() for field, value in wanted.items() if field in EQUALITY_FIELDS]
    for field, test in (("date_start", operator.ge), ("date_end", operator.le)):
        if field in wanted:
            tests.append(test(F.col("date_received"), F.lit(wanted[field]).cast("timestamp_ntz")))
    return F.coalesce(reduce(operator.and_, tests, F.lit(True)), F.lit(False))


def scaled(column: str) -> Column:
    """A score as a share of its range; unknown scores and constant ranges give 0."""
    value, low, high = F.col(f"{column}_score"), F.col(f"{column}_low"), F.col(f"{column}_high")
    return F.when((high > low) & (high - low < float("inf")), F.coalesce((value - low) / (high - low), F.lit(0.0))).otherwise(0.0)


def search_pass(vectors: DataFrame, asked: Sequence[Row], kind: str, key: str, k: int, lexical_weight: float, dense_weight: float) -> tuple[DataFrame, DataFrame]:
    """Evidence and trace of the questions of one pass."""
    spark = vectors.sparkSession
    questions, filters = Questions.of(asked)
    # Every distinct filter is evaluated where the scan is; documents that pass none never reach a Python worker.
    passes = [passing(f) for f in filters]
    lowered = vectors.where(reduce(lambda a, b: a | b, passes)).select(key, "idx", "x", "dense", F.array(*passes).alias("passes"))
    shared = spark.sparkContext.broadcast((vars(questions), k, lexical_weight, dense_weight))
    of_key = vectors.schema[key].dataType
    schema = (f"position int, `{key}` {of_key.simpleString()}, lexical_score double, dense_score double, n bigint, "
              "lexical_low double, lexical_high double, dense_low double, dense_high double")
    found = materialize(lowered.mapInArrow(_band(shared, key, to_arrow_type(of_key)), schema), "bands")
    shared.destroy()
    ranges = found.where("n IS NOT NULL").groupBy("position").agg(
        F.sum("n").alias("candidate_count"), *[F.min(f"{c}_low").alias(f"{c}_low") for c in ("lexical", "dense")], *[F.max(f"{c}_high").alias(f"{c}_high") for c in ("lexical", "dense")])
    names = spark.createDataFrame(list(enumerate(questions.ids)), f"position int, question_id {kind}")
    known = names.join(ranges, "position", "left").withColumn("candidate_count", F.coalesce("candidate_count", F.lit(0).cast("bigint")))
    known = F.broadcast(known)  # a row per question of the pass
    fused = F.lit(lexical_weight) * scaled("lexical") + F.lit(dense_weight) * scaled("dense")
    best = found.where("n IS NULL").select("position", key, "lexical_score", "dense_score").join(known, "position").withColumn("hybrid_score", fused)
    evidence = top_k(best, "question_id", "hybrid_score", key, k).select("question_id", key, "lexical_score", "dense_score", "hybrid_score", "rank")
    trace = known.select(
        "question_id", "candidate_count", F.least("candidate_count", F.lit(k)).alias("returned_count"),
        F.lit(lexical_weight).alias("lexical_weight"), F.lit(dense_weight).alias("dense_weight"),
        F.when(F.col("candidate_count") == 0, "metadata_filter_returned_no_rows").alias("reason"), *RANGES,
    )
    return evidence, trace


def hybrid_search(vectors: DataFrame, asked: DataFrame, k: int = 8, lexical_weight: float = LEXICAL_WEIGHT, dense_weight: float = DENSE_WEIGHT,
                  key: str = "complaint_id") -> tuple[DataFrame, DataFrame]:
    """``(evidence, trace)`` for all questions; the trace ends with the ranges the scores were scaled by.

    ``vectors``: one row per document with filter columns, sparse ``idx``/``x`` and ``dense``, both of unit length. ``asked``: one row per
    question with ``question_id``, the filter fields and its own vectors. Question sets beyond one pass are cut by a
    hash of their id into passes that follow each other. Weights are not negative.
    """
    if lexical_weight < 0 or dense_weight < 0:
        raise ValueError("weights must not be negative")
    columns = [F.col("question_id").alias("question"), "idx", "x", "dense", *QUESTION_FIELDS]
    asked = materialize(asked.select("question_id", "idx", "x", "dense", *QUESTION_FIELDS), "asked")
    kind = asked.schema["question_id"].dataType.simpleString()
    parts = max(1, -(-asked.count() // PASS))
    found = []
    for part in range(parts):
        rows = asked.filter(F.pmod(F.xxhash64("question_id"), F.lit(parts)) == part).select(*columns).orderBy("question").collect()
        if rows:
            found.append(search_pass(vectors, rows, kind, key, k, lexical_weight, dense_weight))
    if not found:
        raise ValueError("no questions given")
    return tuple(reduce(DataFrame.unionByName, side) for side in zip(*found))


def without_filters(questions: DataFrame) -> DataFrame:
    return questions.withColumns({f: F.lit(None).cast("string") for f in QUESTION_FIELDS if f not in questions.columns})


@dataclass(frozen=True)
class Index:
    """Retrieval index as tables: terms with their basis row, document vectors with metadata, cleaned texts.

    ``residual`` is the share of the documents' squared length that the dense vectors leave out, measured when the index was built.
    """

    terms: DataFrame
    vectors: DataFrame
    docs: DataFrame
    basis: np.ndarray
    spec: TfidfSpec
    residual: float
    path: str

    @property
    def model(self) -> str:
        return f"local_lsa_tfidf_svd_{self.basis.shape[1]}"

    def summary(self) -> DataFrame:
        return self.docs.agg(F.count(F.lit(1)).alias("indexed_narratives")).withColumn("embedding_model", F.lit(self.model))

    def delete(self) -> None:
        """Delete the index's tables; no frame that is still to be evaluated reads them."""
        delete_folder(self.docs.sparkSession, self.path)

    def ask(self, questions: DataFrame) -> DataFrame:
        """Questions (``question_id``, ``question``, filters) with vectors in the space of the index."""
        sparse = materialize(tfidf.doc_vectors(tfidf.count_terms(questions, "question_id", "question", self.spec), self.terms, "question_id", self.spec), "asked")
        dense = lowrank.project(sparse, "question_id", self.basis)
        return without_filters(questions).join(sparse, "question_id", "left").join(dense, "question_id", "left")


def open_index(spark: SparkSession, path: str, spec: TfidfSpec = INDEX) -> Index:
    """Index from its tables. The term table, basis included, is limited by ``max_features``."""
    terms = spark.read.parquet(f"{path}/terms")
    basis = terms.orderBy("idx").select("basis").toArrow()["basis"].combine_chunks()
    basis = basis.flatten().to_numpy().reshape(len(basis), -1)
    model = spark.read.parquet(f"{path}/model").first()
    return Index(terms.drop("basis"), spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/docs"), basis, spec, model["residual"], path)


def build_index(complaints: DataFrame, path: str | None = None, min_chars: int = 80,
                components: int = 128, passes: int = 2, spec: TfidfSpec = INDEX, key: str = "complaint_id") -> Index:
    """Clean, weigh and project all narratives, and write the index tables below ``path``."""
    spark = complaints.sparkSession
    path = path or scratch_path(spark, "index")
    docs = narratives(complaints, min_chars)
    kept = [c for c in complaints.columns if c != "consumer_complaint_narrative"]
    write_scratch(docs.select(*kept, "clean_narrative"), f"{path}/docs")
    docs = spark.read.parquet(f"{path}/docs")
    n_docs = docs.count()
    if not n_docs:
        raise ValueError("no narratives to index")
    with tfidf.counted_documents(docs, key, "clean_narrative", spec, FILTER_COLUMNS) as counts:
        terms = tfidf.numbered_vocabulary(counts, spec, "index_terms", F.lit(n_docs))
        n_terms = terms.count()
        # Documents without a known term stay candidates; their vectors are null and their scores 0.
        sparse = materialize(tfidf.doc_vectors(counts, terms, key, spec, FILTER_COLUMNS), "index_sparse")
    width = min(components, max(2, n_terms - 1), max(2, n_docs - 1))
    found = lowrank.right_singular(sparse.where("idx IS NOT NULL"), n_terms, width, passes)
    basis = found.vectors
    write_scratch(spark.createDataFrame([(found.residual,)], "residual double"), f"{path}/model")
    rows = pa.table({"idx": pa.array(np.arange(n_terms, dtype=np.int32)), "basis": pa.array(list(basis))})
    write_scratch(terms.join(spark.createDataFrame(rows), "idx"), f"{path}/terms")
    # A document's filter columns, terms and dense vector come from one row, so the index takes no join.
    write_scratch(lowrank.with_projection(sparse, basis), f"{path}/vectors")
    discard(terms, sparse)
    return open_index(spark, path, spec)


def retrieve(index: Index, questions: DataFrame, k: int = 8, lexical_weight: float = LEXICAL_WEIGHT, dense_weight: float = DENSE_WEIGHT) -> tuple[DataFrame, DataFrame]:
    """Evidence and trace of questions asked to an index; the trace names the index's dense model."""
    evidence, trace = hybrid_search(index.vectors, index.ask(questions), k, lexical_weight, dense_weight)
    return evidence, trace.withColumn("embedding_model", F.lit(index.model))


def dense_search(vectors: DataFrame, asked: DataFrame, k: int = 8, key: str = "vec_id") -> DataFrame:
    """Cosine top-k on dense vectors of unit length; ``asked`` holds ``question_id`` and ``dense``."""
    empty = {"idx": F.array().cast("array<int>"), "x": F.array().cast("array<double>")}
    blank = {c: F.lit(None).cast("string") for c in EQUALITY_FIELDS} | {"date_received": F.lit(None).cast("timestamp_ntz")}
    evidence, _ = hybrid_search(vectors.withColumns(empty | blank), without_filters(asked).withColumns(empty), k, 0.0, 1.0, key)
    return evidence.select("question_id", key, F.col("dense_score").alias("score"), "rank")


def unit(col) -> F.Column:
    """Array of floats as array of doubles of length 1."""
    values = F.transform(col, lambda v: v.cast("double"))
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v))
    # Binding the norm to a variable computes it once, not once per element.
    return F.element_at(F.transform(F.array(norm), lambda n: F.transform(values, lambda v: F.coalesce(F.try_divide(v, n), F.lit(0.0)))), 1)
