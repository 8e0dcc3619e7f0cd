"""Lexical and dense top-k search for many questions at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from casemill.fixed import CITATION_FORMAT, CITATION_MISSING
from casemill.operators import tfidf
from casemill.operators.tfidf import SEARCH, TfidfSpec
from casemill.session import materialize

SCORE_DIGITS = 9  # scores equal to this many digits are ties, which go to the smaller id
BATCH_TERMS = 65_536  # terms of the questions that are searched together
BLOCK_DOCS = 128


def citation(key: Column) -> Column:
    return F.when(key.isNull(), F.lit(CITATION_MISSING)).otherwise(F.format_string(CITATION_FORMAT, key.cast("bigint")))


def top_k(scored: DataFrame, question: str, score: str, key: str, k: int) -> DataFrame:
    """The k best rows per question with their rank.

    A rank filter below the shuffle keeps k rows per question and task, so a question that matches every document
    moves no more rows than any other.
    """
    order = Window.partitionBy(question).orderBy(F.desc(F.round(score, SCORE_DIGITS)), key)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass(frozen=True)
class Asked:
    """A batch of questions over the terms they use: ``terms`` with their idf, and of every question its term numbers and weights."""

    ids: list
    terms: list[str]
    idf: list[float]
    numbers: list[np.ndarray]
    weights: list[np.ndarray]

    @staticmethod
    def of(rows: Sequence[Row]) -> Asked:
        idf = {e["term"]: e["idf"] for r in rows for e in r["parts"]}
        terms = sorted(idf)
        number = {t: i for i, t in enumerate(terms)}
        return Asked([r["question"] for r in rows], terms, [idf[t] for t in terms],
                     [np.array([number[e["term"]] for e in r["parts"]]) for r in rows], [np.array([e["x"] for e in r["parts"]]) for r in rows])


def batches_of(asked: DataFrame, question: str) -> Iterator[Asked]:
    """Questions in batches with a bounded number of terms; only one batch is on the driver at a time."""
    rows, size = [], 0
    for row in asked.groupBy(F.col(question).alias("question")).agg(F.array_sort(F.collect_list(F.struct("term", "x", "idf"))).alias("parts")).toLocalIterator():
        if rows and size + len(row["parts"]) > BATCH_TERMS:
            yield Asked.of(rows)
            rows, size = [], 0
        rows.append(row)
        size += len(row["parts"])
    if rows:
        yield Asked.of(rows)


class Postings:
    """Inverted index of a task's documents: postings by term, and the largest weight of every term in each block of documents."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, x: np.ndarray, n_terms: int, n_docs: int):
        order = np.lexsort((docs, terms))
        self.docs, self.x, self.n_docs = docs[order], x[order], n_docs
        self.heads = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.bounds = np.zeros((n_terms, -(-n_docs // BLOCK_DOCS)))
        np.maximum.at(self.bounds, (terms[order], self.docs // BLOCK_DOCS), self.x)

    def best(self, numbers: np.ndarray, weights: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the blocks that can hold one of the k best; ``floor`` is a k-th score known from elsewhere."""
        limits = weights @ self.bounds[numbers]
        first = np.argsort(-limits)[:2]
        docs, scores = self.scored(numbers, weights, np.isin(np.arange(limits.size), first))
        if scores.size >= k:
            floor = max(floor, np.partition(scores, scores.size - k)[scores.size - k])
        rest = (limits > 0) & (limits >= floor - 2 * 10.0 ** -SCORE_DIGITS)
        rest[first] = False
        if not rest.any():
            return docs, scores
        more, high = self.scored(numbers, weights, rest)
        return np.concatenate([docs, more]), np.concatenate([scores, high])

    def scored(self, numbers: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros(self.n_docs)
        for number, weight in zip(numbers, weights):
            span = slice(self.heads[number], self.heads[number + 1])
            docs = self.docs[span]
            use = blocks[docs // BLOCK_DOCS]
            total[docs[use]] += weight * self.x[span][use]
        docs = np.flatnonzero(total)
        return docs, total[docs]


def matching(counts: DataFrame, key: str, spec: TfidfSpec, shared) -> DataFrame:
    """``(key, idx, x)``: of every document the terms that a batch asks for, before its length is taken out."""
    sublinear = spec.sublinear

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Asked(**shared.value)
        wanted, idf = pa.array(asked.terms, pa.string()), np.array(asked.idf)
        for part in tfidf.sliced(parts):
            lengths, terms, tf = tfidf.counted(part)
            found = pc.fill_null(pc.index_in(terms, wanted), -1).to_numpy(zero_copy_only=False)
            known = np.flatnonzero(found >= 0)
            tf = tf[known].astype(float)
            x = (np.log(tf) + 1 if sublinear else tf) * idf[found[known]]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(np.repeat(np.arange(lengths.size), lengths)[known], minlength=lengths.size))])
            at = pa.array(offsets.astype(np.int32))
            rows = pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(at, pa.array(found[known].astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(x))], names=[key, "idx", "x"])
            yield rows.filter(pa.array(np.diff(offsets) > 0))

    return counts.select(key, "terms", "tf").mapInArrow(body, f"`{key}` {counts.schema[key].dataType.simpleString()}, idx array<int>, x array<double>")


def search_tasks(matched: DataFrame, key: str, k: int, shared) -> DataFrame:
    """``(position, key, score)``: the k best documents of every task for each question of the batch."""

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Asked(**shared.value)
        heads: list[list[tuple]] = [[] for _ in asked.ids]
        for part in parts:
            lengths = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(part.num_rows), lengths)
            x = part.column(2).flatten().to_numpy(zero_copy_only=False) / part.column(3).to_numpy()[rows]
            index = Postings(part.column(1).flatten().to_numpy(zero_copy_only=False), rows, x, len(asked.terms), part.num_rows)
            keys = part.column(0).to_pylist()
            for j, head in enumerate(heads):
                floor = -head[-1][0] if len(head) == k else 0.0
                docs, scores = index.best(asked.numbers[j], asked.weights[j], k, floor)
                if docs.size:
                    rounded = np.round(scores, SCORE_DIGITS)
                    if docs.size > k:  # ties with the k-th stay, as smaller keys go first
                        use = rounded >= np.partition(rounded, docs.size - k)[docs.size - k]
                        docs, scores, rounded = docs[use], scores[use], rounded[use]
                    found = [(-r, keys[d], s) for r, d, s in zip(rounded.tolist(), docs.tolist(), scores.tolist())]
                    heads[j] = sorted(head + found, key=lambda t: t[:2])[:k]
        rows = [(j, t[1], t[2]) for j, head in enumerate(heads) for t in head]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), None, pa.float64()))], names=["position", key, "score"])

    return matched.mapInArrow(body, f"position int, `{key}` {matched.schema[key].dataType.simpleString()}, score double")


def lexical_top(counts: DataFrame, questions: DataFrame, k: int, key: str, question: str, question_text: str, spec: TfidfSpec) -> DataFrame:
    """``(question, key, score, rank)`` of the documents with a common term: cosine over all terms.

    Each task holds an inverted index of the documents it reads, batch by batch, and skips blocks of documents whose bound stays below a
    question's k-th score. It returns k rows a question, so there is no row per question and document.
    """
    spark = counts.sparkSession
    vocab = materialize(tfidf.vocabulary(counts, spec), "search_terms")
    lengths = materialize(tfidf.norms(counts, vocab, key, spec), "lengths")
    asked = tfidf.weights(tfidf.count_terms(questions, question, question_text, spec), vocab, question, spec).join(vocab.select("term", "idf"), "term")
    kind = questions.schema[question].dataType.simpleString()
    found = spark.createDataFrame([], f"`{question}` {kind}, `{key}` {counts.schema[key].dataType.simpleString()}, score double")
    for batch in batches_of(asked, question):
        shared = spark.sparkContext.broadcast(vars(batch))
        matched = matching(counts, key, spec, shared).join(lengths, key).select(key, "idx", "x", "norm")
        names = spark.createDataFrame(list(enumerate(batch.ids)), f"position int, `{question}` {kind}")
        best = materialize(top_k(search_tasks(matched, key, k, shared), "position", "score", key, k), "lexical_top")
        shared.destroy()
        found = found.unionByName(best.join(F.broadcast(names), "position").select(question, key, "score"))  # a name per question of the batch
    return top_k(found, question, "score", key, k)


def fill_unmatched(top: DataFrame, questions: DataFrame, docs: DataFrame, question: str, key: str, k: int) -> DataFrame:
    """Complete questions with fewer than k matches by documents of score 0, smallest ids first.

    Fewer than k of the smallest 2k ids can be taken, so that many are enough for every question.
    """
    smallest = docs.select(key).orderBy(key).limit(2 * k).select(F.collect_list(key)).scalar()
    spare = questions.select(question, F.explode(smallest).alias(key)).join(top.select(question, key), [question, key], "left_anti") \
        .withColumn("score", F.lit(0.0))
    return top_k(top.select(question, key, "score").unionByName(spare), question, "score", key, k)


def lexical_search(docs: DataFrame, questions: DataFrame, k: int = 8, key: str = "complaint_id", text: str = "clean_narrative",
                   question: str = "question_id", question_text: str = "question", spec: TfidfSpec = SEARCH) -> DataFrame:
    """``(question, key, score, rank)``: TF-IDF cosine, features fitted on the documents once for all questions."""
    counts = tfidf.count_terms(docs, key, text, spec)
    top = materialize(lexical_top(counts, questions, k, key, question, question_text, spec), "lexical_top")
    return fill_unmatched(top, questions, counts, question, key, k)


def evidence(top: DataFrame, docs: DataFrame, key: str = "complaint_id") -> DataFrame:
    """Top rows with their document columns and citation; a document without id is cited as missing."""
    return top.join(docs, key).withColumn("citation", citation(F.col("complaint_id")))
