"""TF-IDF features over words and pairs of words.

Documents are counted once: a pass over the texts writes a row of distinct terms and counts per document, without a shuffle of texts or words. Document
frequencies, weights and vectors start from that table. A vocabulary limited to ``max_features`` rows is broadcast to the tasks that read the counts, which
look a batch's terms up in it at once and return whole vectors; an unlimited one is joined on the term.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from casemill.fixed import (
    ENGLISH_STOP_WORDS, TFIDF_INDEX, TFIDF_ROUTER, TFIDF_SEARCH, TFIDF_TOPICS,
)
from casemill.functions.text import tokens, with_bigrams
from casemill.session import discard, materialize


@dataclass(frozen=True)
class TfidfSpec:
    """Feature settings; ``max_features`` None keeps all terms, ``max_df`` is a share of documents, ``stop_words`` may be any list."""

    max_features: int | None
    min_df: int = 1
    max_df: float = 1.0
    sublinear: bool = False
    stop_words: Sequence[str] = tuple(ENGLISH_STOP_WORDS)


SEPARATOR = "\n"  # between terms: no word holds it
HELD_TERMS = 1_000_000  # entries of documents that a task adds up at a time
PART_TERMS = 1_000_000  # entries of documents behind a part of the terms
PLACES = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
HEAD_TERMS = 262_144  # most frequent terms that are broadcast, of a vocabulary of any size

TOPICS, ROUTER = TfidfSpec(**TFIDF_TOPICS), TfidfSpec(**TFIDF_ROUTER)
SEARCH, INDEX = TfidfSpec(**TFIDF_SEARCH), TfidfSpec(**TFIDF_INDEX)


def terms_of(text: Column, spec: TfidfSpec) -> Column:
    return with_bigrams(tokens(text, spec.stop_words))


def blocks_of(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of numbers as binary values."""
    at = (offsets * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(values)])


def numbers_of(blocks: pa.Array, kind: type) -> np.ndarray:
    """The numbers of all blocks, one after the other; no block is null."""
    at = np.frombuffer(blocks.buffers()[1], np.int32)[blocks.offset:blocks.offset + len(blocks) + 1]
    return np.frombuffer(blocks.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind) if len(blocks) and at[0] < at[-1] else np.zeros(0, kind)


def counted(part: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of terms of each document, terms, counts) of a batch whose last columns are ``terms`` and ``tf``."""
    lists = pc.split_pattern(part.column(part.num_columns - 2), SEPARATOR)
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), lists.flatten(), numbers_of(part.column(part.num_columns - 1), np.int32)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of few documents: what a task expands at a time stays small, whatever Spark sends."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


class TermCounter:
    """Distinct terms of lower-case texts with their counts: per text one string of terms, null without any, and one block of numbers.

    Words are numbered per batch, so words and pairs are counted as numbers.
    """

    def __init__(self, stop_words: Sequence[str]):
        self.stop, self.words = pa.array(sorted(stop_words), pa.string()), re.compile(r"\w\w+").findall  # letters, numbers and underscores, two or more

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        found = [self.words(text or "") for text in texts.to_pylist()]
        rows = np.repeat(np.arange(len(found)), np.fromiter(map(len, found), np.int64, len(found)))
        coded = pa.array([w for words in found for w in words], pa.string()).dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kept = ~pc.is_in(words, self.stop).to_numpy(zero_copy_only=False)[codes]
        codes, rows = codes[kept], rows[kept]
        first, second = codes[:-1], codes[1:]
        same = rows[:-1] == rows[1:]
        pairs, numbers = np.unique((first * len(words) + second)[same], return_inverse=True)
        left, right = np.divmod(pairs, max(len(words), 1))
        terms = pa.concat_arrays([words, pc.binary_join_element_wise(words.take(pa.array(left)), words.take(pa.array(right)), " ")])
        places, tf = np.unique(np.concatenate([rows * len(terms) + codes, rows[:-1][same] * len(terms) + len(words) + numbers]), return_counts=True)
        rows, numbers = np.divmod(places, max(len(terms), 1))
        offsets = np.searchsorted(rows, np.arange(len(found) + 1)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), terms.take(pa.array(numbers))), SEPARATOR)
        return pc.if_else(pa.array(np.diff(offsets) > 0), joined, pa.scalar(None, pa.string())), blocks_of(tf.astype(np.int32), offsets)


def count_terms(docs: DataFrame, key: str, text: str, spec: TfidfSpec, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, terms string, tf binary)``: the distinct terms of every document and their counts as 32-bit numbers, a document's in one row; written. Columns to keep
    follow the key.

    A document's terms are one string, so that millions of them pass Spark as one value a document; :func:`counted` takes them apart. Lower case and words are those of :func:`~casemill.functions.text.tokens`; splitting and counting a text in one go moves no words.
    """
    stop = spec.stop_words

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TermCounter(stop)
        for part in sliced(batches):
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *count(part.column(part.num_columns - 1))], names=[*names, "terms", "tf"])

    names = [key, *keep]
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    lowered = docs.select(*names, F.lower(text).alias("text"))
    return materialize(lowered.mapInArrow(body, f"{kinds}, terms string, tf binary"), "term_counts")


@contextmanager
def counted_documents(docs: DataFrame, key: str, text: str, spec: TfidfSpec, keep: Sequence[str] = ()) -> Iterator[DataFrame]:
    """The counted terms of documents as a table that goes when its user has ended. Documents that :func:`count_terms` has counted already, with the same stop words, stay."""
    if "terms" in docs.columns and "tf" in docs.columns:
        yield docs.select(key, *keep, "terms", "tf")
        return
    counts = count_terms(docs, key, text, spec, keep)
    try:
        yield counts
    finally:
        discard(counts)


def occurrences(counts: DataFrame, key: str) -> DataFrame:
    """``(key, term, tf)``: a row per document and term."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            lengths, terms, tf = counted(part)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(lengths.size), lengths))), terms, pa.array(tf)], names=[key, "term", "tf"])

    return counts.select(key, "terms", "tf").mapInArrow(body, f"`{key}` {counts.schema[key].dataType.simpleString()}, term string, tf int")


def part_of(terms: pa.Array, parts: int) -> np.ndarray:
    """The part each term is dealt to, from its bytes by fixed weights of their places; equal terms meet in one, others may."""
    at = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    data = np.frombuffer(terms.buffers()[2], np.uint8)[at[0]:at[-1]].astype(np.uint64)
    place = np.arange(data.size) - np.repeat(at[:-1] - at[0], np.diff(at))
    sums = np.add.reduceat((data + np.uint64(1)) * PLACES[place % PLACES.size], at[:-1] - at[0])  # no term is empty
    sums ^= sums >> np.uint64(29)
    return ((sums * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def parts_of(counts: DataFrame) -> int:
    """The number of parts that terms are dealt to; it grows with the entries."""
    size = counts.select(F.sum(F.octet_length("tf"))).first()[0] or 0
    return max(1, -(-size // (4 * PART_TERMS)))


def dealt(terms: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the terms by part, the parts that have some, where each begins and ends)."""
    part = part_of(terms, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    use = np.flatnonzero(np.diff(cuts))
    return order, use, np.append(cuts[use], order.size).astype(np.int32)


def joined_terms(terms: pa.Array, order: np.ndarray, at: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at), terms.take(pa.array(order))), SEPARATOR)


def added_up(terms: pa.ChunkedArray, df: np.ndarray, cf: np.ndarray) -> pa.Table:
    """(term, df, cf) of distinct terms."""
    sums = pa.table({"term": terms, "df": df, "cf": cf}).group_by("term", use_threads=False).aggregate([("df", "sum"), ("cf", "sum")])
    return pa.table({"term": sums["term"].combine_chunks(), "df": sums["df_sum"].combine_chunks(), "cf": sums["cf_sum"].combine_chunks()})


def document_frequencies(counts: DataFrame, least: int) -> DataFrame:
    """``(term, df, cf)`` of the terms of at least ``least`` documents.

    Tasks add up their documents' terms and deal the sums to parts, whose number follows from the entries; a part's sums travel as a few values and are added where they meet.
    """
    parts = parts_of(counts)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            tf = np.concatenate([t for _, t in held]).astype(np.int64)
            sums = added_up(pa.chunked_array([t for t, _ in held]), np.ones(tf.size, np.int64), tf)
            order, use, at = dealt(sums["term"].chunk(0), parts)
            terms = joined_terms(sums["term"].chunk(0), order, at)
            numbers = [blocks_of(sums[c].to_numpy()[order].astype(np.int64), at) for c in ("df", "cf")]
            yield pa.RecordBatch.from_arrays([pa.array(use, pa.int32()), terms, *numbers], names=["part", "terms", "df", "cf"])

        for piece in sliced(batches):
            _, terms, tf = counted(piece)
            held.append((terms, tf))
            size += tf.size
            if size >= HELD_TERMS:
                yield from sent()
                held, size = [], 0
        if size:
            yield from sent()

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().to_batches()[0]
        sums = added_up(pa.chunked_array([pc.split_pattern(rows.column(1), SEPARATOR).flatten()]), numbers_of(rows.column(2), np.int64), numbers_of(rows.column(3), np.int64))
        return sums.filter(pc.greater_equal(sums["df"], least))

    sums = counts.select("terms", "tf").mapInArrow(body, "part int, terms string, df binary, cf binary")
    return sums.groupBy("part").applyInArrow(add, "term string, df bigint, cf bigint")


def vocabulary(counts: DataFrame, spec: TfidfSpec, size: Column | None = None) -> DataFrame:
    """``(term, df, cf, idf)`` from counted documents: the terms within the document-frequency bounds, or the ``max_features`` most frequent of them.

    Terms below the count that cannot make the cut are dropped before the final ordering, so the single task that
    merges the ordered heads sees little more than ``max_features`` rows however many terms there are.
    """
    size = counts.select(F.count(F.lit(1))).scalar() if size is None else size
    terms = document_frequencies(counts, spec.min_df)
    terms = terms.filter((F.col("df") >= spec.min_df) & (F.col("df") <= F.lit(spec.max_df) * size))
    idf = F.log((size + 1).cast("double") / (F.col("df") + 1)) + 1
    if spec.max_features is None:
        return terms.withColumn("idf", idf)
    terms = materialize(terms, "terms")
    by_count = terms.groupBy("cf").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("cf")).rowsBetween(Window.unboundedPreceding, 0))
    cut = by_count.withColumn("upto", upto).filter(F.col("upto") >= spec.max_features).select(F.max("cf")).scalar()
    kept = terms.filter(F.col("cf") >= F.coalesce(cut, F.lit(0))).orderBy(F.desc("cf"), "term").limit(spec.max_features)
    found = kept.withColumn("idf", idf)
    found.all_terms = terms
    return found


def raw_weight(tf, sublinear: bool):
    """Term frequency as the settings count it, before idf and length; for columns."""
    return F.log(tf.cast("double")) + 1 if sublinear else tf.cast("double")


class Weigher:
    """Unit-length TF-IDF of counted documents in a task, over a vocabulary in term order."""

    def __init__(self, terms: list[str], idf: np.ndarray, sublinear: bool):
        self.terms, self.idf, self.sublinear = pa.array(terms, pa.string()), idf, sublinear

    def __call__(self, lengths: np.ndarray, terms: pa.Array, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, term numbers, weights) of the documents' known terms."""
        found = pc.fill_null(pc.index_in(terms, self.terms), -1).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(lengths.size), lengths)
        known = np.flatnonzero(found >= 0)
        idx, rows = found[known].astype(np.int32), rows[known]
        x = tf[known].astype(float)
        x = (np.log(x) + 1 if self.sublinear else x) * self.idf[idx]
        norm = np.sqrt(np.bincount(rows, x * x, lengths.size))
        return np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=lengths.size))]), idx, x / norm[rows]


def vectors_of(counts: DataFrame, vocab: DataFrame, key: str, spec: TfidfSpec, names: bool, keep: Sequence[str] | None = None) -> DataFrame:
    """One unit-length sparse row per document with a known term: term numbers (``idx``), or the terms themselves, and weights. Columns to keep follow the key; then there
    is a row for every document, with nulls for one without known terms."""
    if spec.max_features is None:
        raise ValueError("only a vocabulary with a bound can be sent to every task")
    table = vocab.select("term", "idf", *(["idx"] if "idx" in vocab.columns else [])).orderBy("idx" if "idx" in vocab.columns else "term").toArrow()
    shared = counts.sparkSession.sparkContext.broadcast((table["term"].to_pylist(), table["idf"].to_numpy()))
    sublinear, column, kind = spec.sublinear, "terms" if names else "idx", "string" if names else "int"
    kept = [key, *(keep or ())]

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = Weigher(*shared.value, sublinear)
        for batch in sliced(batches):
            offsets, idx, x = weigh(*counted(batch))
            known = np.diff(offsets) > 0
            at = pa.array(offsets.astype(np.int32), mask=None if keep is None else np.append(~known, False))
            first = pa.ListArray.from_arrays(at, weigh.terms.take(pa.array(idx)) if names else pa.array(idx))
            rows = pa.RecordBatch.from_arrays([*batch.columns[:-2], first, pa.ListArray.from_arrays(at, pa.array(x))], names=[*kept, column, "x"])
            yield rows.filter(pa.array(known)) if keep is None else rows

    fields = ", ".join(f"`{n}` {counts.schema[n].dataType.simpleString()}" for n in kept)
    return counts.select(*kept, "terms", "tf").mapInArrow(body, f"{fields}, {column} array<{kind}>, x array<double>")


def doc_vectors(counts: DataFrame, vocab: DataFrame, key: str, spec: TfidfSpec, keep: Sequence[str] | None = None) -> DataFrame:
    """``(key, *keep, idx array<int>, x array<double>)``: one unit-length sparse row per document with a known term; with ``keep``, be it empty, one per document."""
    return vectors_of(counts, vocab, key, spec, names=False, keep=keep)


def weights(counts: DataFrame, vocab: DataFrame, key: str, spec: TfidfSpec) -> DataFrame:
    """``(key, term, x)`` with unit length per document."""
    if spec.max_features is not None:
        return vectors_of(counts, vocab, key, spec, names=True).select(key, F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("x"))))
    found = occurrences(counts, key).join(vocab.select("term", "idf"), "term")
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(key)))
    return found.select(key, "term", (raw_weight(F.col("tf"), spec.sublinear) * F.col("idf")).alias("x")).withColumn("x", F.col("x") / norm)


def least_df(vocab: DataFrame, most: int) -> int:
    """The smallest document frequency that no more than ``most`` terms reach; above all of them if there is none."""
    by_df = vocab.groupBy("df").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("df")).rowsBetween(Window.unboundedPreceding, 0))
    least = by_df.withColumn("upto", upto).where(F.col("upto") <= most).select(F.min("df")).first()[0]
    return (1 << 62) if least is None else least


def norms(counts: DataFrame, vocab: DataFrame, key: str, spec: TfidfSpec) -> DataFrame:
    """``(key, norm)``: length of every document with a known term; the vocabulary may have any size.

    Frequent terms, which make up most entries, are broadcast and added up where the documents lie. The others are dealt to parts by their term, as those of the
    vocabulary are, and a part sends one sum per document.
    """
    least, parts = least_df(vocab, HEAD_TERMS), parts_of(counts)
    head = vocab.where(F.col("df") >= least).select("term", "idf").toArrow()
    shared = counts.sparkSession.sparkContext.broadcast((head["term"].to_pylist(), head["idf"].to_numpy()))
    sublinear, of_key = spec.sublinear, to_arrow_type(counts.schema[key].dataType)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, idf = shared.value
        wanted = pa.array(names, pa.string())
        held, size = [], 0

        def listed(keys: pa.Array, values: pa.Array, at: np.ndarray) -> tuple[pa.Array, pa.Array]:
            return tuple(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), a) for a in (keys, values))

        def row(part: pa.Array, keys: pa.Array, terms: pa.Array, tf: pa.Array, squares: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part, keys, terms, tf, squares], names=["part", "keys", "terms", "tf", "squares"])

        def others() -> pa.RecordBatch:
            keys, terms = (pa.chunked_array([h[i] for h in held]).combine_chunks() for i in (0, 1))
            order, use, at = dealt(terms, parts)
            keys, _ = listed(keys.take(pa.array(order)), pa.nulls(order.size, pa.float64()), at)
            return row(pa.array(use, pa.int32()), keys, joined_terms(terms, order, at), blocks_of(np.concatenate([h[2] for h in held])[order], at), pa.nulls(use.size, pa.list_(pa.float64())))

        for piece in sliced(batches):
            lengths, terms, tf = counted(piece)
            found = pc.fill_null(pc.index_in(terms, wanted), -1).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(lengths.size), lengths)
            known, other = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
            x = tf[known].astype(float)
            x = (np.log(x) + 1 if sublinear else x) * idf[found[known]]
            some = np.unique(rows[known])
            keys, squares = listed(piece.column(0).take(pa.array(some)), pa.array(np.bincount(rows[known], x * x, lengths.size)[some]), np.array([0, some.size]))
            yield row(pa.nulls(1, pa.int32()), keys, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), squares)
            held.append((piece.column(0).take(pa.array(rows[other])), terms.take(pa.array(other)), tf[other]))
            size += other.size
            if size >= HELD_TERMS:
                yield others()
                held, size = [], 0
        if size:
            yield others()

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order, use, at = dealt(batch.column(0), parts)
                yield pa.RecordBatch.from_arrays([pa.array(use, pa.int32()), joined_terms(batch.column(0), order, at), blocks_of(batch.column(1).to_numpy()[order], at)], names=["part", "terms", "idf"])

    def squared(entries: pa.Table, terms: pa.Table) -> pa.Table:
        if not entries.num_rows or not terms.num_rows:
            return pa.table({key: pa.array([], of_key), "square": pa.array([], pa.float64())})
        entries, terms = (t.combine_chunks().to_batches()[0] for t in (entries, terms))
        found = pc.index_in(pc.split_pattern(entries.column("terms"), SEPARATOR).flatten(), pc.split_pattern(terms.column("terms"), SEPARATOR).flatten())
        found = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(found >= 0)
        x = numbers_of(entries.column("tf"), np.int32)[known].astype(float)
        x = (np.log(x) + 1 if sublinear else x) * numbers_of(terms.column("idf"), np.float64)[found[known]]
        sums = pa.table({key: entries.column("keys").flatten().take(pa.array(known)), "square": x * x}).group_by(key, use_threads=False).aggregate([("square", "sum")])
        return pa.table({key: sums[key], "square": sums["square_sum"]})

    kind = counts.schema[key].dataType.simpleString()
    entries = materialize(counts.select(key, "terms", "tf").mapInArrow(body, f"part int, keys array<{kind}>, terms string, tf binary, squares array<double>"), "norm_parts")
    shared.destroy()
    tail = vocab.where(F.col("df") < least).select("term", "idf").mapInArrow(rare, "part int, terms string, idf binary")
    more = entries.where("part IS NOT NULL").select("part", "keys", "terms", "tf").groupBy("part").cogroup(tail.groupBy("part")).applyInArrow(squared, f"`{key}` {kind}, square double")
    known = entries.where("part IS NULL").select(F.inline(F.arrays_zip(F.col("keys").alias(key), F.col("squares").alias("square"))))
    return known.unionByName(more).groupBy(key).agg(F.sqrt(F.sum("square")).alias("norm"))


def tfidf(docs: DataFrame, key: str, text: str, spec: TfidfSpec) -> DataFrame:
    counts = count_terms(docs, key, text, spec)
    return weights(counts, vocabulary(counts, spec), key, spec)


def numbered(vocab: DataFrame) -> DataFrame:
    """Vocabulary with term numbers from 0 in term order; at most ``max_features`` rows."""
    return vocab.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def numbered_vocabulary(counts: DataFrame, spec: TfidfSpec, name: str, size: Column | None = None) -> DataFrame:
    """The numbered vocabulary as a written table; the table of all terms that it was cut from is gone."""
    vocab = vocabulary(counts, spec, size)
    written = materialize(numbered(vocab), name)
    discard(vocab.all_terms)
    return written
