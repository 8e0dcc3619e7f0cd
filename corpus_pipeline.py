"""The corpus pipeline: language ID, quality, line dedup, near duplicates, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
documents. All but the last keep the columns of ``documents``. Rows that a stage keeps are whole, but for the lines that the line stage deletes.

Null and repeated ids: every stage judges row by row, so a row's fate is its own whatever its id. The line stage counts rows that repeat id and text as
one. Of similar rows the one with the smallest id stays, null last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import language, line_dedup, ngram_join, packing, quality
from casemill.llm.arrow import unused
from casemill.llm.queries import BYTE_VOCABULARY, GOOD, SHINGLE_WORDS, SIMILAR, table, vocabulary
from casemill.session import materialize_plain as materialize

SEQUENCE, END_ID = 1024, 0


def digest(text: str) -> F.Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; texts without letters go.

    The verdict on a row follows from its text and its source, so rejected rows are known by these. They are a written table: Spark knows its size and
    broadcasts it only if it is small.
    """
    model = language.fit(docs, "doc_id", "text", "lang")
    rows = language.of_document(docs).withColumn("digest", digest("text"))
    found = language.identify(rows.select("digest", "text", "declared", "host", "suffix"), model)
    rejected = materialize(found.where("NOT accepted").select(F.col("digest").alias("gone"), "host").distinct(), "rejected")
    kept = docs.where("text IS NOT NULL AND text <> ''").alias("docs")
    return kept.join(rejected.alias("rejected"), (digest("docs.text") == F.col("rejected.gone")) & F.col("docs.source").eqNullSafe(F.col("rejected.host")), "left_anti") \
        .select(*(F.col(f"docs.`{c}`") for c in docs.columns))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as good; the text alone decides."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    name = unused(docs.columns, "score")
    return quality.score(docs, model, name=name, keep_text=True).where(F.col(name) >= GOOD).select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; n_chars follows the new text. Documents of which nothing is left go."""
    lines, gone = unused(docs.columns, "lines"), unused(docs.columns, "gone")
    cut = line_dedup.dedup(docs, n_lines=lines, n_deleted=gone).where((F.col(gone) == 0) | (F.col(gone) < F.col(lines)))
    return cut.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: the one with the smallest id, null last."""
    row = unused(docs.columns, "row")
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    similar = ngram_join.similar(keyed, SHINGLE_WORDS, SIMILAR, doc_id=row).where("n_links > 0").select(F.col("doc_id").alias(row), "class_id")
    members = materialize(similar.join(keyed.select(row, "doc_id"), row), "similar")
    first = members.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", row)).alias("first")).select(F.col(f"first.{row}").alias(row))
    dropped = materialize(members.select(row).join(materialize(first, "first"), row, "left_anti"), "dropped")
    # A merge join at any size: the texts move once, which suits rows that grow with the documents.
    return keyed.join(dropped.hint("merge"), row, "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack(docs, vocabulary(BYTE_VOCABULARY), END_ID, SEQUENCE)


STAGES = [
    ("language", identified), ("quality", good), ("line_dedup", without_repeated_lines), ("ngram_join", one_of_each_group), ("packing", packed)]

# The stages fit models and tokenise: SQL cannot express them. Tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
