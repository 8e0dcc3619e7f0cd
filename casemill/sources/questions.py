"""Retrieval evaluation sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

FILTER_FIELDS = ["company", "product", "issue", "state", "date_start", "date_end"]
QUESTION_SCHEMA = T.StructType([
    T.StructField("question_id", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("expected_product", T.StringType()),
    T.StructField("expected_issue", T.StringType()),
    T.StructField("expected_company", T.StringType()),
    T.StructField("expected_terms", T.ArrayType(T.StringType())),
    T.StructField("expected_behavior", T.StringType()),
    T.StructField("filters", T.StructType([T.StructField(f, T.StringType()) for f in FILTER_FIELDS])),
])


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """JSON question set; the explicit schema drops unknown filter keys."""
    return with_defaults(spark.read.schema(QUESTION_SCHEMA).option("multiLine", True).json(path))


def with_defaults(questions: DataFrame) -> DataFrame:
    return questions.withColumns({
        "expected_behavior": F.coalesce("expected_behavior", F.lit("retrieve")),
        "expected_terms": F.coalesce("expected_terms", F.array().cast("array<string>")),
    })


def split_terms(col: F.Column) -> F.Column:
    """``|``-separated expected terms, lower-cased, blanks dropped."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), r"\|"), lambda t: F.lower(F.trim(t)))
    return F.filter(parts, lambda t: t != "")


def read_question_csv(spark: SparkSession, path: str) -> DataFrame:
    """Older question set: CSV with ``|``-separated evidence terms."""
    schema = "question_id string, question string, expected_evidence_terms string, answer_must_include string"
    rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.withColumn("expected_terms", split_terms(F.col("expected_evidence_terms")))
