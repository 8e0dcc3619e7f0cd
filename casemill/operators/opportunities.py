"""Improvement opportunities from frequent product and issue pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed import DEFAULT_OPPORTUNITY, OPPORTUNITY_PATTERNS, OPPORTUNITY_TEXT
from casemill.functions.columns import or_missing
from casemill.operators.metrics import complaint_count, top_n


def pair_counts(complaints: DataFrame, n: int = 30) -> DataFrame:
    """The n most frequent (product, issue) pairs; nulls are a value of their own."""
    counts = complaints.groupBy("product", "issue").agg(complaint_count(complaints).alias("observed_complaints"))
    return top_n(counts, "observed_complaints", "product", "issue", n=n)


def match_pattern(text: Column) -> Column:
    """Struct of name and intervention of the first pattern with a keyword in the text, else the default."""
    def found(name: str, intervention: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(intervention).alias("intervention"))

    options = []
    for name, keywords, intervention in OPPORTUNITY_PATTERNS:
        hit = F.lit(False)
        for keyword in keywords:
            hit = hit | text.contains(keyword)
        options.append(F.when(hit, found(name, intervention)))
    return F.coalesce(*options, found(*DEFAULT_OPPORTUNITY))


def derive_opportunities(complaints: DataFrame, emerging: DataFrame | None = None, n: int = 30) -> DataFrame:
    """One row per frequent pair with its matched opportunity; ``emerging`` adds the score of the issue."""
    pairs = pair_counts(complaints, n)
    product, issue = or_missing(F.col("product")), or_missing(F.col("issue"))
    rows = pairs.withColumn("m", match_pattern(F.lower(F.concat_ws(" ", product, issue)))).select(
        F.col("m.name").alias("opportunity_name"),
        F.concat(F.lit("High complaint volume for "), product, F.lit(" / "), issue).alias("observed_problem"),
        F.col("observed_complaints").alias("supporting_data"), F.col("product").alias("affected_products"),
        F.col("issue").alias("affected_issues"), F.col("m.intervention").alias("potential_ai_intervention"),
        *[F.lit(text).alias(column) for column, text in OPPORTUNITY_TEXT.items()],
    )
    if emerging is None:
        return rows
    scores = emerging.select(F.col("issue").alias("affected_issues"), F.col("emerging_issue_score").alias("score"))
    return rows.join(scores, "affected_issues", "left") \
        .withColumn("emerging_issue_signal", F.coalesce("score", F.lit(0.0))).drop("score")
