"""Retrieval evaluation: per-question checks and their roll-up."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed import CITATION_MARKS, EVIDENCE_TEXT_COLUMNS
from casemill.functions.columns import share
from casemill.operators.search import lexical_search


def term_recall_report(docs: DataFrame, questions: DataFrame, k: int = 5) -> DataFrame:
    """Older evaluation: share of expected terms found in the text of the top-k documents of each question."""
    top = lexical_search(docs, questions, k).join(docs.select("complaint_id", F.lower("clean_narrative").alias("text")), "complaint_id")
    # k documents per question, so the grouped text is bounded by k texts.
    found = top.groupBy("question_id").agg(
        F.count(F.lit(1)).alias("retrieved_records"), F.count("complaint_id").alias("citable"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda r: r["text"]), " ").alias("combined"),
    )
    hits = F.size(F.filter("expected_terms", lambda t: F.contains("combined", t)))
    citable = F.coalesce(F.col("citable"), F.lit(0)) > 0
    return questions.join(found, "question_id", "left").select(
        "question_id", "question", F.coalesce("retrieved_records", F.lit(0)).alias("retrieved_records"),
        citable.alias("has_citable_complaint_ids"),
        F.coalesce(F.try_divide(hits.cast("double"), F.size("expected_terms")), F.lit(0.0)).alias("term_recall"),
        citable.alias("groundedness_gate"),
    )


def _any_term(text: Column) -> Column:
    return F.exists("expected_terms", lambda t: F.contains(text, F.lower(t)))


def question_report(evidence: DataFrame, questions: DataFrame, traces: DataFrame, k_values: tuple[int, ...] = (5, 10)) -> DataFrame:
    """Checks per question from ranked evidence (one row per question, rank and document).

    Every check is a boolean of one evidence row, so a question's rows reduce with ``bool_or`` while combining; the
    texts themselves are not grouped. An abstain question passes when its filters leave no candidate.
    """
    checked = evidence.join(questions.select(
        "question_id", "expected_terms", "expected_product", "expected_issue", "expected_company"), "question_id")
    row_text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in EVIDENCE_TEXT_COLUMNS]))
    hits = {"term": _any_term(row_text)}
    for field in ("product", "company", "issue"):
        hits[field] = F.coalesce(F.lower(field) == F.lower(f"expected_{field}"), F.lit(False))
    aggregates = [F.count(F.lit(1)).alias("retrieved_count"), F.bool_and(F.col("complaint_id").isNotNull()).alias("all_cited")]
    for k in k_values:
        aggregates += [F.bool_or(hit & (F.col("rank") <= k)).alias(f"{name}_{k}") for name, hit in hits.items()]
    found = checked.groupBy("question_id").agg(*aggregates)
    rows = questions.join(found, "question_id", "left").join(traces.select("question_id", "candidate_count"), "question_id", "left")

    def true(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    abstain = F.col("expected_behavior") == "abstain"
    retrieved = F.coalesce("retrieved_count", F.lit(0))
    abstain_pass = abstain & (F.coalesce("candidate_count", F.lit(0)) == 0) & (retrieved == 0)
    has_terms = F.size("expected_terms") > 0
    most = max(k_values)

    def recall(k: int) -> Column:
        wanted = {"term": has_terms, **{f: F.coalesce(F.col(f"expected_{f}"), F.lit("")) != "" for f in ("product", "company", "issue")}}
        checks, any_check = F.lit(True), F.lit(False)
        for name, asked in wanted.items():
            checks, any_check = checks & (~asked | true(f"{name}_{k}")), any_check | asked
        return F.when(abstain, abstain_pass).when(any_check, checks).otherwise(retrieved > 0)

    return rows.select(
        "question_id", "expected_behavior", retrieved.alias("retrieved_count"),
        (abstain_pass | ((retrieved > 0) & true("all_cited"))).alias("citation_valid"),
        (~has_terms | true(f"term_{most}")).alias("expected_term_hit"),
        *[recall(k).alias(f"recall_at_{k}") for k in k_values],
    )


def answer_citation_rate(answers: DataFrame) -> DataFrame:
    """One row: share of answers that cite a complaint or a metric."""
    cites = reduce(operator.or_, [F.col("answer").contains(mark) for mark in CITATION_MARKS])
    return answers.agg(F.avg(F.when(cites, 1.0).otherwise(0.0)).alias("answer_citation_presence_rate"))


def roll_up(report: DataFrame, k_values: tuple[int, ...] = (5, 10)) -> DataFrame:
    """One row: question count and the share of questions that pass each check."""
    flags = [*[f"recall_at_{k}" for k in k_values], "citation_valid", "expected_term_hit"]
    names = {"citation_valid": "citation_validity_rate", "expected_term_hit": "expected_term_hit_rate"}
    return report.agg(F.count(F.lit(1)).alias("question_count"), *[share(F.col(f)).alias(names.get(f, f)) for f in flags])
