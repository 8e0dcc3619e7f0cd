"""Governance catalog and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed import (
    CATALOG_TEXT, CONTROL_LIBRARY, DEFAULT_CONTROLS, RISK_NAME_TERMS, TRUSTWORTHY_DIMENSIONS,
)


def risk_tier(name: Column, impact: Column | str = "medium", uses_genai: Column | bool = True) -> Column:
    """Additive score of impact, generative use and name terms, as High, Moderate or Low."""
    impact = F.lit(impact) if isinstance(impact, str) else impact
    uses_genai = F.lit(uses_genai) if isinstance(uses_genai, bool) else uses_genai
    named = F.lit(False)
    for term in RISK_NAME_TERMS:
        named = named | F.lower(name).contains(term)
    score = (
        F.lit(1) + F.when(impact == "high", 2).when(impact == "medium", 1).otherwise(0)
        + F.when(uses_genai, 1).otherwise(0) + F.when(named, 1).otherwise(0)
    )
    return F.when(score >= 5, "High").when(score >= 3, "Moderate").otherwise("Low")


def recommended_controls(name: Column) -> Column:
    """Controls of the use case joined by ``|``; an unknown name gets the default set."""
    joined = {k: " | ".join(v) for k, v in CONTROL_LIBRARY.items()}
    options = [F.when(name == k, F.lit(v)) for k, v in joined.items()]
    return F.coalesce(*options, F.lit(joined[DEFAULT_CONTROLS]))


def governance_catalog(opportunities: DataFrame, order: str = "supporting_data") -> DataFrame:
    """One row per use case: that of the opportunity with the largest ``order`` value."""
    first = opportunities.groupBy(F.col("opportunity_name").alias("ai_use_case")).agg(
        F.max_by(
            F.struct(F.col("potential_ai_intervention").alias("intended_purpose"), F.col("risk_considerations").alias("major_risks")),
            F.struct(order, "potential_ai_intervention"),
        ).alias("o")
    )
    return first.select(
        "ai_use_case", "o.intended_purpose", "o.major_risks", risk_tier(F.col("ai_use_case")).alias("risk_tier"),
        F.lit(", ".join(TRUSTWORTHY_DIMENSIONS)).alias("nist_dimensions"),
        recommended_controls(F.col("ai_use_case")).alias("recommended_controls"),
        *[F.lit(text).alias(column) for column, text in CATALOG_TEXT.items()],
    )


def control_count(catalog: DataFrame) -> DataFrame:
    """Use cases and the number of their recommended controls."""
    return catalog.agg(
        F.count_distinct("ai_use_case").alias("governance_use_cases"),
        F.coalesce(F.sum(F.size(F.split("recommended_controls", r"\|"))), F.lit(0)).alias("governance_controls"),
    )


def severity(risks: DataFrame) -> DataFrame:
    return risks.withColumn("severity", F.col("likelihood") * F.col("impact"))


def distinct_list_items(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct trimmed items of a comma-separated column."""
    items = df.select(F.explode(F.split(column, ",")).alias("item"))
    return items.agg(F.count_distinct(F.trim("item")).alias("items"))


def join_catalog(opportunities: DataFrame, catalog: DataFrame) -> DataFrame:
    """Opportunities with the tier and controls of their use case, the first catalog row per use case."""
    unique = catalog.groupBy(F.col("ai_use_case").alias("opportunity_name")).agg(
        F.min_by(F.struct("risk_tier", "recommended_controls"), "intended_purpose").alias("c")
    )
    return opportunities.join(unique, "opportunity_name", "left").select(
        *opportunities.columns, "c.risk_tier", "c.recommended_controls"
    )
