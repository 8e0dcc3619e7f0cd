"""Company scale metrics from financial facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.fixed import CONCEPTS, HIGH, SCALE_NOTE


def is_full_year() -> Column:
    return F.upper("fiscal_period") == "FY"


def prefer_annual(facts: DataFrame) -> DataFrame:
    """Full-year facts; for a company that has none at all, its annual reports instead."""
    has_year = facts.groupBy("sec_cik", "company").agg(F.bool_or(is_full_year()).alias("has_year")).alias("y")
    same = F.expr("f.sec_cik <=> y.sec_cik AND f.company <=> y.company")  # documents may lack a name
    return facts.alias("f").join(has_year, same).select("f.*", "has_year") \
        .filter(F.when(F.col("has_year"), is_full_year()).otherwise(F.col("form") == "10-K")).drop("has_year")


def resolve_facts(facts: DataFrame, prefer: str = "last") -> DataFrame:
    """One annual fact per company, metric and year.

    ``prefer="last"`` takes the highest concept number and then the latest filing; ``"first"`` takes the lowest
    concept number, i.e. the one listed as most wanted. Greatest-per-group is a ``max_by`` aggregate, which
    combines on the map side and needs no sort. The best full-year and the best annual-report fact are both kept
    until the small per-year table says which kind the company has, so the facts are shuffled once, combined.
    """
    priority = F.col("concept_priority") if prefer == "last" else -F.col("concept_priority")
    payload = F.struct("fiscal_period", "form", "filed_date", "xbrl_concept", "unit", "value", "accession")

    def best(kind: Column) -> Column:
        order = F.struct(priority, F.col("filed_date"), F.col("period_end"), F.col("accession"), F.col("value"))
        return F.max_by(payload, F.when(kind, order))

    yearly = facts.groupBy("company", "sec_cik", "fiscal_year", "metric_name").agg(
        best(is_full_year()).alias("by_year"), best(F.col("form") == "10-K").alias("by_form")
    )
    has_year = F.bool_or(F.col("by_year").isNotNull()).over(Window.partitionBy("sec_cik", "company"))
    return yearly.withColumn("f", F.when(has_year, F.col("by_year")).otherwise(F.col("by_form"))) \
        .filter(F.col("f").isNotNull()).select("company", "sec_cik", "fiscal_year", "metric_name", "f.*")


def latest_values(lineage: DataFrame) -> DataFrame:
    """Newest value per company and metric, by fiscal year and then filing date."""
    order = F.struct("fiscal_year", "filed_date", "accession")
    return lineage.groupBy("sec_cik", "metric_name").agg(
        F.max_by("value", order).alias("value"), F.max("fiscal_year").alias("fiscal_year")
    )


def scale_table(lineage: DataFrame, entity_map: DataFrame) -> DataFrame:
    """Entity map with one column per metric, the newest fiscal year over all metrics, and the normalisation gate."""
    latest = latest_values(lineage)
    wide = latest.groupBy("sec_cik").agg(
        *[F.max(F.when(F.col("metric_name") == m, F.col("value"))).alias(m) for m in sorted(CONCEPTS)],
        F.max("fiscal_year").alias("scale_fiscal_year"),
    )
    allowed = (
        F.coalesce(F.col("confidence_tier") == HIGH, F.lit(False))
        & (F.col("assets").isNotNull() | F.col("revenue").isNotNull())
        & ~F.coalesce("manual_review_required", F.lit(True))
    )
    return entity_map.join(wide, "sec_cik", "left").withColumns({
        "normalization_allowed": allowed, "normalization_note": F.lit(SCALE_NOTE),
    })


def company_lineage(lineage: DataFrame, entity_map: DataFrame) -> DataFrame:
    """Resolved facts of accepted companies, tagged with their names and ticker."""
    accepted = entity_map.filter(F.col("confidence_tier") == HIGH) \
        .select("sec_cik", "cfpb_company_name", "canonical_company_name", "ticker")
    return lineage.join(accepted, "sec_cik")


def lineage_status(lineage: DataFrame, entity_map: DataFrame) -> DataFrame:
    """Accepted companies, registrants with facts, and distinct company-years."""
    requested = entity_map.select(F.count_if(F.col("confidence_tier") == HIGH)).scalar()
    return lineage.agg(
        F.count_distinct("sec_cik").alias("registrants_with_observations"),
        F.count_distinct("sec_cik", "fiscal_year").alias("company_year_observations"),
    ).withColumn("companies_requested", requested)
