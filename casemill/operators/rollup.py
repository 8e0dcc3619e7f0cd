"""Final metric record from many tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed import DEFAULT_HOURLY_WAGE
from casemill.operators import governance, metrics, value


def _one(df: DataFrame) -> Column:
    """A one-row frame as a struct column."""
    return df.select(F.struct(*df.columns)).scalar()


def final_metrics(complaints: DataFrame, opportunities: DataFrame, topics: DataFrame | None = None, evaluation: DataFrame | None = None,
                  router: DataFrame | None = None, index: DataFrame | None = None, text: str = "Credit reporting") -> DataFrame:
    """One row: KPIs, opportunity and governance counts, baseline value, and whichever optional records are given.

    Every part is a one-row aggregate read as a scalar, so nothing is joined.
    """
    kpis = metrics.kpi_summary(complaints)
    catalog = governance.governance_catalog(opportunities)
    parts = {"g": governance.control_count(catalog), "o": opportunities.agg(F.count(F.lit(1)).alias("opportunities"))}
    if topics is not None:
        parts["t"] = topics.agg(F.count(F.lit(1)).alias("topics"), F.coalesce(F.sum("volume"), F.lit(0)).alias("topic_narrative_volume"))
    if evaluation is not None:
        parts["e"] = evaluation
    if router is not None:
        parts["r"] = router.select(F.col("records").alias("routing_model_records"), F.col("classes").alias("routing_model_classes"),
                                   "baseline_macro_f1", "model_macro_f1")
    if index is not None:
        parts["i"] = index.select("indexed_narratives")
    states = complaints.select(F.struct(F.count_distinct("state").alias("states"), F.count_if(F.lower("product").contains(text.lower()))
                                        .alias("matching_product_volume"))).scalar()
    row = kpis.withColumns({"s": states, **{name: _one(part) for name, part in parts.items()}})
    row = value.calculate_value(row.withColumns({"observed_complaints": F.col("complaints"), "hourly_wage": F.lit(DEFAULT_HOURLY_WAGE)}))
    share = F.bround(F.coalesce(F.try_divide(F.col("narratives").cast("double"), F.col("complaints")), F.lit(0.0)), 4)
    return row.select(
        F.col("complaints").alias("record_count"), "date_min", "date_max", "companies", "products", "issues", "s.*", "narratives",
        share.alias("narrative_share"), *[f"{name}.*" for name in parts],
        F.col("estimated_annual_capacity_value").alias("baseline_estimated_annual_capacity_value"),
        F.col("three_year_net_value").alias("baseline_three_year_net_value"),
    )
