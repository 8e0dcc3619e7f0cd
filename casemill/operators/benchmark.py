"""Company benchmark with optional normalisation by financial scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casemill.fixed import NO_SCALE_NOTE, SCALE_NOTE
from casemill.operators.metrics import timely_share, top_n

SCALE_COLUMNS = [
    "cfpb_company_name", "canonical_company_name", "sec_cik", "ticker", "confidence_tier", "manual_review_required",
    "scale_fiscal_year", "assets", "revenue", "normalization_allowed",
]


def company_base(complaints: DataFrame) -> DataFrame:
    """Per company: complaints with an id, distinct products, narratives, timely share over all rows."""
    return complaints.groupBy("company").agg(
        F.count("complaint_id").alias("raw_complaints"), F.count_distinct("product").alias("products"),
        F.count("consumer_complaint_narrative").alias("narrative_count"), timely_share().alias("timely_rate"),
    )


def benchmark_page(benchmark: DataFrame, n: int = 200) -> DataFrame:
    """The companies with most complaints, in order: ``n`` is the length of the page."""
    return top_n(benchmark, "raw_complaints", "company", n=n)


def company_benchmark(complaints: DataFrame, scale: DataFrame | None = None) -> DataFrame:
    """Benchmark rows, joined to scale metrics where given. Order by ``raw_complaints`` at the point of use.

    Both sides hold one row per company after aggregation, so the join cannot be skewed; Spark broadcasts the
    scale side on its own when its measured size allows it.
    """
    base = company_base(complaints)
    if scale is None:
        return base.withColumn("normalization_note", F.lit(NO_SCALE_NOTE))
    kept = [c for c in SCALE_COLUMNS if c in scale.columns]
    joined = base.join(scale.select(kept), F.col("company") == F.col("cfpb_company_name"), "left")
    if "normalization_allowed" in kept:
        allowed = F.coalesce(F.col("normalization_allowed"), F.lit(False))
    else:
        allowed = F.col("cfpb_company_name").isNotNull()

    def per_billion(column: str):
        if column not in kept:
            return F.lit(None).cast("double")
        amount = F.col(column).try_cast("double")
        return F.when(allowed & (amount > 0), F.col("raw_complaints") / (amount / 1e9))

    return joined.withColumns({
        "complaints_per_1b_assets": per_billion("assets"), "complaints_per_1b_revenue": per_billion("revenue"),
        "normalization_note": F.lit(SCALE_NOTE),
    })
