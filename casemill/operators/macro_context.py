"""Complaint volume against macro series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.fixed import MACRO_CAVEAT, MACRO_LAGS
from casemill.functions.columns import month
from casemill.operators.metrics import monthly_counts
from casemill.sources.macro import series_description


def monthly_series(observations: DataFrame) -> DataFrame:
    """Mean value per series and month."""
    dated = observations.withColumn("month", month(F.col("date").cast("string").try_cast("date")))
    return dated.filter(F.col("month").isNotNull() & F.col("series_id").isNotNull()).groupBy("series_id", "month") \
        .agg(F.avg("value").alias("value"))


def join_months(complaints: DataFrame, observations: DataFrame) -> DataFrame:
    """``(series_id, month, complaints, value)`` of the months both sides have."""
    return monthly_series(observations).join(monthly_counts(complaints), "month").filter(F.col("value").isNotNull())


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: correlation from co-moments, null for constant input where ``corr`` would fail."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def lagged_correlation(complaints: DataFrame, observations: DataFrame, lags: Sequence[int] = MACRO_LAGS,
                       min_months: int = 12) -> DataFrame:
    """Correlation per series and lag, in joined-row order; series below ``min_months`` joined months are dropped."""
    joined = join_months(complaints, observations)
    by_series = Window.partitionBy("series_id")
    ordered = by_series.orderBy("month")
    lagged = F.array(*[
        F.struct(F.lit(k).cast("bigint").alias("lag_months"), (F.lag("value", k).over(ordered) if k else F.col("value")).alias("v"))
        for k in lags
    ])
    rows = joined.withColumn("lagged", lagged).withColumn("months", F.count(F.lit(1)).over(by_series)) \
        .filter(F.col("months") >= min_months).select("series_id", "complaints", F.inline("lagged"))
    y = F.when(F.col("v").isNotNull(), F.col("complaints").cast("double"))
    return rows.groupBy("series_id", "lag_months").agg(
        pearson(F.col("v"), y).alias("correlation"), F.count("v").alias("paired_months")
    ).withColumns({"description": series_description(F.col("series_id")), "caveat": F.lit(MACRO_CAVEAT)})
