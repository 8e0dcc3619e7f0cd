"""Trailing-baseline spikes and the emerging-issue score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casemill.operators.metrics import monthly_counts, top_n


def detect_spikes(df: DataFrame, group: str = "product", min_history: int = 6, window: int = 12,
                  threshold: float = 2.0) -> DataFrame:
    """Monthly counts of each non-null group against the mean and population deviation of the rows before.

    The baseline covers up to ``window`` observed months before the current one and is null below ``min_history``.
    A constant baseline gives a null score, and a null score is no spike.
    """
    counts = monthly_counts(df.filter(F.col(group).isNotNull()), group)
    before = Window.partitionBy(group).orderBy("month").rowsBetween(-window, -1)
    enough = F.count("complaints").over(before) >= min_history
    return counts.withColumns({
        "baseline_mean": F.when(enough, F.avg("complaints").over(before)),
        "baseline_std": F.when(enough, F.stddev_pop("complaints").over(before)),
    }).withColumn(
        "z_score", F.try_divide(F.col("complaints") - F.col("baseline_mean"), F.nullif(F.col("baseline_std"), F.lit(0.0)))
    ).withColumn("spike_flag", F.coalesce(F.col("z_score") >= threshold, F.lit(False)))


def emerging_scores(df: DataFrame, group: str = "issue") -> DataFrame:
    """Scores of the latest month: 0.65 x positive z-score + 0.35 x volume relative to the largest group."""
    spikes = detect_spikes(df, group, min_history=4)
    latest = spikes.filter(F.col("month") == spikes.select(F.max("month")).scalar())
    largest = latest.select(F.max("complaints")).scalar()
    return latest.withColumns({
        "growth_component": F.greatest(F.coalesce("z_score", F.lit(0.0)), F.lit(0.0)),
        "volume_component": F.try_divide(F.col("complaints").cast("double"), largest.cast("double")),
    }).withColumn(
        "emerging_issue_score", F.bround(0.65 * F.col("growth_component") + 0.35 * F.col("volume_component"), 3)
    )


def anomaly_summary(df: DataFrame, group: str = "issue", n: int = 5) -> DataFrame:
    """The n highest emerging-issue scores."""
    return top_n(emerging_scores(df, group), "emerging_issue_score", group, n=n)
