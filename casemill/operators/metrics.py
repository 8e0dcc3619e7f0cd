"""KPI, volume, share, growth and response metrics.

Every metric first aggregates with map-side partial aggregation; windows run on the small aggregate only, so a
group holding a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.fixed import ANALYTICS_CITATIONS
from casemill.functions.columns import is_yes, month, or_missing, ratio, share
from casemill.functions.filters import CaseFilters, apply_filters


def top_n(df: DataFrame, count: str, *ties: str, n: int) -> DataFrame:
    """The n largest rows by ``count``; ties by name, nulls last."""
    return df.orderBy(F.desc(count), *[F.asc_nulls_last(t) for t in ties]).limit(n)


def kpi_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: rows, distinct companies, products and issues, narratives, first and last day."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct

    def count_of(name: str, column: str, aggregate) -> Column:
        return (aggregate(F.col(column)) if column in df.columns else F.lit(0).cast("bigint")).alias(name)

    return df.agg(
        F.count(F.lit(1)).alias("complaints"),
        count_of("companies", "company", distinct), count_of("products", "product", distinct),
        count_of("issues", "issue", distinct), count_of("narratives", "consumer_complaint_narrative", F.count),
        F.to_date(F.min("date_received")).alias("date_min"), F.to_date(F.max("date_received")).alias("date_max"),
    )


PARTIAL = "partial_count"  # column of tables whose rows stand for several complaints


def complaint_count(df: DataFrame) -> Column:
    """Complaints of a group: its rows, or the sum of its partial counts."""
    return F.sum(PARTIAL) if PARTIAL in df.columns else F.count(F.lit(1))


def monthly_partials(df: DataFrame, *groups: str) -> DataFrame:
    """``(date_received, *groups, partial_count)``: complaints by month and groups, dated by the month's first day.

    Counts by month, year, group or pair give the same result from this table as from the complaints, and the partials of a month depend on that month only.
    """
    first = F.date_trunc("month", "date_received").cast("timestamp_ntz").alias("date_received")
    return df.groupBy(first, *groups).agg(complaint_count(df).alias(PARTIAL))


def monthly_counts(df: DataFrame, *groups: str) -> DataFrame:
    """Complaints per observed month and group; undated rows dropped, null groups kept. Partial counts may stand for the rows."""
    dated = df.withColumn("month", month(F.col("date_received"))).filter(F.col("month").isNotNull())
    return dated.groupBy("month", *groups).agg(complaint_count(df).alias("complaints"))


def volume_by_month(df: DataFrame, group: str | None = None) -> DataFrame:
    """Monthly volume with the mean of the last three observed months; null for the null group."""
    counts = monthly_counts(df, *([group] if group else []))
    frame = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy("month").rowsBetween(-2, 0)
    rolling = F.avg("complaints").over(frame)
    return counts.withColumn("rolling_3m", F.when(F.col(group).isNotNull(), rolling) if group else rolling)


def top_categories(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """The n largest categories with their share of all rows; an unknown column gives an empty frame."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{column}` string, complaints bigint, share double")
    counts = df.groupBy(or_missing(F.col(column)).alias(column)).agg(complaint_count(df).alias("complaints"))
    total = counts.select(F.sum("complaints")).scalar()
    return top_n(counts, "complaints", column, n=n).withColumn("share", ratio(F.col("complaints"), total))


def top_series(df: DataFrame, group: str, n: int = 5) -> DataFrame:
    """Monthly volume of the n largest categories only."""
    volume = volume_by_month(df, group)
    return volume.join(top_categories(df, group, n).select(group), group, "left_semi")


def yoy_growth(df: DataFrame, group: str) -> DataFrame:
    """Yearly counts with growth against the previous observed year of the group."""
    counts = df.groupBy(group, F.year("date_received").alias("year")).agg(complaint_count(df).alias("complaints"))
    prior = F.lag("complaints").over(Window.partitionBy(group).orderBy(F.asc_nulls_last("year")))
    return counts.withColumn("prior_year", F.when(F.col(group).isNotNull(), prior)).withColumn(
        "yoy_growth",
        F.when(F.col("prior_year") > 0, ratio(F.col("complaints") - F.col("prior_year"), F.col("prior_year"))),
    )


def contains_count(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column contains the text, ignoring case."""
    return df.agg(F.count_if(F.lower(F.col(column)).contains(text.lower())).alias("complaints"))


def complaint_volume(df: DataFrame, filters: CaseFilters | None = None) -> DataFrame:
    return apply_filters(df, filters).agg(
        F.count(F.lit(1)).alias("complaints"), F.to_date(F.min("date_received")).alias("date_min"),
        F.to_date(F.max("date_received")).alias("date_max"),
    ).withColumn("citation", F.lit(ANALYTICS_CITATIONS["complaint_volume"]))


def top_issues(df: DataFrame, filters: CaseFilters | None = None, n: int = 5) -> DataFrame:
    return top_categories(apply_filters(df, filters), "issue", n)


def _growth_of(recent: Column, prior: Column, history: Column, months: int) -> list[Column]:
    enough = history >= 2 * months
    return [
        F.when(enough, F.lit("ok")).otherwise(F.lit("insufficient_history")).alias("status"),
        F.lit(months).cast("bigint").alias("months"), F.when(enough, recent).alias("recent_complaints"),
        F.when(enough, prior).alias("prior_complaints"), F.when(enough, ratio(recent - prior, prior)).alias("growth_rate"),
    ]


def growth_rate(df: DataFrame, filters: CaseFilters | None = None, months: int = 6) -> DataFrame:
    """The last observed months against as many before; one row, with a status when history is too short."""
    counts = monthly_counts(apply_filters(df, filters))
    ranked = counts.withColumn("age", F.row_number().over(Window.orderBy(F.desc("month"))))
    sums = ranked.agg(
        F.coalesce(F.sum(F.when(F.col("age") <= months, F.col("complaints"))), F.lit(0)).alias("recent"),
        F.coalesce(F.sum(F.when(F.col("age").between(months + 1, 2 * months), F.col("complaints"))), F.lit(0)).alias("prior"),
        F.count(F.lit(1)).alias("history"),
    )
    return sums.select(*_growth_of(F.col("recent"), F.col("prior"), F.col("history"), months)) \
        .withColumn("citation", F.lit(ANALYTICS_CITATIONS["growth_rate"]))


def response_metrics(df: DataFrame, filters: CaseFilters | None = None, n: int = 5) -> DataFrame:
    """One row: timely share over all rows and a map of the n most frequent responses.

    One aggregate per response value gives both, so the rows are read once.
    """
    per_response = apply_filters(df, filters).groupBy(or_missing(F.col("company_response_to_consumer")).alias("response")) \
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_yes(F.col("timely_response"))).alias("timely"))
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "response"))
    top = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("rank") <= n, F.struct("response", "n")))))
    return per_response.withColumn("rank", rank).agg(
        F.when(F.count(F.lit(1)) > 0, F.lit("ok")).otherwise(F.lit("no_records")).alias("status"),
        ratio(F.sum("timely"), F.sum("n")).alias("timely_response_rate"), top.alias("top_responses"),
    ).withColumn("citation", F.lit(ANALYTICS_CITATIONS["response_metrics"]))


def default_analytics(df: DataFrame, filters: CaseFilters | None = None, months: int = 6, n: int = 5) -> DataFrame:
    """Volume, growth, top issues and response metrics in one row, from a single pass over the filtered rows.

    The pass counts by (month, issue, response, timely); the four metrics are sums of that small cube.
    """
    rows = apply_filters(df, filters)
    cube = rows.groupBy(
        month(F.col("date_received")).alias("month"), or_missing(F.col("issue")).alias("issue"),
        or_missing(F.col("company_response_to_consumer")).alias("response"),
        is_yes(F.col("timely_response")).alias("timely"),
    ).agg(F.count(F.lit(1)).alias("n"), F.min("date_received").alias("first"), F.max("date_received").alias("last"))

    def top_map(key: str) -> DataFrame:
        ranked = top_n(cube.groupBy(key).agg(F.sum("n").alias("n")), "n", key, n=n)
        entry = F.struct((-F.col("n")).alias("order"), F.col(key).alias("name"), F.col("n").alias("complaints"))
        named = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["name"].alias("name"), e["complaints"].alias("complaints")))
        return ranked.agg(named)

    monthly = cube.filter(F.col("month").isNotNull()).groupBy("month").agg(F.sum("n").alias("complaints"))
    ranked = monthly.withColumn("age", F.row_number().over(Window.orderBy(F.desc("month"))))
    growth = ranked.agg(F.struct(
        F.coalesce(F.sum(F.when(F.col("age") <= months, F.col("complaints"))), F.lit(0)).alias("recent"),
        F.coalesce(F.sum(F.when(F.col("age").between(months + 1, 2 * months), F.col("complaints"))), F.lit(0)).alias("prior"),
        F.count(F.lit(1)).alias("history"),
    ))
    return cube.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("complaints"), F.to_date(F.min("first")).alias("date_min"),
        F.to_date(F.max("last")).alias("date_max"),
        ratio(F.sum(F.when(F.col("timely"), F.col("n")).otherwise(0)), F.sum("n")).alias("timely_response_rate"),
    ).withColumns({
        "g": growth.scalar(), "top_issues": top_map("issue").scalar(), "top_responses": top_map("response").scalar(),
    }).select(
        "complaints", "date_min", "date_max", "timely_response_rate",
        *[c for c in _growth_of(F.col("g.recent"), F.col("g.prior"), F.col("g.history"), months)],
        "top_issues", "top_responses",
    )


def timely_share(column: str = "timely_response") -> Column:
    return share(is_yes(F.col(column)))
