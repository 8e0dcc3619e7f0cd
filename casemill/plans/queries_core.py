"""Registered queries: ingest, filters, quality, metrics, anomalies, benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.fixed import API_FIELD_RENAMES, COMPLAINT_COLUMNS, NO_SCALE_NOTE, SCALE_NOTE
from casemill.functions.columns import month
from casemill.functions.filters import CaseFilters, apply_filters, multi_select
from casemill.operators import anomaly, benchmark, metrics, quality
from casemill.plans.sql import CASES, MONTHLY, monthly_by, scores, spikes
from casemill.plans.tables import cases
from casemill.session import scratch_path
from casemill.sources import artifacts, complaints
from casemill.streaming import refresh

FILTERS = CaseFilters(product="building", state="nation_3", date_start="1996-01-01", date_end="2000-06-30")
FILTER_SQL = """lower(product) = 'building' AND lower(state) = 'nation_3'
  AND date_received >= TIMESTAMP '1996-01-01' AND date_received <= TIMESTAMP '2000-06-30'"""
SEGMENT = CaseFilters(product="MACHINERY")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources ------------------------------------------------------------------------------------------
RAW_COLUMNS = ["complaint_id", "date_received", "product", "issue", "company", "state", "timely_response",
               "consumer_complaint_narrative", "company_response_to_consumer"]


def land_csv(spark: SparkSession, sf_dir: str) -> str:
    """The cases as a raw bulk extract: published headers, padded text, a broken id and date here and there."""
    rows = cases(spark, sf_dir, *RAW_COLUMNS)
    header = {name: text for text, name in COMPLAINT_COLUMNS.items()}
    broken = F.col("complaint_id") % 10 == 0
    raw = rows.select(
        F.when(broken, F.lit("n/a")).otherwise(F.col("complaint_id").cast("string")).alias("Complaint ID"),
        F.when(F.col("complaint_id") % 7 == 0, F.lit("unknown"))
        .otherwise(F.date_format("date_received", "yyyy-MM-dd")).alias("Date received"),
        F.concat(F.lit("\t "), F.col("product"), F.lit("  ")).alias("Product"),
        F.concat(F.col("issue"), F.lit("\n\"quoted\", text")).alias("Issue"),
        *[F.col(c).alias(header[c]) for c in RAW_COLUMNS[4:]],
        F.lit("dropped").alias("Unknown column"),
    )
    path = scratch_path(spark, "bulk_csv")
    raw.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def bulk_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = complaints.read_bulk_csv(spark, land_csv(spark, sf_dir))
    return rows.withColumns({"date_received": F.to_date("date_received"), "date_sent_to_company": F.to_date("date_sent_to_company")})


def bulk_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to month-partitioned Parquet store, then the store by month."""
    store = scratch_path(spark, "store")
    complaints.ingest_bulk(spark, land_csv(spark, sf_dir), store)
    return complaints.read_store(spark, store).groupBy("received_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("complaint_id").alias("n_ids"),
        F.count("consumer_complaint_narrative").alias("n_narratives"),
    )


def land_api_pages(spark: SparkSession, rows: DataFrame) -> str:
    """Rows as search API responses, ten to a page, one page per line."""
    fields = F.struct(*[F.col(c).alias(API_FIELD_RENAMES.get(c, c)) for c in rows.columns])
    page = F.struct(F.struct(F.collect_list(F.struct(F.col("s").alias("_source"))).alias("hits")).alias("hits"))
    pages = rows.select(F.floor(F.col("complaint_id") / 10).alias("page"), fields.alias("s")).groupBy("page").agg(page.alias("p"))
    path = scratch_path(spark, "api_pages")
    pages.select(F.to_json("p")).write.text(path)
    return path


def api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark, sf_dir, *RAW_COLUMNS).withColumn("date_received", F.date_format("date_received", "yyyy-MM-dd"))


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land_api_pages(spark, api_rows(spark, sf_dir))
    pages = complaints.read_api_pages(spark, path, "1997-01-01", "1998-12-31", multi_line=False)
    return pages.select(
        "complaint_id", F.to_date("date_received").alias("date_received"), "product", "issue", "company", "state",
        "consumer_complaint_narrative", "company_response_to_consumer", "timely_response", "zip_code",
    )


def window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh window: orders of 1998 with a new issue, half of them new ids, some moved by two months."""
    rows = complaints.normalize_columns(cases(spark, sf_dir, *RAW_COLUMNS)).filter(F.year("date_received") == 1998)
    key = F.col("complaint_id")
    return rows.withColumns({
        "complaint_id": F.when(key % 2 == 0, key).otherwise(key + 1_000_000_000),
        "issue": F.lit("refreshed"),
        "date_received": F.when(key % 4 == 0, F.col("date_received") + F.expr("interval 2 months")).otherwise(F.col("date_received")),
    })


def store_months(store: DataFrame) -> DataFrame:
    return store.groupBy(month(F.col("date_received")).alias("month"), "issue").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("complaint_id").alias("id_sum")
    )


def incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = scratch_path(spark, "store")
    complaints.write_store(complaints.normalize_columns(cases(spark, sf_dir, *RAW_COLUMNS)), store)
    complaints.refresh_store(spark, store, window_rows(spark, sf_dir))
    return store_months(complaints.read_store(spark, store))


def streaming_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same refresh, fed from landed API pages by a file stream."""
    store = scratch_path(spark, "store")
    complaints.write_store(complaints.normalize_columns(cases(spark, sf_dir, *RAW_COLUMNS)), store)
    window = window_rows(spark, sf_dir).select(*RAW_COLUMNS).withColumn("date_received", F.date_format("date_received", "yyyy-MM-dd"))
    landing = land_api_pages(spark, window)
    refresh.refresh_from_landing(spark, landing, store, scratch_path(spark, "refresh_checkpoint"), multi_line=False)
    return store_months(complaints.read_store(spark, store))


REFRESH_SQL = f"""WITH {CASES}, win AS (
  SELECT CASE WHEN complaint_id % 2 = 0 THEN complaint_id ELSE complaint_id + 1000000000 END AS complaint_id,
         'refreshed' AS issue,
         CASE WHEN complaint_id % 4 = 0 THEN date_received + INTERVAL 2 MONTH ELSE date_received END AS date_received
  FROM cases WHERE year(date_received) = 1998
), merged AS (
  SELECT complaint_id, issue, date_received FROM cases WHERE complaint_id NOT IN (SELECT complaint_id FROM win)
  UNION ALL SELECT * FROM win
)
SELECT CAST(date_trunc('month', date_received) AS DATE) AS month, issue, count(*) AS n_rows,
       CAST(sum(complaint_id) AS BIGINT) AS id_sum
FROM merged GROUP BY 1, 2"""


def csv_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table written as a CSV artifact and read back."""
    scored = anomaly.emerging_scores(cases(spark, sf_dir, "date_received", "product"), "product") \
        .select("product", "complaints", "emerging_issue_score")
    path = scratch_path(spark, "scores_csv")
    artifacts.write_csv_table(scored, path)
    return artifacts.read_csv_table(spark, path, scored.schema)


def parameterised_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complaints.sql_query(
        spark, "SELECT state, count(*) AS complaints FROM complaints WHERE product = :product AND date_received >= "
               "CAST(:start AS TIMESTAMP_NTZ) GROUP BY state",
        cases(spark, sf_dir), {"product": "BUILDING", "start": "1999-01-01"},
    )


# --- filters ------------------------------------------------------------------------------------------
def metadata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_filters(cases(spark, sf_dir, "complaint_id", "date_received", "product", "state"), FILTERS)
    return rows.withColumn("date_received", F.to_date("date_received"))


def interactive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark, sf_dir, "complaint_id", "date_received", "product", "state", "company")
    kept = multi_select(rows, ["BUILDING", "MACHINERY"], ["NATION_1", "NATION_2", "NATION_3"], "1996-01-01", "1999-12-31")
    return kept.groupBy("product", "state").agg(F.count(F.lit(1)).alias("complaints"), F.count_distinct("company").alias("companies"))


def company_drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product mix of the company with most complaints."""
    rows = cases(spark, sf_dir, "company", "issue")
    leader = metrics.top_categories(rows, "company", 1).select("company").scalar()
    return metrics.top_categories(rows.filter(F.col("company") == leader), "issue", 8)


# --- metrics ------------------------------------------------------------------------------------------
def response_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark, sf_dir, "product", "company_response_to_consumer", "timely_response")
    return rounded(metrics.response_metrics(rows, SEGMENT), 6, "timely_response_rate").select(
        "status", "timely_response_rate", F.explode("top_responses").alias("response", "complaints")
    )


def default_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark, sf_dir, "product", "issue", "date_received", "company_response_to_consumer", "timely_response")
    bundle = metrics.default_analytics(rows, SEGMENT)

    def joined(column: str):
        return F.array_join(F.transform(column, lambda e: F.concat_ws("=", e["name"], e["complaints"].cast("string"))), "; ")

    return rounded(bundle, 6, "timely_response_rate", "growth_rate").withColumns({
        "top_issues": joined("top_issues"), "top_responses": joined("top_responses"),
    })


DEFAULT_ANALYTICS_SQL = f"""WITH {CASES.replace("cases AS", "all_cases AS", 1)},
cases AS (SELECT * FROM all_cases WHERE lower(product) = 'machinery'), {MONTHLY},
aged AS (SELECT complaints, row_number() OVER (ORDER BY month DESC) AS age FROM monthly),
g AS (SELECT CAST(sum(complaints) FILTER (age <= 6) AS BIGINT) AS recent,
             CAST(sum(complaints) FILTER (age BETWEEN 7 AND 12) AS BIGINT) AS prior, count(*) AS history FROM aged),
i AS (SELECT issue, count(*) AS n FROM (SELECT coalesce(issue, 'Missing') AS issue FROM cases) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5),
r AS (SELECT response, count(*) AS n FROM (SELECT coalesce(company_response_to_consumer, 'Missing') AS response FROM cases)
      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
SELECT count(*) AS complaints, CAST(min(date_received) AS DATE) AS date_min, CAST(max(date_received) AS DATE) AS date_max,
  round(avg(CASE WHEN lower(timely_response) = 'yes' THEN 1.0 ELSE 0.0 END), 6) AS timely_response_rate,
  (SELECT CASE WHEN history >= 12 THEN 'ok' ELSE 'insufficient_history' END FROM g) AS status, CAST(6 AS BIGINT) AS months,
  (SELECT recent FROM g) AS recent_complaints, (SELECT prior FROM g) AS prior_complaints,
  (SELECT round((recent - prior) / CAST(prior AS DOUBLE), 6) FROM g) AS growth_rate,
  (SELECT string_agg(issue || '=' || n, '; ' ORDER BY n DESC, issue) FROM i) AS top_issues,
  (SELECT string_agg(response || '=' || n, '; ' ORDER BY n DESC, response) FROM r) AS top_responses
FROM cases"""


def scale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale denominators: order value per company; a tenth of it as revenue; every third company not allowed."""
    totals = cases(spark, sf_dir, "company", "assets").groupBy(F.col("company").alias("cfpb_company_name")) \
        .agg(F.sum("assets").alias("assets"))
    number = F.regexp_extract("cfpb_company_name", r"(\d+)$", 1).cast("bigint")
    return totals.withColumns({
        "revenue": F.when(number % 2 == 0, F.col("assets") / 10), "normalization_allowed": F.nullif(number % 3, F.lit(2)) == 0,
    })


def company_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark, sf_dir, "complaint_id", "company", "product", "timely_response", "consumer_complaint_narrative")
    result = benchmark.company_benchmark(rows, scale_rows(spark, sf_dir))
    return rounded(result, 6, "timely_rate").withColumns({
        "assets": F.round("assets", 4), "revenue": F.round("revenue", 4),
        "complaints_per_1b_assets": F.round("complaints_per_1b_assets", 4),
        "complaints_per_1b_revenue": F.round("complaints_per_1b_revenue", 4),
    })


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_profile(cases(spark, sf_dir).withColumn("date_received", F.to_date("date_received")))


PROFILE_COLUMNS = ["complaint_id", "date_received", "product", "issue", "company", "state", "company_response_to_consumer",
                   "timely_response", "consumer_complaint_narrative"]
PROFILE_SQL = f"WITH {CASES}\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS field, count(*) AS records, count(*) - count({c}) AS missing_count,
  round_even((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 4) AS missing_rate,
  count(DISTINCT {c}) AS unique_values, CAST({"CAST(min(date_received) AS DATE)" if c == "date_received" else f"min({c})"} AS VARCHAR)
  AS example_non_null FROM cases""" for c in PROFILE_COLUMNS)


def schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation of the cases with repeated ids and some text that is no date."""
    rows = cases(spark, sf_dir, "complaint_id", "date_received", "product", "issue", "company", "state", "timely_response",
                 "consumer_complaint_narrative")
    key = F.col("complaint_id")
    spoiled = rows.withColumns({
        "date_received": F.when(key % 50 == 0, "unknown").otherwise(F.col("date_received").cast("string")),
        "complaint_id": F.when(key % 100 == 1, key - 1).otherwise(key),
    })
    return quality.validate_schema(spoiled, F.lit("2001-01-01").cast("timestamp_ntz")).select("check", "violated")


QUERIES = {
    "bulk_csv_scan": bulk_csv_scan,
    "bulk_ingest": bulk_ingest,
    "ingest_metadata": lambda s, d: complaints.ingest_metadata(cases(s, d)),
    "api_pages": api_pages,
    "incremental_refresh": incremental_refresh,
    "streaming_refresh": streaming_refresh,
    "csv_artifact": csv_artifact,
    "parameterised_sql": parameterised_sql,
    "sample_head": lambda s, d: complaints.sample_head(cases(s, d, "complaint_id", "product")).agg(
        F.count("*").alias("rows_read"), F.count_distinct("complaint_id").alias("ids")),
    "metadata_filter": metadata_filter,
    "interactive_filter": interactive_filter,
    "company_drill_down": lambda s, d: rounded(company_drill_down(s, d), 6, "share"),
    "kpi_summary": lambda s, d: metrics.kpi_summary(cases(s, d)),
    "volume_by_month": lambda s, d: rounded(metrics.volume_by_month(cases(s, d, "date_received")), 6, "rolling_3m"),
    "volume_by_month_group": lambda s, d: rounded(
        metrics.volume_by_month(cases(s, d, "date_received", "company_response_to_consumer"), "company_response_to_consumer"), 6, "rolling_3m"),
    "top_categories": lambda s, d: rounded(metrics.top_categories(cases(s, d, "company"), "company"), 6, "share"),
    "top_series": lambda s, d: rounded(metrics.top_series(cases(s, d, "date_received", "issue"), "issue", 3), 6, "rolling_3m"),
    "yoy_growth": lambda s, d: rounded(metrics.yoy_growth(cases(s, d, "date_received", "product"), "product"), 6, "yoy_growth"),
    "contains_count": lambda s, d: metrics.contains_count(cases(s, d, "product"), "product", "Build"),
    "complaint_volume": lambda s, d: metrics.complaint_volume(cases(s, d, "date_received", "product", "state"), FILTERS),
    "top_issues": lambda s, d: rounded(metrics.top_issues(cases(s, d, "date_received", "product", "state", "issue"), FILTERS), 6, "share"),
    "growth_rate": lambda s, d: rounded(metrics.growth_rate(cases(s, d, "date_received", "product"), SEGMENT), 6, "growth_rate"),
    "response_metrics": response_metrics,
    "default_analytics": default_analytics,
    "detect_spikes": lambda s, d: rounded(
        anomaly.detect_spikes(cases(s, d, "date_received", "product")), 6, "baseline_mean", "baseline_std", "z_score"),
    "emerging_scores": lambda s, d: rounded(
        anomaly.emerging_scores(cases(s, d, "date_received", "state"), "state"), 6, "baseline_mean", "baseline_std", "z_score",
        "growth_component", "volume_component"),
    "anomaly_summary": lambda s, d: anomaly.anomaly_summary(cases(s, d, "date_received", "issue"))
    .select("issue", "complaints", "emerging_issue_score"),
    "company_base": lambda s, d: rounded(benchmark.company_benchmark(
        cases(s, d, "complaint_id", "company", "product", "timely_response", "consumer_complaint_narrative")), 6, "timely_rate"),
    "company_benchmark": company_benchmark,
    "benchmark_page": lambda s, d: benchmark.benchmark_page(benchmark.company_base(cases(s, d))).select("company", "raw_complaints", "products"),
    "column_profile": column_profile,
    "response_distribution": lambda s, d: quality.response_distribution(
        cases(s, d, "company_response_to_consumer", "timely_response", "submitted_via")),
    "schema_checks": schema_checks,
}

COMPANY_SQL = """SELECT company, count(complaint_id) AS raw_complaints, count(DISTINCT product) AS products,
  count(consumer_complaint_narrative) AS narrative_count,
  round(avg(CASE WHEN lower(timely_response) = 'yes' THEN 1.0 ELSE 0.0 END), 6) AS timely_rate FROM cases GROUP BY 1"""

ORACLE = {
    "bulk_csv_scan": f"""WITH {CASES}
SELECT CASE WHEN complaint_id % 10 <> 0 THEN complaint_id END AS complaint_id,
  CASE WHEN complaint_id % 7 <> 0 THEN CAST(date_received AS DATE) END AS date_received, product,
  issue || chr(10) || '"quoted", text' AS issue, company, state, timely_response, consumer_complaint_narrative,
  company_response_to_consumer, CAST(NULL AS DATE) AS date_sent_to_company,
  {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in COMPLAINT_COLUMNS.values() if c not in [*RAW_COLUMNS, "date_sent_to_company"])}
FROM cases""",
    "bulk_ingest": f"""WITH {CASES}
SELECT CASE WHEN complaint_id % 7 = 0 THEN 'none' ELSE strftime(date_received, '%Y-%m') END AS received_month, count(*) AS n_rows,
  count(CASE WHEN complaint_id % 10 <> 0 THEN 1 END) AS n_ids, count(consumer_complaint_narrative) AS n_narratives
FROM cases GROUP BY 1""",
    "ingest_metadata": f"""WITH {CASES}
SELECT count(*) AS record_count, CAST(min(date_received) AS DATE) AS date_min, CAST(max(date_received) AS DATE) AS date_max,
  count(consumer_complaint_narrative) AS narrative_count, false AS limited_extract FROM cases""",
    "api_pages": f"""WITH {CASES}
SELECT complaint_id, CAST(date_received AS DATE) AS date_received, product, issue, company, state,
  consumer_complaint_narrative, company_response_to_consumer, timely_response, CAST(NULL AS VARCHAR) AS zip_code
FROM cases WHERE date_received >= DATE '1997-01-01' AND CAST(date_received AS DATE) <= DATE '1998-12-31'""",
    "incremental_refresh": REFRESH_SQL,
    "streaming_refresh": REFRESH_SQL,
    "csv_artifact": f"WITH {scores('product')} SELECT product, complaints, emerging_issue_score FROM scores",
    "parameterised_sql": f"""WITH {CASES} SELECT state, count(*) AS complaints FROM cases
WHERE product = 'BUILDING' AND date_received >= TIMESTAMP '1999-01-01' GROUP BY state""",
    "metadata_filter": f"""WITH {CASES} SELECT complaint_id, CAST(date_received AS DATE) AS date_received, product, state
FROM cases WHERE {FILTER_SQL}""",
    "interactive_filter": f"""WITH {CASES} SELECT product, state, count(*) AS complaints, count(DISTINCT company) AS companies
FROM cases WHERE product IN ('BUILDING', 'MACHINERY') AND state IN ('NATION_1', 'NATION_2', 'NATION_3')
  AND date_received BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' GROUP BY 1, 2""",
    "company_drill_down": f"""WITH {CASES}, leader AS (
  SELECT company FROM cases GROUP BY 1 ORDER BY count(*) DESC, company LIMIT 1),
own AS (SELECT * FROM cases WHERE company = (SELECT company FROM leader))
SELECT issue, count(*) AS complaints, round(count(*) / CAST((SELECT count(*) FROM own) AS DOUBLE), 6) AS share
FROM own GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8""",
    "kpi_summary": f"""WITH {CASES}
SELECT count(*) AS complaints, count(DISTINCT company) AS companies, count(DISTINCT product) AS products,
  count(DISTINCT issue) AS issues, count(consumer_complaint_narrative) AS narratives,
  CAST(min(date_received) AS DATE) AS date_min, CAST(max(date_received) AS DATE) AS date_max FROM cases""",
    "volume_by_month": f"""WITH {CASES}, {MONTHLY}
SELECT month, complaints, round(avg(complaints) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_3m
FROM monthly""",
    "volume_by_month_group": f"""WITH {CASES}, {monthly_by("company_response_to_consumer")}
SELECT month, company_response_to_consumer, complaints, CASE WHEN company_response_to_consumer IS NOT NULL THEN
  round(avg(complaints) OVER (PARTITION BY company_response_to_consumer ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
  END AS rolling_3m FROM monthly""",
    "top_categories": f"""WITH {CASES}
SELECT company, count(*) AS complaints, round(count(*) / CAST((SELECT count(*) FROM cases) AS DOUBLE), 6) AS share
FROM cases GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    "top_series": f"""WITH {CASES}, {monthly_by("issue")},
top AS (SELECT issue FROM cases GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
SELECT month, issue, complaints,
  round(avg(complaints) OVER (PARTITION BY issue ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_3m
FROM monthly WHERE issue IN (SELECT issue FROM top)""",
    "yoy_growth": f"""WITH {CASES}, yearly AS (
  SELECT product, CAST(year(date_received) AS INTEGER) AS year, count(*) AS complaints FROM cases GROUP BY 1, 2),
lagged AS (SELECT *, lag(complaints) OVER (PARTITION BY product ORDER BY year NULLS LAST) AS prior_year FROM yearly)
SELECT *, CASE WHEN prior_year > 0 THEN round((complaints - prior_year) / CAST(prior_year AS DOUBLE), 6) END AS yoy_growth FROM lagged""",
    "contains_count": f"WITH {CASES} SELECT count(*) AS complaints FROM cases WHERE lower(product) LIKE '%build%'",
    "complaint_volume": f"""WITH {CASES}
SELECT count(*) AS complaints, CAST(min(date_received) AS DATE) AS date_min, CAST(max(date_received) AS DATE) AS date_max,
  '[Analytics: complaint volume]' AS citation FROM cases WHERE {FILTER_SQL}""",
    "top_issues": f"""WITH {CASES}, own AS (SELECT * FROM cases WHERE {FILTER_SQL})
SELECT issue, count(*) AS complaints, round(count(*) / CAST((SELECT count(*) FROM own) AS DOUBLE), 6) AS share
FROM own GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "growth_rate": f"""WITH {CASES.replace("cases AS", "all_cases AS", 1)},
cases AS (SELECT * FROM all_cases WHERE lower(product) = 'machinery'), {MONTHLY},
aged AS (SELECT complaints, row_number() OVER (ORDER BY month DESC) AS age FROM monthly),
g AS (SELECT CAST(sum(complaints) FILTER (age <= 6) AS BIGINT) AS recent_complaints,
             CAST(sum(complaints) FILTER (age BETWEEN 7 AND 12) AS BIGINT) AS prior_complaints FROM aged)
SELECT 'ok' AS status, CAST(6 AS BIGINT) AS months, *,
  round((recent_complaints - prior_complaints) / CAST(prior_complaints AS DOUBLE), 6) AS growth_rate,
  '[Analytics: recent complaint growth]' AS citation FROM g""",
    "response_metrics": f"""WITH {CASES}, own AS (SELECT * FROM cases WHERE lower(product) = 'machinery')
SELECT 'ok' AS status, (SELECT round(avg(CASE WHEN lower(timely_response) = 'yes' THEN 1.0 ELSE 0.0 END), 6) FROM own)
  AS timely_response_rate, coalesce(company_response_to_consumer, 'Missing') AS response, count(*) AS complaints
FROM own GROUP BY 3 ORDER BY 4 DESC, 3 LIMIT 5""",
    "default_analytics": DEFAULT_ANALYTICS_SQL,
    "detect_spikes": f"""WITH {spikes("product", 6)}
SELECT month, product, complaints, round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std,
  round(z_score, 6) AS z_score, coalesce(z_score >= 2.0, false) AS spike_flag FROM spikes""",
    "emerging_scores": f"""WITH {scores("state")}
SELECT month, state, complaints, round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std,
  round(z_score, 6) AS z_score, coalesce(z_score >= 2.0, false) AS spike_flag, round(growth_component, 6) AS growth_component,
  round(volume_component, 6) AS volume_component, emerging_issue_score FROM scores""",
    "anomaly_summary": f"""WITH {scores("issue")}
SELECT issue, complaints, emerging_issue_score FROM scores ORDER BY 3 DESC, 1 LIMIT 5""",
    "company_base": f"WITH {CASES} SELECT *, '{NO_SCALE_NOTE}' AS normalization_note FROM ({COMPANY_SQL})",
    "sample_head": "SELECT least(count(*), 10000) AS rows_read, least(count(*), 10000) AS ids FROM orders",
    "benchmark_page": f"""WITH {CASES} SELECT company, raw_complaints, products FROM ({COMPANY_SQL})
ORDER BY raw_complaints DESC, company NULLS LAST LIMIT 200""",
    "company_benchmark": f"""WITH {CASES}, base AS ({COMPANY_SQL}),
totals AS (SELECT company AS cfpb_company_name, sum(assets) AS assets,
                  CAST(regexp_extract(company, '(\\d+)$', 1) AS BIGINT) AS number FROM cases GROUP BY 1),
scale AS (SELECT cfpb_company_name, assets, CASE WHEN number % 2 = 0 THEN assets / 10 END AS revenue,
                 nullif(number % 3, 2) = 0 AS normalization_allowed FROM totals)
SELECT company, raw_complaints, products, narrative_count, timely_rate, cfpb_company_name, round(assets, 4) AS assets,
  round(revenue, 4) AS revenue, normalization_allowed,
  CASE WHEN coalesce(normalization_allowed, false) AND assets > 0 THEN round(raw_complaints / (assets / 1e9), 4) END AS complaints_per_1b_assets,
  CASE WHEN coalesce(normalization_allowed, false) AND revenue > 0 THEN round(raw_complaints / (revenue / 1e9), 4) END AS complaints_per_1b_revenue,
  '{SCALE_NOTE}' AS normalization_note
FROM base LEFT JOIN scale ON company = cfpb_company_name""",
    "column_profile": PROFILE_SQL,
    "response_distribution": f"WITH {CASES}\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS dimension, coalesce({c}, 'Missing') AS category, count(*) AS complaints FROM cases GROUP BY 2"
        for c in ("company_response_to_consumer", "timely_response", "submitted_via")),
    "schema_checks": f"""WITH {CASES}, spoiled AS (
  SELECT CASE WHEN complaint_id % 100 = 1 THEN complaint_id - 1 ELSE complaint_id END AS complaint_id,
         CASE WHEN complaint_id % 50 <> 0 THEN date_received END AS date_received FROM cases)
SELECT 'missing_columns' AS "check", true AS violated
UNION ALL SELECT 'duplicate_ids', count(DISTINCT complaint_id) < count(*) FROM spoiled
UNION ALL SELECT 'unparseable_dates', avg(CASE WHEN date_received IS NULL THEN 1.0 ELSE 0.0 END) > 0.01 FROM spoiled
UNION ALL SELECT 'future_dates', max(date_received) > TIMESTAMP '2001-01-02' FROM spoiled""",
}
