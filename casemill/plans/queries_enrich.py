"""Registered queries: financial facts, macro series, wages, entity resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.fixed import (
    ALIAS_NOTE, FUZZY_NOTE, HIGH, LEGAL_SUFFIXES, LOW, MACRO_CAVEAT, MACRO_SOURCE, MEDIUM, SCALE_NOTE, WAGE_NOTE, WAGE_OCCUPATIONS, WAGE_PERIOD, WAGE_SOURCE, WAGE_SOURCE_URL,
)
from casemill.functions.text import normalize_company_name
from casemill.operators import entities, macro_context, scale
from casemill.plans.queries_core import rounded
from casemill.plans.sql import CASES, MONTHLY, quoted
from casemill.plans.tables import cases, macro_observations, seed_map, table
from casemill.session import scratch_path
from casemill.sources import entity_seed, facts, macro, wages

# --- financial facts ----------------------------------------------------------------------------------
FACT_CONCEPTS = ["Assets", "Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "ProfitLoss", "Goodwill"]


def fact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per order: the customer as registrant, two concepts, mixed units, forms and periods.

    Every 20th document is cut short and does not parse.
    """
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"), "left")
    key, year = F.col("o_orderkey"), F.year("o_orderdate")
    names = F.array(*[F.lit(c) for c in FACT_CONCEPTS])
    fact = F.struct(
        year.alias("fy"), F.when(F.col("o_custkey") % 4 == 0, "Q4").when(key % 3 == 0, "FY").otherwise("Q2").alias("fp"),
        F.when(F.col("o_orderstatus") == "F", "10-K").when(F.col("o_orderstatus") == "O", "10-Q").otherwise("8-K").alias("form"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("end"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 45), "yyyy-MM-dd").alias("filed"),
        F.when(key % 11 != 0, F.col("o_totalprice")).alias("val"), key.cast("string").alias("accn"),
    )
    units = F.struct(F.create_map(F.when(key % 13 == 0, "EUR").otherwise("USD"), F.array(fact)).alias("units"))
    concepts = F.map_from_arrays(
        F.array(F.element_at(names, (key % 5 + 1).cast("int")), F.element_at(names, ((key + 2) % 5 + 1).cast("int"))),
        F.array(units, units),
    )
    document = F.to_json(F.struct(
        F.col("o_custkey").cast("string").alias("cik"), F.col("c_name").alias("entityName"),
        F.create_map(F.lit("us-gaap"), concepts).alias("facts"),
    ))
    return rows.select(F.when(key % 20 == 0, F.substring(document, 1, 40)).otherwise(document).alias("value"))


def landed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "company_facts")
    fact_documents(spark, sf_dir).write.text(path)
    return facts.read_company_facts(spark, path, multi_line=False)


def facts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_rows(facts.parse_company_facts(fact_documents(spark, sf_dir), "value"))


def entity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_seed.coerce_seed_map(seed_map(spark, sf_dir)).drop("seed_order")


FACTS_SQL = """raw AS (
  SELECT o_orderkey AS k, o_custkey, c_name AS company, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS sec_cik,
         CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
         CASE WHEN o_custkey % 4 = 0 THEN 'Q4' WHEN o_orderkey % 3 = 0 THEN 'FY' ELSE 'Q2' END AS fiscal_period,
         CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '8-K' END AS form,
         strftime(o_orderdate, '%Y-%m-%d') AS period_end, strftime(o_orderdate + INTERVAL 45 DAY, '%Y-%m-%d') AS filed_date,
         CAST(o_orderkey AS VARCHAR) AS accession, o_totalprice AS value
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
), facts AS (
  SELECT company, sec_cik, metric_name, concept_priority, xbrl_concept, 'USD' AS unit, fiscal_year, fiscal_period,
         period_end, form, filed_date, accession, value
  FROM raw JOIN (VALUES (0, 'assets', 1, 'Assets'), (1, 'revenue', 1, 'Revenues'),
    (2, 'revenue', 2, 'RevenueFromContractWithCustomerExcludingAssessedTax'), (3, 'net_income', 2, 'ProfitLoss'))
    AS c(i, metric_name, concept_priority, xbrl_concept) ON i IN (k % 5, (k + 2) % 5)
  WHERE k % 20 <> 0 AND k % 13 <> 0 AND k % 11 <> 0 AND form <> '8-K'
), annual AS (
  SELECT * FROM (SELECT *, bool_or(upper(fiscal_period) = 'FY') OVER (PARTITION BY sec_cik, company) AS has_year FROM facts)
  WHERE CASE WHEN has_year THEN upper(fiscal_period) = 'FY' ELSE form = '10-K' END
), resolved AS (
  SELECT company, sec_cik, fiscal_year, metric_name, fiscal_period, form, filed_date, xbrl_concept, unit, value, accession
  FROM (SELECT *, row_number() OVER (PARTITION BY company, sec_cik, fiscal_year, metric_name
          ORDER BY concept_priority DESC, filed_date DESC, period_end DESC, accession DESC, value DESC) AS rn FROM annual) WHERE rn = 1
), latest AS (
  SELECT sec_cik, metric_name, value, fiscal_year FROM (SELECT *, row_number() OVER (PARTITION BY sec_cik, metric_name
          ORDER BY fiscal_year DESC, filed_date DESC, accession DESC) AS rn FROM resolved) WHERE rn = 1
)"""
SEED_SQL = """seed AS (
  SELECT replace(s_name, 'Supplier', 'CUSTOMER') AS cfpb_company_name, s_name || ' Financial Corp.' AS canonical_company_name,
         lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS sec_cik, 'T' || s_suppkey AS ticker,
         CASE WHEN s_suppkey % 2 = 0 THEN 'manual_seed' ELSE 'imported' END AS match_method,
         CAST(round(0.85 + (s_suppkey % 8) * 0.02, 2) AS DOUBLE) AS match_score, s_suppkey % 5 = 0 AS flagged, s_suppkey AS seed_order
  FROM supplier
), entity_map AS (
  SELECT cfpb_company_name, canonical_company_name, sec_cik, ticker, match_method, match_score,
         CASE WHEN match_score >= 0.96 THEN 'HIGH CONFIDENCE' WHEN match_score >= 0.88 THEN 'MEDIUM - REVIEW'
              ELSE 'LOW - REJECT' END AS confidence_tier, match_score < 0.96 OR flagged AS manual_review_required,
         'derived' AS notes, seed_order FROM seed
)"""


def lineage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the fetched facts, with the number of documents that did not parse."""
    documents = landed_facts(spark, sf_dir)
    errors = facts.fact_errors(documents).select(F.count(F.lit(1))).scalar()
    mapped = entity_map(spark, sf_dir)
    lineage = scale.company_lineage(scale.resolve_facts(facts.fact_rows(documents)), mapped)
    return scale.lineage_status(lineage, mapped).withColumn("errors", errors)


# --- macro and wages ----------------------------------------------------------------------------------
def macro_observation_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation payloads landed as JSON, one per supplier, every eighth value not numeric; the scan per series."""
    source = table(spark, sf_dir, "lineitem").filter(F.col("l_suppkey").isNotNull())
    value = F.when(F.col("l_partkey") % 8 == 0, ".").otherwise(F.col("l_extendedprice").cast("string"))
    entry = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), value.alias("value"))
    path = scratch_path(spark, "macro")
    source.select(F.to_json(F.struct(F.col("l_returnflag").alias("series_id"), F.array(entry).alias("observations"))).alias("value")) \
        .write.text(path)
    rows = macro.read_observations(spark, path, multi_line=False)
    return rows.groupBy("series_id", "description", "source").agg(
        F.count(F.lit(1)).alias("observations"), F.round(F.sum("value"), 2).alias("total"), F.min("date").alias("first_date"))


def raw_wages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a wage workbook: formatted numbers, suppressed values, padded and upper-case headers."""
    codes = F.array(*[F.lit(c) for c in WAGE_OCCUPATIONS], F.lit("99-0000"), F.lit("11-1011"))
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.element_at(codes, (key % 7 + 1).cast("int")).alias(" OCC_CODE"), F.col("p_name").alias("OCC_TITLE "),
        F.when(key % 10 == 0, "*").otherwise(F.format_number("p_retailprice", 2)).alias("H_MEAN"),
        F.when(key % 9 == 0, "#").otherwise(F.format_number(F.col("p_size") * 1000, 0)).alias("A_MEAN"), F.lit("x").alias("OTHER"),
    )


WAGES_SQL = """wages AS (
  SELECT ['43-4051', '43-9061', '13-1111', '13-2099', '15-2051', '99-0000', '11-1011'][p_partkey % 7 + 1] AS occupation_code,
         p_name AS occupation, CASE WHEN p_partkey % 10 <> 0 THEN round(p_retailprice, 2) END AS mean_hourly_wage,
         CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size * 1000 AS DOUBLE) END AS mean_annual_wage
  FROM part WHERE p_partkey % 7 < 5
)"""


def default_wage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default wage when each occupation has one row, its mean over the workbook."""
    rows = wages.normalize_wages(raw_wages(spark, sf_dir))
    means = rows.groupBy("occupation_code").agg(F.avg("mean_hourly_wage").alias("mean_hourly_wage"))
    return rounded(wages.default_hourly_wage(means), 8, "hourly_wage")


# --- entities -----------------------------------------------------------------------------------------
def companies_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.company_counts(cases(spark, sf_dir, "company"))


def seed_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_seed.coerce_seed_map(seed_map(spark, sf_dir))


def seed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed map text with a header: unquoted commas and a second number in the notes, quoted fields, short and empty registrant numbers."""
    key = F.col("s_suppkey")
    name = F.concat(F.col("s_name"), F.when(key % 3 == 0, ", N.A.").otherwise(""))
    number = F.when(key % 10 == 9, "").when(key % 10 == 8, key.cast("string")).otherwise(F.lpad(key.cast("string"), 10, "0"))
    quoted = F.concat(F.lit('"'), name, F.lit(' ""Q""",Parent Corp.,'), number, F.lit(',TCK,manual_seed,0.98,false,"Public, listed."'))
    ragged = F.concat_ws(",", name, F.lit("Parent Corp."), F.lpad(key.cast("string"), 10, "0"), F.lit("TCK,manual_seed,0.98,false,Public, see,0000000001,a,b,c,d"))
    path = scratch_path(spark, "seed_map")
    lines = table(spark, sf_dir, "supplier").select(F.when((key % 2 == 0) | (key % 10 == 9), quoted).otherwise(ragged).alias("value"))
    lines.union(spark.createDataFrame([(",".join(entity_seed.SEED_COLUMNS),)], "value string")).write.text(path)
    return entity_seed.read_seed_map(spark, path).drop("seed_order")


def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised names of supplier names dressed up with legal suffixes and punctuation."""
    dressed = F.concat(F.lit("The "), F.col("s_name"), F.lit(" & Sons, Nat'l. Bank, N.A. of "), F.col("n_name"), F.lit(" INC."))
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", normalize_company_name(dressed).alias("normalized"))


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(entities.review_table(companies_of(spark, sf_dir), seed_of(spark, sf_dir)), 6, "match_score")


def alias_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review rows decided by alias: every company name contains one of the aliases, one of them not seeded."""
    aliases = {f"customer 00000{d}": f"Supplier#00000000{d} Financial Corp." for d in range(9)} | {"customer": "Not seeded"}
    rows = entities.review_table(companies_of(spark, sf_dir), seed_of(spark, sf_dir), aliases=aliases, whole_words=False)
    return rows.filter(F.col("match_method") == "alias_suggestion")


QUERIES = {
    "facts_scan": lambda s, d: facts.fact_rows(landed_facts(s, d)),
    "facts_errors": lambda s, d: facts.fact_errors(landed_facts(s, d)).agg(F.count(F.lit(1)).alias("documents")),
    "facts_annual": lambda s, d: scale.prefer_annual(facts_of(s, d)),
    "facts_resolved": lambda s, d: scale.resolve_facts(facts_of(s, d)),
    "facts_resolved_first": lambda s, d: scale.resolve_facts(facts_of(s, d), prefer="first"),
    "facts_latest": lambda s, d: scale.latest_values(scale.resolve_facts(facts_of(s, d))),
    "facts_scale": lambda s, d: scale.scale_table(scale.resolve_facts(facts_of(s, d)), entity_map(s, d)),
    "facts_status": lineage_status,
    "macro_observation_scan": macro_observation_scan,
    "macro_status": lambda s, d: macro.series_status(macro_observations(s, d)),
    "macro_monthly": lambda s, d: rounded(macro_context.join_months(cases(s, d, "date_received"), macro_observations(s, d)), 8, "value"),
    "lag_correlation": lambda s, d: rounded(
        macro_context.lagged_correlation(cases(s, d, "date_received"), macro_observations(s, d)), 6, "correlation"),
    "wage_table": lambda s, d: wages.normalize_wages(raw_wages(s, d)),
    "default_wage": default_wage,
    "seed_recovery": seed_lines,
    "seed_coercion": lambda s, d: rounded(seed_of(s, d), 4, "match_score"),
    "company_name_forms": name_forms,
    "company_counts": companies_of,
    "unmapped_companies": lambda s, d: entities.unmapped_companies(companies_of(s, d), seed_of(s, d)),
    "mapped_companies": lambda s, d: entities.mapped_companies(companies_of(s, d), seed_of(s, d)),
    "mapping_coverage": lambda s, d: rounded(
        entities.mapping_coverage(companies_of(s, d), seed_of(s, d)), 6, "coverage_by_company", "coverage_by_volume",
        "high_confidence_coverage_by_volume"),
    "entity_alias_review": alias_review,
    "entity_review": review,
}

COMPANIES_SQL = """companies AS (SELECT company AS cfpb_company_name, count(*) AS complaints FROM cases WHERE company IS NOT NULL GROUP BY 1)"""
RESOLVED_FIRST = FACTS_SQL.replace("ORDER BY concept_priority DESC,", "ORDER BY concept_priority,")
MACRO_MONTHS = f"""{CASES}, {MONTHLY}, series AS (
  SELECT l_returnflag AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_extendedprice) AS value
  FROM lineitem WHERE l_returnflag IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2
), joined AS (SELECT series_id, month, complaints, value FROM series JOIN monthly USING (month))"""



def normalized_sql(name: str) -> str:
    return (f"array_to_string(list_filter(string_split_regex(regexp_replace(replace(lower({name}), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +'), "
            f"lambda w: w <> '' AND w NOT IN ({', '.join(quoted(w) for w in LEGAL_SUFFIXES)})), ' ')")


# Matching blocks of two names: the longest common run, the first of equal ones, then the same to the left and to the right of it.
REVIEW_SQL = f"""WITH RECURSIVE {CASES}, {COMPANIES_SQL}, {SEED_SQL},
open AS (SELECT *, {normalized_sql("cfpb_company_name")} AS a FROM companies WHERE lower(cfpb_company_name) NOT IN (SELECT lower(cfpb_company_name) FROM seed)
  ORDER BY complaints DESC, cfpb_company_name LIMIT 200),
canon AS (SELECT canonical_company_name, min(seed_order) AS tie, {normalized_sql("canonical_company_name")} AS b FROM seed GROUP BY 1),
pairs AS (SELECT DISTINCT a, b FROM open, canon),
cells AS (SELECT a, b, i, j FROM pairs, range(1, 200) r(i), range(1, 200) s(j) WHERE i <= length(a) AND j <= length(b) AND a[i] = b[j]),
runs AS (SELECT a, b, i, j, row_number() OVER (PARTITION BY a, b, j - i, island ORDER BY i DESC) AS n
  FROM (SELECT *, i - row_number() OVER (PARTITION BY a, b, j - i ORDER BY i) AS island FROM cells)),
spans AS (SELECT a, b, CAST(1 AS BIGINT) AS i0, length(a) + 1 AS i1, CAST(1 AS BIGINT) AS j0, length(b) + 1 AS j1, CAST(0 AS BIGINT) AS matched FROM pairs
  UNION ALL SELECT a, b, CASE side WHEN 0 THEN i0 ELSE best.i + best.n END, CASE side WHEN 0 THEN best.i ELSE i1 END,
    CASE side WHEN 0 THEN j0 ELSE best.j + best.n END, CASE side WHEN 0 THEN best.j ELSE j1 END, CASE side WHEN 0 THEN best.n ELSE 0 END
  FROM (SELECT a, b, i0, i1, j0, j1, arg_min({{'i': i, 'j': j, 'n': least(n, i1 - i, j1 - j)}}, {{'n': -least(n, i1 - i, j1 - j), 'i': i, 'j': j}}) AS best
    FROM spans JOIN runs USING (a, b) WHERE i >= i0 AND i < i1 AND j >= j0 AND j < j1 GROUP BY ALL), (VALUES (0), (1)) v(side)),
ratios AS (SELECT a, b, 2.0 * sum(matched) / (length(a) + length(b)) AS score FROM spans GROUP BY a, b),
best AS (SELECT a, arg_min({{'name': canonical_company_name, 'score': score}}, {{'s': -score, 'tie': tie}}) AS best FROM ratios JOIN canon USING (b) GROUP BY 1)
SELECT cfpb_company_name, complaints, best.name AS suggested_canonical_company_name, CAST(NULL AS VARCHAR) AS suggested_sec_cik, CAST(NULL AS VARCHAR) AS suggested_ticker,
  'fuzzy_suggestion' AS match_method, CAST(round(best.score, 6) AS DOUBLE) AS match_score,
  CASE WHEN best.score >= 0.96 THEN '{HIGH}' WHEN best.score >= 0.88 THEN '{MEDIUM}' ELSE '{LOW}' END AS confidence_tier, true AS manual_review_required, {quoted(FUZZY_NOTE)} AS notes
FROM open JOIN best USING (a)"""

ORACLE = {
    "entity_review": REVIEW_SQL,
    "facts_scan": f"WITH {FACTS_SQL} SELECT * FROM facts",
    "facts_errors": "SELECT count(*) AS documents FROM orders WHERE o_orderkey % 20 = 0",
    "facts_annual": f"WITH {FACTS_SQL} SELECT * EXCLUDE (has_year) FROM annual",
    "facts_resolved": f"WITH {FACTS_SQL} SELECT * FROM resolved",
    "facts_resolved_first": f"WITH {RESOLVED_FIRST} SELECT * FROM resolved",
    "facts_latest": f"WITH {FACTS_SQL} SELECT * FROM latest",
    "facts_scale": f"""WITH {FACTS_SQL}, {SEED_SQL}, wide AS (
  SELECT sec_cik, max(value) FILTER (metric_name = 'assets') AS assets, max(value) FILTER (metric_name = 'revenue') AS revenue,
         max(value) FILTER (metric_name = 'net_income') AS net_income,
         max(value) FILTER (metric_name = 'operating_income') AS operating_income, max(fiscal_year) AS scale_fiscal_year
  FROM latest GROUP BY 1)
SELECT entity_map.* EXCLUDE (seed_order), wide.* EXCLUDE (sec_cik), confidence_tier = 'HIGH CONFIDENCE'
  AND (assets IS NOT NULL OR revenue IS NOT NULL) AND NOT manual_review_required AS normalization_allowed,
  '{SCALE_NOTE}' AS normalization_note
FROM entity_map LEFT JOIN wide USING (sec_cik)""",
    "facts_status": f"""WITH {FACTS_SQL}, {SEED_SQL}, lineage AS (
  SELECT resolved.* FROM resolved JOIN entity_map USING (sec_cik) WHERE confidence_tier = 'HIGH CONFIDENCE')
SELECT (SELECT count(*) FROM entity_map WHERE confidence_tier = 'HIGH CONFIDENCE') AS companies_requested,
  count(DISTINCT sec_cik) AS registrants_with_observations, count(DISTINCT (sec_cik, fiscal_year)) AS company_year_observations,
  (SELECT count(*) FROM orders WHERE o_orderkey % 20 = 0) AS errors FROM lineage""",
    "macro_observation_scan": f"""SELECT l_returnflag AS series_id, l_returnflag AS description, '{MACRO_SOURCE}' AS source,
  count(*) AS observations, round(sum(l_extendedprice), 2) AS total, strftime(min(l_shipdate), '%Y-%m-%d') AS first_date
FROM lineitem WHERE l_partkey % 8 <> 0 GROUP BY 1""",
    "macro_status": "SELECT count(DISTINCT l_returnflag) AS series, count(*) AS observations FROM lineitem",
    "macro_monthly": f"WITH {MACRO_MONTHS} SELECT series_id, month, complaints, round(value, 8) AS value FROM joined",
    "lag_correlation": f"""WITH {MACRO_MONTHS}, shifted AS (
  SELECT series_id, k, complaints, CASE k WHEN 0 THEN value WHEN 1 THEN lag(value, 1) OVER w WHEN 3 THEN lag(value, 3) OVER w
         ELSE lag(value, 6) OVER w END AS v, count(*) OVER (PARTITION BY series_id, k) AS months
  FROM joined CROSS JOIN (VALUES (0), (1), (3), (6)) AS lags(k) WINDOW w AS (PARTITION BY series_id, k ORDER BY month))
SELECT series_id, CAST(k AS BIGINT) AS lag_months, round(corr(v, complaints), 6) AS correlation, count(v) AS paired_months,
  series_id AS description, '{MACRO_CAVEAT}' AS caveat FROM shifted WHERE months >= 12 GROUP BY series_id, k""",
    "wage_table": f"""WITH {WAGES_SQL} SELECT *, '{WAGE_PERIOD}' AS benchmark_period, '{WAGE_SOURCE}' AS source,
  '{WAGE_SOURCE_URL}' AS source_url, '{WAGE_NOTE}' AS benchmark_note FROM wages""",
    "default_wage": f"WITH {WAGES_SQL} SELECT round(coalesce(avg(mean_hourly_wage), 24.0), 8) AS hourly_wage FROM wages WHERE occupation_code = '43-4051'",
    "seed_recovery": """SELECT s_name || CASE WHEN s_suppkey % 3 = 0 THEN ', N.A.' ELSE '' END || CASE WHEN regular THEN ' "Q"' ELSE '' END AS cfpb_company_name,
  'Parent Corp.' AS canonical_company_name,
  CASE s_suppkey % 10 WHEN 9 THEN NULL WHEN 8 THEN CAST(s_suppkey AS VARCHAR) ELSE lpad(CAST(s_suppkey AS VARCHAR), 10, '0') END AS sec_cik, 'TCK' AS ticker,
  'manual_seed' AS match_method, '0.98' AS confidence, 'false' AS manual_review_flag,
  CASE WHEN regular THEN 'Public, listed.' ELSE 'Public, see,0000000001,a,b,c,d' END AS notes
FROM (SELECT *, s_suppkey % 2 = 0 OR s_suppkey % 10 = 9 AS regular FROM supplier)""",
    "seed_coercion": f"WITH {SEED_SQL} SELECT * REPLACE (round(match_score, 4) AS match_score) FROM entity_map",
    "company_name_forms": f"""SELECT s_suppkey, array_to_string(list_filter(string_split_regex(regexp_replace(replace(lower(
    'The ' || s_name || ' & Sons, Nat''l. Bank, N.A. of ' || n_name || ' INC.'), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +'),
  lambda w: w <> '' AND w NOT IN ({", ".join(f"'{w}'" for w in LEGAL_SUFFIXES)})), ' ') AS normalized
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "company_counts": f"WITH {CASES}, {COMPANIES_SQL} SELECT * FROM companies",
    "unmapped_companies": f"""WITH {CASES}, {COMPANIES_SQL}, {SEED_SQL}
SELECT * FROM companies WHERE lower(cfpb_company_name) NOT IN (SELECT lower(cfpb_company_name) FROM seed)
ORDER BY complaints DESC, cfpb_company_name LIMIT 200""",
    "mapped_companies": f"""WITH {CASES}, {COMPANIES_SQL}, {SEED_SQL}
SELECT * FROM companies WHERE lower(cfpb_company_name) IN (SELECT lower(cfpb_company_name) FROM seed)""",
    "mapping_coverage": f"""WITH {CASES}, {COMPANIES_SQL}, {SEED_SQL}, flagged AS (
  SELECT complaints, lower(cfpb_company_name) IN (SELECT lower(cfpb_company_name) FROM seed) AS mapped,
         lower(cfpb_company_name) IN (SELECT lower(cfpb_company_name) FROM entity_map WHERE confidence_tier = 'HIGH CONFIDENCE') AS high
  FROM companies)
SELECT count(*) AS distinct_companies, (SELECT count(*) FROM seed) AS seed_mappings,
  (SELECT count(*) FROM entity_map WHERE confidence_tier = 'HIGH CONFIDENCE') AS high_confidence_mappings,
  (SELECT count(*) FROM entity_map WHERE confidence_tier LIKE 'MEDIUM%') AS medium_review_mappings,
  round(count(*) FILTER (mapped) / CAST(count(*) AS DOUBLE), 6) AS coverage_by_company,
  round(sum(complaints) FILTER (mapped) / CAST(sum(complaints) AS DOUBLE), 6) AS coverage_by_volume,
  round(sum(complaints) FILTER (high) / CAST(sum(complaints) AS DOUBLE), 6) AS high_confidence_coverage_by_volume FROM flagged""",
    "entity_alias_review": f"""WITH {CASES}, {COMPANIES_SQL}, {SEED_SQL}, open AS (
  SELECT * FROM companies WHERE lower(cfpb_company_name) NOT IN (SELECT lower(cfpb_company_name) FROM seed)
  ORDER BY complaints DESC, cfpb_company_name LIMIT 200),
named AS (SELECT *, regexp_extract(replace(lower(cfpb_company_name), '#', ' '), 'customer 00000([0-8])', 1) AS digit FROM open)
SELECT named.cfpb_company_name, complaints, canonical_company_name AS suggested_canonical_company_name,
  sec_cik AS suggested_sec_cik, ticker AS suggested_ticker, 'alias_suggestion' AS match_method, CAST(0.9 AS DOUBLE) AS match_score,
  'MEDIUM - REVIEW' AS confidence_tier, true AS manual_review_required, '{ALIAS_NOTE}' AS notes
FROM named JOIN seed ON canonical_company_name = 'Supplier#00000000' || digit || ' Financial Corp.' WHERE digit <> ''""",
}
