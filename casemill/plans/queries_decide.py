"""Registered queries: opportunities, value model, governance, classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.fixed import (
    ASSUMPTION_DEFAULTS, CATALOG_TEXT, CONTROL_LIBRARY, DEFAULT_CONTROLS, DEFAULT_OPPORTUNITY, OPPORTUNITY_PATTERNS,
    OPPORTUNITY_TEXT, SCENARIOS, SENSITIVITY_FIELDS, TRUSTWORTHY_DIMENSIONS,
)
from casemill.operators import anomaly, classification, governance, opportunities, value
from casemill.plans.queries_core import rounded
from casemill.plans.sql import CASES, quoted, scores
from casemill.plans.tables import cases, table


# --- opportunities ------------------------------------------------------------------------------------
def issue_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints whose product and issue hold pattern keywords: part types and names get a phrase by their key."""
    phrases = F.array(*[F.lit(p) for p in PHRASES])
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    key = F.col("l_partkey")
    return line.join(part, key == F.col("p_partkey"), "left").select(
        F.nullif("p_type", F.lit("ECONOMY")).alias("product"),
        F.element_at(phrases, (key % len(PHRASES) + 1).cast("int")).alias("issue"), F.col("l_shipdate").alias("date_received"),
    )


PHRASES = ["Wrong department and fraud", "Account statement", "Late FEE", "Letter never came", "Identity theft", "Volume", "Delay in call",
           "Closed", "Other"]
ISSUES_SQL = f"""cases AS (
  SELECT nullif(p_type, 'ECONOMY') AS product, [{", ".join(quoted(p) for p in PHRASES)}][l_partkey % {len(PHRASES)} + 1] AS issue,
         l_shipdate AS date_received
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
)"""
PATTERN_SQL = "CASE " + " ".join(
    f"WHEN {' OR '.join(f'contains(txt, {quoted(k)})' for k in keywords)} THEN {quoted(name)}" for name, keywords, _ in OPPORTUNITY_PATTERNS
) + f" ELSE {quoted(DEFAULT_OPPORTUNITY[0])} END"
INTERVENTION_SQL = "CASE opportunity_name " + " ".join(
    f"WHEN {quoted(name)} THEN {quoted(text)}" for name, _, text in OPPORTUNITY_PATTERNS
) + f" ELSE {quoted(DEFAULT_OPPORTUNITY[1])} END"
OPPORTUNITIES_SQL = f"""pairs AS (
  SELECT product, issue, count(*) AS n, lower(coalesce(product, 'Missing') || ' ' || coalesce(issue, 'Missing')) AS txt
  FROM cases GROUP BY 1, 2 ORDER BY n DESC, product NULLS LAST, issue NULLS LAST LIMIT 30
), named AS (SELECT *, {PATTERN_SQL} AS opportunity_name FROM pairs), opps AS (
  SELECT opportunity_name, 'High complaint volume for ' || coalesce(product, 'Missing') || ' / ' || coalesce(issue, 'Missing')
    AS observed_problem, n AS supporting_data, product AS affected_products, issue AS affected_issues,
    {INTERVENTION_SQL} AS potential_ai_intervention,
    {", ".join(f"{quoted(t)} AS {c}" for c, t in OPPORTUNITY_TEXT.items())}
  FROM named
)"""


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opportunities.derive_opportunities(issue_texts(spark, sf_dir))


def opportunities_with_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = issue_texts(spark, sf_dir)
    return opportunities.derive_opportunities(rows, anomaly.emerging_scores(rows))


# --- value --------------------------------------------------------------------------------------------
def workloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints per product and issue as workloads, with a wage that depends on the issue."""
    counts = cases(spark, sf_dir, "product", "issue").groupBy("product", "issue").agg(F.count(F.lit(1)).alias("observed_complaints"))
    return counts.withColumn("hourly_wage", F.lit(20.0) + F.substring("issue", 1, 1).cast("double")) \
        .withColumn("observed_complaints", F.col("observed_complaints") * 1000)


WORKLOADS_SQL = f"""{CASES}, workloads AS (
  SELECT product, issue, count(*) * 1000 AS observed_complaints, 20.0 + CAST(issue[1] AS DOUBLE) AS hourly_wage,
         {", ".join(f"CAST({v!r} AS DOUBLE) AS {c}" for c, v in ASSUMPTION_DEFAULTS.items())}
  FROM cases GROUP BY 1, 2
)"""


def value_sql(source: str) -> str:
    """CTEs from a table of assumptions to all outputs."""
    return f"""hours AS (
  SELECT *, observed_complaints * average_handling_minutes / 60 AS observed_hours_workload,
         observed_complaints * ai_addressable_share AS ai_addressable_complaints FROM {source}
), released AS (
  SELECT *, observed_hours_workload * ai_addressable_share * time_reduction AS gross_hours_released,
         observed_hours_workload * ai_addressable_share * time_reduction * adoption_rate * success_probability AS expected_hours_released,
         implementation_cost + 3 * annual_operating_cost AS total_cost FROM hours
), net AS (
  SELECT *, expected_hours_released * hourly_wage AS estimated_annual_capacity_value,
         expected_hours_released * hourly_wage - annual_operating_cost AS annual_net_value FROM released
), outputs AS (
  SELECT * EXCLUDE (total_cost), 3 * annual_net_value - implementation_cost AS three_year_net_value,
         (3 * estimated_annual_capacity_value - total_cost) / nullif(total_cost, 0) AS roi,
         annual_net_value / (1 + discount_rate) + annual_net_value / (1 + discount_rate) ** 2
           + annual_net_value / (1 + discount_rate) ** 3 - implementation_cost AS npv,
         CASE WHEN annual_net_value <= 0 THEN CAST('inf' AS DOUBLE) ELSE implementation_cost / annual_net_value END AS payback_years
  FROM net
)"""


VALUE_OUTPUTS = ["observed_hours_workload", "ai_addressable_complaints", "gross_hours_released", "expected_hours_released",
                 "estimated_annual_capacity_value", "annual_net_value", "three_year_net_value", "roi", "npv"]
ROUND_OUTPUTS = ", ".join(f"round({c}, 4) AS {c}" for c in VALUE_OUTPUTS)
FIELDS_SQL = ["observed_complaints", "hourly_wage", *ASSUMPTION_DEFAULTS]
SCENARIO_SQL = f"""scenarios AS (SELECT * FROM (VALUES {", ".join(
    f"({quoted(n)}, " + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in f.values()) + ")" for n, f in SCENARIOS.items())})
  AS s(scenario, s_share, s_time, s_adoption, s_success, s_cost)),
cells AS (SELECT product, issue, scenario, observed_complaints, hourly_wage, average_handling_minutes, s_share AS ai_addressable_share,
  s_time AS time_reduction, s_adoption AS adoption_rate, implementation_cost * s_cost AS implementation_cost, annual_operating_cost,
  s_success AS success_probability, discount_rate FROM workloads CROSS JOIN scenarios)"""


def sensitivity_sql() -> str:
    """One CTE per field and side, combined with the base outputs."""
    parts, selects = [f"WITH {WORKLOADS_SQL}, {value_sql('workloads')}"], []
    for i, field in enumerate(SENSITIVITY_FIELDS):
        sides = {}
        for side, factor in (("low", 0.8), ("high", 1.2)):
            c = {f: f for f in FIELDS_SQL} | {field: f"({field} * {factor})"}
            sides[side] = (f"(({c['observed_complaints']} * {c['average_handling_minutes']} / 60 * {c['ai_addressable_share']} * {c['time_reduction']}"
                           f" * {c['adoption_rate']} * {c['success_probability']} * {c['hourly_wage']} - {c['annual_operating_cost']}) * 3"
                           f" - {c['implementation_cost']})")
        selects.append(f"SELECT product, issue, {quoted(field)} AS assumption, round({sides['low']} - three_year_net_value, 4) AS low_case_delta, "
                       f"round({sides['high']} - three_year_net_value, 4) AS high_case_delta, "
                       f'round(abs({sides["high"]} - {sides["low"]}), 4) AS "range" FROM outputs')
    return parts[0] + "\n" + "\nUNION ALL\n".join(selects)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as value samples."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) - 25000).alias("npv"),
        F.when(F.col("l_quantity") < 5, F.lit(float("inf"))).otherwise(F.col("l_quantity") / 10).alias("payback_years"),
    )


# --- governance ---------------------------------------------------------------------------------------
def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.governance_catalog(derived(spark, sf_dir))


CONTROLS_SQL = "CASE ai_use_case " + " ".join(
    f"WHEN {quoted(k)} THEN {quoted(' | '.join(v))}" for k, v in CONTROL_LIBRARY.items()
) + f" ELSE {quoted(' | '.join(CONTROL_LIBRARY[DEFAULT_CONTROLS]))} END"
CATALOG_SQL = f"""{ISSUES_SQL}, {OPPORTUNITIES_SQL}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY opportunity_name ORDER BY supporting_data DESC, potential_ai_intervention DESC) AS rn FROM opps
), catalog AS (
  SELECT opportunity_name AS ai_use_case, potential_ai_intervention AS intended_purpose, risk_considerations AS major_risks,
         CASE WHEN regexp_matches(lower(opportunity_name), 'routing|summarization|assistant') THEN 4 ELSE 3 END AS score,
         {quoted(", ".join(TRUSTWORTHY_DIMENSIONS))} AS nist_dimensions,
         {", ".join(f"{quoted(t)} AS {c}" for c, t in CATALOG_TEXT.items())}
  FROM firsts WHERE rn = 1
), full_catalog AS (
  SELECT * EXCLUDE (score), CASE WHEN score >= 5 THEN 'High' WHEN score >= 3 THEN 'Moderate' ELSE 'Low' END AS risk_tier,
         {CONTROLS_SQL} AS recommended_controls FROM catalog
)"""


def risk_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of one use case per part, named after the part, with impact and kind by key."""
    key = F.col("p_partkey")
    name = F.concat_ws(" ", F.col("p_name"), F.when(key % 3 == 0, "Routing").when(key % 3 == 1, "assistant").otherwise("search"))
    impact = F.when(key % 4 == 0, "high").when(key % 4 == 1, "medium").otherwise("low")
    return table(spark, sf_dir, "part").select("p_partkey", governance.risk_tier(name, impact, key % 5 != 0).alias("tier"))


def risk_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    risks = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("risk_id"), (F.col("p_size") % 5 + 1).alias("likelihood"), (F.col("p_partkey").cast("int") % 5 + 1).alias("impact"))
    return governance.severity(risks)


def monitoring_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct items of a comma-separated list built from part attributes."""
    lists = table(spark, sf_dir, "part").select(F.concat_ws(" , ", "p_brand", "p_type", "p_name").alias("monitoring_metrics"))
    return governance.distinct_list_items(lists, "monitoring_metrics")


# --- classification -----------------------------------------------------------------------------------
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priority as label, predicted by a rule on the order value; one label is never predicted."""
    band = F.floor(F.col("o_totalprice") / 125000)
    predicted = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(
        F.element_at(F.array(*[F.lit(p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM")]), (band % 3 + 1).cast("int")))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("label"),
        F.when(predicted == "5-LOW", "1-URGENT").otherwise(predicted).alias("prediction"))


PREDICTIONS_SQL = """predictions AS (
  SELECT label, CASE WHEN p = '5-LOW' THEN '1-URGENT' ELSE p END AS prediction FROM (
    SELECT o_orderpriority AS label, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority
      ELSE ['1-URGENT', '2-HIGH', '3-MEDIUM'][CAST(floor(o_totalprice / 125000) AS BIGINT) % 3 + 1] END AS p FROM orders)
)"""
REPORT_SQL = """classes AS (SELECT label AS class FROM predictions UNION SELECT prediction FROM predictions), counted AS (
  SELECT class, (SELECT count(*) FROM predictions WHERE label = class AND prediction = class) AS tp,
         (SELECT count(*) FROM predictions WHERE label = class) AS support,
         (SELECT count(*) FROM predictions WHERE prediction = class) AS predicted FROM classes
), report AS (
  SELECT class, coalesce(tp / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS precision, coalesce(tp / CAST(nullif(support, 0) AS DOUBLE), 0) AS recall,
         coalesce(2 * tp / CAST(nullif(predicted + support, 0) AS DOUBLE), 0) AS f1, support, tp FROM counted
)"""
SUMMARY_SQL = """SELECT CAST(sum(support) AS BIGINT) AS records, count(*) AS classes, round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) AS accuracy,
  round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
  round(sum(precision * support) / sum(support), 6) AS weighted_precision, round(sum(recall * support) / sum(support), 6) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM report"""
SUMMARY_RATES = ["accuracy", *[f"{k}_{m}" for k in ("macro", "weighted") for m in ("precision", "recall", "f1")]]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("label"))


def majority_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the majority-class baseline on the held-out quarter."""
    split = classification.stratified_split(labelled(spark, sf_dir), "label", "doc_id")
    guessed = classification.majority_baseline(split.filter(~F.col("is_test")), split.filter("is_test"))
    return rounded(classification.summary_report(guessed), 6, *SUMMARY_RATES)


SPLIT_SQL = """split AS (
  SELECT o_orderkey AS doc_id, o_orderpriority AS label, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || ':42'), o_orderkey)
    <= round(count(*) OVER (PARTITION BY o_orderpriority) * 0.25) AS is_test FROM orders
)"""

QUERIES = {
    "pair_counts": lambda s, d: opportunities.pair_counts(issue_texts(s, d)),
    "opportunities": derived,
    "opportunities_with_signal": opportunities_with_signal,
    "value_table": lambda s, d: rounded(value.calculate_value(workloads(s, d)), 4, *VALUE_OUTPUTS, "payback_years"),
    "value_scenarios": lambda s, d: rounded(value.scenario_table(workloads(s, d)), 4, *VALUE_OUTPUTS, "payback_years", "implementation_cost"),
    "value_sensitivity": lambda s, d: rounded(value.sensitivity(workloads(s, d)), 4, "low_case_delta", "high_case_delta", "range")
    .select("product", "issue", "assumption", "low_case_delta", "high_case_delta", "range"),
    "sensitivity_ranking": lambda s, d: value.sensitivity(workloads(s, d)).select("product", "issue", "assumption", "rank"),
    "sample_summary": lambda s, d: rounded(value.sample_summary(samples(s, d)), 4, "median_npv", "p10_npv", "p50_npv", "p90_npv",
                                           "probability_npv_positive", "probability_payback_within_3_years"),
    "governance_catalog": catalog,
    "governance_controls": lambda s, d: governance.control_count(catalog(s, d)),
    "governed_opportunities": lambda s, d: governance.join_catalog(derived(s, d), catalog(s, d))
    .select("opportunity_name", "affected_products", "affected_issues", "supporting_data", "risk_tier", "recommended_controls"),
    "risk_tiers": risk_tiers,
    "risk_severity": risk_severity,
    "monitoring_metrics": monitoring_metrics,
    "class_report": lambda s, d: rounded(classification.class_report(predictions(s, d)), 6, "precision", "recall", "f1"),
    "summary_report": lambda s, d: rounded(classification.summary_report(predictions(s, d)), 6, *SUMMARY_RATES),
    "eligible_classes": lambda s, d: classification.eligible_classes(
        table(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("label")), "label", 2200),
    "stratified_split": lambda s, d: classification.stratified_split(labelled(s, d), "label", "doc_id"),
    "majority_report": majority_report,
}

ORACLE = {
    "pair_counts": f"""WITH {ISSUES_SQL} SELECT product, issue, count(*) AS observed_complaints FROM cases GROUP BY 1, 2
ORDER BY 3 DESC, product NULLS LAST, issue NULLS LAST LIMIT 30""",
    "opportunities": f"WITH {ISSUES_SQL}, {OPPORTUNITIES_SQL} SELECT * FROM opps",
    "opportunities_with_signal": f"""WITH {scores("issue").replace(CASES, ISSUES_SQL)}, {OPPORTUNITIES_SQL}
SELECT opps.*, coalesce(emerging_issue_score, 0) AS emerging_issue_signal FROM opps LEFT JOIN scores ON affected_issues = scores.issue""",
    "value_table": f"WITH {WORKLOADS_SQL}, {value_sql('workloads')} SELECT product, issue, {', '.join(FIELDS_SQL)}, {ROUND_OUTPUTS}, "
                   "round(payback_years, 4) AS payback_years FROM outputs",
    "value_scenarios": f"""WITH {WORKLOADS_SQL}, {SCENARIO_SQL}, {value_sql('cells')} SELECT product, issue, scenario,
  {', '.join(f for f in FIELDS_SQL if f != 'implementation_cost')}, round(implementation_cost, 4) AS implementation_cost, {ROUND_OUTPUTS},
  round(payback_years, 4) AS payback_years FROM outputs""",
    "value_sensitivity": sensitivity_sql(),
    "sensitivity_ranking": f"""SELECT product, issue, assumption, CAST(row_number() OVER (PARTITION BY product, issue ORDER BY "range" DESC,
  list_position([{", ".join(map(quoted, SENSITIVITY_FIELDS))}], assumption)) AS INTEGER) AS rank FROM ({sensitivity_sql()})""",
    "sample_summary": """WITH samples AS (SELECT l_extendedprice * (1 - l_discount) - 25000 AS npv,
  CASE WHEN l_quantity < 5 THEN CAST('inf' AS DOUBLE) ELSE l_quantity / 10 END AS payback_years FROM lineitem)
SELECT count(*) AS simulations, round(median(npv), 4) AS median_npv, round(quantile_cont(npv, 0.1), 4) AS p10_npv,
  round(quantile_cont(npv, 0.5), 4) AS p50_npv, round(quantile_cont(npv, 0.9), 4) AS p90_npv,
  round(avg(CASE WHEN npv > 0 THEN 1.0 ELSE 0.0 END), 4) AS probability_npv_positive,
  round(avg(CASE WHEN payback_years <= 3 THEN 1.0 ELSE 0.0 END), 4) AS probability_payback_within_3_years FROM samples""",
    "governance_catalog": f"WITH {CATALOG_SQL} SELECT * FROM full_catalog",
    "governance_controls": f"""WITH {CATALOG_SQL} SELECT count(DISTINCT ai_use_case) AS governance_use_cases,
  CAST(sum(length(recommended_controls) - length(replace(recommended_controls, '|', '')) + 1) AS BIGINT) AS governance_controls FROM full_catalog""",
    "governed_opportunities": f"""WITH {CATALOG_SQL} SELECT opportunity_name, affected_products, affected_issues, supporting_data,
  risk_tier, recommended_controls FROM opps LEFT JOIN full_catalog ON opportunity_name = ai_use_case""",
    "risk_tiers": """WITH scored AS (SELECT p_partkey, 1 + CASE WHEN p_partkey % 4 = 0 THEN 2 WHEN p_partkey % 4 = 1 THEN 1 ELSE 0 END
  + CASE WHEN p_partkey % 5 <> 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 3 < 2 THEN 1 ELSE 0 END AS score FROM part)
SELECT p_partkey, CASE WHEN score >= 5 THEN 'High' WHEN score >= 3 THEN 'Moderate' ELSE 'Low' END AS tier FROM scored""",
    "risk_severity": """WITH risks AS (SELECT p_partkey AS risk_id, p_size % 5 + 1 AS likelihood, CAST(p_partkey % 5 + 1 AS INTEGER) AS impact FROM part)
SELECT *, likelihood * impact AS severity FROM risks""",
    "monitoring_metrics": """SELECT count(DISTINCT trim(item)) AS items FROM
  (SELECT unnest(string_split(concat_ws(' , ', p_brand, p_type, p_name), ',')) AS item FROM part)""",
    "class_report": f"WITH {PREDICTIONS_SQL}, {REPORT_SQL} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                    "round(f1, 6) AS f1, support, tp FROM report",
    "summary_report": f"WITH {PREDICTIONS_SQL}, {REPORT_SQL} {SUMMARY_SQL}",
    "eligible_classes": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS label FROM orders
WHERE year(o_orderdate) IN (SELECT year(o_orderdate) FROM orders GROUP BY 1 HAVING count(*) >= 2200)""",
    "stratified_split": f"WITH {SPLIT_SQL} SELECT * FROM split",
    "majority_report": f"""WITH {SPLIT_SQL}, predictions AS (SELECT label, (SELECT label FROM split WHERE NOT is_test GROUP BY 1
  ORDER BY count(*) DESC, 1 LIMIT 1) AS prediction FROM split WHERE is_test), {REPORT_SQL} {SUMMARY_SQL}""",
}
