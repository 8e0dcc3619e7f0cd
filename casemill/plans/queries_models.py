"""Registered queries: topics, router, answers, final metrics, nightly refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.fixed import ABSTAIN_TEXT, ANSWER_MODE, ANSWER_TEXT, ASSUMPTION_DEFAULTS, COMPLAINT_COLUMNS, NO_GROWTH_TEXT, REQUIRED_COLUMNS
from casemill.functions.text import narratives
from casemill.operators import answers, evaluation, rollup, router, topics
from casemill.plans import nightly
from casemill.plans.queries_core import rounded
from casemill.plans.queries_decide import CATALOG_SQL, ISSUES_SQL, OPPORTUNITIES_SQL, REPORT_SQL, SPLIT_SQL, SUMMARY_SQL, derived, quoted, value_sql
from casemill.plans.queries_retrieval import FLAGS, ROLL_UP_SQL, built_index, filtered_questions, hybrid_fixed, hybrid_sql, index_report, report_sql
from casemill.plans.queries_text import DOCS_SQL, clean_sql, docs_of
from casemill.plans.sql import CASES, scores
from casemill.plans.tables import cases, documents, table
from casemill.session import freed_shuffles, materialize, scratch_path
from casemill.sources import complaints


# --- topics and router --------------------------------------------------------------------------------
def topic_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per language, added up over the registry of fitted topics, with what must hold of it: volumes are those of the written assignments, names and terms are
    those of vocabulary words, the examples of a topic are assigned to it with its best scores."""
    docs = docs_of(spark, sf_dir)
    registry, assigned = topics.discover_topics(docs)
    registry = materialize(registry, "registry")
    volumes = assigned.groupBy("topic_id").agg(F.count(F.lit(1)).alias("n"), F.max("topic_score").alias("best"))
    joined = registry.join(volumes, "topic_id", "left")
    examples = joined.select("topic_id", "best", F.posexplode("representatives").alias("at", "complaint_id")).join(
        assigned.select("complaint_id", F.col("topic_id").alias("own"), "topic_score"), "complaint_id")
    fits = joined.select(F.struct(
        F.bool_and(F.col("volume") == F.coalesce("n", F.lit(0))).alias("volumes"), F.count_distinct("topic_name").alias("names"),
        F.bool_and((F.size(F.split("top_terms", ", ")) == topics.TERMS_PER_TOPIC) & F.startswith(F.replace("top_terms", F.lit(", "), F.lit("; ")), "topic_name")).alias("terms"))).scalar()
    shown = examples.select(F.bool_and((F.col("own") == F.col("topic_id")) & ((F.col("at") > 0) | (F.col("topic_score") == F.col("best"))))).scalar()
    languages = registry.select(F.explode("product_distribution").alias("lang", "n")).groupBy("lang").agg(F.sum("n").alias("documents"))
    return languages.withColumns({"volumes_fit": fits["volumes"], "terms_fit": fits["terms"], "names": fits["names"], "examples_fit": shown})


def router_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, classes and baseline of the router, whether its fit converged, and whether its quality reaches a floor."""
    report = rounded(router.train_router(docs_of(spark, sf_dir), min_class=10).report, 4, "baseline_macro_f1")
    return report.withColumn("model_reaches_floor", (F.col("model_macro_f1") >= 0.9) & (F.col("accuracy") >= 0.9)).drop("model_macro_f1", "accuracy")


def given_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of documents whose topic and score are given: the source number and the text length."""
    assigned = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("complaint_id"), (F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 7).alias("topic_id"),
        F.col("n_chars").cast("double").alias("topic_score"), F.col("lang").alias("product"), F.col("source").alias("company"))
    names = assigned.select("topic_id").distinct().withColumns({"topic_name": F.lit("given"), "top_terms": F.lit("given")})
    registry = topics.topic_registry(assigned, names)

    def listed(column: str) -> F.Column:
        entries = F.transform(F.map_entries(column), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k")))
        return F.array_join(F.transform(F.array_sort(entries), lambda e: F.concat_ws("=", e["k"], (-e["n"]).cast("string"))), "; ")

    return registry.select("topic_id", "volume", listed("product_distribution").alias("products"), listed("company_distribution").alias("companies"),
                           F.array_join(F.transform("representatives", lambda r: r.cast("string")), ",").alias("representatives"))


def top_list_sql(column: str, name: str) -> str:
    return f"""{name} AS (SELECT topic_id, string_agg({column} || '=' || n, '; ' ORDER BY n DESC, {column}) AS {name} FROM (
  SELECT topic_id, {column}, count(*) AS n, row_number() OVER (PARTITION BY topic_id ORDER BY count(*) DESC, {column}) AS rn
  FROM assigned GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1)"""


# --- answers ------------------------------------------------------------------------------------------
def document_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as complaints: language, source, and the date, priority and status of the order of the same number."""
    orders = table(spark, sf_dir, "orders")
    docs = documents(spark, sf_dir).select("complaint_id", "product", "company", "state")
    return docs.join(orders, F.col("complaint_id") == F.col("o_orderkey"), "left").select(
        *docs.columns, F.col("o_orderdate").alias("date_received"), F.col("o_orderpriority").alias("issue"),
        F.nullif("o_orderstatus", F.lit("P")).alias("company_response_to_consumer"),
        F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No").alias("timely_response"))


def answer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The evidence is a few written rows per question; only the documents in it are cleaned again, for their excerpts.
    evidence = materialize(hybrid_fixed(spark, sf_dir, 8)[0], "evidence")
    cited = narratives(documents(spark, sf_dir).join(evidence.select("complaint_id"), "complaint_id", "left_semi"))
    answered = answers.answer_questions(filtered_questions(spark, sf_dir), document_cases(spark, sf_dir), evidence, cited)
    return rounded(answered, 6, "timely_response_rate", "growth_rate").select(
        "question_id", "complaints", "date_min", "date_max", "timely_response_rate", "growth_rate", "answer", "mode",
        F.array_join("citations", " ").alias("citations"), F.coalesce(F.array_size("evidence"), F.lit(0)).alias("n_evidence"))


def text_sql(text: str, *parts: str) -> str:
    """SQL concatenation of a text with %s places."""
    pieces = [quoted(p).replace("\n", "' || chr(10) || '") for p in text.split("%s")]
    return " || ".join(x for pair in zip(pieces, [*parts, "''"]) for x in pair)


ANSWERS_SQL = f"""WITH {hybrid_sql(8)}, complaint_rows AS (
  SELECT item_id AS question_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderdate, coalesce(o_orderpriority, 'Missing') AS issue,
         CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS timely
  FROM filters f JOIN documents d ON (f.lang IS NULL OR lower(d.lang) = f.lang) AND (f.source IS NULL OR lower(d.source) = f.source)
  LEFT JOIN orders ON doc_id = o_orderkey
), totals AS (SELECT question_id, count(*) AS complaints, CAST(min(o_orderdate) AS DATE) AS date_min, CAST(max(o_orderdate) AS DATE) AS date_max,
  avg(timely) AS timely_response_rate FROM complaint_rows GROUP BY 1),
aged AS (SELECT question_id, count(*) AS n, row_number() OVER (PARTITION BY question_id ORDER BY month DESC) AS age
  FROM complaint_rows WHERE month IS NOT NULL GROUP BY question_id, month),
growth AS (SELECT question_id, CASE WHEN count(*) >= 12 THEN (sum(n) FILTER (age <= 6) - sum(n) FILTER (age BETWEEN 7 AND 12))
  / CAST(sum(n) FILTER (age BETWEEN 7 AND 12) AS DOUBLE) END AS growth_rate FROM aged GROUP BY 1),
issue_list AS (SELECT question_id, string_agg(issue || ' (' || format('{{:,}}', n) || ')', ', ' ORDER BY n DESC, issue) AS issues FROM (
  SELECT question_id, issue, count(*) AS n, row_number() OVER (PARTITION BY question_id ORDER BY count(*) DESC, issue) AS rn
  FROM complaint_rows GROUP BY 1, 2) WHERE rn <= 3 GROUP BY 1),
cited AS (SELECT question_id, count(*) AS n, string_agg('[CFPB Complaint ' || complaint_id || ']', ' ' ORDER BY rank) AS citations,
  string_agg('[CFPB Complaint ' || complaint_id || ']', ' ' ORDER BY rank) FILTER (rank <= 3) AS first_three FROM top GROUP BY 1),
joined AS (SELECT item_id AS question_id, * EXCLUDE (item_id, text), format('{{:,}}', coalesce(complaints, 0)) AS counted,
  CASE WHEN growth_rate IS NULL THEN {quoted(NO_GROWTH_TEXT)}
       ELSE 'recent 6-month volume changed by ' || printf('%.1f%%', round_even(growth_rate * 100, 1)) END AS growth_text
  FROM benchmark LEFT JOIN totals ON totals.question_id = item_id LEFT JOIN growth ON growth.question_id = item_id
  LEFT JOIN issue_list ON issue_list.question_id = item_id LEFT JOIN cited ON cited.question_id = item_id)
SELECT question_id, complaints, date_min, date_max, round(timely_response_rate, 6) AS timely_response_rate, round(growth_rate, 6) AS growth_rate,
  CASE WHEN n IS NULL THEN {text_sql(ABSTAIN_TEXT, "counted")} ELSE {text_sql(ANSWER_TEXT, "counted", "issues", "first_three", "growth_text")} END AS answer,
  '{ANSWER_MODE}' AS mode, coalesce(citations, '') AS citations, CAST(coalesce(n, 0) AS INTEGER) AS n_evidence FROM joined"""


# --- roll-up and nightly refresh ----------------------------------------------------------------------
def final_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole record: topics, evaluation on a built index, router and index beside the metrics. Of the router's fitted quality it says whether it beats the baseline."""
    index = built_index(spark, sf_dir)
    checked = materialize(evaluation.roll_up(index_report(spark, sf_dir, index)), "evaluated")
    summary = materialize(index.summary(), "index_summary")
    index.delete()  # before the router's tables are written
    report = router.train_router(docs_of(spark, sf_dir), min_class=10).report
    row = rollup.final_metrics(cases(spark, sf_dir), derived(spark, sf_dir), given_topics(spark, sf_dir), checked, report, summary, text="Build")
    row = row.withColumn("model_beats_baseline", F.col("model_macro_f1") > F.col("baseline_macro_f1")).drop("model_macro_f1")
    return rounded(rounded(row, 4, "baseline_estimated_annual_capacity_value", "baseline_three_year_net_value", "baseline_macro_f1"), 6, *FLAGS.values())


def narrative_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cases with the text of the document of the same number as narrative, and its language as product where there is one."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("complaint_id"), "text", "lang")
    return cases(spark, sf_dir, *REQUIRED_COLUMNS).join(docs, "complaint_id", "left").withColumns({
        "consumer_complaint_narrative": F.col("text"), "product": F.coalesce("lang", "product")}).select(REQUIRED_COLUMNS)


def land_valid_csv(spark: SparkSession, sf_dir: str) -> str:
    """The cases as a valid bulk extract with all columns validation asks for."""
    header = {name: text for text, name in COMPLAINT_COLUMNS.items()}
    rows = narrative_cases(spark, sf_dir).withColumn("date_received", F.date_format("date_received", "yyyy-MM-dd"))
    path = scratch_path(spark, "valid_csv")
    with freed_shuffles(spark):
        rows.select([F.col(c).alias(header[c]) for c in REQUIRED_COLUMNS]).write.option("header", True).option("escape", '"').csv(path)
    return path


def nightly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The opportunities of a whole run with topics and router, and what must hold of these: all narratives have a topic, and the router learnt and converged."""
    tables = nightly.run_nightly(spark, land_valid_csv(spark, sf_dir), scratch_path(spark, "nightly"), min_class=10, keep_extract=False)
    documents_in_topics = tables["topics"].select(F.sum("volume")).scalar()
    report = tables["router_report"].select(F.struct("records", "classes", "converged", (F.col("model_macro_f1") > F.col("baseline_macro_f1")).alias("better"))).scalar()
    return tables["opportunities"].withColumns({
        "topic_documents": documents_in_topics, "router_records": report["records"], "router_classes": report["classes"],
        "router_converged": report["converged"], "router_beats_baseline": report["better"]})


def window_of(rows: DataFrame, part: int) -> DataFrame:
    """A window of changed complaints: every seventh has another issue, half of these are two months older, and the window brings some that are new."""
    key = F.col("complaint_id")
    return rows.where(key % 7 == part).withColumns({
        "issue": F.lit(f"changed {part}"), "date_received": F.when(key % 2 == 0, F.col("date_received") - F.expr("interval 2 months")).otherwise(F.col("date_received")),
        "complaint_id": F.when(key % 3 == 0, key + 1_000_000_000).otherwise(key)})


def nightly_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emerging issues after an ingest and two refreshes, from partials of which each refresh recounted its months."""
    output = scratch_path(spark, "nightly")
    nightly.run_nightly(spark, land_valid_csv(spark, sf_dir), output, run_nlp=False, keep_extract=False)
    for part in (1, 2):
        rows = narrative_cases(spark, sf_dir).withColumn("date_received", F.date_trunc("day", "date_received").cast("timestamp_ntz"))
        window = complaints.normalize_columns(window_of(rows, part))
        tables = nightly.refresh_nightly(spark, window, output, run_nlp=False)
    return rounded(tables["emerging_issues"], 6, "baseline_mean", "baseline_std", "z_score", "growth_component", "volume_component")


QUERIES = {
    "topic_registry": topic_registry,
    "given_topics": given_topics,
    "router_report": router_report,
    "answers": answer_table,
    "answer_citations": lambda s, d: rounded(evaluation.answer_citation_rate(answer_table(s, d)), 6, "answer_citation_presence_rate"),
    "final_metrics": final_metrics,
    "nightly_run": nightly_run,
    "nightly_refresh": nightly_refresh,
}

ROUTER_SQL = f"""WITH {DOCS_SQL}, classed AS (SELECT doc_id, lang AS label FROM docs WHERE lang IN (SELECT lang FROM docs GROUP BY 1 HAVING count(*) >= 10)),
{SPLIT_SQL.replace("o_orderkey AS doc_id, o_orderpriority AS label", "doc_id, label").replace("o_orderpriority", "label").replace("o_orderkey", "doc_id").replace("FROM orders", "FROM classed")},
predictions AS (SELECT label, (SELECT label FROM split WHERE NOT is_test GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS prediction FROM split WHERE is_test), {REPORT_SQL}
SELECT 'trained' AS status, 'product' AS target, (SELECT count(*) FROM split) AS records, (SELECT count(DISTINCT label) FROM split) AS classes,
  round(macro_f1, 4) AS baseline_macro_f1, true AS converged, true AS model_reaches_floor FROM ({SUMMARY_SQL})"""
NARRATIVE_CASES = CASES.replace("cases AS (", "plain_cases AS (", 1) + """,
cases AS (SELECT plain_cases.* REPLACE (text AS consumer_complaint_narrative, coalesce(lang, product) AS product, date_trunc('day', date_received) AS date_received)
  FROM plain_cases LEFT JOIN documents ON complaint_id = doc_id)"""
NIGHTLY_SQL = f"""WITH {scores("issue").replace(CASES, NARRATIVE_CASES, 1)}, {OPPORTUNITIES_SQL},
texts AS (SELECT product, clean FROM (SELECT product, {clean_sql("consumer_complaint_narrative")} AS clean FROM cases WHERE consumer_complaint_narrative IS NOT NULL) WHERE length(clean) >= 80),
classes AS (SELECT product, count(*) AS n FROM texts WHERE product IS NOT NULL GROUP BY 1 HAVING count(*) >= 10)
SELECT opps.*, coalesce(emerging_issue_score, 0) AS emerging_issue_signal, (SELECT count(*) FROM texts) AS topic_documents,
  (SELECT CAST(sum(n) AS BIGINT) FROM classes) AS router_records, (SELECT count(*) FROM classes) AS router_classes, true AS router_converged, true AS router_beats_baseline
FROM opps LEFT JOIN scores ON affected_issues = scores.issue"""


def merged_sql(name: str, before: str, part: int) -> str:
    """CTEs of a window and of the complaints after it."""
    return f"""win{part} AS (SELECT * REPLACE ('changed {part}' AS issue, CASE complaint_id % 2 WHEN 0 THEN date_received - INTERVAL 2 MONTH ELSE date_received END AS date_received,
  CASE complaint_id % 3 WHEN 0 THEN complaint_id + 1000000000 ELSE complaint_id END AS complaint_id) FROM landed WHERE complaint_id % 7 = {part}),
{name} AS (SELECT * FROM {before} WHERE complaint_id NOT IN (SELECT complaint_id FROM win{part}) UNION ALL SELECT * FROM win{part})"""


REFRESHED_CASES = f"{NARRATIVE_CASES.replace('cases AS (SELECT plain_cases.*', 'landed AS (SELECT plain_cases.*', 1)}, {merged_sql('once', 'landed', 1)}, {merged_sql('cases', 'once', 2)}"
NIGHTLY_REFRESH_SQL = f"""WITH {scores("issue").replace(CASES, REFRESHED_CASES, 1)}
SELECT month, issue, complaints, round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std, round(z_score, 6) AS z_score,
  coalesce(z_score >= 2, false) AS spike_flag, round(growth_component, 6) AS growth_component, round(volume_component, 6) AS volume_component, emerging_issue_score FROM scores"""

ORACLE = {
    "given_topics": f"""WITH assigned AS (SELECT doc_id, CAST(CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % 7 AS INTEGER) AS topic_id, n_chars, lang, source FROM documents),
volume AS (SELECT topic_id, count(*) AS volume FROM assigned GROUP BY 1), {top_list_sql("lang", "products")}, {top_list_sql("source", "companies")},
best AS (SELECT topic_id, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rn) AS representatives FROM (
  SELECT topic_id, doc_id, row_number() OVER (PARTITION BY topic_id ORDER BY n_chars DESC, doc_id) AS rn FROM assigned) WHERE rn <= 3 GROUP BY 1)
SELECT topic_id, volume, products, companies, representatives FROM volume JOIN products USING (topic_id) JOIN companies USING (topic_id)
JOIN best USING (topic_id)""",
    "answers": ANSWERS_SQL,
    "answer_citations": f"""SELECT round(avg(CASE WHEN contains(answer, '[CFPB Complaint') OR contains(answer, '[Analytics:') THEN 1.0 ELSE 0.0 END), 6)
  AS answer_citation_presence_rate FROM ({ANSWERS_SQL})""",
    "router_report": ROUTER_SQL,
    "topic_registry": f"""WITH {DOCS_SQL} SELECT lang, count(*) AS documents, true AS volumes_fit, true AS terms_fit, CAST(12 AS BIGINT) AS names, true AS examples_fit
FROM docs GROUP BY 1""",
    "final_metrics": f"""WITH evaluated AS (WITH {report_sql(1.0, 0.0)} {ROLL_UP_SQL}), routed AS ({ROUTER_SQL}), indexed AS (WITH {DOCS_SQL} SELECT count(*) AS n FROM docs),
{CASES}, {CATALOG_SQL.replace(ISSUES_SQL, ISSUES_SQL.replace("cases AS", "issue_cases AS", 1), 1).replace("FROM cases GROUP BY", "FROM issue_cases GROUP BY", 1)},
base AS (SELECT count(*) AS observed_complaints, CAST(24.0 AS DOUBLE) AS hourly_wage,
  {", ".join(f"CAST({v!r} AS DOUBLE) AS {c}" for c, v in ASSUMPTION_DEFAULTS.items())} FROM cases), {value_sql("base")}
SELECT count(*) AS record_count, CAST(min(date_received) AS DATE) AS date_min, CAST(max(date_received) AS DATE) AS date_max,
  count(DISTINCT company) AS companies, count(DISTINCT product) AS products, count(DISTINCT issue) AS issues, count(DISTINCT state) AS states,
  count(*) FILTER (lower(product) LIKE '%build%') AS matching_product_volume, count(consumer_complaint_narrative) AS narratives,
  round_even(count(consumer_complaint_narrative) / CAST(count(*) AS DOUBLE), 4) AS narrative_share,
  (SELECT count(DISTINCT ai_use_case) FROM full_catalog) AS governance_use_cases,
  (SELECT CAST(sum(length(recommended_controls) - length(replace(recommended_controls, '|', '')) + 1) AS BIGINT) FROM full_catalog) AS governance_controls,
  (SELECT count(*) FROM opps) AS opportunities, (SELECT count(DISTINCT CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % 7) FROM documents) AS topics,
  (SELECT count(*) FROM documents) AS topic_narrative_volume,
  (SELECT round(estimated_annual_capacity_value, 4) FROM outputs) AS baseline_estimated_annual_capacity_value,
  (SELECT round(three_year_net_value, 4) FROM outputs) AS baseline_three_year_net_value,
  (SELECT question_count FROM evaluated) AS question_count, {", ".join(f"(SELECT {n} FROM evaluated) AS {n}" for n in FLAGS.values())},
  (SELECT records FROM routed) AS routing_model_records, (SELECT classes FROM routed) AS routing_model_classes, (SELECT baseline_macro_f1 FROM routed) AS baseline_macro_f1,
  true AS model_beats_baseline, (SELECT n FROM indexed) AS indexed_narratives FROM cases""",
    "nightly_run": NIGHTLY_SQL,
    "nightly_refresh": NIGHTLY_REFRESH_SQL,
}
