"""Registered queries: text cleaning, features, lexical search and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.fixed import ENGLISH_STOP_WORDS
from casemill.functions.text import clean_text, narratives
from casemill.operators import search, tfidf
from casemill.plans.queries_core import rounded
from casemill.plans.tables import documents, questions, table
from casemill.sources import complaints


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narratives(documents(spark, sf_dir))


def clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned texts of the documents and of the conversation turns, the latter with marks as in redacted text."""
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.concat(F.lit("XXXX paid on xx/xx/2025\r\n"), F.col("text"), F.lit(" XX ")).alias("text"))
    docs = table(spark, sf_dir, "documents").select((-F.col("doc_id")).alias("id"), "text")
    return docs.unionByName(turns).select("id", clean_text(F.col("text")).alias("clean_text"))


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + "]"


def clean_sql(column: str) -> str:
    return (rf"trim(regexp_replace(regexp_replace(coalesce({column}, ''), '(?i)\bX{{2,}}\b|XXXX+|xx/xx/\d{{2,4}}', ' ', 'g'), "
            r"'[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}]+', ' ', 'g'))")


def terms_sql(name: str, source: str, key: str, text: str) -> str:
    """CTE of (key, term, tf) over words and neighbouring pairs."""
    return rf"""{name} AS (
  SELECT {key}, term, count(*) AS tf FROM (
    SELECT {key}, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM (
      SELECT {key}, list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda w: NOT list_contains({STOP_SQL}, w)) AS t
      FROM {source})) GROUP BY 1, 2
)"""


DOCS_SQL = f"""docs AS (SELECT * FROM (SELECT doc_id, lang, source, {clean_sql("text")} AS clean FROM documents) WHERE length(clean) >= 80)"""


def weights_sql(spec: tfidf.TfidfSpec) -> str:
    """CTEs from ``docs`` to ``weights``: vocabulary and unit-length TF-IDF."""
    tf = "(1 + ln(tf))" if spec.sublinear else "tf"
    return f"""{terms_sql("counts", "docs", "doc_id", "clean")}, vocab AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, ln((1 + (SELECT count(*) FROM docs)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf
  FROM counts GROUP BY 1 HAVING count(*) >= {spec.min_df} AND count(*) <= {spec.max_df} * (SELECT count(*) FROM docs)
  {f'ORDER BY sum(tf) DESC, term LIMIT {spec.max_features}' if spec.max_features else ''}
), raw AS (SELECT doc_id, term, {tf} * idf AS x FROM counts JOIN vocab USING (term)),
weights AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM raw)"""


def asked_sql(spec: tfidf.TfidfSpec) -> str:
    """CTEs from ``benchmark`` to ``asked``: question weights over the same vocabulary."""
    tf = "(1 + ln(tf))" if spec.sublinear else "tf"
    return f"""{terms_sql("qcounts", "benchmark", "item_id", "text")},
qraw AS (SELECT item_id, term, {tf} * idf AS x FROM qcounts JOIN vocab USING (term)),
asked AS (SELECT item_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY item_id)) AS qx FROM qraw)"""


def lexical_sql(k: int) -> str:
    return f"""{DOCS_SQL}, {weights_sql(tfidf.SEARCH)}, {asked_sql(tfidf.SEARCH)},
scored AS (SELECT item_id, doc_id, sum(x * qx) AS score FROM weights JOIN asked USING (term) GROUP BY 1, 2),
every AS (SELECT item_id AS question_id, doc_id AS complaint_id, coalesce(score, 0) AS score
  FROM (SELECT item_id, doc_id FROM benchmark CROSS JOIN docs) LEFT JOIN scored USING (item_id, doc_id)),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, complaint_id) AS INTEGER) AS rank
  FROM every) WHERE rank <= {k})"""


def term_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older evaluation: expected terms are the words of ten or more letters of each question."""
    from casemill.operators.evaluation import term_recall_report

    asked = questions(spark, sf_dir)
    words = F.array_distinct(F.regexp_extract_all(F.lower("question"), F.lit(r"(\p{L}{10,})"), F.lit(1)))
    report = term_recall_report(docs_of(spark, sf_dir), asked.withColumn("expected_terms", words))
    return rounded(report, 6, "term_recall").drop("question")


TERM_RECALL_SQL = rf"""WITH {lexical_sql(5)},
found AS (SELECT question_id, count(*) AS retrieved_records, string_agg(lower(clean), ' ' ORDER BY rank) AS combined
  FROM top JOIN docs ON complaint_id = doc_id GROUP BY 1),
expected AS (SELECT item_id AS question_id, list_distinct(regexp_extract_all(lower(text), '\p{{L}}{{10,}}')) AS terms FROM benchmark)
SELECT question_id, retrieved_records, true AS has_citable_complaint_ids, true AS groundedness_gate,
  CASE WHEN len(terms) = 0 THEN 0 ELSE round(len(list_filter(terms, lambda t: contains(combined, t))) / CAST(len(terms) AS DOUBLE), 6) END AS term_recall
FROM found JOIN expected USING (question_id)"""

def unkeyed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which every tenth has no id and every tenth shares its id with a neighbour."""
    number = F.col("complaint_id")
    ids = F.when(number % 10 == 3, None).when(number % 10 == 5, number - 1).otherwise(number)
    return narratives(complaints.with_document_key(documents(spark, sf_dir).withColumn("complaint_id", ids)))


def unkeyed_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = unkeyed_docs(spark, sf_dir)
    top = search.lexical_search(docs, questions(spark, sf_dir), k=6, key=complaints.DOCUMENT_KEY)
    return rounded(search.evidence(top, docs, complaints.DOCUMENT_KEY), 6, "score").select("question_id", "rank", "score", "complaint_id", "citation")


QUERIES = {
    "clean_text": clean_all,
    "unkeyed_evidence": unkeyed_evidence,
    "narratives": lambda s, d: docs_of(s, d).select("complaint_id", F.length("clean_narrative").alias("n_chars")),
    "vocabulary": lambda s, d: rounded(tfidf.vocabulary(tfidf.count_terms(docs_of(s, d), "complaint_id", "clean_narrative", tfidf.TOPICS), tfidf.TOPICS), 6, "idf"),
    "tfidf_weights": lambda s, d: rounded(tfidf.tfidf(docs_of(s, d), "complaint_id", "clean_narrative", tfidf.TOPICS), 6, "x"),
    "tfidf_weights_sublinear": lambda s, d: rounded(tfidf.tfidf(docs_of(s, d), "complaint_id", "clean_narrative", tfidf.INDEX), 6, "x"),
    "lexical_topk": lambda s, d: rounded(search.lexical_search(docs_of(s, d), questions(s, d)), 6, "score"),
    "lexical_evidence": lambda s, d: rounded(search.evidence(
        search.lexical_search(docs_of(s, d), questions(s, d), k=5), docs_of(s, d)), 6, "score")
    .select("question_id", "complaint_id", "score", "rank", "company", "product", "citation", F.substring("clean_narrative", 1, 700).alias("excerpt")),
    "term_recall": term_recall,
}

UNKEYED_SQL = f"""{lexical_sql(6).split("top AS (")[0]}
keyed AS (SELECT *, CASE WHEN complaint_id % 10 = 3 THEN NULL WHEN complaint_id % 10 = 5 THEN complaint_id - 1 ELSE complaint_id END AS id FROM every),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, complaint_id % 10 IN (3, 4, 5), complaint_id) AS INTEGER) AS rank
  FROM keyed) WHERE rank <= 6)"""

ORACLE = {
    "unkeyed_evidence": f"""WITH {UNKEYED_SQL} SELECT question_id, rank, round(score, 6) AS score, id AS complaint_id,
  coalesce('[CFPB Complaint ' || id || ']', '[CFPB Complaint missing]') AS citation FROM top""",
    "clean_text": f"""SELECT id, {clean_sql("text")} AS clean_text FROM (
  SELECT -doc_id AS id, text FROM documents
  UNION ALL SELECT conv_id * 1000 + turn, 'XXXX paid on xx/xx/2025' || chr(13) || chr(10) || text || ' XX ' FROM conversations)""",
    "narratives": f"WITH {DOCS_SQL} SELECT doc_id AS complaint_id, CAST(length(clean) AS INTEGER) AS n_chars FROM docs",
    "vocabulary": f"WITH {DOCS_SQL}, {weights_sql(tfidf.TOPICS)} SELECT term, df, cf, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights": f"WITH {DOCS_SQL}, {weights_sql(tfidf.TOPICS)} SELECT doc_id AS complaint_id, term, round(x, 6) AS x FROM weights",
    "tfidf_weights_sublinear": f"WITH {DOCS_SQL}, {weights_sql(tfidf.INDEX)} SELECT doc_id AS complaint_id, term, round(x, 6) AS x FROM weights",
    "lexical_topk": f"WITH {lexical_sql(8)} SELECT question_id, complaint_id, round(score, 6) AS score, rank FROM top",
    "lexical_evidence": f"""WITH {lexical_sql(5)} SELECT question_id, complaint_id, round(score, 6) AS score, rank, source AS company,
  lang AS product, '[CFPB Complaint ' || complaint_id || ']' AS citation, substring(clean, 1, 700) AS excerpt
FROM top JOIN docs ON complaint_id = doc_id""",
    "term_recall": TERM_RECALL_SQL,
}
