"""Registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import ann, bpe, counts, embed_dedup, language, line_dedup, lm, ngram_join, packing, quality, ranked, spelling, token_file
from casemill.session import scratch_path

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
LINK_COSINE = 0.93
SHINGLE_WORDS, SIMILAR = 5, 0.8
GOOD = 0.3
NEIGHBOURS = 20
BEST_DOCUMENTS = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    return bpe.read_vocabulary(public_tokenizers.path(name))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents and all pages; a row has either a doc_id or a page_id."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.fit(docs, "doc_id", "text", "lang")
    none = F.lit(None).cast("long")
    evidence = ["text", "declared", "host", "suffix"]
    rows = language.of_document(docs).select("doc_id", none.alias("page_id"), *evidence).union(
        language.of_page(pages).select(none.alias("doc_id"), "page_id", *evidence))
    return language.identify(rows, model)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), LINK_COSINE)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"), SHINGLE_WORDS, SIMILAR)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = vocabulary(BYTE_VOCABULARY)
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), file)
    return bpe.decode(ids, file).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_file")
    token_file.write(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), path, end_id=2)
    return token_file.layout(spark, path)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, NEIGHBOURS)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(WORD_VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), end_id=0, longest=1024)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), BEST_DOCUMENTS)
    return found.select("item_id", "rank", "doc_id", "score")


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


TERMS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
RANKED_SQL = f"""WITH words AS (SELECT doc_id, rn, unnest({TERMS_SQL}) AS term FROM (SELECT doc_id, text, row_number() OVER () AS rn FROM documents)),
tf AS (SELECT rn, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
size AS (SELECT rn, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
total AS (SELECT count(*) AS all_n, CAST(sum(n) AS BIGINT) AS all_l FROM size),
asked AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * all_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total
  WHERE term IN (SELECT term FROM asked) GROUP BY term, all_n),
scored AS (SELECT item_id, rn, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_n) // all_l)))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (rn), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0) WHERE rank <= {BEST_DOCUMENTS}"""


QUERIES = {f.__name__: f for f in (
    op1_language, op2_embedding_dedup, op3_quality, op4_ngram_join, op5_bpe, op6_token_file, op7_line_dedup, op8_neighbours, op9_token_counts, op10_packing,
    op11_ranked_search, op12_lm_scores, op13_spelling_variants)}
# The other results are digests of tokens, hashes and fitted models, which SQL cannot express: tests hold those queries against brute force.
ORACLE: dict[str, str] = {"op11_ranked_search": RANKED_SQL}
