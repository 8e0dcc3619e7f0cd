"""The pipeline's stages against what they promise, on the small tables and on a made-up corpus."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from casemill.llm import line_dedup, ngram_join
from pyspark.sql import functions as F
from tests.llm.test_operators import SF_DIR, brute_dedup, brute_links, check_pieces, classes, shingles

STAGES = dict(corpus_pipeline.STAGES)


def corpus(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_names_and_columns(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "line_dedup", "ngram_join", "packing"]
    for name in list(STAGES)[:-1]:
        assert STAGES[name](spark, docs, SF_DIR).dtypes == docs.dtypes


def test_language_keeps_documents_and_drops_those_without(spark, docs):
    kept = STAGES["language"](spark, docs, SF_DIR)
    assert kept.count() >= 0.99 * docs.count()
    odd = docs.union(corpus(spark, ["", None, "123 456 !!", "***"], [9001, 9002, 9003, None]))
    left = STAGES["language"](spark, odd, SF_DIR)
    assert left.where("doc_id > 9000").count() == 0 and left.count() == kept.count()


def test_rows_are_judged_by_themselves(spark, docs):
    """Null and repeated ids: each row's fate is its own."""
    text = docs.where("lang = 'en'").first().text
    odd = docs.union(corpus(spark, [text, "123 !!", text, "123 !!"], [9001, 9001, None, None]))
    left = STAGES["language"](spark, odd, SF_DIR)
    assert left.where("text = '123 !!'").count() == 0 and left.where("doc_id = 9001").count() == 1 and left.where("doc_id IS NULL").count() == 1
    words = " ".join(f"w{i}" for i in range(40))
    rows = corpus(spark, [words, words + " x", "all other words stand in this text " * 3, words, words, "", None], [5, 4, 4, None, None, 4, None])
    got = STAGES["ngram_join"](spark, rows, SF_DIR)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(4, words + " x"), (4, "all other words stand in this text " * 3), (4, ""), (None, None)], key=repr)


def test_columns_named_like_helpers(spark, docs):
    extra = docs.limit(30).selectExpr("*", "'mine' AS score0", "'mine' AS _score", "'mine' AS row0", "'mine' AS lines0", "'mine' AS gone0", "'mine' AS digest", "'mine' AS host")
    for name in list(STAGES)[:-1]:
        kept = STAGES[name](spark, extra, SF_DIR)
        assert kept.dtypes == extra.dtypes and {r.score0 for r in kept.collect()} <= {"mine"}


def test_quality_decides_by_the_text(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = STAGES["quality"](spark, docs, SF_DIR).select("doc_id").join(labels, "doc_id", "right")
    assert STAGES["quality"](spark, docs, SF_DIR).join(docs, docs.columns, "left_anti").count() == 0
    assert kept.where("quality = 1").count() > 0


def test_lines_match_brute_force(spark):
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = ["\n".join(draw.choice([passage, "short line", f"own line number {i} {draw.random()}"]) for _ in range(4)) for i in range(30)] + ["", None, passage]
    got = STAGES["line_dedup"](spark, corpus(spark, texts), SF_DIR).orderBy("doc_id").collect()
    want, gone = brute_dedup(texts, line_dedup.MIN_WORDS)
    left = [i for i, t in enumerate(texts) if not gone[i] or gone[i] < len(t.split("\n"))]
    assert len(left) < len(texts) and [(r.doc_id, r.text) for r in got] == [(i, want[i]) for i in left]
    assert all(r.n_chars == len(r.text or "") for r in got) and sum(passage in (r.text or "") for r in got) == 1


def test_one_document_of_each_group_stays(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    lead = classes(brute_links([shingles(texts[i], 5) for i in ids], 0.8))
    got = STAGES["ngram_join"](spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == [ids[i] for i in range(len(ids)) if lead[i] == i]
    assert got.join(docs, docs.columns, "left_anti").count() == 0
    assert ngram_join.similar(got).where("n_links > 0").count() == 0


def test_run(spark, docs):
    rows = corpus_pipeline.run(spark, SF_DIR)
    at = docs
    for name in list(STAGES)[:-1]:
        at = STAGES[name](spark, at, SF_DIR)
    texts = {r.doc_id: r.text for r in at.collect()}
    found = rows.collect()
    assert {r.doc_id for r in found} == set(texts)
    ids = sorted(texts)
    place = {i: k for k, i in enumerate(ids)}
    moved = [type(r)(**(r.asDict() | {"doc_id": place[r.doc_id]})) for r in found]
    check_pieces(moved, [texts[i] for i in ids], 0, 1024)


def test_empty_documents(spark, docs):
    none = docs.where(F.lit(False))
    for stage in STAGES.values():
        assert stage(spark, none, SF_DIR).count() == 0
