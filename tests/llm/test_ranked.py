"""Ranked search against brute force and SQL."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from casemill.llm import queries, ranked
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
DOC = "doc_id bigint, text string, score string, rank string, doc string, n string, ids string, position string"
ITEM = "item_id bigint, text string, variant string, terms string"


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    rows = [(d, Counter(terms(t))) for d, t in docs]
    rows = [(d, c) for d, c in rows if c]
    n, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in sorted({(i, t) for i, t in items if t is not None}, key=repr):
        scored = []
        for d, c in rows:
            m = 75 + (25 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "x", "x", "x", "x", "x", "x") for d, t in docs], DOC),
            spark.createDataFrame([(i, t, "x", "x") for i, t in items], ITEM))


def rows_of(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


ODD_DOCS = [(1, None), (2, ""), (3, "... --"), (4, "Fee fee FEE fée"), (4, "fee fee fee fée"), (None, "fee bank"), (None, "fee bank"), (5, "ÀB àb x 中文 9"),
            (6, "fee " * 40_000 + "rare"), (7, "bank"), (8, "bank"), (9, "bank"), (-3, "bank"), (2**62, "bank ퟿😀")]
ODD_ITEMS = [(1, "fee bank"), (1, "fee bank"), (1, "rare"), (2, None), (3, ""), (4, "bank bank BANK"), (None, "àb 9 😀"), (5, "nowhere"), (6, "!!")]


def test_odd_rows(spark):
    docs, items = frames(spark, ODD_DOCS, ODD_ITEMS)
    assert rows_of(ranked.search(docs, items, 3)) == brute(ODD_DOCS, ODD_ITEMS, 3)


def test_random_tables_in_small_shards_and_blocks(spark, monkeypatch):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(draw.randrange(400), " ".join(draw.choice(vocabulary[: draw.randrange(2, 60)]) for _ in range(draw.randrange(30)))) for _ in range(700)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(1, 12)))) for i in range(30)]
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 25)
    monkeypatch.setattr(ranked, "GROUP_TERMS", 15)
    monkeypatch.setattr(ranked, "SHARD_DOCS", 64)
    assert rows_of(ranked.search(*frames(spark, docs, items), 7)) == brute(docs, items, 7)


@pytest.mark.parametrize("docs, items", [([], ODD_ITEMS), (ODD_DOCS, []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    found = ranked.search(*frames(spark, docs, items))
    assert found.columns == ["item_id", "variant", "rank", "doc_id", "score"] and found.count() == 0


def test_stops_before_all_documents_are_met():
    draw = np.random.default_rng(1)
    n = 5_000
    impacts = draw.integers(1, 1_000_000, (6, n))
    ids, docs = np.repeat(np.arange(6), n), np.tile(np.arange(n), 6)
    impacts[:, 17] = 999_999
    shard = ranked.Shard(ids, docs, impacts.ravel(), n, np.arange(6))
    weights = np.array([5, 4, 3, 0, 2, 1])
    met, scores, count = shard.best(np.arange(6), weights, 1, 0)
    whole = weights @ impacts
    assert count < n // 10
    assert met[np.argmax(scores)] == 17 and (scores == whole[met]).all()
    for k in (1, 3, 20):
        met, scores, _ = shard.best(np.arange(6), weights, k, 0)
        border = np.sort(whole)[-k]
        assert set(np.flatnonzero(whole >= border)) <= set(met.tolist())
    # A k-th score known from elsewhere stops earlier; ties with it are still met.
    assert set(np.flatnonzero(whole >= whole[17])) <= set(shard.best(np.arange(6), weights, 20, int(whole[17]))[0].tolist())


def test_query_matches_sql(spark):
    assert compare(queries.op11_ranked_search(spark, SF_DIR), connect(SF_DIR), queries.ORACLE["op11_ranked_search"]) == []
