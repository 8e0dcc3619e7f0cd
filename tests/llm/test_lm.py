"""Language model against exact counts."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from casemill.llm import lm, queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SCHEMA = "doc_id bigint, text string, row string, word string, n string, held_out string, score string"


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def brute(docs):
    """Rows with the score of the same model on exact counts."""
    single, pairs = Counter(), Counter()
    for doc, text in docs:
        if not held(doc):
            t = tokens(text)
            single.update(t)
            pairs.update(zip([None, *t], t))
    followers = Counter(a for a, _ in pairs)
    n, v = sum(single.values()), len(single)
    n1, n2 = (sum(c == k for c in pairs.values()) for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for doc, text in docs:
        t = tokens(text)
        base = sum(math.log10((single[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for a, w in zip([None, *t], t):
            p = (single[w] + 1) / (n + v + 1)
            if single[a]:
                p = max(pairs[a, w] - d, 0) / single[a] + d * followers[a] / single[a] * p
            score += math.log10(p)
        out.append((doc, held(doc), len(t), sum(single[w] > 0 for w in t), n, base, score))
    return sorted(out, key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", "x", "x", "x", "x") for d, t in docs], SCHEMA)


def rows_of(found):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found.collect()), key=repr)


def close(got, want, share):
    assert [r[:5] for r in sorted(got, key=repr)] == [r[:5] for r in sorted(want, key=repr)]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert sum(r[6] for r in got) == pytest.approx(sum(r[6] for r in want), rel=share)


def random_docs(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é中", "Ünï", "\0", "a b", "😀"]
    passage = " ".join(draw.choices(vocabulary, k=60))
    return [(i, " ".join(draw.choices(vocabulary[: draw.randrange(2, 305)], k=draw.randrange(80))) + ("\n" + passage if i % 4 == 0 else "")) for i in range(n)]


def test_filter_gives_levels_back():
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 2**63, 20_000).astype(np.uint64)
    counts = np.concatenate([np.ones(10_000, np.int64), draw.integers(1, 5000, 10_000)])
    held_by = lm.part_of(keys, 3)
    segments = [lm.segment([(lm.PAIR, keys[held_by == p], counts[held_by == p])]) for p in range(3)]
    held_in = lm.Filter(*lm.Filter.fields(segments))
    want = np.searchsorted(lm.SCALE, counts, side="right")
    got = held_in.level(keys, held_by, lm.PAIR)
    assert (got >= want).all() and (got == want).mean() > 0.97
    absent = draw.integers(0, 2**63, 50_000).astype(np.uint64)
    assert (held_in.level(absent, lm.part_of(absent, 3), lm.PAIR) > 0).mean() < 0.03
    assert (held_in.level(keys, held_by, lm.COUNT) > 0).mean() < 0.03
    small = np.arange(1, 9)
    assert lm.MIDDLE[np.searchsorted(lm.SCALE, small, side="right")].tolist() == small.tolist()


def test_probabilities_add_up_to_one():
    docs = random_docs(2, 60)
    single = Counter(w for d, t in docs for w in tokens(t))
    pairs = Counter(p for d, t in docs for p in zip([None, *tokens(t)], tokens(t)))
    n, v = sum(single.values()), len(single)
    for a in (None, "w0", "w7"):
        c, t = single[a], sum(x == a for x, _ in pairs)
        total = sum(max(pairs[a, w] - 0.7, 0) / c + 0.7 * t / c * (single[w] + 1) / (n + v + 1) for w in single) + 0.7 * t / c / (n + v + 1)
        assert total == pytest.approx(1)


def test_random_texts(spark, monkeypatch):
    docs = random_docs(4, 250)
    want = brute(docs)
    close(rows_of(lm.score(frame(spark, docs))), want, 0.02)
    held_rows = [r for r in want if r[1]]
    assert held_rows and sum(r[6] for r in held_rows) > sum(r[5] for r in held_rows)
    # Several segments, small slices, a short head, and a filter that goes out in turns.
    for name, value in (("PART_TOKENS", 1500), ("PART_WORDS", 60), ("PENDING_TOKENS", 500), ("HEAD_WORDS", 20), ("FILTER_BYTES", 2000), ("SLICE_BYTES", 700), ("HOT_SHARE", 30), ("KNOWN_WORDS", 50)):
        monkeypatch.setattr(lm, name, value)
    close(rows_of(lm.score(frame(spark, docs))), want, 0.02)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "Same same SAME"), (4, "Same same SAME"), (None, "x" * 60_000 + " y"), (None, None), (5, "ÀÉ àé z  "),
            (6, "long " * 30_000)] + [(i, "rare words here") for i in range(10, 40)]
    assert any(held(d) for d, _ in docs)
    close(rows_of(lm.score(frame(spark, docs))), brute(docs), 0.03)


def test_empty_and_untrained(spark):
    found = lm.score(frame(spark, []))
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and found.count() == 0
    only = [(next(i for i in range(100) if held(i)), "never learnt from")]
    assert rows_of(lm.score(frame(spark, only))) == [(only[0][0], True, 4, 0, 0, 0.0, 0.0)]


def test_tokens_carry_the_end_between_texts():
    t = lm.Tokens(pa.array(["A b", None, "", "b"]))
    names = [*(w.decode() for w in t.words.to_pylist()), None]
    assert [(names[a], names[b]) for a, b in zip(t.before, t.codes)] == [(None, "a"), ("a", "b"), ("b", None), (None, None), (None, None), (None, "b"), ("b", None)]
    assert t.rows.tolist() == [0, 0, 0, 1, 2, 3, 3]


def test_query_on_the_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = brute(docs)
    got = rows_of(queries.op12_lm_scores(spark, SF_DIR))
    close(got, want, 0.02)
    assert [r[6] for r in got] == pytest.approx([r[6] for r in want], rel=0.1)
