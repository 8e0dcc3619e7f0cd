"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from casemill.llm import queries, spelling

SF_DIR = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SCHEMA = "doc_id bigint, text string, word string, n string, root string, bucket string"


def counted(docs):
    seen = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def near_of(words):
    """Near words through all words with one place taken out; replaced characters agree on place and rest."""
    rest = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            rest[w[:i] + "*" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in rest.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def brute(docs):
    words = counted(docs)
    near = near_of(words)
    form = {}
    for w, n in words.items():
        best = min(((-words[o], o) for o in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def rows_of(found):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect())


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", "x", "x", "x") for d, t in docs], SCHEMA)


def misspelt(seed, n_docs):
    draw = random.Random(seed)
    letters = "abéÿ×z"
    stems = ["".join(draw.choices(letters, k=draw.randrange(6, 13))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "mississippi" * 9]
    docs = []
    for i in range(n_docs):
        words = []
        for _ in range(60):
            w = draw.choice(stems) if draw.random() < 0.8 else stems[0]
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice(letters) + w[at:], w[:at] + draw.choice(letters) + w[at + 1 :]])
            words.append(w.upper() if draw.random() < 0.1 else w)
        docs.append((i % 17 if i % 5 else None, " 1".join(words)))
    return docs


def test_checksums_of_joined_texts():
    draw = random.Random(1)
    first = [draw.randbytes(draw.randrange(9)) for _ in range(300)]
    second = [draw.randbytes(draw.randrange(9) if i % 9 else 5000 + i) for i in range(300)]
    got = spelling.Checksums().joined(np.array([zlib.crc32(a) for a in first]), np.array([zlib.crc32(b) for b in second]), np.array([len(b) for b in second]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(first, second, strict=True)]


def test_latin_characters():
    words = ["", "aé", "ÀÿzÃ×", "b"]
    data, offsets = spelling.latin(pa.array([w.encode() for w in words], pa.binary()))
    assert [data[a:b].tobytes().decode("latin-1") for a, b in zip(offsets, offsets[1:])] == words


def test_random_words(spark, monkeypatch):
    docs = misspelt(3, 150)
    want = brute(docs)
    assert sum(r[1] is not None for r in want) > 20 and max(r[4] for r in want) > 5
    assert rows_of(spelling.variants(frame(spark, docs))) == want
    # Small blocks, tiles and chunks: buckets are cut into cells, and cells go over several batches.
    monkeypatch.setattr(spelling, "BLOCK", 3)
    monkeypatch.setattr(spelling, "TILE_CELLS", 200)
    monkeypatch.setattr(spelling, "CHUNK_ROWS", 50)
    monkeypatch.setattr(spelling, "PENDING_ROWS", 20)
    assert rows_of(spelling.variants(frame(spark, docs))) == want


def test_chains_lead_to_one_root(spark):
    words = [("abcdefgh" + "x" * i, 3 * 10**i) for i in range(4)]
    docs = [(d, " ".join([w] * n)) for d in (None,) for w, n in words]
    want = brute(docs)
    assert len({r[2] for r in want}) == 1
    assert rows_of(spelling.variants(frame(spark, docs))) == want


def test_odd_rows_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (3, "kurz"), (4, "1234 -- ××××××× ×××××××"), (5, "a" * 50_000 + " " + "a" * 50_000 + " " + "a" * 49_999 + "b " + "a" * 49_999 + "b"),
            (5, "doppelt doppelt Doppelt"), (5, "doppelt doppelt Doppelt"), (None, "İstanbul Straße straße STRAßE ΑΒΓΔΕΖΗ")]
    assert rows_of(spelling.variants(frame(spark, docs))) == brute(docs)
    for none in ([], [(1, None)], [(1, "kurz")]):
        found = spelling.variants(frame(spark, none))
        assert set(found.columns) == {"word", "form", "root", "n", "n_near", "form_n"} and found.count() == 0


def test_query_on_the_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert rows_of(queries.op13_spelling_variants(spark, SF_DIR)) == brute(docs)
