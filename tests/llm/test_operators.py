"""Operators against brute force on small tables: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casemill.llm import ann, bpe, counts, embed_dedup, language, line_dedup, ngram_join, packing, quality, queries, token_file, words
from casemill.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "a", "x's'll've 'S''", "one  two\n\n three\t", "a<|endoftext|> b<|startoftext|><|endoftext|>", "a" * 4000, "Straße ΣΑΣ İx é é 😀𝒜 12²３ 中文",
       "w " * 30000, "  　 \r\n", "\0x\0", "same words here again", "same words here again"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, start string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, None if i % 3 else "en", None if i % 4 else "s", None, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def random_texts(seed, n, longest=40):
    draw = random.Random(seed)
    letters = "aaab'sretvlmd  \n\t1²é。!$\0 　😀𝒜'ΣİßÅ̊"
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(longest))) for _ in range(n)]


def table_texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()]


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


# words


def test_spaced_words_match_the_pattern():
    texts = random_texts(1, 3000) + [t or "" for t in ODD]
    pattern, table = regex.compile(bpe.PATTERN), words.class_table()
    got = [w for _, b in words.batches(texts, table, 500) for w in b.slices(*words.spaced_words(b))]
    assert got == [w for t in texts for w in pattern.findall(t)]


def thue_morse(levels):
    """Two different words whose polynomial hashes modulo 2^64 are equal."""
    one, two = "a", "b"
    for _ in range(levels):
        one, two = one + two, two + one
    return one, two


def test_distinct_spans_are_told_apart_by_content():
    texts = [" ".join(thue_morse(k)) for k in (10, 11, 12)] + ["é中 😀 é中", "", "ab a b ab"]
    for _, b in words.batches(texts, words.class_table(), 3000):
        starts, ends = words.visible_words(b)
        if starts.size:
            found, at = b.distinct(starts, ends)
            assert len(set(found.to_pylist())) == len(found)
            assert [found[i].as_py().decode() for i in at.tolist()] == b.slices(starts, ends)


def test_words_with_equal_polynomial_hashes(spark):
    pairs = [thue_morse(k) for k in (10, 11, 12)]
    texts = [t for p in pairs for t in (*p, " ".join(p), " ".join([p[0]] * 40), " ".join([p[1]] * 40), f"{p[0]}\n{p[1]}")]
    vocabulary = bpe.read_vocabulary(BYTE)
    rows = bpe.decode(bpe.encode(documents(spark, texts), vocabulary), vocabulary).orderBy("doc_id").collect()
    assert [r.ids for r in rows] == library(BYTE, texts) and [r.decoded for r in rows] == texts
    counted = counts.count_tokens(documents(spark, texts), bpe.read_vocabulary(WORD)).orderBy("doc_id").collect()
    assert [r.n_tokens for r in counted] == list(map(len, library(WORD, texts)))
    check_links(ngram_join.similar(documents(spark, texts)).collect(), brute_links([shingles(t, 5) for t in texts], 0.8), "doc_id", "class_id")
    lines = ["\n".join([p[0], "x y"]) for p in pairs] + ["\n".join([p[1], "x y"]) for p in pairs]
    assert [r.n_deleted for r in line_dedup.dedup(documents(spark, lines), 3).collect()] == [0] * 6


def test_hashes_tell_spans_apart():
    texts = ["ab ba ab abab baba abc", "ab"]
    b = words.Batch(texts, words.class_table())
    starts, ends = words.visible_words(b)
    seen = {}
    for w, h in zip(b.slices(starts, ends), words.Hasher()(b.points, starts, ends), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) == 5


# 5, 9: encoding and counts


def test_encode_and_decode_match_the_library(spark):
    texts = ODD + random_texts(2, 400)
    vocabulary = bpe.read_vocabulary(BYTE)
    rows = bpe.decode(bpe.encode(documents(spark, texts), vocabulary), vocabulary).orderBy("doc_id").collect()
    want = library(BYTE, texts)
    assert [r.ids for r in rows] == want
    tokenizer = Tokenizer.from_file(BYTE)
    assert [r.decoded for r in rows] == [tokenizer.decode(i, skip_special_tokens=False) for i in want]
    assert [r.start for r in rows] == ["clash"] * len(texts)
    assert bpe.decode(bpe.encode(empty(spark), vocabulary), vocabulary).count() == 0


def test_decode_of_cut_characters(spark):
    vocabulary, tokenizer = bpe.read_vocabulary(BYTE), Tokenizer.from_file(BYTE)
    ids = [library(BYTE, ["é😀中"])[0][k:] for k in range(4)] + [[], None, [50256]]
    rows = bpe.decode(spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, ids array<int>"), vocabulary).orderBy("n").collect()
    assert [r.decoded for r in rows] == [tokenizer.decode(x or [], skip_special_tokens=False) for x in ids]


def test_word_table_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 50)
    monkeypatch.setattr(counts, "TABLE_WORDS", 50)
    texts = random_texts(3, 300)
    table, counter = bpe.WordTable(bpe.read_vocabulary(BYTE)), counts.Counter(bpe.read_vocabulary(WORD), words.newer_characters())
    for first in range(0, 300, 40):
        part = texts[first : first + 40]
        flat, n = table.ids(part)
        assert [list(x) for x in np.split(flat, np.cumsum(n)[:-1])] == library(BYTE, part)
        assert list(counter.counts(part)) == list(map(len, library(WORD, part)))


def test_counts_match_the_library(spark):
    texts = ODD + random_texts(4, 400)
    rows = counts.count_tokens(documents(spark, texts), bpe.read_vocabulary(WORD)).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == list(map(len, library(WORD, texts)))
    assert [r.n_bytes for r in rows] == [len((t or "").encode()) for t in texts]
    assert counts.count_tokens(empty(spark), bpe.read_vocabulary(WORD)).count() == 0


def test_counts_of_characters_that_python_does_not_know():
    newer = words.newer_characters()
    counter = counts.Counter(bpe.read_vocabulary(WORD), newer)
    chars = [chr(c) for c in (0xA7CB, 0xA7DC, 0x13808, 0x1385C, 0x13988, *list(newer[0])[::9], *newer[1], *range(0xA0, 0x3000, 7))]
    texts = [t for c in chars for t in (f"a{c}b", f"{c}{c} {c}1")]
    assert counter.counts(texts).tolist() == list(map(len, library(WORD, texts)))


@pytest.mark.parametrize("name", ["op5_bpe", "op9_token_counts"])
def test_digest_queries(spark, name):
    texts = table_texts(spark)
    rows = {r.doc_id: r for r in queries.QUERIES[name](spark, SF_DIR).collect()}
    assert sorted(rows) == list(range(len(texts)))
    for i, ids in enumerate(library(BYTE if name == "op5_bpe" else WORD, texts)):
        r = rows[i]
        if name == "op5_bpe":
            want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[i].encode()).hexdigest())
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want
        else:
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[i].encode()), len(ids), len(ids) > 2048)


# 6: token files


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_layout(rows, texts, end_id):
    start = 0
    for r, ids in zip(sorted(rows, key=lambda r: r.doc_id), library(BYTE, texts), strict=True):
        ids = [*ids, end_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files(spark):
    texts = ODD + random_texts(5, 300)
    path = scratch_path(spark, "files")
    token_file.write(documents(spark, texts).repartition(5), bpe.read_vocabulary(BYTE), path, end_id=2)
    check_layout(token_file.layout(spark, path).collect(), texts, 2)
    some = token_file.read(spark, path, [3, 7]).orderBy("doc_id").collect()
    assert [list(r.ids) for r in some] == [[*library(BYTE, [texts[i]])[0], 2] for i in (3, 7)]
    path = scratch_path(spark, "files")
    token_file.write(empty(spark), bpe.read_vocabulary(BYTE), path, end_id=2)
    assert token_file.layout(spark, path).count() == 0


def test_token_file_query(spark):
    check_layout(queries.op6_token_file(spark, SF_DIR).collect(), table_texts(spark), 2)


def test_token_files_of_repeated_and_null_ids(spark):
    path = scratch_path(spark, "files")
    docs = spark.createDataFrame([(None, "a b"), (4, "x"), (4, "x y z"), (4, "x"), (None, None)], "doc_id bigint, text string")
    token_file.write(docs, bpe.read_vocabulary(BYTE), path, end_id=2)
    rows = sorted(token_file.layout(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 4, 4, 4]
    assert [r.start for r in rows] == list(np.cumsum([0, *(r.n_tokens for r in rows)])[:-1])


def test_many_documents_of_one_id_lie_as_reported(spark):
    path = scratch_path(spark, "files")
    texts = [" ".join(["w"] * (1 + 7 * i % 23)) for i in range(40)]
    token_file.write(spark.createDataFrame([(7, t) for t in texts], "doc_id bigint, text string").repartition(4), bpe.read_vocabulary(BYTE), path, end_id=2)
    start = 0
    reported = sorted(((r.start, r.n_tokens, r.ids_crc32) for r in token_file.layout(spark, path).collect()))
    for r, (at, n, check) in zip(token_file.read(spark, path).coalesce(1).collect(), reported, strict=True):
        assert (at, n, check) == (start, len(r.ids), crc(r.ids))
        start += n


# 10: packing


def check_pieces(rows, texts, end_id, longest):
    ids = [[*x, end_id] for x in library(BYTE, texts)]
    for i, doc in enumerate(ids):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1]) and sum(r.length for r in own) == len(doc)
        for r in own:
            assert r.doc_tokens == len(doc) and r.ids_crc32 == crc(doc[r.start : r.start + r.length]) and r.offset == 0
            assert r.length <= longest and r.length & (r.length - 1) == 0
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    lengths = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths, reverse=True)


def test_packing(spark, monkeypatch):
    texts = ODD + random_texts(6, 100)
    packed = packing.pack(documents(spark, texts).repartition(4), bpe.read_vocabulary(BYTE), end_id=0, longest=64, with_ids=True)
    rows = packed.collect()
    check_pieces(rows, texts, 0, 64)
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length for r in rows)
    assert packing.pack(empty(spark), bpe.read_vocabulary(BYTE), end_id=0).count() == 0
    monkeypatch.setattr(packing, "CHUNK_PIECES", 10)
    check_pieces(packing.pack(documents(spark, texts).repartition(4), bpe.read_vocabulary(BYTE), end_id=0, longest=64).collect(), texts, 0, 64)
    with pytest.raises(ValueError):
        packing.pieces(empty(spark), "", 0, longest=1000)


def test_packing_takes_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    plan = packing.pieces(docs, queries.vocabulary(queries.BYTE_VOCABULARY), 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_packing_query(spark):
    check_pieces(queries.op10_packing(spark, SF_DIR).collect(), table_texts(spark), 0, 1024)


# 4: n-gram join


def shingles(text, size):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute_links(sets, threshold):
    n = len(sets)
    links = {i: set() for i in range(n)}
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) >= threshold * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if both / (len(sets[i]) + len(sets[j]) - both) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    return links


def classes(links):
    lead = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, near in links.items():
            low = min([lead[i], *(lead[j] for j in near)])
            changed |= low < lead[i]
            lead[i] = low
    return lead


def check_links(rows, links, key, group):
    lead = classes(links)
    assert {r[key]: (r[group], r.n_links, r.kept) for r in rows} == {i: (lead[i], len(links[i]), lead[i] == i) for i in links}


def near_copies(seed, groups=6, copies=25):
    draw = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{g}x{draw.randrange(500)}" for _ in range(draw.choice([3, 8, 60, 200]))]
        for _ in range(copies):
            new = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                new[draw.randrange(len(new))] = f"n{draw.randrange(10**6)}"
            out.append(draw.choice([" ", "\n", "  "]).join(new))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_ngram_join(spark, block):
    texts = ODD + near_copies(7)
    rows = ngram_join.similar(documents(spark, texts).repartition(3), block=block).collect()
    check_links(rows, brute_links([shingles(t, 5) for t in texts], 0.8), "doc_id", "class_id")
    assert ngram_join.similar(empty(spark)).count() == 0


def test_ngram_join_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (1, "z y x"), (2, "A b  c"), (3, "")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in ngram_join.similar(docs).collect()}
    assert sorted(rows) == [1, 2, 3] and rows[3].n_links == 0


def test_ngram_join_query(spark):
    texts = table_texts(spark)
    check_links(queries.op4_ngram_join(spark, SF_DIR).collect(), brute_links([shingles(t, 5) for t in texts], 0.8), "doc_id", "class_id")


def test_banding_reaches_its_recall():
    bands, rows = ngram_join.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 256
    draw, minhash = np.random.default_rng(1), ngram_join.MinHash(bands, rows)
    shared = 0
    for _ in range(300):
        items = draw.integers(0, 1 << 63, 180, dtype=np.uint64)
        shared += bool((minhash(items[:162]) == minhash(items[18:])).any())  # similarity 0.8
    assert shared == 300


# 2: embeddings


def test_embedding_dedup(spark):
    draw = np.random.default_rng(2)
    base = draw.standard_normal((6, 16))
    vectors = [list(map(float, (base[i % 6] + draw.standard_normal(16) * draw.choice([0.02, 0.1, 0.3])).astype(np.float32))) for i in range(200)]
    rows = [(i, v, i % 2 if i % 11 else None, "x") for i, v in enumerate(vectors)]
    rows += [(200, vectors[0], 0, "x"), (201, vectors[0], 0, "x"), (202, [2 * x for x in vectors[0]], 0, "x"), (203, None, 0, "x"), (204, [0.0] * 16, 0, "x"),
             (205, [None] + vectors[0][1:], 0, "x"), (206, [float("nan")] + vectors[0][1:], 0, "x"), (207, [float("inf")] * 16, 0, "x"), (208, vectors[0][:5], 0, "x"), (209, [], 0, "x")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, n_links string")

    def ok(v):
        return v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {i: set() for i, *_ in rows}
    unit = {i: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for i, v, *_ in rows if ok(v)}
    for i in unit:
        for j in unit:
            if i != j and rows[i][2] is not None and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.93:
                links[i].add(j)
    for block in (512, 20):
        check_links(embed_dedup.near_duplicates(table, 0.93, block=block).collect(), links, "vec_id", "component_id")
    assert embed_dedup.near_duplicates(table.limit(0)).count() == 0


def test_embeddings_of_any_length_norm_and_id(spark):
    rows = [(0, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1e-200, 1e-200], 1), (4, [3e-200, 3e-200], 1), (5, [1e200, 1e200], 1),
            (6, [5e-324, 5e-324], 1), (7, [0.0, 1.0, 0.0], 1), (8, [0.0, 1.0, 0.0], 1), (9, [1.0], 2), (10, [-1.0], 2), (11, [4.0], 2),
            (20, [0.0, 0.0, 1.0], 3), (20, [0.0, 1.0, 0.0], 3), (20, [0.0, 0.0, 2.0], 3), (21, [0.0, 1.0, 0.01], 3), (None, [0.0, 1.0, 0.0], 3)]
    found = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in found)
    assert got == [(0, 0, 0), (1, 1, 1), (2, 1, 1), (3, 3, 3), (4, 3, 3), (5, 3, 3), (6, 3, 3), (7, 1, 7), (8, 1, 7), (9, 1, 9), (10, 0, 10), (11, 1, 9),
                   (20, 1, 20), (20, 1, 20), (20, 1, 20), (21, 1, 20)]


def test_embedding_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    unit = {r.vec_id: np.array(r.embedding) / np.linalg.norm(r.embedding) for r in rows}
    label = {r.vec_id: r.label for r in rows}
    links = {i: {j for j in unit if i != j and label[i] == label[j] and unit[i] @ unit[j] >= 0.93} for i in unit}
    check_links(queries.op2_embedding_dedup(spark, SF_DIR).collect(), links, "vec_id", "component_id")


def test_calibrated_count():
    count = embed_dedup.calibrated()
    draw = np.random.default_rng(3)
    gaps = np.abs(draw.standard_normal((20000, embed_dedup.PROJECTIONS)))
    assert ((gaps <= embed_dedup.WIDTH).sum(axis=1) >= count).all()


def test_pairs_far_apart_on_the_first_projection(spark):
    draw = np.random.default_rng(12)
    base = draw.standard_normal((80_000, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = draw.standard_normal(base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = draw.uniform(0.9301, 0.94, (len(base), 1))
    other = cosine * base + np.sqrt(1 - cosine**2) * side
    first = embed_dedup.directions(48, embed_dedup.PROJECTIONS)[:, 0]
    far = np.flatnonzero(np.abs((base - other) @ first) > 1.06 * embed_dedup.WIDTH * np.sqrt(2 - 2 * 0.93))[:60]
    vectors = np.vstack([base[far], other[far], draw.standard_normal((2000, 48))])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    links = {i: set(np.flatnonzero(near[i]).tolist()) - {i} for i in range(len(vectors))}
    assert len(far) == 60 and sum(map(len, links.values())) >= 120
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>, label int")
    check_links(embed_dedup.near_duplicates(table, 0.93, block=64).collect(), links, "vec_id", "component_id")


def test_reach_of_the_blocks():
    assert 4.8 < embed_dedup.reach() < 5
    assert 1 - math.erf(embed_dedup.reach() / math.sqrt(2)) <= 1.001 * (1 - embed_dedup.RECALL)


# 8: neighbours


def exact_neighbours(ids, vectors, query, k):
    scores = vectors @ vectors[query]
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:k]
    return [(ids[i], scores[i]) for i in order]


def test_neighbours_recall(spark):
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((3000, 24)) * draw.uniform(0.5, 2, (3000, 1))
    vectors[500:900] = vectors[500] + 0.01 * draw.standard_normal((400, 24))
    table = spark.createDataFrame([(i, list(map(float, v)), "x") for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>, rank string")
    rows = ann.nearest_neighbours(table, F.col("vec_id") % 20 == 0, 20, shard_rows=1000).collect()
    ids, hit = np.arange(3000), 0
    for q in range(0, 3000, 20):
        got = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert got == sorted(got, key=lambda r: (-r.score, r.vec_id))
        assert all(abs(r.score - vectors[q] @ vectors[r.vec_id]) < 1e-9 and r.vec_id != q for r in got)
        hit += len({r.vec_id for r in got} & {i for i, _ in exact_neighbours(ids, vectors, q, 20)})
    assert hit / (150 * 20) >= 0.95


def test_neighbours_beside_copies(spark):
    draw = np.random.default_rng(14)
    vectors = draw.standard_normal((ann.SHARD_ROWS, 24))
    vectors[1::8] = vectors[1]  # a hot group in one full shard
    vectors[0], vectors[20] = vectors[1], vectors[1]
    vectors[4000:4030] = vectors[1] * 0.9 + 0.1 * draw.standard_normal((30, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    rows = ann.nearest_neighbours(table, F.col("vec_id") % 20 == 0, 20).collect()
    got, ids, hit = {}, np.arange(len(vectors)), []
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append(r.vec_id)
    copies = np.flatnonzero((vectors == vectors[1]).all(axis=1)).tolist()
    for q in range(0, len(vectors), 20):
        hit.append(len(set(got[q]) & {i for i, _ in exact_neighbours(ids, vectors, q, 20)}) / 20)
        assert len(got[q]) == len(set(got[q])) == 20
    for q in (0, 20):
        longer = [i for i in np.argsort(-(vectors @ vectors[q])) if vectors[i] @ vectors[q] > vectors[q] @ vectors[q] + 1e-9][:20]
        assert got[q][len(longer) :] == [i for i in copies if i != q][: 20 - len(longer)]
    print("recall beside copies", np.mean(hit))
    assert np.mean(hit) >= 0.95


def test_neighbours_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0])] * 30 + [(1, [1.0, 0.0])] * 3 + [(2, [1.0, 0.0]), (0, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest_neighbours(table, F.expr("vec_id = 2"), 20).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0] * 20


def test_neighbours_of_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [0.5, None]), (7, [1.0]), (20, [-1.0, 2.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.nearest_neighbours(table, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0), (20, 3, 2, -1.0)]
    assert ann.nearest_neighbours(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("dims, spread", [(64, 0.0), (64, 1.0), (384, 0.0)])
def test_recall_on_a_full_shard_without_structure(spark, dims, spread):
    draw = np.random.default_rng(dims)
    n = ann.SHARD_ROWS if dims < 100 else 2_000
    vectors = draw.standard_normal((n, dims)) * np.exp(spread * draw.uniform(-1, 1, (n, 1)))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(table, F.col("vec_id") % 40 == 0, 20, shard_rows=2 * n).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = [len(got[q] & {i for i, _ in exact_neighbours(np.arange(n), vectors, q, 20)}) / 20 for q in range(0, n, 40)]
    print("recall", dims, spread, np.mean(hit))
    assert np.mean(hit) >= 0.9


def test_neighbours_of_any_length_and_norm(spark):
    rows = [(20, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0, 1.0]), (40, [0.0, 0.0, 3.0]), (60, [1e-200, 0.0]), (80, [7.0])]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [(20, 1, 1, 2.0), (20, 2, 60, 1e-200), (40, 1, 2, 3.0), (60, 1, 1, 2e-200), (60, 2, 20, 1e-200)]


def test_neighbour_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = queries.op8_neighbours(spark, "/root/testdata/sf0.01").collect()
    hit = [len({r.vec_id for r in got if r.query_id == ids[q]} & {i for i, _ in exact_neighbours(ids, vectors, q, 20)}) for q in np.flatnonzero(ids % 20 == 0)]
    assert np.mean(hit) / 20 >= 0.9


# 7: line dedup


def brute_dedup(texts, min_words):
    """The union of all runs with enough words, from a line with words to one, that occurred at an earlier place, without what the first copy covers."""
    lines = [None if t is None else t.split("\n") for t in texts]
    weight = [[len(x.split()) for x in d] if d is not None else [] for d in lines]
    seen, gone = {}, [set() for _ in texts]
    places = [(i, p) for i, d in enumerate(lines) if d is not None for p in range(len(d))]
    for i, p in places:
        for m in range(1, len(lines[i]) - p + 1):
            seen.setdefault(tuple(lines[i][p : p + m]), (i, p))
    for i, p in places:
        for m in range(1, len(lines[i]) - p + 1):
            if weight[i][p] and weight[i][p + m - 1] and sum(weight[i][p : p + m]) >= min_words:
                doc, at = seen[tuple(lines[i][p : p + m])]
                if (doc, at) < (i, p):
                    gone[i].update(range(max(p, at + m) if doc == i else p, p + m))
    return [None if d is None else "\n".join(x for k, x in enumerate(d) if k not in gone[i]) for i, d in enumerate(lines)], [len(g) for g in gone]


@pytest.mark.parametrize("min_words", [1, 4, 9])
def test_line_dedup(spark, min_words):
    draw = random.Random(8)
    pool = ["", "a", "b c", "d e f", "g h i j k", "l"]
    texts = ["\n".join(draw.choice(pool) if draw.random() < 0.8 else f"own {draw.random()}" for _ in range(draw.randrange(1, 14))) for _ in range(40)] + [None, "", "x\n", "x\n"]
    rows = line_dedup.dedup(documents(spark, texts).repartition(3), min_words).orderBy("doc_id").collect()
    # Texts in order of ids, so the brute force sees the same order of places; a repeated text has an id of its own.
    want, gone = brute_dedup(texts, min_words)
    assert [r.text for r in rows] == want
    assert [r.n_deleted for r in rows] == gone
    assert [r.ids for r in rows] == ["clash"] * len(texts)
    assert line_dedup.dedup(empty(spark)).count() == 0


def test_line_dedup_rows(spark):
    docs = spark.createDataFrame([(None, "a b\nc"), (1, "a b\nc"), (2, "q\na b\nc"), (2, "q\na b\nc"), (3, None)], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup(docs, 3).collect()), key=str)
    assert got == sorted([(None, "a b\nc"), (1, ""), (2, "q"), (2, "q"), (3, None)], key=str)


def test_line_query(spark):
    """The whole table against all its runs."""
    texts = table_texts(spark)
    want, gone = window_dedup(texts, line_dedup.MIN_WORDS)
    rows = queries.op7_line_dedup(spark, SF_DIR).orderBy("doc_id").collect()
    assert [r.text for r in rows] == want and [r.n_deleted for r in rows] == gone
    assert [r.n_lines for r in rows] == [len(t.split("\n")) for t in texts]


def window_dedup(texts, min_words):
    """As ``brute_dedup``, with the shortest runs from and to every line, which make up all others."""
    lines = [t.split("\n") for t in texts]
    runs = []
    for i, d in enumerate(lines):
        weight = [len(x.split()) for x in d]
        for p in range(len(d)):
            for step in (1, -1):
                total, q = 0, p
                while 0 <= q < len(d) and total < min_words:
                    total += weight[q]
                    q += step
                if weight[p] and total >= min_words:
                    runs.append((i, p, q) if step == 1 else (i, q + 1, p + 1))
        worded = [p for p in range(len(d)) if weight[p]]
        runs += [(i, p, q + 1) for p, q in zip(worded, worded[1:]) if q > p + 1 and weight[p] + weight[q] >= min_words]
    first = {}
    for i, a, b in sorted(set(runs)):
        first.setdefault(tuple(lines[i][a:b]), (i, a))
    gone = [set() for _ in texts]
    for i, a, b in set(runs):
        doc, at = first[tuple(lines[i][a:b])]
        if (doc, at) < (i, a):
            gone[i].update(range(max(a, at + b - a) if doc == i else a, b))
    return ["\n".join(x for k, x in enumerate(d) if k not in gone[i]) for i, d in enumerate(lines)], [len(g) for g in gone]


def test_both_brute_forces_agree():
    draw = random.Random(9)
    texts = ["\n".join(draw.choice(["", "a", "b c", "d e f", "x"]) for _ in range(draw.randrange(1, 12))) for _ in range(60)]
    for min_words in (1, 2, 4, 7):
        assert window_dedup(texts, min_words) == brute_dedup(texts, min_words)


def test_first_copies_stay(spark):
    texts = ["\n".join(["w"] * 60), "\n" * 200, "\n".join(["w"] * 60), "a b c\n" + "\n" * 50 + "d e f", "x\na b c\n" + "\n" * 50 + "d e f\ny"]
    rows = line_dedup.dedup(documents(spark, texts), 30).orderBy("doc_id").collect()
    assert [r.n_deleted for r in rows] == [30, 0, 60, 0, 0]
    rows = line_dedup.dedup(documents(spark, texts[3:]), 6).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [texts[3], "x\ny"]


def test_columns_named_like_helpers(spark):
    docs = spark.createDataFrame([(i, "a b\nc", 1, 2, 3, 4, 5) for i in range(2)], "doc_id bigint, text string, _d int, _h int, _runs int, line_d0 int, LINE_RUNS0 int")
    rows = line_dedup.dedup(docs, 3).orderBy("doc_id").collect()
    assert [(r.text, r.n_deleted, r._d, r._h, r._runs, r.line_d0, r.LINE_RUNS0) for r in rows] == [("a b\nc", 0, 1, 2, 3, 4, 5), ("", 2, 1, 2, 3, 4, 5)]


def test_maximal_runs(spark):
    body = [f"line number {k}" for k in range(9)]
    texts = ["\n".join(["own a", *body, "end a"]), "\n".join(["own b", *body[2:8], "mid b", *body[:4]]), None, "short"]
    rows = line_dedup.repeated_runs(documents(spark, texts), 6).orderBy("doc_id", "start").collect()
    assert [tuple(r) for r in rows] == [(1, 1, 6, 0, 3), (1, 8, 4, 0, 1)]
    assert line_dedup.repeated_runs(empty(spark)).count() == 0


# 1 and 3: language and quality


def test_language_of_tables(spark):
    rows = queries.op1_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    docs, pages = [r for r in rows if r.doc_id is not None], [r for r in rows if r.page_id is not None]
    assert len(docs) == len(truth) and len(pages) == 250
    assert np.mean([r.language == truth[r.doc_id] for r in docs]) >= 0.98
    assert np.mean([r.accepted for r in docs]) >= 0.99
    assert np.mean([r.language == r.declared for r in pages]) >= 0.98


def test_rare_languages_are_languages(spark):
    rows = [(i if i % 3 else i % 50, f"some common text {i % 7}", "en") for i in range(9000)] + [(9000 + k, f"{c * 5} rare", c * 2) for k, c in enumerate("abcdfghi")]
    rows += [(None, "no id", "xx"), (9100, None, "yy"), (9101, "unlabelled", None)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), "doc_id", "text", "lang")
    assert model.languages == sorted([*(c * 2 for c in "abcdfghi"), "en", "xx", "yy"])
    trigrams = language.Trigrams()
    for k, name in enumerate(model.languages):
        codes, _ = trigrams(pa.array([t for _, t, of in rows if of == name], pa.string()))
        counts = 1 + np.bincount(codes, minlength=language.BUCKETS)
        assert np.allclose(model.logs[:, k], np.log(counts / counts.sum()), atol=1e-4)
    assert language.fit(spark.createDataFrame([], "doc_id bigint, text string, lang string"), "doc_id", "text", "lang").languages == []


def test_language_evidence_and_nulls(spark):
    model = language.TextModel(["de", "en"], np.zeros((language.BUCKETS, 3), np.float32) - 9)
    model.logs[:, 2] = -20
    rows = [("t", "de", "h", "com"), ("t", None, "h", "de"), ("t", None, None, None), ("", "de", "h", "de"), (None, None, None, None), ("12 !", "de", None, None)] + [("t", "de", "d.de", "de")] * 9 + [("t", None, "d.de", "de")]
    df = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "id int, text string, declared string, host string, suffix string, language int")
    got = {r.id: r for r in language.identify(df.drop("language"), model).collect()}
    assert got[0].language == "de" and got[1].language == "de" and got[15].language == "de"
    assert [got[i].language for i in (3, 4, 5)] == ["und"] * 3 and not any(got[i].accepted for i in (3, 4, 5))
    assert got[15].posterior > got[1].posterior > 0.5  # the host's other rows count
    assert language.identify(df.drop("language").limit(0), model).count() == 0


def test_no_language_is_known(spark):
    docs = spark.createDataFrame([(1, "some text", None, "h"), (2, None, None, None)], "doc_id bigint, text string, lang string, source string")
    rows = language.of_document(docs).select("doc_id", "text", "declared", "host", "suffix")
    found = language.identify(rows, language.fit(docs, "doc_id", "text", "lang")).collect()
    assert {(r.language, r.accepted) for r in found} == {("und", False)}


def test_page_evidence(spark):
    page = ("<html class=x LANG='DE-at'><script>var a='<p>';</script><p>Hallo <b>Welt</b></p></html>", "HTTPS://www.Example.de:80/x?y")
    r = language.of_page(spark.createDataFrame([page, (None, None)], "html string, url string")).collect()
    assert (r[0].declared, r[0].host, r[0].suffix, r[0].text.split()) == ("de", "www.example.de", "de", ["Hallo", "Welt"])
    assert (r[1].declared, r[1].host, r[1].text) == (None, None, None)


def test_quality_on_the_held_out_fold(spark):
    rows = {r.doc_id: r for r in queries.op3_quality(spark, "/root/testdata/sf0.1").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    fold = [i for i in labels if rows[i].held_out]
    assert np.mean([rows[i].predicted == labels[i] for i in fold]) >= 0.95


def test_quality_edges(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] + [(99, 1), (None, 0), (3, None)], "doc_id bigint, quality int")
    scored = quality.score(docs, quality.fit(docs, labels), keep_text=True)
    assert scored.where("score >= 0 AND score <= 1").count() == len(ODD) and scored.columns == [*docs.columns, "score"]
    assert quality.fit(docs, labels.limit(0)) is None and quality.score(docs, None).where("score = 0.5").count() == len(ODD)
    assert quality.score(empty(spark), quality.fit(docs, labels)).count() == 0


def test_sample_of_labels(spark, monkeypatch):
    """Labels of absent documents take no place in the sample, and a repeated id gives one text."""
    docs = documents(spark, [f"good words here {i}" if i % 2 else f"BAD 111 {i}" for i in range(60)])
    docs = docs.union(docs.where("doc_id < 9").withColumn("text", F.lit("zzz other")))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1000 + i, i % 2) for i in range(5000)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality, "TRAIN_ROWS", 60)
    monkeypatch.setattr(quality, "CALIBRATE_ROWS", 0)
    seen = []
    fit = quality.fit_features
    monkeypatch.setattr(quality, "fit_features", lambda v, x, y, *rest: seen.append((x, y)) or fit(v, x, y, *rest))
    model = quality.fit(docs, labels)
    known = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    assert len(seen[0][1]) == len(known) and seen[0][1].sum() == sum(i % 2 for i in known)
    texts = {i: min((f"good words here {i}" if i % 2 else f"BAD 111 {i}", *(["zzz other"] if i < 9 else [])), key=lambda t: hashlib.sha256(t.encode()).hexdigest()) for i in known}
    want = quality.features(quality.Tokens(), model.vectors, list(texts.values()))
    assert np.allclose(sorted(map(tuple, want.astype(float))), sorted(map(tuple, seen[0][0])))


def test_word_vectors_of_all_documents(spark):
    texts = [f"labelled words of kind {i % 2} here" for i in range(20)] + [f"rare{i} vocabulary{i} only{i} there" for i in range(40)] + ODD[:9]
    docs = documents(spark, texts).repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, quality int")
    got, index, want = quality.fit(docs, labels).vectors, quality.index_vectors(), np.zeros((quality.BUCKETS, quality.WIDTH))
    for _, _, hashes, of, _ in quality.Tokens()([t or "" for t in texts]):
        at = quality.buckets(hashes)
        for i in range(at.size):
            for j in range(max(0, i - 2), min(at.size, i + 3)):
                if i != j and of[i] == of[j]:
                    want[at[i]] += index[at[j]]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(got, want, atol=1e-6)


def test_contexts_are_whole_numbers_around_every_word():
    from casemill.llm import quality

    rng = np.random.default_rng(6)
    names = [f"word{i}" for i in range(50)]
    texts = [" ".join(names[i] for i in rng.integers(0, 50, n)) for n in (0, 1, 2, 3, 30, 0, 400, 1)]
    index = np.vstack([quality.index_vectors(), np.zeros((1, quality.WIDTH), np.float32)]).astype(np.int8)
    tokens, total, want = quality.Tokens(), np.zeros((2, quality.BUCKETS, quality.WIDTH), np.int64), np.zeros((quality.BUCKETS, quality.WIDTH), np.int64)
    for text in texts:
        at = np.concatenate([quality.buckets(h) for _, _, h, _, _ in tokens([text])])
        for i, word in enumerate(at):
            for j in range(max(0, i - quality.WINDOW), min(len(at), i + quality.WINDOW + 1)):
                want[word] += index[at[j]] if j != i else 0
    quality.add_contexts(total[0], index, tokens, texts)
    size, quality.CONTEXT_WORDS = quality.CONTEXT_WORDS, 7
    try:
        quality.add_contexts(total[1], index, tokens, texts)
    finally:
        quality.CONTEXT_WORDS = size
    assert want.any() and (total == want).all()
