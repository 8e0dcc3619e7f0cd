"""Similarity join of documents on word n-grams: MinHash bands find candidates, full n-gram sets verify them.

A document's set is its windows of ``size`` consecutive words (lower case, split at white space), or all its words at once if it has fewer. Two documents link
if the Jaccard similarity of their sets is at least ``threshold``. Steps:

1. One pass over the texts gives every document a fingerprint of its set and its band hashes. Documents with equal sets form a class of copies;
   only its smallest id goes on, with the number of copies.
2. Band hashes are shuffled. Each bucket with several members points them at its smallest one, and the connected components of these pointers
   hold every pair that shares a bucket. No pair is written.
3. The sets of a component's documents meet in cells: small components share a cell, a large one is split into blocks and each pair of blocks is a cell. A
   cell verifies the pairs that share a band, and returns per document the weight of its links and the smallest document linked in the cell.

Nulls and repeats: null and empty texts have no set and link with nothing. Rows without id are left out of the result. Rows with the same id count as one
document, the one with the smallest fingerprint.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm import words
from casemill.llm.arrow import list_array, map_batches, ragged, texts_of
from casemill.llm.components import components, local_leads
from casemill.session import materialize_plain as materialize

BATCH_CHARS = 1_000_000
BLOCK = 512
SLAB = 4096


def banding(threshold: float, recall: float, most: int = 256) -> tuple[int, int]:
    """(bands, rows): the longest bands whose number for ``recall`` at ``threshold`` stays within ``most`` hash functions."""
    best = (most, 1)
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


class Shingles:
    """Sorted distinct n-gram hashes of texts."""

    def __init__(self, size: int):
        self.size, self.classes = size, words.class_table()

    def sets(self, texts: list[str]) -> Iterator[np.ndarray]:
        for _, b in words.batches([t.lower() for t in texts], self.classes, BATCH_CHARS):
            starts, ends = words.visible_words(b)
            tokens = np.zeros(0, np.uint64)
            if starts.size:
                found, at = b.distinct(starts, ends)
                tokens = words.digests(found)[at, 0]
            counts = np.bincount(b.text_of(starts), minlength=b.count)
            for n, at in zip(counts.tolist(), ragged(counts).tolist(), strict=False):
                yield np.unique(words.shingle_hashes(tokens[at : at + n], min(n, self.size))) if n else np.zeros(0, np.uint64)


class MinHash:
    """Band hashes of a set."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.times = draw.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.plus = draw.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
        self.number = words.mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def __call__(self, items: np.ndarray) -> np.ndarray:
        low = np.full(self.times.size, 0xFFFFFFFF, np.uint32)
        x = (items >> np.uint64(32)).astype(np.uint32)
        for at in range(0, x.size, SLAB):
            values = self.times[:, None] * x[None, at : at + SLAB]
            values += self.plus[:, None]
            np.minimum(low, values.min(axis=1), out=low)
        out = self.number.copy()
        for row in low.reshape(self.bands, self.rows).astype(np.uint64).T:
            out = words.mixed(out + row)
        return out.view(np.int64)


def fingerprint(items: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    if not items.size:
        return 0, 0
    one, two = words.mixed(items), words.mixed(items ^ np.uint64(words.MULTIPLIER))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int((two * (one | np.uint64(1))).sum(dtype=np.uint64).view(np.int64))


def profiles(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, one, two, n, bands) of every row: fingerprint, set size and band hashes."""

    def make():
        shingles, minhash = Shingles(size), MinHash(bands, rows)

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            prints, sizes, found = [], [], []
            for items in shingles.sets(texts_of(part.column(1))):
                prints.append(fingerprint(items))
                sizes.append(items.size)
                found.append(minhash(items) if items.size else np.zeros(0, np.int64))
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()), pa.array(sizes, pa.int64()),
                 list_array(np.concatenate([*found, np.zeros(0, np.int64)]), ragged(lengths), pa.int64())],
                names=["doc_id", "one", "two", "n", "bands"])

        return step

    return map_batches(docs, make, "doc_id bigint, one bigint, two bigint, n bigint, bands array<bigint>")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` with the n-gram set instead of the text, where it still has the expected fingerprint."""

    def make():
        shingles = Shingles(size)

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = part.to_pydict()
            found = list(shingles.sets(texts_of(part.column(part.schema.get_field_index("text")))))
            same = [fingerprint(x) == p for x, p in zip(found, zip(rows["one"], rows["two"], strict=True), strict=True)]
            found = [x.view(np.int64) if s else np.zeros(0, np.int64) for x, s in zip(found, same, strict=True)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.get_field_index(n)) for n in names), list_array(np.concatenate([*found, np.zeros(0, np.int64)]), ragged(lengths), pa.int64())],
                names=[*names, "items"]).filter(pa.array(same))

        return step

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return map_batches(docs, make, f"{fields}, items array<bigint>")


def candidates(reps: DataFrame) -> DataFrame:
    """(doc_id, component) of the documents that share a band bucket with another."""
    rows = reps.select("doc_id", F.explode("bands").alias("bucket"))
    full = rows.groupBy("bucket").agg(F.min("doc_id").alias("lead"), F.count("*").alias("members")).where("members > 1").select("bucket", "lead")
    return components(rows.join(full, "bucket").where("doc_id <> lead"), "doc_id", "lead").withColumnRenamed("node", "doc_id")


def cells_of(members: DataFrame, group: str, block: int) -> DataFrame:
    """``members`` once per cell: small groups share cells, a large one has a cell for each pair of its blocks (columns cell, part)."""
    sizes = members.groupBy(group).agg(F.count("*").alias("size"))
    shared = sizes.where(F.col("size") <= block).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // block + 1
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = members.join(sizes, group).withColumn("blocks", blocks).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    cell = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(group), F.lit(shared))).otherwise(
        F.xxhash64(F.col(group), F.least("part", "other"), F.greatest("part", "other")))
    return (dealt.withColumn("other", other).withColumn("cell", cell)
            .withColumn("across", F.col("part") != F.col("other")).drop("size", "blocks", "other"))


def links_within(cell: pa.Table, threshold: float) -> pa.Table:
    """Per document of a cell: the weight of its links there and the smallest document linked with it."""
    ids, weights = cell["doc_id"].to_numpy(), cell["copies"].to_numpy()
    groups, parts, across = cell["component"].to_numpy(), cell["part"].to_numpy(), cell["across"].to_numpy()
    order = np.lexsort((ids, groups))
    bounds = np.flatnonzero(np.diff(groups[order], prepend=groups[order[0]] - 1)) if order.size else np.zeros(0, np.int64)
    items, bands = cell["items"].combine_chunks(), cell["bands"].combine_chunks()
    flat, offsets = items.values.to_numpy(), items.offsets.to_numpy()
    band = bands.flatten().to_numpy().reshape(ids.size, -1)
    linked, leads = np.zeros(ids.size, np.int64), ids.copy()
    for rows in np.split(order, bounds[1:]):
        rows = rows[np.append(True, ids[rows][1:] != ids[rows][:-1])]  # an id once
        n = rows.size
        if n < 2:
            continue
        lengths = offsets[rows + 1] - offsets[rows]
        _, codes = np.unique(np.concatenate([flat[offsets[r] : offsets[r + 1]] for r in rows]), return_inverse=True)
        at, seen = ragged(lengths), np.zeros(codes.max() + 1, np.int64)
        left, right = [], []
        for i in range(n - 1):
            later = np.arange(i + 1, n)
            later = later[(band[rows[later]] == band[rows[i]]).any(axis=1)]
            if across[rows[0]]:
                later = later[parts[rows[later]] != parts[rows[i]]]
            later = later[np.minimum(lengths[later], lengths[i]) >= threshold * np.maximum(lengths[later], lengths[i])]
            if not later.size:
                continue
            seen[codes[at[i] : at[i + 1]]] = 1
            spans = np.concatenate([codes[at[j] : at[j + 1]] for j in later])
            common = np.add.reduceat(seen[spans], ragged(lengths[later])[:-1])
            seen[codes[at[i] : at[i + 1]]] = 0
            later = later[common / (lengths[later] + lengths[i] - common) >= threshold]
            left.append(np.full(later.size, i))
            right.append(later)
        if left:
            one, two = np.concatenate(left), np.concatenate(right)
            np.add.at(linked, rows[one], weights[rows[two]])
            np.add.at(linked, rows[two], weights[rows[one]])
            leads[rows] = ids[rows[local_leads(n, one, two)]]
    keep = linked > 0
    return pa.table({"doc_id": pa.array(ids[keep]), "linked": pa.array(linked[keep]), "lead": pa.array(leads[keep])})


def similar(docs: DataFrame, size: int = 5, threshold: float = 0.8, recall: float = 0.9999, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links, kept) of every document: the smallest id reachable by links, its links, and whether it is that id."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    bands, rows = banding(threshold, recall)
    seen = materialize(profiles(docs, size, bands, rows), "profiles")
    if seen.groupBy("doc_id").count().where("count > 1").limit(1).count():
        seen = materialize(seen.groupBy("doc_id").agg(F.min(F.struct("one", "two", "n", "bands")).alias("s")).select("doc_id", "s.*"), "profiles")
    classes = materialize(seen.where("n > 0").groupBy("one", "two").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "copies")
    reps = seen.drop("n").join(classes.select(F.col("rep").alias("doc_id"), "copies"), "doc_id")
    near = candidates(reps)
    members = materialize(reps.join(near, "doc_id"), "members")
    sets = sets_of(cells_of(members, "component", block).join(docs, "doc_id"), size)

    def verify(cell: pa.Table) -> pa.Table:
        return links_within(cell, threshold)

    found = materialize(sets.groupBy("cell").applyInArrow(verify, "doc_id bigint, linked bigint, lead bigint"), "links")
    joined = components(found, "doc_id", "lead")
    counted = found.groupBy("doc_id").agg(F.sum("linked").alias("linked"))
    by_rep = (classes.withColumnRenamed("rep", "doc_id").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(counted, "doc_id", "left")
              .select("one", "two", F.coalesce("component", "doc_id").alias("class_id"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (seen.select("doc_id", "one", "two", "n").join(by_rep, ["one", "two"], "left")
            .select("doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                    F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).cast("long").alias("n_links"))
            .withColumn("kept", F.col("doc_id") == F.col("class_id")))
