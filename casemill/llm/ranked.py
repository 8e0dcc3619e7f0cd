"""Ranked lexical search with the Best Position Algorithm on impact lists.

A scan counts, per document, its terms and those of the stated items; sums over all documents give the numbers that weights and impacts need. The counts
are written once, and each task of the search takes its documents in shards of bounded size. A shard has one impact list per term of the items: its
documents by falling impact. For an item the lists of its terms are read by direct access: at the first unseen position of every list, some positions at a
time. A document met that way is looked up in all lists of the item, which gives its whole score and its position in every list. The best position of a list is the
last one of the run of seen positions at its head, and no unseen document has a larger impact there. Once the sum of the weighted impacts at the
best positions is strictly below the k-th score, no other document of the shard can be among the k best, ties included. Tasks hand over k rows per
item; postings are never shuffled.

An item is a distinct pair of item id and text; if an id has several texts, ``variant`` numbers them in text order from 0. Items are taken in blocks whose terms are
counted in one scan each; only one block is on the driver at a time. Every row of documents is a document of its own, also with a null or
repeated id; null ids come last among equal scores. Null, empty and termless texts have no score, and items without terms no rows. Ids are whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from casemill.llm import spans
from casemill.llm.arrow import list_array, ragged
from casemill.session import materialize_plain as materialize

# Bytes that belong to no term: all of ASCII but digits and letters.
TERM = spans.marker([b for b in range(128) if not chr(b).isalnum()])
BLOCK_TERMS, BLOCK_BYTES = 65_536, 4_000_000  # distinct terms of a block of items and their bytes
GROUP_TERMS = 4_096  # distinct terms of the items that share a position table
SHARD_DOCS, SHARD_CELLS = 10_000, 1 << 25  # documents of a shard, and cells of its position table
STEP = 16


@dataclass(frozen=True)
class Block:
    """Items with the numbers of their terms in ``vocabulary`` and how often each has them."""

    ids: list
    variants: list[int]
    vocabulary: list[bytes]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @staticmethod
    def of(rows: list[Row]) -> Block:
        vocabulary = sorted({bytes(t) for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        found = [np.unique([number[bytes(t)] for t in r["terms"]], return_counts=True) for r in rows]
        return Block([r["item"] for r in rows], [r["variant"] for r in rows], vocabulary, [t for t, _ in found], [c for _, c in found])

    def groups(self) -> Iterator[list[int]]:
        """Items in groups of at most ``GROUP_TERMS`` distinct terms; an item with more is a group by itself."""
        group, known = [], set()
        for i, terms in enumerate(self.terms):
            new = known | set(terms.tolist())
            if group and len(new) > GROUP_TERMS:
                yield group
                group, new = [], set(terms.tolist())
            group, known = [*group, i], new
        if group:
            yield group


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(item, variant, terms)`` of the items with terms."""
    distinct = items.select(F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL").distinct()
    numbered = distinct.withColumn("variant", F.row_number().over(Window.partitionBy("item").orderBy("text")) - 1)

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found, rows = spans.cut(part.column("text"), TERM)
            offsets = ragged(np.bincount(rows, minlength=part.num_rows))
            terms = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), found)
            yield pa.RecordBatch.from_arrays([part.column("item"), part.column("variant"), terms], names=["item", "variant", "terms"])

    return numbered.mapInArrow(body, "item long, variant int, terms array<binary>").where("size(terms) > 0")


def blocks(items: DataFrame) -> Iterator[Block]:
    """Items in blocks of bounded size; an item beyond the bound is a block by itself."""
    rows, known, size = [], set(), 0
    for row in items.toLocalIterator():
        new = {bytes(t) for t in row["terms"]} - known
        if rows and (len(known) + len(new) > BLOCK_TERMS or size + sum(map(len, new)) > BLOCK_BYTES):
            yield Block.of(rows)
            rows, known, size = [], set(), 0
            new = {bytes(t) for t in row["terms"]}
        rows.append(row)
        known |= new
        size += sum(map(len, new))
    if rows:
        yield Block.of(rows)


def count_terms(docs: DataFrame, key: str, text: str, shared) -> DataFrame:
    """``(doc, n, ids, tf)`` of the documents with terms: how many they have, and how often those of the vocabulary."""

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.binary())
        for whole in parts:
            for part in spans.slices(whole, "text"):
                found, rows = spans.cut(part.column("text"), TERM)
                n = np.bincount(rows, minlength=part.num_rows)
                ids = pc.fill_null(pc.index_in(found, wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                known = np.flatnonzero(ids >= 0)
                pairs, tf = np.unique(rows[known] * len(wanted) + ids[known], return_counts=True)
                offsets = ragged(np.bincount(pairs // len(wanted), minlength=part.num_rows))
                batch = pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(n.astype(np.int64)), list_array(pairs % len(wanted), offsets, pa.int32()), list_array(tf, offsets, pa.int64())],
                    names=["doc", "n", "ids", "tf"])
                yield batch.filter(pa.array(n > 0))

    return docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL AND text <> ''") \
        .mapInArrow(body, "doc long, n long, ids array<int>, tf array<bigint>")


class Shard:
    """Impact lists of some documents: per term the documents by falling impact, and every document's position in every list."""

    def __init__(self, ids: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int, terms: np.ndarray):
        """``ids``, ``docs``, ``impacts``: postings; ``terms``: sorted numbers of the terms to index."""
        at = np.minimum(np.searchsorted(terms, ids), terms.size - 1)
        use = np.flatnonzero(terms[at] == ids)
        at, docs, impacts = at[use], docs[use], impacts[use]
        order = np.lexsort((docs, -impacts, at))
        self.docs, self.impacts, at = docs[order], impacts[order], at[order]
        self.heads = np.searchsorted(at, np.arange(terms.size + 1))
        # Positions of a list count from 1; 0 says that the document is not in it.
        self.positions = np.zeros((terms.size, n_docs), np.int16 if n_docs < 1 << 15 else np.int32)
        self.positions[at, self.docs] = np.arange(at.size) - self.heads[at] + 1
        self.terms, self.n_docs = terms, n_docs

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents met, their scores, and the number of them: all documents of the shard that can be among the k best.

        ``floor`` is a k-th score known from elsewhere, 0 if there is none.
        """
        at = np.searchsorted(self.terms, terms)
        heads, sizes = self.heads[at], self.heads[at + 1] - self.heads[at]
        full = np.flatnonzero((sizes > 0) & (weights > 0))
        at, heads, sizes, weights = at[full], heads[full], sizes[full], weights[full]
        seen_doc = np.zeros(self.n_docs, bool)
        reached = np.zeros(at.size, np.int64)  # best positions
        met, scores, kth, step = [], [], floor, STEP
        while True:
            open_lists = np.flatnonzero(reached < sizes)
            if not open_lists.size:
                break
            # Direct access at the first unseen positions: a position is unseen if its document is.
            ahead = [self.docs[heads[i] + reached[i] : heads[i] + min(reached[i] + step, sizes[i])] for i in open_lists]
            new = np.unique(np.concatenate(ahead))
            new = new[~seen_doc[new]]
            seen_doc[new] = True
            places = self.positions[at[:, None], new[None, :]].astype(np.int64)
            impacts = np.where(places > 0, self.impacts[np.maximum(heads[:, None] + places - 1, 0)], 0)
            met.append(new)
            scores.append(weights @ impacts)
            for i in open_lists:  # the run of seen positions at the head of each list
                reached[i] = self.run(heads[i], reached[i], sizes[i], seen_doc, step)
            pool = np.concatenate(scores)
            if pool.size >= k:
                kth = max(kth, int(np.partition(pool, pool.size - k)[pool.size - k]))
            limit = int(weights @ np.where(reached < sizes, self.impacts[heads + reached - 1], 0))
            if limit < kth:
                break
            step *= 2
        if not met:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        docs, scores = np.concatenate(met), np.concatenate(scores)
        return docs, scores, docs.size

    def run(self, head: int, reached: int, size: int, seen_doc: np.ndarray, step: int) -> int:
        while reached < size:
            seen = seen_doc[self.docs[head + reached : head + min(reached + step, size)]]
            gap = int(np.argmin(seen))
            if not seen[gap]:
                return reached + gap
            reached += seen.size
        return reached


class Best:
    """The k best rows of an item so far, by score, then id; null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        use = scores > 0
        scores, ids, null = (np.concatenate([a, b[use]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]

    @property
    def kth(self) -> int:
        return int(self.scores[-1]) if self.scores.size == self.k else 0


def search_tasks(counted: DataFrame, shared, k: int) -> DataFrame:
    """``(position, doc, score)``: per task and item of the block the k best documents."""

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, weights, n_all, total = shared.value
        block = Block(**fields)
        groups = [(g, np.unique(np.concatenate([block.terms[i] for i in g]))) for g in block.groups()]
        size = max(64, min(SHARD_DOCS, SHARD_CELLS // max(t.size for _, t in groups)))
        best = [Best(k) for _ in block.ids]
        for part in parts:
            for first in range(0, part.num_rows, size):
                shard = part.slice(first, size)
                n = shard.column("n").to_numpy(zero_copy_only=False)
                length = 75 + (25 * n * n_all) // total
                counts = pc.list_value_length(shard.column("ids")).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(shard.num_rows), counts)
                ids = shard.column("ids").flatten().to_numpy(zero_copy_only=False)
                tf = shard.column("tf").flatten().to_numpy(zero_copy_only=False)
                impacts = (1_000_000_000 * tf) // (1000 * tf + 12 * length[row])
                keys = pc.fill_null(shard.column("doc"), 0).to_numpy(zero_copy_only=False)
                null = pc.is_null(shard.column("doc")).to_numpy(zero_copy_only=False)
                for group, terms in groups:
                    lists = Shard(ids, row, impacts, shard.num_rows, terms)
                    for i in group:
                        docs, scores, _ = lists.best(block.terms[i], block.repeats[i] * weights[block.terms[i]], k, best[i].kth)
                        best[i].add(scores, keys[docs], null[docs])
        position = np.repeat(np.arange(len(best), dtype=np.int32), [b.ids.size for b in best])
        if position.size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(position), pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.null for b in best])),
                 pa.array(np.concatenate([b.scores for b in best]))], names=["position", "doc", "score"])

    return counted.mapInArrow(body, "position int, doc long, score long")


def term_weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def search_block(docs: DataFrame, block: Block, k: int, key: str, text: str) -> DataFrame:
    """``(item_id, variant, rank, doc_id, score)`` of one block of items, written."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(block.vocabulary)
    counted = materialize(count_terms(docs, key, text, vocabulary), "term_counts")
    n, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(block.vocabulary), np.int64)
    for row in counted.select(F.explode("ids").alias("id")).groupBy("id").count().toLocalIterator():  # at most BLOCK_TERMS rows
        df[row["id"]] = row["count"]
    shared = spark.sparkContext.broadcast((vars(block), term_weights(df, n), n, max(total, 1)))
    order = Window.partitionBy("position").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = search_tasks(counted, shared, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(zip(range(len(block.ids)), block.ids, block.variants, strict=True)), "position int, item_id long, variant int")
    found = materialize(ranked.join(names, "position").select("item_id", "variant", "rank", F.col("doc").alias("doc_id"), "score"), "ranked")
    shared.destroy()
    vocabulary.destroy()
    return found


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, variant, rank, doc_id, score)``: the k best documents with a score above 0 of every item."""
    found = None
    for block in blocks(item_terms(items, item, item_text)):
        part = search_block(docs, block, k, key, text)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], "item_id long, variant int, rank int, doc_id long, score long") if found is None else found
