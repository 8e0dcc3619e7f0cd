"""Language model of word pairs whose counts lie in a log-frequency Bloom filter, broadcast to the tasks that score texts.

Three scans. The first counts words (whole, by content). The second counts pairs of neighbouring tokens: tasks send sorted arrays of 64-bit pair keys with
counts, dealt by key; each receiver adds them up and writes its own segment of the filter. A count is held as its level on a scale that is
exact up to 8 and then grows by 19 % a step: a pair of level q is entered q times, once for each level, so membership probes from level 1 up to the first miss give the
level back. Never too low, and one level too high about once in 64 times. Counts of words and of the distinct followers of a word are held the same way. The third
scan scores: with c, t and D the counts, follower counts and the discount n1 / (n1 + 2 n2) of pairs seen once and twice,

    P(w | v) = max(c(v w) - D, 0) / c(v) + D t(v) / c(v) P(w),    P(w) = (c(w) + 1) / (N + V + 1),    P(w | unknown v) = P(w)

where v is the token before, the end token before a text's first word. The base score needs exact counts of all words: words above a frequency that at most ``HEAD_WORDS`` words reach
are broadcast with them, the others, of which none is frequent, meet the count table in a join.

The filter has a size that follows from the corpus. Up to ``FILTER_BYTES`` it is one broadcast; beyond that segments go out in turns, each of which scores the pairs
that belong to it, and a document's sums are added. Texts are folded A to Z only; words are runs without ASCII white space; every text ends with one end
token. Null and empty texts are the end token alone. A null id reads as empty in the fold's checksum. Every row of documents is scored on its own, repeated ids too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm import spans
from casemill.llm.arrow import ragged
from casemill.llm.words import mixed
from casemill.session import materialize_plain as materialize

WORD = spans.marker([0x20, *range(9, 14)])
FOLDS, HELD_FOLD = 7, 2
HEAD_WORDS, HEAD_BYTES = 65_536, 64  # words that are broadcast with their counts, and their longest
PROBES, BITS_PER_ENTRY = 6, 10.0  # an entry's six bits lie in one word of 64; a probe of an absent entry succeeds about once in 60 times
PART_TOKENS, PART_WORDS = 1_000_000, 500_000  # tokens and words behind a segment
HOT_WORDS, HOT_SHARE = 1 << 20, 8  # most words whose pairs are spread over all segments, and the share of a segment from which they are
PENDING_TOKENS, SLICE_BYTES = 400_000, 400_000
KNOWN_WORDS = 400_000  # words whose counts a task remembers
FILTER_BYTES = 256 << 20
END = np.uint64(0x6A09E667F3BCC908)  # the end token's key
PAIR, COUNT, FOLLOWERS = 1, 2, 3
# Counts 1 to 8, then steps of 19 % (four to a doubling).
SCALE = np.unique(np.round(np.concatenate([np.arange(1, 10), 9 * 2 ** (np.arange(1, 160) / 4)])).astype(np.int64))
MIDDLE = np.concatenate([[0.0], np.sqrt(SCALE[:-1].astype(float) * (SCALE[1:] - 1)), [float(SCALE[-1])]])


def held_out(doc: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit(""))) % FOLDS == HELD_FOLD


def keys_of(words: pa.Array) -> np.ndarray:
    """64-bit keys of words; a null is the end token."""
    digest = xxhash.xxh3_64_intdigest
    keys = np.fromiter((digest(w) for w in spans.pieces(words)), np.uint64, len(words))
    if words.null_count:
        keys[pc.is_null(words).to_numpy(zero_copy_only=False)] = END
    return keys


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Keys of pairs: the upper half is that of the first token's key, so followers can be counted from pair keys alone."""
    low = mixed(mixed(before) + after * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return (before & np.uint64(0xFFFFFFFF00000000)) | low


def prefix(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(32)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys) % np.uint64(parts)).astype(np.int64)


def pair_part(pairs: np.ndarray, parts: int, hot: np.ndarray) -> np.ndarray:
    """The segment of pairs: that of their first token, so its followers lie together, but for hot ones (sorted prefixes), whose pairs are spread."""
    first = prefix(pairs)
    spread = hot[np.minimum(np.searchsorted(hot, first), hot.size - 1)] == first
    return part_of(np.where(spread, pairs, first), parts)


def entry(keys: np.ndarray, level: int, kind: int, words) -> tuple[np.ndarray, np.ndarray]:
    """The word that holds each entry, and its bits there."""
    first = mixed(keys ^ mixed(np.array([level * 4 + kind], np.uint64)))
    second = mixed(first + np.uint64(0x9E3779B97F4A7C15))
    bits = np.zeros(keys.size, np.uint64)
    for _ in range(PROBES):
        bits |= np.uint64(1) << (second & np.uint64(63))
        second >>= np.uint64(6)
    return (first >> np.uint64(32)) * words >> np.uint64(32), bits


def segment(filled: list[tuple[int, np.ndarray, np.ndarray]]) -> bytes:
    """Words that hold (kind, keys, counts)."""
    levels = [np.searchsorted(SCALE, counts, side="right") for _, _, counts in filled]
    out = np.zeros(max(1, int(BITS_PER_ENTRY / 64 * sum(int(q.sum()) for q in levels))), np.uint64)
    for (kind, keys, _), upto in zip(filled, levels, strict=True):
        for level in range(1, int(upto.max(initial=0)) + 1):
            at, bits = entry(keys[upto >= level], level, kind, np.uint64(out.size))
            np.bitwise_or.at(out, at.astype(np.int64), bits)
    return out.tobytes()


class Filter:
    """Segments as one flat array of words; ``level`` probes them."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes, self.begins = flat, sizes.astype(np.uint64), ragged(sizes)[:-1]

    @staticmethod
    def fields(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``segments`` by number; an empty one holds nothing."""
        bodies = [np.frombuffer(s or bytes(8), np.uint64) for s in segments]
        return np.concatenate(bodies), np.array([b.size for b in bodies], np.int64)

    def level(self, keys: np.ndarray, parts: np.ndarray, kind: int) -> np.ndarray:
        """The level of each key: probes go on from level 1 while all bits of the entry are set."""
        out = np.zeros(keys.size, np.int64)
        active = np.arange(keys.size)
        sizes, begins = self.sizes[parts], self.begins[parts]
        for level in range(1, SCALE.size + 1):
            at, bits = entry(keys, level, kind, sizes)
            hit = np.flatnonzero(self.flat[begins + at.astype(np.int64)] & bits == bits)
            if not hit.size:
                break
            active, keys, sizes, begins = active[hit], keys[hit], sizes[hit], begins[hit]
            out[active] = level
        return out

    def count(self, keys: np.ndarray, kind: int, parts: np.ndarray) -> np.ndarray:
        return MIDDLE[self.level(keys, parts, kind)]


class WordCounts:
    """Counts and follower counts of words from the filter; those met before are remembered."""

    def __init__(self, held: Filter):
        self.held = held
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, 2))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """(count, followers) of distinct keys."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(keys.size, bool)
        inside = np.flatnonzero(at < self.keys.size)
        known[inside] = self.keys[at[inside]] == keys[inside]
        out = np.zeros((keys.size, 2))
        out[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        if new.size:
            new = new[np.argsort(keys[new])]
            fresh = keys[new]
            home = part_of(prefix(fresh), self.held.sizes.size)
            out[new, 0] = self.held.count(fresh, COUNT, home)
            out[new, 1] = np.minimum(self.held.count(prefix(fresh), FOLLOWERS, home), out[new, 0])
            if self.keys.size + fresh.size > KNOWN_WORDS:
                self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, 2))
            place = np.searchsorted(self.keys, fresh)
            self.keys, self.values = np.insert(self.keys, place, fresh), np.insert(self.values, place, out[new], axis=0)
        return out


class Tokens:
    """Tokens of some texts: ``codes`` are numbers of distinct words, the end token has the next number; each text is preceded by an end token."""

    def __init__(self, column: pa.Array):
        found, rows = spans.cut(column, WORD)
        coded = found.dictionary_encode()
        self.words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.end, n = len(self.words), len(column)
        self.counts = np.bincount(rows, minlength=n) + 1
        self.rows = np.repeat(np.arange(n), self.counts)
        self.codes = np.full(self.rows.size, self.end, np.int64)
        self.inner = np.ones(self.rows.size, bool)
        self.inner[np.cumsum(self.counts) - 1] = False
        self.codes[self.inner] = codes
        self.before = np.concatenate([[self.end], self.codes[:-1]]).astype(np.int64) if self.codes.size else self.codes

    def keys(self) -> np.ndarray:
        return np.append(keys_of(self.words), END).astype(np.uint64)

    def pairs(self, inverse: bool = False):
        return np.unique(self.before * (self.end + 1) + self.codes, return_inverse=inverse, return_counts=not inverse)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts of ``docs``."""

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0

        def merged() -> Iterator[pa.RecordBatch]:
            table = pa.concat_tables(pending).group_by("word").aggregate([("n", "sum")])
            yield from pa.table({"word": table["word"].cast(pa.string()), "n": table["n_sum"]}).to_batches(max_chunksize=20_000)

        for whole in parts:
            for part in spans.slices(whole, "text", SLICE_BYTES):
                coded = spans.cut(part.column("text"), WORD)[0].dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
                pending.append(pa.table({"word": coded.dictionary, "n": n.astype(np.int64)}))
                size += n.size
                if size > PENDING_TOKENS // 2:
                    yield from merged()
                    pending, size = [], 0
        if pending:
            yield from merged()

    return docs.where("text <> ''").select("text").mapInArrow(body, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not keys.size:
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def dealt(keys: np.ndarray, counts: np.ndarray, part: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """``(part, keys, counts)``: a row per part with the bytes of its arrays."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    keys, counts = keys[order], counts[order].astype(np.int64)
    use = np.flatnonzero(np.diff(cuts)).tolist()
    for first in range(0, len(use), 64):
        some = use[first : first + 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), *(pa.array([a[cuts[p] : cuts[p + 1]].tobytes() for p in some], pa.binary()) for a in (keys, counts))],
            names=["part", "keys", "counts"])


def arrays_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of ``dealt`` rows, put together: they lie one after the other in the columns' buffers."""
    return tuple(np.concatenate([np.zeros(0, t), *(spans.bytes_of(c)[0].view(t) for c in rows[name].chunks)]) for name, t in (("keys", np.uint64), ("counts", np.int64)))


def pair_segments(docs: DataFrame, parts: int, word_parts: int, hot: np.ndarray) -> DataFrame:
    """``(part, bits, n1, n2, followers)``: segments of the pair filter, pairs seen once and twice, and per word part keys and numbers of followers."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0

        def merged() -> Iterator[pa.RecordBatch]:
            keys, counts = (np.concatenate([p[i] for p in pending]) for i in (0, 1))
            pending.clear()
            keys, counts = summed(keys, counts)
            yield from dealt(keys, counts, pair_part(keys, parts, hot), parts)

        for whole in batches:
            for part in spans.slices(whole, "text", SLICE_BYTES):
                tokens = Tokens(part.column("text"))
                keys = tokens.keys()
                pairs, counts = tokens.pairs()
                pending.append((pair_keys(keys[pairs // (tokens.end + 1)], keys[pairs % (tokens.end + 1)]), counts))
                size += pairs.size
                if size > PENDING_TOKENS:
                    yield from merged()
                    pending, size = [], 0
        if pending:
            yield from merged()

    def build(rows: pa.Table) -> pa.Table:
        keys, counts = summed(*arrays_of(rows))
        heads, followers = summed(prefix(keys), np.ones(keys.size, np.int64))
        dealt_out = list(dealt(heads, followers, part_of(heads, word_parts), word_parts))
        rows_out = pa.Table.from_batches(dealt_out) if dealt_out else None
        lists = rows_out.to_struct_array().combine_chunks() if rows_out else pa.array([], pa.struct([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))
        return pa.table({"part": rows["part"].slice(0, 1), "bits": pa.array([segment([(PAIR, keys, counts)])], pa.binary()), "n1": [int((counts == 1).sum())],
                         "n2": [int((counts == 2).sum())], "followers": pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists)})

    blobs = docs.select("text").mapInArrow(body, "part int, keys binary, counts binary")
    return blobs.groupBy("part").applyInArrow(
        build, "part int, bits binary, n1 long, n2 long, followers array<struct<part:int,keys:binary,counts:binary>>")


def word_segments(counts: DataFrame, pairs: DataFrame, parts: int) -> DataFrame:
    """``(part, bits)``: segments that hold the counts of words and of their followers."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = keys_of(batch.column("word").cast(pa.binary()))
            yield from dealt(keys, batch.column("n").to_numpy(), part_of(prefix(keys), parts), parts)

    def build(rows: pa.Table) -> pa.Table:
        words = [arrays_of(rows.filter(pc.equal(rows["kind"], kind))) for kind in (COUNT, FOLLOWERS)]
        bits = segment([(kind, *summed(*a)) for kind, a in zip((COUNT, FOLLOWERS), words, strict=True)])
        return pa.table({"part": rows["part"].slice(0, 1), "bits": pa.array([bits], pa.binary())})

    blobs = counts.mapInArrow(body, "part int, keys binary, counts binary").withColumn("kind", F.lit(COUNT))
    followers = pairs.select(F.inline("followers")).withColumn("kind", F.lit(FOLLOWERS))
    return blobs.union(followers).groupBy("part").applyInArrow(build, "part int, bits binary")


def least_power(counts: DataFrame, most: int) -> int:
    """The smallest e so that no more than ``most`` words occur 2^e times or more."""
    least, total = 63, 0
    for row in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).count().orderBy(F.desc("e")).collect():  # at most 63 rows
        total += row["count"]
        if total > most:
            break
        least = row["e"]
    return least


def head_words(counts: DataFrame) -> pa.Table:
    """The words of at least a count that no more than ``HEAD_WORDS`` words reach."""
    return counts.where((F.floor(F.log2("n")) >= least_power(counts, HEAD_WORDS)) & (F.octet_length("word") <= HEAD_BYTES)).toArrow()


def hot_prefixes(counts: DataFrame) -> np.ndarray:
    """Sorted prefixes of the keys of words that would fill a good part of a segment, at most ``HOT_WORDS``, and of the end token."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(prefix(keys_of(batch.column("word").cast(pa.binary()))).astype(np.int64))], names=["prefix"])

    hot = counts.where((F.col("n") >= PART_TOKENS // HOT_SHARE) & (F.floor(F.log2("n")) >= least_power(counts, HOT_WORDS)))
    found = hot.mapInArrow(body, "prefix long").toArrow()["prefix"].to_numpy().astype(np.uint64)
    return np.unique(np.append(found, prefix(np.array([END]))))


def score_texts(docs: DataFrame, shared) -> DataFrame:
    """One row per text, and one per text and word that is not broadcast. Only the pairs of the segments at hand add to the score."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_counts, n, v, ends, discount, pair_fields, here, hot, word_fields, with_base = shared.value
        wanted, pairs_held, word_counts_of = pa.array(head, pa.binary()), Filter(*pair_fields), WordCounts(Filter(*word_fields))
        terms = np.log10((np.append(head_counts, 0.0) + 1) / (n + v + 1))
        for whole in batches:
            for part in spans.slices(whole, "text", SLICE_BYTES):
                tokens, part = Tokens(part.column("text")), part.select(["row", "doc_id", "held_out"])
                keys, rows = tokens.keys(), part.num_rows
                count, followers = word_counts_of(keys).T
                plain = (count + 1) / (n + v + 1)
                pairs, at = tokens.pairs(inverse=True)
                before, after = np.divmod(pairs, tokens.end + 1)
                joint = pair_keys(keys[before], keys[after])
                home = pair_part(joint, here.size, hot)
                mine = here[home]
                seen = np.zeros(pairs.size)
                seen[mine] = pairs_held.count(joint[mine], PAIR, home[mine])
                seen = np.minimum(seen, np.minimum(count[before], count[after]))
                total = np.maximum(count[before], 1)
                mass = np.where(count[before] > 0, discount * np.maximum(followers[before], 1) / total, 1.0)
                log = np.where(mine, np.log10(np.maximum(seen - discount, 0) / total + mass * plain[after]), 0.0)
                columns = {"score": np.bincount(tokens.rows, log[at], rows), "n_tokens": tokens.counts.astype(np.int64)}
                if with_base:
                    number = pc.fill_null(pc.index_in(tokens.words, wanted), len(head)).to_numpy(zero_copy_only=False)
                    number = np.append(number, len(head))[tokens.codes]
                    known = number < len(head)
                    base = np.where(known, terms[number], np.where(tokens.inner, 0.0, np.log10((ends + 1) / (n + v + 1))))
                    columns |= {"base_score": np.bincount(tokens.rows, base, rows),
                                "n_known": np.bincount(tokens.rows, known | (~tokens.inner & (ends > 0)), rows).astype(np.int64)}
                    rest = np.flatnonzero(~known & tokens.inner)
                    pairs, tf = np.unique(tokens.rows[rest] * (tokens.end + 1) + tokens.codes[rest], return_counts=True)
                    row, code = np.divmod(pairs, tokens.end + 1)
                    for first in range(0, row.size, 20_000):
                        some = slice(first, first + 20_000)
                        yield table_of(part.take(pa.array(row[some])), {}, tokens.words.take(pa.array(code[some])).cast(pa.string()), tf[some])
                yield table_of(part, columns, pa.nulls(rows, pa.string()), np.zeros(rows, np.int64))
            pa.default_memory_pool().release_unused()

    def table_of(part: pa.RecordBatch, columns: dict, word: pa.Array, tf: np.ndarray) -> pa.RecordBatch:
        kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
        values = [pa.array(columns[c], t) if c in columns else pa.nulls(part.num_rows, t) for c, t in kinds.items()]
        return pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("doc_id"), part.column("held_out"), *values, word, pa.array(tf.astype(np.int64))],
            names=["row", "doc_id", "held_out", *kinds, "word", "tf"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        body, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, word string, tf long")


def turns(sizes: list[int], limit: int) -> Iterator[np.ndarray]:
    """Segments by turn: as many consecutive ones as fit."""
    here, size = np.zeros(len(sizes), bool), 0
    for i, n in enumerate(sizes):
        if here.any() and size + n > limit:
            yield here
            here, size = np.zeros(len(sizes), bool), 0
        here[i] = True
        size += n
    yield here


def segments_of(table: DataFrame, parts: int, here: np.ndarray | None = None) -> list[bytes]:
    """Written segments by number; an empty one for parts that hold nothing."""
    out = [b""] * parts
    chosen = table.select("part", "bits") if here is None else table.where(F.col("part").isin(np.flatnonzero(here).tolist())).select("part", "bits")
    for row in chosen.toLocalIterator():
        out[row["part"]] = bytes(row["bits"])
    return out


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``; learns from the texts that are not held out."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")) \
        .withColumn("held_out", held_out()).withColumn("row", F.monotonically_increasing_id())
    train = texts.where("NOT held_out")
    counts = materialize(word_counts(train), "word_counts")
    ends = train.count()
    words, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n, v = total + ends, words + (ends > 0)
    parts, word_parts = max(1, -(-n // PART_TOKENS)), max(1, -(-v // PART_WORDS))
    hot = hot_prefixes(counts)
    pairs = materialize(pair_segments(train, parts, word_parts, hot), "pair_segments")
    end_row = spark.createDataFrame([(None, ends)] if ends else [], "word string, n long")
    by_word = materialize(word_segments(counts.union(end_row), pairs, word_parts), "word_segments")
    once, twice = pairs.agg(F.coalesce(F.sum("n1"), F.lit(0)), F.coalesce(F.sum("n2"), F.lit(0))).first()
    head = head_words(counts)
    sizes = {r["part"]: r["size"] for r in pairs.select("part", F.octet_length("bits").alias("size")).collect()}
    plan = list(turns([sizes.get(p, 0) for p in range(parts)], FILTER_BYTES))
    if len(plan) > 1:  # rows need the same number in each turn
        texts = materialize(texts, "texts")
    word_fields = Filter.fields(segments_of(by_word, word_parts))
    found = []
    for turn, here in enumerate(plan):
        shared = spark.sparkContext.broadcast((
            head["word"].cast(pa.binary()).to_pylist(), head["n"].to_numpy().astype(float), n, v, ends, once / (once + 2 * twice) if once else 0.0,
            Filter.fields(segments_of(pairs, parts, here)), here, hot, word_fields, turn == 0))
        found.append(materialize(score_texts(texts, shared), "scores"))
        shared.destroy()
    rows = found[0].where("word IS NULL")
    rare = found[0].where("word IS NOT NULL").select("row", "word", "tf").join(counts, "word", "left")
    c = F.coalesce("n", F.lit(0))
    sums = [rare.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10((c + 1) / F.lit(float(n + v + 1)))).alias("more_base"), F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("more_known"),
        F.lit(0.0).alias("more_score")), *(f.groupBy("row").agg(F.lit(0.0).alias("more_base"), F.lit(0).cast("long").alias("more_known"), F.sum("score").alias("more_score"))
                                          for f in found[1:])]
    more = sums[0]
    for other in sums[1:]:
        more = more.union(other)
    if len(sums) > 1:
        more = more.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("more_base", "more_known", "more_score")))

    def plus(column: str, extra: str) -> Column:
        return (F.col(column) + F.coalesce(F.col(extra), F.lit(0))).alias(column)

    return rows.join(more, "row", "left").select(
        F.col("doc_id").alias(key), "held_out", "n_tokens", plus("n_known", "more_known"), F.lit(n).cast("long").alias("train_tokens"), plus("base_score", "more_base"),
        plus("score", "more_score"))
