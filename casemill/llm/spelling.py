"""Spelling variants: words that differ by one inserted, deleted or replaced character, found by dense tiles over prefixes and suffixes.

Words are counted in the tasks that read the texts. Two words are one edit apart if their common prefix and suffix together reach the longer length less one,
so the longer word's places, less one, are cut into windows: for one of them the pair agrees on all characters before and behind. Each word goes
to the bucket of every window, as the longer and as the shorter of a pair. Inside a bucket padded matrices of characters, aligned left and right, are
compared in tiles, which gives common prefix and suffix of many pairs at once; a pair counts in the bucket of its own window only. A bucket with more than
``BLOCK`` words is cut into blocks, and each pair of its blocks is a cell of its own. Cells return sums per word: no pair leaves a task.

A word's form is its most frequent near word if that is ten times as frequent; counts grow tenfold along forms, so the way to the root is short and is
found by doubling. Null and empty texts have no words; a null id reads as empty in the checksum that alters words. Every row of documents counts, also with a
repeated id. Runs hold only A to Z, a to z and U+00C0 to U+00FF, so a character is one byte of Latin-1.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm import spans
from casemill.llm.arrow import gather, ragged
from casemill.session import materialize_plain as materialize

LEAST_LENGTH, LEAST_COUNT, ALTERED_ONE_IN, FORM_RATIO = 7, 2, 31, 10
WINDOW, MOST_WINDOWS = 3, 8  # places of a window, and windows of a word at most (long words have wider ones)
BLOCK = 2_048
PENDING_ROWS, CHUNK_ROWS, TILE_CELLS = 300_000, 200_000, 16_000_000


def letters(data: np.ndarray) -> np.ndarray:
    """Marks ASCII letters and U+00C0 to U+00FF, whose first byte is C3."""
    table = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
    lead = data == 0xC3
    inside = table[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte per character of UTF-8 words below U+0100, and the offsets of the words."""
    data, offsets = spans.bytes_of(words)
    tail = np.zeros(data.size + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=tail[1:])
    lead = np.flatnonzero(data >= 0xC0)
    chars = data.copy()
    chars[lead + 1] = ((data[lead] & 3) << 6) | (data[lead + 1] & 0x3F)
    return np.delete(chars, lead), tail[offsets]


class Checksums:
    """CRC-32 of a text after another one, from the checksums of both: checksums are linear, so the first is moved by the second's length."""

    def __init__(self) -> None:
        step = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
        x = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        self.moves = [(x >> np.uint32(8)) ^ step[x & 255]]  # by one byte; then by two, four ...

    def apply(self, move: np.ndarray, x: np.ndarray) -> np.ndarray:
        return move[0][x & 255] ^ move[1][(x >> 8) & 255] ^ move[2][(x >> 16) & 255] ^ move[3][x >> 24]

    def joined(self, first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out, bit = first.astype(np.uint32), 0
        while (lengths >> bit).any():
            if bit == len(self.moves):
                self.moves.append(self.apply(self.moves[-1], self.moves[-1]))
            use = np.flatnonzero((lengths >> bit) & 1)
            out[use] = self.apply(self.moves[bit], out[use])
            bit += 1
        return out ^ second.astype(np.uint32)


def altered_words(part: pa.RecordBatch, sums: Checksums) -> tuple[pa.Array, np.ndarray]:
    """Words of a batch and how often each occurs, after the checksum's deletions; shorter ones than ``LEAST_LENGTH`` are left out."""
    found, rows = spans.cut(part.column("text"), letters)
    coded = found.dictionary_encode()
    known, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    data, offsets = spans.bytes_of(known)
    chars = np.diff(latin(known)[1])
    use = chars[codes] >= LEAST_LENGTH
    pairs, counts = np.unique(rows[use] * np.int64(max(len(known), 1)) + codes[use], return_counts=True)
    rows, codes = np.divmod(pairs, max(len(known), 1))
    heads = np.array([zlib.crc32(("" if d is None else str(d)).encode() + b":") for d in part.column("doc").to_pylist()], np.uint32)
    raw = data.tobytes()
    own = np.zeros(len(known), np.uint32)
    long = np.flatnonzero(chars >= LEAST_LENGTH)
    own[long] = [zlib.crc32(raw[a:b]) for a, b in zip(offsets[long].tolist(), offsets[long + 1].tolist(), strict=True)]
    h = sums.joined(heads[rows], own[codes], np.diff(offsets)[codes])
    hit = h % ALTERED_ONE_IN == 0
    whole = np.bincount(codes[~hit], counts[~hit], len(known)).astype(np.int64)
    kept = np.flatnonzero(whole)
    cut = np.flatnonzero(hit & (chars[codes] > LEAST_LENGTH))
    shorter = []
    for code, at in zip(codes[cut].tolist(), (h[cut] % chars[codes[cut]]).tolist(), strict=True):
        word = raw[offsets[code] : offsets[code + 1]].decode()
        shorter.append((word[:at] + word[at + 1 :]).encode())
    return pa.concat_arrays([known.take(pa.array(kept)), pa.array(shorter, pa.binary())]), np.concatenate([whole[kept], counts[cut]])


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(word, n)`` of all words with at least ``LEAST_COUNT`` occurrences."""

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, pending, size = Checksums(), [], 0

        def merged() -> Iterator[pa.RecordBatch]:
            table = pa.concat_tables(pending).group_by("word").aggregate([("n", "sum")])
            yield from pa.table({"word": table["word"].cast(pa.string()), "n": table["n_sum"]}).to_batches(max_chunksize=20_000)

        for whole in parts:
            for part in spans.slices(whole, "text"):
                words, n = altered_words(part, sums)
                pending.append(pa.table({"word": words, "n": n}))
                size += len(words)
                if size > PENDING_ROWS:
                    yield from merged()
                    pending, size = [], 0
        if pending:
            yield from merged()

    found = docs.select(F.col(key).cast("string").alias("doc"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL AND text <> ''") \
        .mapInArrow(body, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def windows_of(length):
    """How many windows a pair with this longer length has; for numbers and numpy arrays."""
    return np.clip(-(-(length - 1) // WINDOW), 3, MOST_WINDOWS)


def bucketed(words: DataFrame) -> DataFrame:
    """``(bucket, place, word, n)``: a row per word, longer length and window. ``place`` is 8 x longer length + window."""
    size = F.length("word")

    def keys(longer: Column) -> Column:
        count = F.least(F.greatest(F.ceil((longer - 1) / WINDOW).cast("int"), F.lit(3)), F.lit(MOST_WINDOWS))

        def key(j: Column) -> Column:
            before = F.floor(j * (longer - 1) / count).cast("int")
            behind = longer - 1 - F.floor((j + 1) * (longer - 1) / count).cast("int")
            place = longer * MOST_WINDOWS + j
            return F.struct(F.xxhash64(place, F.substring("word", F.lit(1), before), F.substring("word", size - behind + 1, behind)).alias("bucket"), place.alias("place"))

        return F.transform(F.sequence(F.lit(0), count - 1), key)

    return words.select(F.explode(F.concat(keys(size), keys(size + 1))).alias("k"), "word", "n").select("k.*", "word", "n")


def cells(rows: DataFrame) -> DataFrame:
    """``bucketed`` rows with their cell: large buckets are cut into blocks, whose pairs are cells; ``side`` tells the two blocks of a pair apart."""
    large = materialize(rows.groupBy("bucket").count().where(F.col("count") > BLOCK)
                        .select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large_buckets")
    own = F.pmod(F.xxhash64("word", "place"), F.col("blocks")).cast("int")

    def cell(other: Column) -> Column:
        low, high = F.least(F.col("own"), other), F.greatest(F.col("own"), other)
        return F.struct((low.cast("long") * F.col("blocks") + high).alias("cell"), F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2).alias("side"))

    placed = rows.join(large, "bucket", "left").withColumn("own", own)
    one = F.array(F.struct(F.lit(0).cast("long").alias("cell"), F.lit(0).alias("side")))
    spread = F.when(F.col("blocks").isNull(), one).otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), cell))
    return placed.select("bucket", "place", "word", "n", F.explode(spread).alias("c")).select("bucket", "c.cell", "place", "c.side", "word", "n")


def aligned(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Padded matrix of characters, from the front or from the back."""
    at = np.arange(width)
    index = (starts + lengths - 1)[:, None] - at if right else starts[:, None] + at
    return np.where(at < lengths[:, None], data[np.clip(index, 0, max(data.size - 1, 0))], 0).astype(np.uint8)


def shared(tile: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal characters at the head of each pair of rows."""
    differs = tile[a] != tile[b]
    return np.where(differs.any(axis=1), differs.argmax(axis=1), tile.shape[1])


def near_pairs(data: np.ndarray, offsets: np.ndarray, group: np.ndarray, place: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows one edit apart, in tiles. ``group`` numbers the cells of sorted rows; a pair is one of rows of the same cell."""
    lengths = np.diff(offsets)
    ends = np.searchsorted(group, group, side="right")
    partners = ends - np.arange(group.size) - 1
    width = max(int(lengths.max(initial=1)), 1)
    upto = np.cumsum(partners)
    first = 0
    while first < group.size:
        base = upto[first] - partners[first]
        last = max(int(np.searchsorted(upto, base + TILE_CELLS // width, side="right")), first + 1)
        rows = np.arange(first, last)
        a = np.repeat(rows, partners[rows])
        b = gather(rows + 1, partners[rows])
        longer = np.maximum(lengths[a], lengths[b])
        use = (place[a] == place[b]) & (longer == place[a] // MOST_WINDOWS) & ((side[a] == 0) | (side[a] != side[b]))
        a, b, longer = a[use], b[use], longer[use]
        if a.size:
            stop = int(b.max()) + 1
            span = slice(first, stop)
            wide = max(int(lengths[span].max()), 1)
            front, back = (aligned(data, offsets[:-1][span], lengths[span], wide, right) for right in (False, True))
            least = np.minimum(lengths[a], lengths[b])
            prefix = np.minimum(shared(front, a - first, b - first), least)
            suffix = np.minimum(shared(back, a - first, b - first), least)
            count = windows_of(longer)
            # The pair's own window is the last one that begins within the common prefix.
            window = np.minimum(((np.minimum(prefix, longer - 1) + 1) * count - 1) // np.maximum(longer - 1, 1), count - 1)
            near = (prefix + suffix >= longer - 1) & (window == place[a] % MOST_WINDOWS)
            yield a[near], b[near]
        first = last


def near_sums(rows: pa.Table) -> pa.RecordBatch | None:
    """``(word, n_near, best_n, best)`` of the words of whole cells: near words, the count of the most frequent one and the smallest such word."""
    words = rows["word"].combine_chunks().cast(pa.binary())
    bucket, cell, place, side, n = (rows[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("bucket", "cell", "place", "side", "n"))
    change = (np.diff(bucket) != 0) | (np.diff(cell) != 0) | (np.diff(place) != 0)
    group = np.concatenate([[0], np.cumsum(change)])
    data, offsets = latin(words)
    found = list(near_pairs(data, offsets, group, place.astype(np.int64), side))
    a, b = (np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in (0, 1))
    if not a.size:
        return None
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    most = np.zeros(group.size, np.int64)
    np.maximum.at(most, one, n[other])
    top = n[other] == most[one]
    ties, rivals = one[top], words.take(pa.array(other[top]))
    table = pa.table({"row": ties, "best": rivals}).group_by("row").aggregate([("best", "min")])
    at = table["row"].to_numpy()
    near = np.bincount(one, minlength=group.size)
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(at)).cast(pa.string()), pa.array(near[at].astype(np.int64)), pa.array(most[at]), table["best_min"].combine_chunks().cast(pa.string())],
        names=["word", "n_near", "best_n", "best"])


def near_words(placed: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` of all words with near words."""

    def body(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0

        def step(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pending, size
            rows = pa.Table.from_batches(pending).combine_chunks()
            end = rows.num_rows
            if not last:  # the last cell may go on in the next batch
                bucket, cell, place = (rows[c].to_numpy() for c in ("bucket", "cell", "place"))
                end = int(np.flatnonzero((bucket == bucket[-1]) & (cell == cell[-1]) & (place == place[-1]))[0])
            sums = near_sums(rows.slice(0, end)) if end else None
            if sums is not None:
                yield sums
            pending = rows.slice(end).to_batches()
            size = rows.num_rows - end

        for part in parts:
            pending.append(part)
            size += part.num_rows
            if size > CHUNK_ROWS:
                yield from step(False)
        if size:
            yield from step(True)

    dealt = placed.repartition("bucket", "cell").sortWithinPartitions("place", "bucket", "cell", "side")
    found = dealt.mapInArrow(body, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.minus_n")).alias("best_n"), "b.best")


def roots_of(linked: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form, by doubling: each round every word points where its target points."""
    roots = materialize(linked.select("word", F.col("form").alias("root")), "roots")
    while True:
        target = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = roots.join(target, "root", "left")
        moved = materialize(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n, n_near, form, form_n, root)``: a row per word."""
    words = materialize(word_counts(docs, key, text), "words")
    near = near_words(cells(bucketed(words)))
    formed = F.col("best_n") >= FORM_RATIO * F.col("n")
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best")).alias("form"),
        F.when(formed, F.col("best_n")).alias("form_n")), "near_words")
    roots = roots_of(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
