"""Line dedup: later copies of repeated runs of lines are deleted.

Every line is named by a cryptographic digest of its bytes. Prefix doubling names the sequences of 2, 4, 8, ... lines that start at each line, from the names of
their two halves; any sequence of m lines has the two names of its first and its last 2^k <= m lines. Names made of content are the same in every
document, so doubling needs no exchange of ranks between documents: only the sequences that matter are dealt out by their names. Those are
the intervals of equal prefixes of a suffix array, and the first place of each is its first copy.

A run begins and ends with lines that have words. It is deleted if it has at least ``min_words`` words and occurred at an earlier place. All such runs together
are the same as the shortest ones: a run is the union of the shortest windows in it that have enough words, counted forward from a line and backward
from a line, or from a line to the next one with words if blank lines lie between. Blank lines count no words, so a window may have any number of them. The first copy always stays: of a copy that
overlaps its first copy, only the lines behind the first copy go. :func:`repeated_runs` gives the maximal runs that the windows make up.

Places are ordered by document id (null first), then the text's digest, then the line number. Null texts have no lines and stay null; an empty text is one empty
line. Rows that repeat id and text count as one row and keep the same lines. Lines are cut at newline characters only and compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm import words
from casemill.llm.arrow import map_batches, ragged, texts_of, unused
from casemill.session import materialize_plain as materialize

MIN_WORDS = 30
BATCH_CHARS = 1_000_000
PLACE = "struct<d:bigint,h:bigint,p:int>"


def joined_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """128-bit names of pairs of 128-bit names; each half depends on all of both."""
    one = words.mixed(left[:, 0] + words.mixed(left[:, 1] + words.mixed(right[:, 0] + words.mixed(right[:, 1] + np.uint64(1)))))
    two = words.mixed(right[:, 1] ^ words.mixed(left[:, 1] ^ words.mixed(right[:, 0] ^ words.mixed(left[:, 0] ^ np.uint64(words.MULTIPLIER)))))
    return np.column_stack([one, two])


def names_of(lines: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Names of the sequences of lines at these places: levels of doubling, and of each sequence the names of its first and last 2^k lines."""
    out = np.zeros((starts.size, 2), np.uint64)
    level, size = lines, 1
    while True:
        use = np.flatnonzero((lengths >= size) & (lengths < 2 * size))
        both = joined_names(level[starts[use]], level[starts[use] + lengths[use] - size])
        out[use] = joined_names(both, np.column_stack([lengths[use].astype(np.uint64), np.zeros(use.size, np.uint64)]))
        if not (lengths >= 2 * size).any():
            return out
        level = joined_names(level[:-size], level[size:])  # a sequence over the end of a text is never asked for
        size *= 2


class Lines:
    """Shortest windows of enough words in texts."""

    def __init__(self, min_words: int):
        self.min_words, self.classes = min_words, words.class_table()

    def windows(self, b: words.Batch) -> tuple[np.ndarray, ...]:
        """(text, first line, lines, name) of the shortest windows that begin or end at a line with words."""
        cut = np.flatnonzero(b.points == 10)
        starts = np.sort(np.concatenate([b.starts, cut + 1]))
        ends = np.sort(np.concatenate([b.ends, cut]))
        text = np.searchsorted(b.ends, starts)  # an empty last line starts at its text's end
        heads, _ = words.visible_words(b)
        counts = np.bincount(np.searchsorted(ends, heads), minlength=starts.size)
        total = ragged(counts)
        first = np.searchsorted(text, text)
        last = np.searchsorted(text, text, side="right")
        worded = np.flatnonzero(counts > 0)
        forward = np.searchsorted(total, total[worded] + self.min_words)  # the first end with enough words
        fits = forward <= last[worded]
        backward = np.searchsorted(total, total[worded + 1] - self.min_words, side="right") - 1
        back = (total[worded + 1] >= self.min_words) & (backward >= first[worded])
        # Blank lines between two lines that have enough words together, in runs that go on on both sides.
        left, right = worded[:-1], worded[1:]
        gap = (right > left + 1) & (text[right] == text[left]) & (counts[left] + counts[right] >= self.min_words)
        begins = np.concatenate([worded[fits], backward[back], left[gap]])
        stops = np.concatenate([forward[fits], worded[back] + 1, right[gap] + 1])
        if not begins.size:
            return text[:0], begins, begins, np.zeros((0, 2), np.uint64)
        begins, stops = np.unique(np.column_stack([begins, stops]), axis=0).T
        found, at = b.distinct(starts, ends)
        names = names_of(words.digests(found, 16)[at], begins, stops - begins)
        return text[begins], begins - first[begins], stops - begins, names


def windows_of(docs: DataFrame, min_words: int) -> DataFrame:
    """(place, lines, one, two): shortest windows and their names; ``docs`` has d, h and text."""

    def make():
        lines = Lines(min_words)

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            part = part.filter(pc.is_valid(part.column(2)))
            for first, b in words.batches(texts_of(part.column(2)), lines.classes, BATCH_CHARS):
                text, number, count, names = lines.windows(b)
                rows = pa.array(first + text)
                place = pa.StructArray.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.array(number, pa.int32())], ["d", "h", "p"])
                yield pa.RecordBatch.from_arrays(
                    [place, pa.array(count, pa.int32()), *(pa.array(np.ascontiguousarray(names[:, k]).view(np.int64)) for k in (0, 1))], names=["place", "lines", "one", "two"])

        return step

    return map_batches(docs, make, f"place {PLACE}, lines int, one bigint, two bigint")


def later_copies(windows: DataFrame) -> DataFrame:
    """(place, lines, first) of the windows that occurred before, with the first place of their content.

    Windows and first places are written: then both sides of the join come from exchanges of their own, and adaptive execution can split a hot window's rows.
    """
    windows = materialize(windows, "windows")
    first = windows.groupBy("one", "two").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last").drop("last")
    return windows.join(materialize(first, "firsts"), ["one", "two"]).where("place > first").select("place", "lines", "first")


def identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """d, h and text of ``docs``: what a row is known by."""
    return docs.select(doc_key(doc_id).alias("d"), text_key(text).alias("h"), F.col(text).alias("text"))


def doc_key(doc_id: str) -> F.Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))


def text_key(text: str) -> F.Column:
    return F.xxhash64(F.sha2(F.col(text).cast("binary"), 256))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text", n_lines: str = "n_lines", n_deleted: str = "n_deleted") -> DataFrame:
    """``docs`` with the later copies gone from the text, and new columns n_lines and n_deleted; columns of the input with these names are replaced."""
    copies = later_copies(windows_of(identified(docs, doc_id, text), min_words))
    overlaps = F.expr("first.d = place.d AND first.h = place.h")
    ranges = copies.select(
        F.col("place.d").alias("d"), F.col("place.h").alias("h"),
        F.when(overlaps, F.greatest(F.expr("place.p"), F.expr("first.p + lines"))).otherwise(F.col("place.p")).alias("a"), F.expr("place.p + lines").alias("b")).where("a < b")
    d, h, runs = (unused(docs.columns, stem) for stem in ("line_d", "line_h", "line_runs"))
    cut_out = materialize(ranges.groupBy(F.col("d").alias(d), F.col("h").alias(h)).agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias(runs))
                          .withColumn(runs, joined_runs(runs)), "runs")
    lines = F.split(F.col(text), "\n", -1)
    keep = F.filter(lines, lambda line, i: ~F.exists(runs, lambda r: (r["a"] <= i) & (i < r["b"])))
    # A merge join at any size: texts with and without runs move once, however many of them there are.
    return (docs.withColumn(d, doc_key(doc_id)).withColumn(h, text_key(text)).join(cut_out.hint("merge"), [d, h], "left")
            .withColumn(n_lines, F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)))
            .withColumn(n_deleted, F.coalesce(F.aggregate(runs, F.lit(0), lambda n, r: n + r["b"] - r["a"]), F.lit(0)))
            .withColumn(text, F.when(F.col(runs).isNull(), F.col(text)).otherwise(F.array_join(keep, "\n")))
            .drop(d, h, runs))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, lines, first_doc_id, first_start): maximal runs of lines whose windows have their first copies side by side in one document."""
    copies = later_copies(windows_of(identified(docs, doc_id, text), min_words))
    rows = copies.select("place.d", "place.h", "place.p", "lines", F.col("first.d").alias("fd"), F.col("first.h").alias("fh"), (F.col("first.p") - F.col("place.p")).alias("shift")).distinct()
    order = Window.partitionBy("d", "h", "fd", "fh", "shift").orderBy("p", "lines")
    before = F.max(F.col("p") + F.col("lines")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    grouped = rows.withColumn("fresh", F.when(F.col("p") <= before, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = grouped.groupBy("d", "h", "fd", "fh", "shift", "run").agg(F.min("p").alias("start"), F.max(F.col("p") + F.col("lines")).alias("end"))
    null = F.lit(-(1 << 63))
    return ends.select(F.nullif("d", null).alias("doc_id"), "start", (F.col("end") - F.col("start")).alias("lines"), F.nullif("fd", null).alias("first_doc_id"),
                       (F.col("start") + F.col("shift")).alias("first_start"))


def joined_runs(column: str) -> F.Column:
    """Sorted ranges of one document as disjoint ones: overlapping and touching ranges grow together."""
    return F.expr(f"""aggregate({column}, cast(array() as array<struct<a:int,b:int>>), (done, r) ->
        CASE WHEN size(done) > 0 AND element_at(done, -1).b >= r.a
             THEN concat(slice(done, 1, size(done) - 1), array(named_struct('a', element_at(done, -1).a, 'b', greatest(element_at(done, -1).b, r.b))))
             ELSE concat(done, array(r)) END)""")
