"""Token counts under a BPE with word ends, by merging ragged arrays of symbols in rank order.

A batch of distinct pre-tokens is held as one flat array of symbols with the number of the sequence each belongs to. In every round each
sequence finds its pair of lowest rank and merges all its occurrences at once, left to right; sequences without a ranked pair are done and leave the
arrays. What survives is counted, and the counts return to the pre-tokens' positions in the texts.

Null texts count as empty. Input columns named like the new ones are replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casemill.llm import words
from casemill.llm.arrow import map_batches, ragged, texts_of, with_columns
from casemill.llm.bpe import byte_chars

BATCH_CHARS = 2_000_000
TABLE_WORDS = 1_000_000


class Merger:
    """Rank-synchronous merging over a vocabulary with an end-of-word mark."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        ids, mark = model["vocab"], model["end_of_word_suffix"] or ""
        self.width = len(ids) + 1
        of = byte_chars()
        char = {b: c for c, b in of.items()}
        unknown = len(ids)
        self.inner = np.array([ids.get(char[b], unknown) for b in range(256)], np.int64)
        self.last = np.array([ids.get(char[b] + mark, unknown) for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.width + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, len(pairs))
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)

    def counts(self, pretokens: list[str]) -> np.ndarray:
        """How many symbols survive of each pre-token."""
        data = [t.encode("utf-8", "replace") for t in pretokens]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        flat = np.frombuffer(b"".join(data), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends[lengths > 0]] = self.last[flat[ends[lengths > 0]]]
        out = lengths.copy()
        rows = np.repeat(np.arange(len(data)), lengths)
        ranks = self.pair_ranks(symbols, rows)
        while True:
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            if not starts.size:
                return out
            low = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, rows.size))
            live = low < self.none
            stay = np.repeat(live, sizes)
            low = np.repeat(low[live], sizes[live])
            symbols, rows, ranks = symbols[stay], rows[stay], ranks[stay]
            if not rows.size:
                return out
            hit = ranks == low
            hit = self.leftmost(hit)
            at = np.flatnonzero(hit)
            symbols[at] = self.made[ranks[at]]
            gone = at + 1
            out -= np.bincount(rows[gone], minlength=out.size)
            keep = np.ones(rows.size, bool)
            keep[gone] = False
            dirty = np.zeros(rows.size, bool)
            dirty[at] = True
            before = at - 1
            before = np.where((before >= 0) & ~keep[np.maximum(before, 0)], before - 1, before)
            dirty[before[before >= 0]] = True
            symbols, rows, ranks, dirty = symbols[keep], rows[keep], ranks[keep], np.flatnonzero(dirty[keep])
            ranks[dirty] = self.none
            inside = dirty[dirty < rows.size - 1]
            inside = inside[rows[inside] == rows[inside + 1]]
            ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])

    def pair_ranks(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rank of each symbol's pair with its right neighbour."""
        ranks = np.full(symbols.size, self.none, np.int64)
        inside = np.flatnonzero(rows[1:] == rows[:-1])
        ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        return ranks

    @staticmethod
    def leftmost(hit: np.ndarray) -> np.ndarray:
        """Of overlapping pairs (a run of one symbol) every second, from the left."""
        edge = np.diff(hit.astype(np.int8), prepend=0)
        begins = np.flatnonzero(edge == 1)
        if not begins.size:
            return hit
        position = np.arange(hit.size) - np.repeat(begins, np.diff(np.append(begins, hit.size)))[: hit.size] if begins[0] == 0 else np.concatenate(
            [np.zeros(begins[0], np.int64), np.arange(begins[0], hit.size) - np.repeat(begins, np.diff(np.append(begins, hit.size)))])
        return hit & (position % 2 == 0)


class Normal:
    """Composed form and lower case, character by character (a final sigma keeps its common form); ``newer`` adds characters that Python does not know."""

    def __init__(self, newer: dict[int, str]):
        self.newer = newer
        self.some = re.compile("[" + "".join(map(chr, newer)) + "]") if newer else None

    def __call__(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.some and self.some.search(text):
                text = text.translate(self.newer)
        return text.lower()


def pretoken_spans(b: words.Batch) -> tuple[np.ndarray, np.ndarray]:
    """Contractions, runs of letters, single numbers, and runs of other characters; white space is dropped."""
    cls = b.classes
    change = np.empty(cls.size, bool)
    change[0] = True
    np.not_equal(cls[1:], cls[:-1], out=change[1:])
    change |= cls == words.NUMBER
    marks = np.flatnonzero(change & (b.points == ord("'")))
    if marks.size:
        heads, lengths = words.contractions(b, marks)
        change[heads + 1] = False
        change[heads + lengths] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], cls.size)
    keep = (cls[starts] != words.SPACE) & (cls[starts] != words.END)
    return starts[keep], ends[keep]


class Counter:
    """Token counts of texts; counts of distinct pre-tokens are kept between batches of a task, up to ``TABLE_WORDS``."""

    def __init__(self, vocabulary: str, newer: tuple[dict[int, int], dict[int, str]]):
        self.merger, self.normal = Merger(vocabulary), Normal(newer[1])
        self.classes = words.with_newer(words.class_table(), newer[0])
        special = [t["content"] for t in json.loads(vocabulary)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known = {}

    def pretokens(self, found: list[str]) -> np.ndarray:
        new = [w for w in found if w not in self.known]
        if new:
            if len(self.known) + len(new) > TABLE_WORDS:
                self.known, new = {}, found
            self.known.update(zip(new, self.merger.counts(new).tolist(), strict=True))
        return np.fromiter((self.known[w] for w in found), np.int64, len(found))

    def counts(self, texts: list[str]) -> np.ndarray:
        extra, parts, owner = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            cut = self.special.split(text) if self.special else [text]
            extra[i] = len(cut) - 1
            parts += map(self.normal, cut)
            owner += [i] * len(cut)
        found = np.zeros(len(parts), np.int64)
        for first, b in words.batches(parts, self.classes, BATCH_CHARS):
            starts, ends = pretoken_spans(b)
            if starts.size:
                distinct, at = b.distinct(starts, ends)
                n = self.pretokens(distinct.cast(pa.string()).to_pylist())[at]
                found[first : first + b.count] = np.bincount(b.text_of(starts), n, b.count)
        return extra + np.bincount(np.array(owner, np.int64), found, len(texts)).astype(np.int64)


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", n_bytes: str = "n_bytes", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` without its text, with the bytes and tokens of every whole text."""
    shared = df.sparkSession.sparkContext.broadcast((vocabulary, words.newer_characters()))
    keep = [c for c in df.columns if c not in (text, n_bytes, n_tokens)]

    def make():
        counter = Counter(*shared.value)

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = texts_of(part.column(text))
            sizes = np.fromiter((len(t.encode("utf-8", "replace")) for t in texts), np.int64, len(texts))
            yield with_columns(part, {n_bytes: pa.array(sizes), n_tokens: pa.array(counter.counts(texts))}, keep)

        return step

    kept = df.select(*keep, text)
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text]
    return map_batches(kept, make, ", ".join([*columns, f"`{n_bytes}` bigint", f"`{n_tokens}` bigint"]))
