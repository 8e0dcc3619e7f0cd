"""Byte-level BPE: encode texts to token ids through a table of distinct words, decode ids through a table of pieces.

Words are cut in the tasks that read the texts. Each task keeps a table of the distinct words it has met: a word is encoded once, and ids come
back to the words' positions by an index into that table. Decoding looks every id up in the id-to-piece table, whose size is the
vocabulary's. The texts are never shuffled: a table of all words joined by position moves more than the texts themselves (README).

Null texts count as empty and give an empty list. Columns of the input with the names of the new ones are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from casemill.llm import words
from casemill.llm.arrow import gather, list_array, map_batches, ragged, texts_of, with_columns

# The pre-tokeniser's pattern (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TABLE_WORDS = 200_000
BATCH_CHARS = 1_000_000


def read_vocabulary(path: str) -> str:
    """The tokenizer file, read on the driver and sent to the tasks: a few megabytes, whatever the input."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_chars() -> dict[str, int]:
    """The byte each character of a byte-level piece stands for: printable bytes stand for themselves, the others follow from 256."""
    plain = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
    rest = [b for b in range(256) if b not in plain]
    return {c: b for b, c in (plain | {b: chr(256 + k) for k, b in enumerate(rest)}).items()}


def pieces_of(vocabulary: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Pieces with their ids, and the special tokens with theirs."""
    spec, of = json.loads(vocabulary), byte_chars()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {bytes(of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}, special


def encoding(vocabulary: str) -> tiktoken.Encoding:
    ranks, special = pieces_of(vocabulary)
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


class WordTable:
    """Distinct words of a task with their ids: rows of one flat array. It starts anew when it holds ``TABLE_WORDS`` words."""

    def __init__(self, vocabulary: str):
        self.encode = encoding(vocabulary)
        self.special = list(self.encode.special_tokens_set)
        self.classes = words.class_table()
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def rows_of(self, found: list[str]) -> np.ndarray:
        new = [w for w in found if w not in self.rows]
        if new:
            if len(self.rows) + len(new) > TABLE_WORDS and self.rows:
                self.clear()
                new = found
            ids = [self.encode.encode_ordinary(w) for w in new]
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.int32, int(lengths.sum()))])
        return np.fromiter((self.rows[w] for w in found), np.int64, len(found))

    def batch_ids(self, batch: words.Batch) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of the batch in one array, and how many each text has."""
        starts, ends = words.spaced_words(batch)
        if not starts.size:
            return np.zeros(0, np.int32), np.zeros(batch.count, np.int64)
        found, at = batch.distinct(starts, ends)
        rows = self.rows_of(found.cast(pa.string()).to_pylist())[at]
        lengths = self.offsets[rows + 1] - self.offsets[rows]
        counts = np.bincount(batch.text_of(starts), lengths, batch.count).astype(np.int64)
        return self.flat[gather(self.offsets[rows], lengths)], counts

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, and how many each has. Texts with a special token's string go through the library as a whole."""
        odd = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        parts, counts = [], np.zeros(len(texts), np.int64)
        for first, batch in words.batches(["" if i in odd else t for i, t in enumerate(texts)], self.classes, BATCH_CHARS):
            ids, n = self.batch_ids(batch)
            parts.append(ids)
            counts[first : first + batch.count] = n
        flat = np.concatenate([*parts, np.zeros(0, np.int32)])
        if odd:
            rows = np.split(flat, np.cumsum(counts)[:-1])
            for i in odd:
                rows[i] = np.array(self.encode.encode(texts[i], allowed_special="all"), np.int32)
                counts[i] = rows[i].size
            flat = np.concatenate(rows)
        return flat, counts


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` without its text, with the token ids (array of int) of every whole text."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    keep = [c for c in df.columns if c not in (text, ids)]

    def make():
        table = WordTable(shared.value)

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            flat, counts = table.ids(texts_of(part.column(text)))
            yield with_columns(part, {ids: list_array(flat, ragged(counts), pa.int32())}, keep)

        return step

    kept = df.select(*keep, text)
    return map_batches(kept, make, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text), f"`{ids}` array<int>"]))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids; bytes that are no UTF-8 become U+FFFD. Null ids give an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    keep = [c for c in df.columns if c != text]

    def make():
        ranks, special = pieces_of(shared.value)
        by_id = {i: p for p, i in ranks.items()} | {i: s.encode() for s, i in special.items()}
        pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        data, at = np.frombuffer(b"".join(pieces), np.uint8), ragged(np.fromiter(map(len, pieces), np.int64, len(pieces)))

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            column = part.column(ids)
            counts = np.fromiter(column.value_lengths().fill_null(0), np.int64, part.num_rows) if part.num_rows else np.zeros(0, np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = at[flat + 1] - at[flat]
            joined = data[gather(at[flat], lengths)].tobytes()
            cuts = ragged(lengths)[ragged(counts)].tolist()
            yield with_columns(part, {text: pa.array([joined[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)], pa.string())}, keep)

        return step

    kept = df.select(*keep)
    return map_batches(kept, make, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"`{text}` string"]))
