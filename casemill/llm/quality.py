"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network with a calibrated temperature.

Every word is hashed to a bucket with a fixed sparse random vector of +1 and -1. The vector of a word is the normalised sum of the random vectors of the words
around it in all documents, labelled or not, summed in a pass over them. A document is the mean vector of its words with a few shares of its form (distinct words, capitals, signs, repeats).
The network is fitted on at most ``TRAIN_ROWS`` labelled rows of known documents, the ones with the smallest hash of their id; a further ``CALIBRATE_ROWS`` at most
set the temperature that makes its probabilities fit the labels. Only texts enter a score. All documents are scored, whole.

Null and empty texts are documents without words and get the network's score of such. Rows keep all their columns; nulls elsewhere play no
part. Labels other than 0 and 1 and labels of unknown documents are left out; repeated labels of a document count as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm import words
from casemill.llm.arrow import ROWS, list_array, map_batches, ragged, texts_of, with_columns
from casemill.llm.counts import pretoken_spans
from casemill.session import materialize_plain as materialize

TRAIN_ROWS = 6_000
CALIBRATE_ROWS = 2_000
BUCKETS = 1 << 15
WIDTH = 64
WINDOW = 2
HIDDEN = 32
FORM = 9
BATCH_CHARS = 250_000
REDUCE = np.int32  # sums of a few thousand small numbers
CONTEXT_WORDS = 8_192  # words whose contexts are held at a time


class Tokens:
    """Words of texts as hashes, with the text each belongs to and the shares of form."""

    def __init__(self) -> None:
        self.hash, self.classes = words.Hasher(), words.class_table()
        points = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
        self.upper = np.zeros(0x10000, bool)
        self.upper[[ord(c) for c in points if c.isupper()]] = True

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first text, number of texts, word hashes, their texts, form) of consecutive texts."""
        for first, b, hashes, of, lengths in self.hashed(texts):
            yield first, b.count, hashes, of, self.form(b, hashes, of, lengths)

    def hashed(self, texts: list[str]) -> Iterator[tuple[int, words.Batch, np.ndarray, np.ndarray, np.ndarray]]:
        """(first text, batch, word hashes, their texts, word lengths) of consecutive texts, without their form."""
        for first, b in words.batches(texts, self.classes, BATCH_CHARS):
            starts, ends = pretoken_spans(b)
            hashes = self.hash(b.points, starts, ends) if starts.size else np.zeros(0, np.uint64)
            yield first, b, hashes, b.text_of(starts), ends - starts

    def form(self, b: words.Batch, hashes: np.ndarray, of: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n = np.bincount(of, minlength=b.count)
        some = np.maximum(n, 1)
        order = np.lexsort((hashes, of))
        fresh = np.ones(order.size, bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
        again = np.zeros(of.size, bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        chars = np.maximum(b.ends - b.starts, 1)
        text = np.repeat(np.arange(b.count), b.ends - b.starts + 1)

        def share(mask: np.ndarray) -> np.ndarray:
            return np.bincount(text[mask], minlength=b.count) / chars

        letters = share(b.classes == words.LETTER)
        upper = share(self.upper[np.minimum(b.points, 0xFFFF)])
        return np.column_stack([
            np.bincount(of[order][fresh], minlength=b.count) / some, np.bincount(of[again], minlength=b.count) / some,
            letters, upper, share(b.classes == words.NUMBER), share(b.classes == words.OTHER), np.bincount(of, lengths, b.count) / some,
            np.log1p(n), share(b.points == 10)]).astype(np.float32)


def index_vectors(seed: int = 3) -> np.ndarray:
    """A sparse random vector of each bucket."""
    draw = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    for _ in range(4):
        out[np.arange(BUCKETS), draw.integers(0, WIDTH, BUCKETS)] += draw.choice([-1, 1], BUCKETS)
    return out


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.mean) / self.spread @ w1 + b1) @ w2 + b2[0]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -40, 40)))


def features(tokens: Tokens, vectors: np.ndarray, texts: list[str]) -> np.ndarray:
    parts = [np.zeros((0, WIDTH + FORM), np.float32)]
    for _, n, hashes, of, form in tokens(texts):
        pooled = np.zeros((n, WIDTH), np.float32)
        if of.size:
            heads = np.flatnonzero(np.diff(of, prepend=-1))
            ends, at, first = np.append(heads[1:], of.size), buckets(hashes), 0
            while first < heads.size:  # texts of a few thousand words at a time
                last = max(first + 1, int(np.searchsorted(ends, heads[first] + CONTEXT_WORDS, side="right")))
                some, begin = slice(first, last), heads[first]
                pooled[of[heads[some]]] = np.add.reduceat(vectors[at[begin : ends[last - 1]]], heads[some] - begin, axis=0) / (ends[some] - heads[some])[:, None]
                first = last
        parts.append(np.hstack([pooled, form]))
    return np.concatenate(parts)


def add_contexts(total: np.ndarray, index: np.ndarray, tokens: Tokens, texts: list[str]) -> None:
    """Add the random vectors around every word of the texts to its bucket's row. All numbers are whole, so sums are exact in any order."""
    for _, _, hashes, of, _ in tokens.hashed(texts):
        if not of.size:
            continue
        # Texts lie one after the other with places without a word around them, so windows need no other care.
        own = np.arange(of.size) + WINDOW * (1 + np.cumsum(np.diff(of, prepend=of[0]) > 0))
        at = np.full(own[-1] + 1 + WINDOW, BUCKETS)
        at[own] = buckets(hashes)
        for first in range(0, of.size, CONTEXT_WORDS):
            here = own[first : first + CONTEXT_WORDS]
            begin = here[0] - WINDOW
            rows = index[at[begin : here[-1] + WINDOW + 1]]
            n = len(rows) - 2 * WINDOW
            around = sum((rows[k : k + n] for k in range(2 * WINDOW + 1) if k not in (0, WINDOW)), rows[:n])
            word = at[here]
            order = np.argsort(word.astype(np.uint16), kind="stable")
            heads = np.flatnonzero(np.diff(word[order], prepend=-1))
            total[word[order[heads]]] += np.add.reduceat(around[(here - here[0])[order]], heads, axis=0, dtype=REDUCE)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The vector of every bucket from all documents. A task sends one row per bucket it met; the driver gets BUCKETS rows at most."""
    names = [f"c{k}" for k in range(WIDTH)]

    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = np.vstack([index_vectors(), np.zeros((1, WIDTH), np.float32)]).astype(np.int8)  # a window's sum has at most 16; the last row stands for "no word"
        tokens, total = Tokens(), np.zeros((BUCKETS, WIDTH), np.int64)
        for part in parts:
            for first in range(0, part.num_rows, ROWS):
                add_contexts(total, index, tokens, texts_of(part.column(0).slice(first, ROWS)))
        met = np.flatnonzero(total.any(axis=1))
        for first in range(0, met.size, 4096):
            some = met[first : first + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(total[some, k]) for k in range(WIDTH))], names=["bucket", *names])

    sums = (docs.select(text).mapInArrow(partial, ", ".join(f"{n} bigint" for n in ["bucket", *names]))
            .groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names))).toArrow()
    total = np.zeros((BUCKETS, WIDTH), np.float32)
    at = sums["bucket"].to_numpy()
    for k, name in enumerate(names):
        total[at, k] = sums[name].to_numpy()
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    return total


def fit_network(x: np.ndarray, y: np.ndarray, steps: int = 1500, seed: int = 5, rate: float = 0.01, decay: float = 1e-4) -> list[np.ndarray]:
    """Adam on the mean log loss, in random batches."""
    draw = np.random.default_rng(seed)
    layers = [draw.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), draw.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for step in range(1, steps + 1):
        rows = draw.integers(0, len(y), min(256, len(y)))
        a, target = x[rows], y[rows]
        hidden = np.tanh(a @ layers[0] + layers[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3][0], -40, 40))) - target) / len(rows)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        slopes = [a.T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
        now = rate * (1 - step / (steps + 1))
        for k, slope in enumerate(slopes):
            slope = slope + decay * layers[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            layers[k] = layers[k] - now * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of logits with the smallest log loss, on a geometric grid."""
    grid = np.geomspace(0.25, 8, 61)
    losses = [np.mean(np.logaddexp(0, np.where(y > 0, -logits, logits) / t)) for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit_features(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, y_calibrate: np.ndarray) -> Model:
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    model = Model(vectors, mean, spread, fit_network((x - mean) / spread, y))
    if len(calibrate):
        model.temperature = fit_temperature(model.logits(calibrate), y_calibrate)
    return model


def held_out(doc_id: str = "doc_id") -> F.Column:
    """The fold that is never learned from; a null id reads as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """A model of at most ``TRAIN_ROWS`` labelled rows with word vectors of all documents; None without labelled rows of both kinds.

    Labels of absent documents are left out before the sample is taken. Of rows that share a labelled id the text with the smallest digest is learned from.
    The sampled texts are turned into features where they lie, so the driver gets a row of numbers for each.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("y")).where("y IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    ids = materialize(known.join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(TRAIN_ROWS + CALIBRATE_ROWS), "sample")
    kinds = ids.groupBy("doc_id").agg(F.sum("y").cast("long").alias("ones"), F.count("y").alias("n"))  # at most as many rows as the limit
    if len(ids.select("y").distinct().take(2)) < 2:
        return None
    vectors = word_vectors(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def make():
        tokens = Tokens()

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            x = features(tokens, shared.value, texts_of(part.column(1))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), list_array(x.ravel(), ragged(np.full(len(x), WIDTH + FORM)), pa.float64())],
                                             names=["doc_id", "ones", "n", "x"])

        return step

    one_text = rows.join(F.broadcast(kinds), "doc_id").groupBy("doc_id").agg(
        F.min_by("text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("text"), F.first("ones").alias("ones"), F.first("n").alias("n"))
    kind = docs.schema[doc_id].dataType.simpleString()
    found = map_batches(one_text, make, f"doc_id {kind}, ones bigint, n bigint, x array<double>").orderBy(F.xxhash64(F.lit("fit"), "doc_id")).toArrow()
    shared.destroy()
    # A label counts as often as it comes.
    n, ones = found["n"].to_numpy(), found["ones"].to_numpy()
    x = np.repeat(np.array(found["x"].to_pylist()).reshape(n.size, WIDTH + FORM), n, axis=0)
    y = np.concatenate([np.repeat([1.0, 0.0], [a, b]) for a, b in zip(ones.tolist(), (n - ones).tolist(), strict=True)])
    cut = len(y) * TRAIN_ROWS // (TRAIN_ROWS + CALIBRATE_ROWS)
    return fit_features(vectors, x[:cut], y[:cut], x[cut:], y[cut:])


def score(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` with the score of every whole text, without the text unless it is kept. Without a model every score is 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)  # a few megabytes: its size follows from BUCKETS and WIDTH
    keep = [c for c in docs.columns if c != name and (keep_text or c != text)]
    used = docs.select(*dict.fromkeys([*keep, text]))

    def make():
        tokens, known = Tokens(), Model(**shared.value) if shared.value else None

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = texts_of(part.column(text))
            scores = known.scores(features(tokens, known.vectors, texts)) if known else np.full(len(texts), 0.5)
            yield with_columns(part, {name: pa.array(scores, pa.float64())}, keep)

        return step

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in used.schema if f.name in keep]
    return map_batches(used, make, ", ".join([*fields, f"`{name}` double"]))
