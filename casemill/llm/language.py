"""Language of texts by fusing evidence: posterior ~ text x declared language x address suffix x prior of the host.

* Text: log probabilities of hashed byte trigrams of each language, counted over all rows with a known language, with or without id. A text counts as at most ``STRENGTH`` independent trigrams, as its trigrams are not independent. A uniform distribution competes as
  "unknown".
* Declared: the lang attribute of markup; right with probability ``DECLARED``.
* Suffix: country suffixes of the address speak for a language with probability ``SUFFIX``; others say nothing.
* Host: shares of languages among the host's other rows, smoothed towards those of its suffix, which are smoothed towards those of all rows. Each row
  votes for the language its text and declaration make likeliest; votes are counted by grouped aggregation over all rows.

A row is rejected (language "und") if it has no letters, if "unknown" beats every language, or if the best posterior is under ``LEAST``. Null or empty
texts have no letters. Null evidence says nothing; rows without host share the prior of their suffix. Repeated ids are judged row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.arrow import list_array, map_batches, ragged
from casemill.session import materialize_plain as materialize

BUCKETS = 1 << 16
STRENGTH = 40.0
DECLARED, SUFFIX, LEAST = 0.9, 0.7, 0.5
SMOOTH = 5.0
# Country suffixes and the language they speak for (fixed values).
COUNTRIES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "ie": "en", "au": "en", "nz": "en", "it": "it", "pt": "pt",
             "br": "pt", "nl": "nl", "pl": "pl", "se": "sv", "ru": "ru", "jp": "ja", "kr": "ko"}
LANG_ATTRIBUTE = r"""(?i)<html[^>]*\slang\s*=\s*["']?([a-z]{2,3})"""
MARKUP = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]+>"


def fold_table() -> np.ndarray:
    """Bytes folded to lower case; those of no letter become 0."""
    out = np.zeros(256, np.uint32)
    out[128:] = np.arange(128, 256)
    for c in range(ord("a"), ord("z") + 1):
        out[c] = out[c - 32] = c
    return out


class Trigrams:
    """Hashed byte trigrams with a letter, of Arrow text columns."""

    def __init__(self) -> None:
        self.fold = fold_table()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, the row of each)."""
        data = [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
        lengths = np.fromiter(map(len, data), np.int64, len(data)) + 3
        x = self.fold[np.frombuffer(b"\0" + b"".join(t + b"\0\0\0" for t in data), np.uint8)]
        rows = np.repeat(np.arange(len(data)), lengths)
        codes = (x[:-3] << np.uint32(16)) + (x[1:-2] << np.uint32(8)) + x[2:-1]
        rows = rows[: codes.size]
        live = codes > 0
        live[np.cumsum(lengths)[:-1] - 1] = False  # two bytes of padding and the next text's first letter
        codes = codes[live] * np.uint32(2654435761)
        return codes >> np.uint32(16), rows[live]


@dataclass
class TextModel:
    languages: list[str]
    logs: np.ndarray  # bucket x language, the last column is "unknown"


def fit(rows: DataFrame, row_id: str, text: str, lang: str) -> TextModel:
    """Trigram probabilities of every language that a row is known to have. A task sends its sums, the driver gets BUCKETS numbers a language."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, totals = Trigrams(), {}
        for part in parts:
            known = np.array(part.column(1).to_pylist(), object)
            for first in range(0, part.num_rows, 200):
                codes, row = trigrams(part.column(0).slice(first, 200))
                of = known[first : first + 200]
                for name in set(of):
                    total = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(codes[(of == name)[row]], minlength=BUCKETS)
        for name, total in totals.items():
            met = np.union1d(np.flatnonzero(total), [0])  # at least one, so that a language of empty texts is one too
            yield pa.RecordBatch.from_arrays([pa.array([name] * met.size, pa.string()), pa.array(met, pa.int64()), pa.array(total[met])], names=["lang", "bucket", "n"])

    labelled = rows.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    sums = labelled.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sums["lang"].combine_chunks().dictionary_encode()
    found = names.dictionary.to_pylist()
    languages = sorted(found)
    place = np.array([languages.index(x) for x in found], np.int64)[names.indices.to_numpy()]
    counts = np.ones((BUCKETS, len(languages)))
    counts[sums["bucket"].to_numpy(), place] += sums["n"].to_numpy()
    logs = np.log(counts / counts.sum(axis=0))
    return TextModel(languages, np.hstack([logs, np.full((BUCKETS, 1), 1 - np.log(BUCKETS))]).astype(np.float32))


def text_evidence(rows: DataFrame, model: TextModel, text: str = "text") -> DataFrame:
    """``rows`` without the text, with the number of trigrams and the mean log probability under each language and "unknown"."""
    shared = rows.sparkSession.sparkContext.broadcast(model.logs)  # BUCKETS x languages
    width = model.logs.shape[1]
    keep = [c for c in rows.columns if c != text]

    def make():
        trigrams, logs = Trigrams(), shared.value

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            column, first = part.column(text), 0
            sizes = np.fromiter((n or 0 for n in pc.binary_length(column).to_pylist()), np.int64, part.num_rows)
            while first < part.num_rows:
                last = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), 1_000_000)))
                last = min(last, part.num_rows)
                codes, row = trigrams(column.slice(first, last - first))
                n = np.bincount(row, minlength=last - first)
                sums = np.column_stack([np.bincount(row, logs[codes, k], last - first) for k in range(width)]) / np.maximum(n, 1)[:, None]
                piece = part.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in keep), pa.array(n), list_array(sums.ravel(), ragged(np.full(last - first, width)), pa.float64())],
                    names=[*keep, "trigrams", "logs"])
                first = last

        return step

    kept = rows.select(*keep, text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text]
    return map_batches(kept, make, ", ".join([*fields, "trigrams bigint", "logs array<double>"]))


def of_page(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Evidence columns of raw pages: visible text, declared language, host and suffix."""
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://([^/:?#\s]+)", 1))
    return pages.withColumns({
        "text": F.regexp_replace(html, MARKUP, " "), "declared": blank(F.lower(F.regexp_extract(html, LANG_ATTRIBUTE, 1))),
        "host": blank(host), "suffix": blank(F.regexp_extract(host, r"\.([a-z]+)$", 1))})


def of_document(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Evidence columns of plain documents: the source stands for the host; markup in the text may declare a language."""
    return docs.withColumns({"declared": blank(F.lower(F.regexp_extract(text, LANG_ATTRIBUTE, 1))), "host": F.col(source), "suffix": F.lit(None).cast("string")})


def blank(column: F.Column) -> F.Column:
    return F.when(column != "", column)


def argmax(column: str, names: list[str]) -> F.Column:
    return F.element_at(F.array(*map(F.lit, names)), F.array_position(F.col(column), F.array_max(column)).cast("int"))


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows`` (with text, declared, host and suffix) without the text, with language, posterior and accepted.

    The evidence is a written table of small rows: votes are counted over it, and the fusion reads it again.
    """
    names = [*model.languages, "und"]
    wide = range(len(names))

    def says(column: str, right: float, of: dict[str, str] | None = None) -> list[F.Column]:
        """Log probability of a statement about the language, for each language; statements about none of ours say nothing."""
        value = F.col(column) if of is None else F.create_map(*(F.lit(x) for kv in of.items() for x in kv))[F.coalesce(F.col(column), F.lit(""))]
        wrong = (1 - right) / max(1, len(names) - 2)
        return [F.when(value.isin(model.languages), F.when(value == n, F.lit(float(np.log(right)))).otherwise(float(np.log(wrong)))).otherwise(0.0) if n != "und"
                else F.when(value.isin(model.languages), float(np.log(wrong))).otherwise(0.0) for n in names]

    declared, suffix = says("declared", DECLARED), says("suffix", SUFFIX, COUNTRIES)
    scale = F.least(F.col("trigrams").cast("double"), F.lit(STRENGTH))
    seen = materialize(
        text_evidence(rows, model).withColumn("own", F.array(*(F.col("logs")[k] * scale + declared[k] + suffix[k] for k in wide))).withColumn("vote", argmax("own", names)), "evidence")
    votes = seen.where("trigrams > 0").groupBy("host", "suffix", "vote").agg(F.count("*").alias("n"))
    by_host = votes.groupBy("host", "suffix").agg(*(F.sum(F.when(F.col("vote") == n, F.col("n")).otherwise(0)).alias(f"h{k}") for k, n in enumerate(names)))
    by_suffix = by_host.groupBy("suffix").agg(*(F.sum(f"h{k}").alias(f"s{k}") for k in wide))
    total = by_suffix.agg(*(F.coalesce(F.sum(f"s{k}"), F.lit(0)) for k in wide)).first()
    overall = [(total[k] + 1) / (sum(total) + len(names)) for k in wide]
    prior = (by_host.where("host IS NOT NULL").alias("h").join(by_suffix.alias("s"), F.expr("h.suffix <=> s.suffix"))
             .select(F.col("h.host").alias("at_host"), F.col("h.suffix").alias("at_suffix"), F.array(*(F.col(f"h{k}") for k in wide)).alias("hosts"),
                     F.array(*(F.col(f"s{k}") for k in wide)).alias("suffixes")))
    # Written, so that Spark knows its size: a small one is broadcast, a large one joined with a hot host's rows split.
    joined = seen.join(materialize(prior, "priors"), F.expr("host = at_host AND suffix <=> at_suffix"), "left")
    zeros = F.array(*(F.lit(0).cast("long") for _ in wide))
    joined = joined.withColumn("hosts", F.coalesce("hosts", zeros)).withColumn("suffixes", F.coalesce("suffixes", zeros))

    def share(k: int) -> F.Column:
        """Smoothed share of a language at the host, without the row's own vote."""
        own = lambda c: F.greatest(F.col(c)[k] - F.when((F.col("trigrams") > 0) & (F.col("vote") == names[k]), 1).otherwise(0), F.lit(0))
        rest = lambda c: F.greatest(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) - F.when(F.col("trigrams") > 0, 1).otherwise(0), F.lit(0))
        middle = (own("suffixes") + SMOOTH * overall[k]) / (rest("suffixes") + SMOOTH)
        return (own("hosts") + SMOOTH * middle) / (rest("hosts") + SMOOTH)

    fused = joined.withColumn("fused", F.array(*(F.col("own")[k] + F.log(share(k)) for k in wide)))
    weight = F.aggregate(F.transform("fused", lambda x: F.exp(x - F.array_max("fused"))), F.lit(0.0), lambda a, x: a + x)
    fused = fused.withColumn("posterior", F.round(1 / weight, 6)).withColumn("best", argmax("fused", names))
    accepted = (F.col("trigrams") > 0) & (F.col("best") != "und") & (F.col("posterior") >= LEAST)
    keep = [c for c in rows.columns if c not in ("text", "suffix", "html")]
    return fused.withColumn("accepted", accepted).withColumn("language", F.when(F.col("accepted"), F.col("best")).otherwise("und")).select(*keep, "language", "posterior", "accepted")
