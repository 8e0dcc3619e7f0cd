"""Entity resolution: name matching, review suggestions and mapping coverage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed import ALIAS_NOTE, ALIAS_SCORE, ALIASES, FUZZY_NOTE, HIGH, MEDIUM
from casemill.functions.columns import ratio
from casemill.functions.text import normalize_company_name
from casemill.operators.metrics import top_n
from casemill.sources.entity_seed import confidence


def company_counts(complaints: DataFrame) -> DataFrame:
    """Complaints per non-null company name."""
    return complaints.filter(F.col("company").isNotNull()).groupBy(F.col("company").alias("cfpb_company_name")) \
        .agg(F.count(F.lit(1)).alias("complaints"))


def _name_keys(seed: DataFrame) -> DataFrame:
    return seed.select(F.lower("cfpb_company_name").alias("name_key")).filter(F.col("name_key").isNotNull()).distinct()


def unmapped_companies(companies: DataFrame, seed: DataFrame, n: int = 200) -> DataFrame:
    """The n largest companies whose name is not in the seed map, ignoring case."""
    keyed = companies.withColumn("name_key", F.lower("cfpb_company_name"))
    rest = keyed.join(_name_keys(seed), "name_key", "left_anti").drop("name_key")
    return top_n(rest, "complaints", "cfpb_company_name", n=n)


def mapped_companies(companies: DataFrame, seed: DataFrame) -> DataFrame:
    keyed = companies.withColumn("name_key", F.lower("cfpb_company_name"))
    return keyed.join(_name_keys(seed), "name_key", "left_semi").drop("name_key")


def alias_target(normalized: Column, aliases: dict[str, str] = ALIASES, whole_words: bool = True) -> Column:
    """Canonical name of the first alias found in the normalised name, as whole words unless they may be parts of longer ones; else null."""
    text = F.concat(F.lit(" "), normalized, F.lit(" ")) if whole_words else normalized
    return F.coalesce(*[F.when(text.contains(f" {a} " if whole_words else a), F.lit(target)) for a, target in aliases.items()])


def with_order(seed: DataFrame) -> DataFrame:
    """Tie-break column ``tie``: the position in the seed file where it is known, else the canonical name."""
    if "seed_order" in seed.columns:
        return seed.withColumn("tie", F.lpad(F.col("seed_order").cast("string"), 20, "0"))
    return seed.withColumn("tie", F.col("canonical_company_name"))


def canonical_names(seed: DataFrame) -> DataFrame:
    """Distinct canonical names with their normalised form and first position."""
    return with_order(seed).filter(F.col("canonical_company_name").isNotNull()).groupBy("canonical_company_name") \
        .agg(F.min("tie").alias("tie")) \
        .withColumn("normalized", normalize_company_name(F.col("canonical_company_name")))


class NameIndex:
    """Names of a batch with their letter counts and letters, which bound the similarity with a query from above.

    The ratio is twice the matched letters over all letters. Matched letters stand in both names, so the common letter counts bound them; and they stand
    in the same order, so the longest common subsequence bounds them more closely. Both bounds are taken for many names at once. Names are compared in order of
    falling bound until no bound reaches the best ratio, so the result is that of comparing all.
    """

    CHUNK = 256

    def __init__(self, names: list[str]):
        self.names = names
        self.lengths = np.array([len(n) for n in names], np.int64)
        points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), "<u4")
        self.letters, self.codes = np.unique(points, return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.counts = np.zeros((len(names), self.letters.size), np.int32)
        np.add.at(self.counts, (np.repeat(np.arange(len(names)), self.lengths), self.codes), 1)
        self.compared = 0

    def ratios(self, matched: np.ndarray, length: int, lengths: np.ndarray) -> np.ndarray:
        total = lengths + length
        return np.where(total > 0, 2.0 * matched / np.maximum(total, 1), 1.0)

    def letter_bounds(self, query: str) -> np.ndarray:
        counts = np.zeros(self.letters.size, np.int32)
        points, n = np.unique(np.frombuffer(query.encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)
        known = np.isin(points, self.letters)
        counts[np.searchsorted(self.letters, points[known])] = n[known]
        return self.ratios(np.minimum(self.counts, counts).sum(axis=1), len(query), self.lengths)

    def order_bounds(self, query: str, rows: np.ndarray) -> np.ndarray:
        """By the length of the longest common subsequence: one machine word holds the query's letters, one step takes a letter of every name. Longer
        queries keep the bound by letters."""
        if not 0 < len(query) <= 64:
            return np.full(rows.size, np.inf)
        places = np.zeros(self.letters.size + 1, np.uint64)  # the last entry stands for "no letter"
        for k, letter in enumerate(query):
            at = np.searchsorted(self.letters, ord(letter))
            if at < self.letters.size and self.letters[at] == ord(letter):
                places[at] |= np.uint64(1 << k)
        open_ = np.full(rows.size, np.uint64(0xFFFFFFFFFFFFFFFF))
        starts, lengths = self.starts[rows], self.lengths[rows]
        for p in range(int(lengths.max(initial=0))):
            letter = np.where(p < lengths, self.codes[np.minimum(starts + p, max(self.codes.size - 1, 0))] if self.codes.size else 0, self.letters.size)
            hit = open_ & places[letter]
            open_ = (open_ + hit) | (open_ - hit)
        used = ~open_ & np.uint64((1 << len(query)) - 1)
        return self.ratios(np.bitwise_count(used).astype(np.int64), len(query), lengths)

    def best(self, query: str, floor: float = -1.0) -> tuple[float, int]:
        """Highest ``SequenceMatcher`` ratio of the query against the names, and the first position that reaches it; (-1, -1) if none reaches ``floor``."""
        score, at = -1.0, -1
        bounds = self.letter_bounds(query)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] >= floor]
        matcher = SequenceMatcher(None, query, autojunk=True)
        for first in range(0, order.size, self.CHUNK):
            rows = order[first:first + self.CHUNK]
            if bounds[rows[0]] < score:
                break
            closer = np.minimum(bounds[rows], self.order_bounds(query, rows))
            for k in np.argsort(-closer, kind="stable"):
                if closer[k] < max(score, floor):
                    break
                row = int(rows[k])
                matcher.set_seq2(self.names[row])
                found = matcher.ratio()
                self.compared += 1
                if found >= floor and (found > score or found == score and row < at):
                    score, at = found, row
        return score, at


def _partial_best(queries: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The best canonical name of a task for every candidate, not every pair."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, tuple] = {}
        for batch in batches:
            batch = batch.sort_values("tie", kind="stable")
            index = NameIndex(batch["normalized"].tolist())
            for query in queries:
                before = found.get(query, (-1.0, "", ""))
                score, at = index.best(query, before[0])
                if at >= 0 and (score > before[0] or batch["tie"].iloc[at] < before[1]):
                    found[query] = (score, batch["tie"].iloc[at], batch["canonical_company_name"].iloc[at])
        if found:
            yield pd.DataFrame([(q, *f) for q, f in found.items()], columns=["query", "match_score", "tie", "canonical_company_name"])

    return best


def fuzzy_best(candidates: DataFrame, seed: DataFrame) -> DataFrame:
    """``(query, canonical_company_name, match_score)``: the most similar canonical name of each candidate.

    ``candidates`` is the review list, whose length is a parameter of the report: its names go to every task once, with the task's code. A task
    looks them up in an index of its own canonical names and returns one row per candidate, so no pair is ever materialised and the final step
    reduces (tasks x candidates) rows. The first canonical name in seed order wins ties.
    """
    queries = sorted(r["normalized"] for r in candidates.select("normalized").where("normalized IS NOT NULL").distinct().collect())
    # Few names come in few parts: they are spread over the cores. Many stay where the grouping by name has put them.
    names = canonical_names(seed).repartition("canonical_company_name")
    partial = names.mapInPandas(
        _partial_best(queries), "query string, match_score double, tie string, canonical_company_name string"
    )
    best = F.min_by(F.struct("canonical_company_name", "match_score"), F.struct(-F.col("match_score"), F.col("tie")))
    return partial.groupBy("query").agg(best.alias("b")).select("query", "b.*")


def review_table(companies: DataFrame, seed: DataFrame, n: int = 200, aliases: dict[str, str] = ALIASES, whole_words: bool = True) -> DataFrame:
    """Suggestions for the n largest unmapped companies: a seeded alias first, else the closest canonical name.

    Both kinds always need review.
    """
    open_names = unmapped_companies(companies, seed, n).withColumn(
        "normalized", normalize_company_name(F.col("cfpb_company_name"))
    ).withColumn("target", alias_target(F.col("normalized"), aliases, whole_words))
    registrants = with_order(seed).groupBy(F.col("canonical_company_name").alias("target")).agg(
        F.min_by(F.struct("sec_cik", "ticker"), F.struct("tie", "sec_cik")).alias("registrant"), F.lit(True).alias("seeded")
    )
    matched = open_names.join(registrants, "target", "left")
    by_alias = F.col("seeded").isNotNull()
    fuzzy = fuzzy_best(matched.filter(~by_alias), seed)
    scored = matched.join(fuzzy, F.when(~by_alias, F.col("normalized")) == F.col("query"), "left")
    score = F.when(by_alias, F.lit(ALIAS_SCORE)).otherwise(F.coalesce("match_score", F.lit(0.0)))
    return scored.select(
        "cfpb_company_name", "complaints",
        F.when(by_alias, F.col("target")).otherwise(F.coalesce("canonical_company_name", F.lit("")))
        .alias("suggested_canonical_company_name"),
        F.col("registrant.sec_cik").alias("suggested_sec_cik"), F.col("registrant.ticker").alias("suggested_ticker"),
        F.when(by_alias, "alias_suggestion").otherwise("fuzzy_suggestion").alias("match_method"),
        score.alias("match_score"),
        F.when(by_alias, F.lit(MEDIUM))
        .otherwise(confidence(score, F.lit("fuzzy_suggestion"))["confidence_tier"]).alias("confidence_tier"),
        F.lit(True).alias("manual_review_required"),
        F.when(by_alias, ALIAS_NOTE).otherwise(FUZZY_NOTE).alias("notes"),
    )


def mapping_coverage(companies: DataFrame, seed: DataFrame) -> DataFrame:
    """One row of seed tier counts and of coverage by distinct company and by complaint volume."""
    tiers = seed.groupBy(F.lower("cfpb_company_name").alias("name_key")).agg(
        F.bool_or(F.col("confidence_tier") == HIGH).alias("high"), F.lit(True).alias("mapped")
    )
    keyed = companies.withColumn("name_key", F.lower("cfpb_company_name")).join(tiers, "name_key", "left")
    mapped, volume = F.coalesce("mapped", F.lit(False)), F.col("complaints")

    def share_of(flag: Column, amount: Column) -> Column:
        return F.coalesce(ratio(F.sum(F.when(flag, amount).otherwise(0)), F.sum(amount)), F.lit(0.0))

    seeds = seed.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("confidence_tier") == HIGH).alias("high"),
        F.count_if(F.col("confidence_tier").startswith("MEDIUM")).alias("medium"),
    )).scalar()
    return keyed.agg(
        F.count(F.lit(1)).alias("distinct_companies"),
        share_of(mapped, F.lit(1)).alias("coverage_by_company"), share_of(mapped, volume).alias("coverage_by_volume"),
        share_of(F.coalesce("high", F.lit(False)), volume).alias("high_confidence_coverage_by_volume"),
    ).withColumn("s", seeds).select(
        "distinct_companies", F.col("s.n").alias("seed_mappings"), F.col("s.high").alias("high_confidence_mappings"),
        F.col("s.medium").alias("medium_review_mappings"), "coverage_by_company", "coverage_by_volume",
        "high_confidence_coverage_by_volume",
    )
