"""Text cleaning, tokens and n-grams as JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed import ENGLISH_STOP_WORDS, LEGAL_SUFFIXES, REDACTION_PATTERN, TOKEN_PATTERN
from casemill.functions.columns import WIDE_SPACES, has_wide_space


def clean_text(col: Column) -> Column:
    """Redaction marks and runs of white space become one blank; null becomes the empty string.

    The redaction pattern runs only on text with two x in a row and the one for wide white space only on text that
    has some. Both are decided on the input column, so that no step is evaluated twice.
    """
    text = F.coalesce(col, F.lit(""))
    unmasked = F.when(F.lower(text).contains("xx"), F.regexp_replace(text, f"(?iU){REDACTION_PATTERN}", " ")).otherwise(text)
    narrow = F.trim(F.regexp_replace(unmasked, r"\s+", " "))
    wide = F.trim(F.regexp_replace(unmasked, f"[\\s{WIDE_SPACES}]+", " "))
    return F.when(has_wide_space(text), wide).otherwise(narrow)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is read from few parts, such as a single small file; else as it is, so that texts are not shuffled.

    Only a plan without exchanges is asked for its parts, as others would run to answer.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "AdaptiveSparkPlan" in df._jdf.queryExecution().executedPlan().nodeName():
        return df
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df


def narratives(df: DataFrame, min_chars: int = 80, text: str = "consumer_complaint_narrative") -> DataFrame:
    """Add ``clean_narrative`` and keep rows whose cleaned text is long enough.

    The text goes through a one-element explode, which keeps the optimiser from pushing the length filter below it and cleaning every text twice.
    """
    cleaned = spread(df).select("*", F.explode(F.array(clean_text(F.col(text)))).alias("clean_narrative"))
    return cleaned.filter(F.length("clean_narrative") >= min_chars)


def tokens(col: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower-case words of two or more characters in text order, without stop words."""
    words = F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(list(stop_words))) if stop_words else words


def with_bigrams(words: Column) -> Column:
    """Words followed by the pairs of neighbouring words.

    The array is bound to a lambda variable first; otherwise each of its uses would split the text again.
    """
    def add_pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.concat(w, F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))

    return F.element_at(F.transform(F.array(words), add_pairs), 1)


def normalize_company_name(col: Column) -> Column:
    """Lower case, ``&`` spelled out, punctuation and legal suffixes removed."""
    spelled = F.regexp_replace(F.lower(col), "&", " and ")
    words = F.split(F.regexp_replace(spelled, "[^a-z0-9 ]+", " "), " +")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(LEGAL_SUFFIXES)), " ")
