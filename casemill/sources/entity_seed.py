"""Seed map of company names to registrants, as CSV or with unquoted commas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.fixed import HIGH, HIGH_SCORE, LOW, MANUAL_HIGH_SCORE, MEDIUM, MEDIUM_SCORE, SEED_COLUMNS, SEED_RENAMES
from casemill.functions.columns import strip

# A comma that is not inside quotes.
SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
# A line with stray commas: text before the first ten-digit number, the number, four plain fields, notes.
RAGGED_LINE = r"^(.*?),(\d{10}),([^,]*),([^,]*),([^,]*),([^,]*),(.*)$"


def unquoted(field: Column) -> Column:
    """Content of a CSV field; empty is null."""
    inner = F.regexp_replace(F.regexp_extract(field, r'^\s*"(.*)"\s*$', 1), '""', '"')
    return F.nullif(F.when(field.rlike(r'^\s*".*"\s*$'), inner).otherwise(field), F.lit(""))


def numbered_fields(lines: DataFrame) -> DataFrame:
    """Lines with their number, their fields as regular CSV, and their form: ``regular``, ``ragged``, ``header`` or null for a line of none."""
    fields = F.split("value", SEPARATOR, -1)
    number = F.regexp_replace(F.element_at("fields", 3), '"', "")
    # element_at fails on short lines in ANSI mode, so the size is tested first.
    regular = F.when(F.size("fields") == 8, number.rlike(r"^\s*\d*(\.0)?\s*$")).otherwise(False)
    ragged = F.col("value").rlike(RAGGED_LINE) & F.regexp_extract("value", RAGGED_LINE, 1).contains(",")
    header = F.coalesce(unquoted(F.get("fields", F.lit(0))) == SEED_COLUMNS[0], F.lit(False))
    form = F.when(header, "header").when(regular, "regular").when(ragged, "ragged")
    return lines.withColumn("seed_order", F.monotonically_increasing_id()).withColumn("fields", fields).withColumn("form", form)


def seed_errors(lines: DataFrame) -> DataFrame:
    """``(seed_order, value)`` of the lines of neither form, which the seed map leaves out; blank lines are no errors."""
    return numbered_fields(lines).where(F.col("form").isNull() & (F.trim("value") != "")).select("seed_order", "value")


def parse_seed_lines(lines: DataFrame) -> DataFrame:
    """The eight fields of every line of ``value``.

    A line is regular CSV if it has eight fields and its third is a number or empty; numbers need no padding there. Any other line is
    taken apart around its first ten-digit number, with the comma before the canonical name as the last one on the left. The header is skipped; lines
    of neither form are left to :func:`seed_errors`.
    """
    left = F.regexp_extract("value", RAGGED_LINE, 1)
    names = [F.regexp_extract(left, "^(.*),([^,]*)$", i) for i in (1, 2)]
    ragged = [*names, *(F.regexp_extract("value", RAGGED_LINE, i) for i in range(2, 8))]
    regular = F.col("form") == "regular"
    return numbered_fields(lines).where(F.col("form").isin("regular", "ragged")).select("seed_order", *[
        F.when(regular, unquoted(F.get("fields", F.lit(i)))).otherwise(F.nullif(ragged[i], F.lit(""))).alias(c) for i, c in enumerate(SEED_COLUMNS)])


def read_seed_map(spark: SparkSession, path: str) -> DataFrame:
    return parse_seed_lines(spark.read.text(path))


def confidence(score: Column, method: Column) -> Column:
    """Struct of confidence tier and review flag for a match score."""
    manual = F.coalesce(method.startswith("manual"), F.lit(False))

    def decision(tier: str, review: bool) -> Column:
        return F.struct(F.lit(tier).alias("confidence_tier"), F.lit(review).alias("manual_review_required"))

    return (
        F.when((manual & (score >= MANUAL_HIGH_SCORE)) | (score >= HIGH_SCORE), decision(HIGH, False))
        .when(score >= MEDIUM_SCORE, decision(MEDIUM, True))
        .otherwise(decision(LOW, True))
    )


def pad_cik(col: Column) -> Column:
    """Registrant number as text of at least ten digits; longer values are kept whole."""
    text = F.regexp_replace(col.cast("string"), r"\.0$", "")
    return F.when(F.length(text) >= 10, text).otherwise(F.lpad(text, 10, "0"))


def coerce_seed_map(seed: DataFrame) -> DataFrame:
    """The nine seed columns with score, tier and review flag filled in; legacy column names are accepted."""
    if "confidence" in seed.columns and "match_score" not in seed.columns:
        seed = seed.withColumnsRenamed(SEED_RENAMES)
    wanted = [SEED_RENAMES.get(c, c) for c in SEED_COLUMNS]
    seed = seed.withColumns({c: F.lit(None).cast("string") for c in wanted if c not in seed.columns})
    score = F.coalesce(strip(F.col("match_score").cast("string")).try_cast("double"), F.lit(0.0))
    said_review = F.coalesce(F.lower(F.col("manual_review_required").cast("string")) == "true", F.lit(False))
    return (
        seed.withColumn("match_score", score)
        .withColumn("decision", confidence(F.col("match_score"), F.col("match_method")))
        .select(
            "cfpb_company_name", "canonical_company_name", pad_cik(F.col("sec_cik")).alias("sec_cik"), "ticker",
            "match_method", "match_score", "decision.confidence_tier",
            (F.col("decision.manual_review_required") | said_review).alias("manual_review_required"), "notes",
            *[c for c in ("seed_order",) if c in seed.columns],
        )
    )
