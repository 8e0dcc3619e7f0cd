"""Occupational wage table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from casemill.fixed import (
    DEFAULT_HOURLY_WAGE, DEFAULT_WAGE_OCCUPATION, WAGE_COLUMNS, WAGE_NOTE, WAGE_OCCUPATIONS, WAGE_PERIOD, WAGE_SOURCE,
    WAGE_SOURCE_URL,
)
from casemill.functions.columns import clean_number

WAGE_NUMBERS = ["h_mean", "a_mean", "h_median", "a_median"]


def normalize_wages(raw: DataFrame, occupations: Iterable[str] = tuple(WAGE_OCCUPATIONS)) -> DataFrame:
    """Wanted occupations with clean numbers, canonical names and lineage columns, ordered by code."""
    rows = raw.toDF(*[c.strip().lower() for c in raw.columns])
    code = "occ_code" if "occ_code" in rows.columns else "o_group"
    rows = rows.filter(F.col(code).cast("string").isin(list(occupations)))
    rows = rows.withColumns({c: clean_number(F.col(c)) for c in WAGE_NUMBERS if c in rows.columns})
    kept = [c for c in WAGE_COLUMNS if c in rows.columns]
    order = [F.col("occupation_code")] if "occ_code" in kept else []
    named = rows.select([F.col(c).alias(WAGE_COLUMNS[c]) for c in kept]).withColumns({
        "benchmark_period": F.lit(WAGE_PERIOD), "source": F.lit(WAGE_SOURCE), "source_url": F.lit(WAGE_SOURCE_URL),
        "benchmark_note": F.lit(WAGE_NOTE),
    })
    return named.orderBy(*order) if order else named


def default_hourly_wage(wages: DataFrame) -> DataFrame:
    """One row: the mean hourly wage of the default occupation, or the fallback."""
    wage = F.first(F.when(F.col("occupation_code") == DEFAULT_WAGE_OCCUPATION, F.col("mean_hourly_wage")), ignorenulls=True)
    return wages.agg(F.coalesce(wage, F.lit(DEFAULT_HOURLY_WAGE)).alias("hourly_wage"))
