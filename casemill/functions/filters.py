"""Metadata filters as one Catalyst predicate, so that date bounds reach the Parquet scan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

EQUALITY_FIELDS = ("company", "product", "issue", "state")


@dataclass(frozen=True)
class CaseFilters:
    """All fields are optional; an empty value means no filter."""

    company: str | None = None
    product: str | None = None
    issue: str | None = None
    state: str | None = None
    date_start: str | None = None
    date_end: str | None = None


def predicate(filters: CaseFilters | None) -> Column | None:
    """Case-insensitive equality and inclusive date bounds, or None when nothing is filtered.

    A bound given as a day means its midnight, so a later time on the end day does not pass. A null date never
    passes a date bound.
    """
    if filters is None:
        return None
    parts = [F.lower(F.col(c)) == getattr(filters, c).lower() for c in EQUALITY_FIELDS if getattr(filters, c)]
    received = F.col("date_received")
    if filters.date_start:
        parts.append(received >= F.lit(dt.datetime.fromisoformat(filters.date_start)).cast("timestamp_ntz"))
    if filters.date_end:
        parts.append(received <= F.lit(dt.datetime.fromisoformat(filters.date_end)).cast("timestamp_ntz"))
    return reduce(lambda a, b: a & b, parts) if parts else None


def apply_filters(df: DataFrame, filters: CaseFilters | None) -> DataFrame:
    condition = predicate(filters)
    return df if condition is None else df.filter(condition)


def multi_select(df: DataFrame, products: list[str] | None = None, states: list[str] | None = None,
                 start: str | None = None, end: str | None = None) -> DataFrame:
    """Interactive filter: any of the given products and states, and an inclusive date range."""
    if products:
        df = df.filter(F.col("product").isin(products))
    if states:
        df = df.filter(F.col("state").isin(states))
    return apply_filters(df, CaseFilters(date_start=start, date_end=end))
