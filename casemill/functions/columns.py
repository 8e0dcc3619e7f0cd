"""Column helpers for coercion, dates and arithmetic. All of them are plain Catalyst expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The six ASCII characters of the JVM's \\s.
SPACES = " \t\n\x0b\f\r"
# White space beyond the six ASCII characters of the JVM's \\s.
WIDE_SPACES = "\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def has_wide_space(text: Column) -> Column:
    """Byte searches, far cheaper than the pattern they decide about."""
    return reduce(lambda a, b: a | b, [text.contains(c) for c in WIDE_SPACES])


def strip(col: Column) -> Column:
    """Trim white space of any kind, where Spark's ``trim`` removes blanks only. Just the ends of a text are looked at."""
    return F.btrim(col, F.lit(f"{SPACES}{WIDE_SPACES}"))


def to_long(col: Column) -> Column:
    """Number text to BIGINT, null where it is not a whole number."""
    number = strip(col.cast("string")).try_cast("double")
    return F.when(number == F.floor(number), F.coalesce(strip(col.cast("string")).try_cast("bigint"),
                                                        number.try_cast("bigint")))


def to_timestamp(col: Column) -> Column:
    """Date or date-time text to TIMESTAMP_NTZ, null where it cannot be read. Offsets are dropped."""
    text = strip(col.cast("string"))
    us_date = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
    return us_date.try_cast("timestamp_ntz")


def month(col: Column) -> Column:
    """First day of the month as DATE, null kept."""
    return F.trunc(col, "month")


def clean_number(col: Column) -> Column:
    """``"48,880"`` to 48880.0; ``"*"`` and other marks to null."""
    return F.regexp_replace(col.cast("string"), r"[,*]", "").try_cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null on a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def is_yes(col: Column) -> Column:
    """Case-insensitive ``yes``; null counts as no."""
    return F.coalesce(F.lower(col) == "yes", F.lit(False))


def share(flag: Column) -> Column:
    """Aggregate: share of all rows where ``flag`` holds."""
    return F.avg(F.when(flag, 1.0).otherwise(0.0))


def or_missing(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit("Missing"))
