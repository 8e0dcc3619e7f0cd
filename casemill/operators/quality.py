"""Schema validation and data-quality profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from casemill.fixed import REQUIRED_COLUMNS, RESPONSE_DIMENSIONS
from casemill.functions.columns import or_missing


def validate_schema(df: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per check: ``(check, violated, detail)``.

    Duplicate ids are counted on the id column alone; two null ids count as duplicates of each other. The two date
    checks and the row counts come from one pass with partial aggregation.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    missing = sorted(set(REQUIRED_COLUMNS) - set(df.columns))
    checks = [F.struct(
        F.lit("missing_columns").alias("check"), F.lit(bool(missing)).alias("violated"),
        F.lit(", ".join(missing)).alias("detail"),
    )]
    aggregates = [F.count(F.lit(1)).alias("n")]
    if "complaint_id" in df.columns:
        aggregates += [F.count_distinct("complaint_id").alias("ids"), F.count("complaint_id").alias("with_id")]
        repeated = (F.col("with_id") - F.col("ids")) + F.greatest(F.col("n") - F.col("with_id") - 1, F.lit(0))
        checks.append(F.struct(
            F.lit("duplicate_ids").alias("check"), (repeated > 0).alias("violated"),
            repeated.cast("string").alias("detail"),
        ))
    if "date_received" in df.columns:
        received = F.col("date_received").cast("string").try_cast("timestamp_ntz")
        aggregates += [F.count(received).alias("dated"), F.max(received).alias("latest")]
        bad = F.coalesce(F.try_divide(F.col("n") - F.col("dated"), F.col("n")), F.lit(0.0))
        checks += [
            F.struct(F.lit("unparseable_dates").alias("check"), (bad > 0.01).alias("violated"),
                     F.round(bad, 6).cast("string").alias("detail")),
            F.struct(F.lit("future_dates").alias("check"),
                     F.coalesce(F.col("latest") > now + F.expr("interval 1 day"), F.lit(False)).alias("violated"),
                     F.col("latest").cast("string").alias("detail")),
        ]
    return df.agg(*aggregates).select(F.inline(F.array(*checks)))


def distinct_counts(df: DataFrame) -> DataFrame:
    """``(position, n)``: exact distinct non-null values of every column that has some.

    Every row gives one short pair of column and value for each column; equal pairs are combined within the tasks before their only exchange, and the counts of a
    column follow from a second one of a few rows. Long texts are pairs with a digest, so no narrative travels.
    """
    def value(name: str, kind: T.DataType) -> Column:
        c = F.col(f"`{name}`")
        if isinstance(kind, T.StringType):
            # The mark keeps a digest apart from a short text that spells it.
            return F.when(F.length(c) > 40, F.concat(F.lit("\u0001"), F.sha2(c, 256))).otherwise(c)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0.0)  # both zeros are one value
        if isinstance(kind, (T.ArrayType, T.StructType)):
            c = F.to_json(F.struct(c))
        return F.base64(c) if isinstance(kind, T.BinaryType) else c.cast("string")

    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.when(F.col(f"`{f.name}`").isNotNull(), value(f.name, f.dataType)).alias("value")) for i, f in enumerate(df.schema)])
    return df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("position", "value").agg(F.lit(1).alias("one")).groupBy("position").agg(F.count("one").alias("n"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: records, missing count and rate, distinct values, and the smallest value as an example.

    Counts and examples of all columns are one aggregate without distincts, :func:`distinct_counts` another; ``approximate`` replaces that by sketches
    in the same aggregate. The smallest text starts with the smallest beginning, so only beginnings are compared for the example.
    """
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    aggregates = [F.count(F.lit(1)).alias("records")]
    for i, c in enumerate(df.columns):
        aggregates += [
            F.count(F.col(c)).alias(f"present_{i}"),
            (F.min(F.substring(c, 1, 160)) if c in texts else F.substring(F.min(c).cast("string"), 1, 160)).alias(f"example_{i}"),
        ]
        if approximate:
            aggregates.append(F.approx_count_distinct(F.col(c)).alias(f"distinct_{i}"))
    total = F.col("records")
    summary = df.agg(*aggregates)
    if not approximate:
        summary = summary.withColumn("distinct", distinct_counts(df).select(F.map_from_entries(F.collect_list(F.struct("position", "n")))).scalar())
    rows = [F.struct(
        F.lit(c).alias("field"), total.alias("records"), (total - F.col(f"present_{i}")).alias("missing_count"),
        F.bround(F.coalesce(F.try_divide(total - F.col(f"present_{i}"), total), F.lit(0.0)), 4).alias("missing_rate"),
        (F.col(f"distinct_{i}") if approximate else F.coalesce(F.col("distinct")[i], F.lit(0).cast("bigint"))).alias("unique_values"),
        F.col(f"example_{i}").alias("example_non_null"),
    ) for i, c in enumerate(df.columns)]
    return summary.select(F.inline(F.array(*rows)))


def response_distribution(df: DataFrame) -> DataFrame:
    """Counts of the response columns that exist, in long form; null is ``Missing``."""
    present = [c for c in RESPONSE_DIMENSIONS if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "dimension string, category string, complaints bigint")
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), or_missing(F.col(c)).alias("category")) for c in present])
    return df.select(F.inline(pairs)).groupBy("dimension", "category").agg(F.count(F.lit(1)).alias("complaints"))
