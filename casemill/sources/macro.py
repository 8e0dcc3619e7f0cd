"""Macro series observations."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casemill.fixed import MACRO_SERIES, MACRO_SOURCE

OBSERVATIONS_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("observations", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()), T.StructField("value", T.StringType()),
    ]))),
])


def series_description(series_id) -> F.Column:
    names = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in MACRO_SERIES.items()))
    return F.coalesce(names[series_id], series_id)


def observation_rows(payloads: DataFrame) -> DataFrame:
    """One row per numeric observation; marks such as ``.`` are dropped."""
    rows = payloads.select("series_id", F.explode("observations").alias("o"))
    return rows.select(
        "series_id", series_description(F.col("series_id")).alias("description"), F.col("o.date").alias("date"),
        F.col("o.value").try_cast("double").alias("value"), F.lit(MACRO_SOURCE).alias("source"),
    ).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def read_observations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All landed series at once. A payload without its own id takes the id from its file name."""
    payloads = spark.read.schema(OBSERVATIONS_SCHEMA).option("multiLine", multi_line).json(path)
    from_name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    return observation_rows(payloads.withColumn("series_id", F.coalesce("series_id", from_name)))


def series_status(observations: DataFrame) -> DataFrame:
    return observations.agg(F.count_distinct("series_id").alias("series"), F.count(F.lit(1)).alias("observations"))
