"""CSV and JSON artifact tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; an absent path gives an empty frame of the same schema."""
    try:
        return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_csv_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
