"""Nested company facts documents (one JSON document per registrant)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casemill.fixed import CONCEPTS, FACT_FORMS
from casemill.sources.entity_seed import pad_cik

FACT = T.StructType([
    T.StructField("fy", T.IntegerType()), T.StructField("fp", T.StringType()), T.StructField("form", T.StringType()),
    T.StructField("end", T.StringType()), T.StructField("filed", T.StringType()),
    T.StructField("val", T.DoubleType()), T.StructField("accn", T.StringType()),
])
FACTS_SCHEMA = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("entityName", T.StringType()),
    T.StructField("facts", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StructType([
        T.StructField("units", T.MapType(T.StringType(), T.ArrayType(FACT))),
    ])))),
    T.StructField("_corrupt_record", T.StringType()),
])


def parse_company_facts(df: DataFrame, json_col: str) -> DataFrame:
    """Parsed documents from a column of JSON text."""
    parsed = F.from_json(F.col(json_col), FACTS_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.select(parsed.alias("d")).select("d.*")


def read_company_facts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per landed document (a file each, or a line each).

    Documents that do not parse keep their text in ``_corrupt_record``. The text is parsed after the scan because
    Spark refuses queries on a JSON scan that touch the corrupt column only.
    """
    return parse_company_facts(spark.read.option("wholetext", multi_line).text(path), "value")


def fact_errors(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("_corrupt_record").isNotNull())


def fact_rows(documents: DataFrame, concepts: dict[str, list[str]] = CONCEPTS) -> DataFrame:
    """USD facts of annual and quarterly reports for the wanted concepts, with metric and priority.

    The concept list is a literal map, so unwanted concepts are dropped before their facts are unnested and no
    join is needed.
    """
    wanted = F.create_map(*chain.from_iterable(
        (F.lit(concept), F.struct(F.lit(metric).alias("metric_name"), F.lit(i).alias("concept_priority")))
        for metric, names in concepts.items() for i, concept in enumerate(names, start=1)
    ))
    by_concept = documents.select(
        F.col("entityName").alias("company"),
        pad_cik(F.coalesce("cik", F.lit(""))).alias("sec_cik"),
        F.explode(F.map_filter(F.col("facts")["us-gaap"], lambda k, _: F.map_contains_key(wanted, k)))
        .alias("xbrl_concept", "concept"),
    )
    facts = by_concept.select(
        "company", "sec_cik", "xbrl_concept", wanted[F.col("xbrl_concept")].alias("m"), F.lit("USD").alias("unit"),
        F.explode(F.col("concept.units")["USD"]).alias("f"),
    )
    return facts.filter(
        F.col("f.val").isNotNull() & F.col("f.fy").isNotNull() & F.col("f.form").isin(FACT_FORMS)
    ).select(
        "company", "sec_cik", "m.metric_name", "m.concept_priority", "xbrl_concept", "unit",
        F.col("f.fy").alias("fiscal_year"), F.coalesce("f.fp", F.lit("")).alias("fiscal_period"),
        F.col("f.end").alias("period_end"), F.col("f.form").alias("form"), F.col("f.filed").alias("filed_date"),
        F.col("f.accn").alias("accession"), F.col("f.val").alias("value"),
    )
