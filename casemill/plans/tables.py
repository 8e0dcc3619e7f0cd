"""Stand-ins: the test tables shaped as the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CUSTOMER_COLUMNS = {"product", "company", "state"}


def cases(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Complaint facts from orders, customers and nations.

    Dimension keys are unique and the joins are left joins, so a dimension whose columns are not asked for can be
    left out without changing any row.
    """
    wanted = list(columns) or [
        "complaint_id", "date_received", "product", "issue", "company", "state", "company_response_to_consumer",
        "timely_response", "consumer_complaint_narrative",
    ]
    rows = table(spark, sf_dir, "orders")
    if CUSTOMER_COLUMNS & set(wanted):
        rows = rows.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    if "state" in wanted:
        rows = rows.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    status = F.col("o_orderstatus")
    source = {
        "complaint_id": lambda: F.col("o_orderkey"),
        "date_received": lambda: F.col("o_orderdate"),
        "product": lambda: F.col("c_mktsegment"),
        "issue": lambda: F.col("o_orderpriority"),
        "company": lambda: F.col("c_name"),
        "state": lambda: F.col("n_name"),
        "company_response_to_consumer": lambda: F.nullif(status, F.lit("P")),
        "timely_response": lambda: F.when(status == "F", "Yes").when(status == "O", "No"),
        "submitted_via": lambda: F.when(F.col("o_totalprice") > 250000, "Phone").otherwise("Web"),
        "consumer_complaint_narrative": lambda: F.when(status == "F", F.col("o_orderpriority")),
        "assets": lambda: F.col("o_totalprice"),
    }
    return rows.select([source[c]().alias(c) for c in wanted])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrative documents: ``lang`` plays the product, ``source`` the company."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("complaint_id"), F.col("text").alias("consumer_complaint_narrative"),
        F.col("lang").alias("product"), F.col("source").alias("company"), F.lit(None).cast("string").alias("issue"),
        F.lit(None).cast("string").alias("state"), F.lit(None).cast("timestamp_ntz").alias("date_received"), "n_chars",
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def seed_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw seed map from suppliers: names of the first customers, scores and review flags derived from the row."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.regexp_replace("s_name", "Supplier", "CUSTOMER").alias("cfpb_company_name"),
        F.concat(F.col("s_name"), F.lit(" Financial Corp.")).alias("canonical_company_name"),
        key.cast("string").alias("sec_cik"), F.concat(F.lit("T"), key.cast("string")).alias("ticker"),
        F.when(key % 2 == 0, "manual_seed").otherwise("imported").alias("match_method"),
        F.round(F.lit(0.85) + (key % 8) * 0.02, 2).cast("string").alias("confidence"),
        F.when(key % 5 == 0, "true").otherwise("false").alias("manual_review_flag"),
        F.lit("derived").alias("notes"), key.alias("seed_order"),
    )


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per return flag: the price of every line item, dated by its shipping day."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("series_id"), F.to_date("l_shipdate").cast("string").alias("date"),
        F.col("l_extendedprice").alias("value"),
    )
