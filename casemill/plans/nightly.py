"""The whole refresh as one job: ingest or merge, validate, profile, score, derive, and optionally topics and router.

The store has a companion table of monthly partial counts. An ingest writes all of it; a refresh recounts only the months that it touched, and the scores and
opportunities are derived from the partials. Topics and router start from the stored documents; the router goes on from the model of the run before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.functions.text import narratives
from casemill.operators import anomaly, metrics, opportunities, quality, router, tfidf, topics
from casemill.session import discard, freed_shuffles
from casemill.sources import artifacts, complaints

PARTIAL_GROUPS = ["product", "issue"]


def refuse_invalid(rows: DataFrame) -> None:
    violated = [r["check"] for r in quality.validate_schema(rows).filter("violated").collect()]
    if violated:
        raise ValueError("; ".join(violated))


def write_partials(spark: SparkSession, output: str, months: list[str] | None = None) -> None:
    """Count the store's months, or only the given ones, into the table of partials. A month that has no rows left loses its folder."""
    store, path = complaints.read_store(spark, f"{output}/complaints"), f"{output}/monthly_partials"
    rows = store if months is None else store.where(F.col(complaints.STORE_PARTITION).isin(months))
    # A month's partials are few; a month that is not dated has its own folder.
    counted = complaints.with_partition(metrics.monthly_partials(rows, *PARTIAL_GROUPS)).coalesce(1 if months else 8)
    with freed_shuffles(spark):
        if months is None:
            counted.write.mode("overwrite").partitionBy(complaints.STORE_PARTITION).parquet(path)
            return
        found = {r[0] for r in rows.select(complaints.STORE_PARTITION).distinct().collect()}
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(complaints.STORE_PARTITION).parquet(path)
    for month in set(months) - found:
        complaints.delete_folder(spark, f"{path}/{complaints.STORE_PARTITION}={month}")


def read_partials(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/monthly_partials").drop(complaints.STORE_PARTITION)


def derive(spark: SparkSession, output: str, run_nlp: bool, target: str = "product", min_class: int = 50) -> dict[str, DataFrame]:
    """Write all artifact tables of the stored complaints and return them."""
    rows = complaints.read_store(spark, f"{output}/complaints").drop(complaints.STORE_PARTITION)
    partials = read_partials(spark, output)
    emerging = anomaly.emerging_scores(partials, "issue")
    tables = {
        "quality_profile": quality.column_profile(rows),
        "emerging_issues": emerging,
        "opportunities": opportunities.derive_opportunities(partials, emerging),
    }
    if run_nlp:
        # Ids may be null or repeated; the models need a key per document, which stands for the id.
        # The key is given, the text cleaned and its terms counted in one step, and the counts serve both models.
        keyed = complaints.keyed_documents(rows.where("consumer_complaint_narrative IS NOT NULL"))
        docs = narratives(keyed.withColumn("complaint_id", F.col(complaints.DOCUMENT_KEY)).drop(complaints.DOCUMENT_KEY))
        counted = tfidf.count_terms(docs, topics.KEY, topics.TEXT, tfidf.TOPICS, list(dict.fromkeys([*topics.ABOUT, target])))
        registry, _ = topics.discover_topics(counted)
        tables["topics"] = registry.withColumns({
            c: F.to_json(c) for c in ("product_distribution", "company_distribution", "representatives")
        })
        model = f"{output}/router_model"
        before = router.open_router(spark, model) if complaints.folder_exists(spark, model) else None
        trained = router.train_router(counted, target, min_class=min_class, start=before)
        trained.write(spark, model)
        discard(counted)
        tables["router_report"], tables["router_classes"] = trained.report, trained.class_report
    with freed_shuffles(spark):
        for name, table in tables.items():
            artifacts.write_csv_table(table, f"{output}/{name}")
    return {name: artifacts.read_csv_table(spark, f"{output}/{name}", table.schema) for name, table in tables.items()}


def run_nightly(spark: SparkSession, csv_path: str, output: str, run_nlp: bool = True, multi_line: bool = True, min_class: int = 50,
                keep_extract: bool = True) -> dict[str, DataFrame]:
    """Ingest a bulk extract, and write and return the artifact tables. Without ``keep_extract`` its folder goes as soon as the store has its rows.

    Fails with the list of violated checks when the ingested rows are not valid; the store of the run before then stays, and so does the extract.
    """
    complaints.ingest_bulk(spark, csv_path, f"{output}/complaints", multi_line, check=refuse_invalid)
    if not keep_extract:
        complaints.delete_folder(spark, csv_path)
    write_partials(spark, output)
    return derive(spark, output, run_nlp, min_class=min_class)


def refresh_nightly(spark: SparkSession, window: DataFrame, output: str, run_nlp: bool = True, min_class: int = 50) -> dict[str, DataFrame]:
    """Merge a window of complaints into the store, recount the months it touched, and write and return the artifact tables."""
    months = complaints.refresh_store(spark, f"{output}/complaints", window)
    if months:
        write_partials(spark, output, months)
    return derive(spark, output, run_nlp, min_class=min_class)
