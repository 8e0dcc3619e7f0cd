"""Incremental refresh of the store from a landing folder of API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.sources.complaints import API_PAGE_SCHEMA, flatten_api_pages, refresh_store


def refresh_from_landing(spark: SparkSession, landing: str, store: str, checkpoint: str, multi_line: bool = True,
                         files_per_batch: int = 1_000) -> None:
    """Merge every page file not seen before into the store, then stop.

    The file stream's checkpoint remembers processed files, so each run costs only the new ones. A batch that is
    run again after a failure merges the same rows by id and leaves the same store.
    """
    pages = (
        spark.readStream.schema(API_PAGE_SCHEMA).option("multiLine", multi_line)
        .option("maxFilesPerTrigger", files_per_batch).json(landing)
    )

    def merge(batch: DataFrame, _: int) -> None:
        refresh_store(batch.sparkSession, store, flatten_api_pages(batch))

    query = pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
