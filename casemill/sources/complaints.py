"""Complaint store: bulk CSV, search API pages, the Parquet table and its incremental refresh."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casemill.fixed import API_FIELD_RENAMES, COMPLAINT_COLUMNS
from casemill.functions.columns import strip, to_long, to_timestamp
from casemill.session import delete_folder, discard, freed_shuffles, materialize
from casemill.sources import records

TIMESTAMP_COLUMNS = {"date_received", "date_sent_to_company"}
STORE_PARTITION = "received_month"


def _column_type(name: str) -> T.DataType:
    if name == "complaint_id":
        return T.LongType()
    return T.TimestampNTZType() if name in TIMESTAMP_COLUMNS else T.StringType()


COMPLAINT_SCHEMA = T.StructType([T.StructField(c, _column_type(c)) for c in COMPLAINT_COLUMNS.values()])


def normalize_columns(df: DataFrame) -> DataFrame:
    """The 18 complaint columns in fixed order: known headers renamed, absent ones null, others dropped.

    Values that do not parse become null instead of failing the job.
    """
    present = set(df.columns)

    def project(header: str, name: str):
        source = header if header in present else name if name in present else None
        raw = F.col(f"`{source}`") if source else F.lit(None)
        if name == "complaint_id":
            return to_long(raw).alias(name)
        if name in TIMESTAMP_COLUMNS:
            return to_timestamp(raw).alias(name)
        return strip(raw.cast("string")).alias(name)

    return df.select([project(header, name) for header, name in COMPLAINT_COLUMNS.items()])


def read_bulk_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Normalised rows of the extracted bulk CSV.

    Narratives may contain line breaks; :func:`~casemill.sources.records.read_csv` still reads one large file in many tasks. With
    ``multi_line=False`` every line is a record, which saves the count of quotes.
    """
    if multi_line:
        return normalize_columns(records.read_csv(spark, path))
    return normalize_columns(spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path))


_API_FIELDS = {name: API_FIELD_RENAMES.get(name, name) for name in COMPLAINT_COLUMNS.values()}
API_PAGE_SCHEMA = T.StructType([
    T.StructField("hits", T.StructType([
        T.StructField("hits", T.ArrayType(T.StructType([
            T.StructField("_source", T.StructType([T.StructField(f, T.StringType()) for f in _API_FIELDS.values()])),
        ]))),
    ])),
])


def flatten_api_pages(pages: DataFrame) -> DataFrame:
    """One normalised row per hit of the landed response pages."""
    hits = pages.select(F.explode("hits.hits").alias("hit"))
    return normalize_columns(hits.select([F.col(f"hit._source.{f}").alias(n) for n, f in _API_FIELDS.items()]))


def read_api_pages(spark: SparkSession, path: str, date_min: str | None = None,
                   date_max: str | None = None, multi_line: bool = True) -> DataFrame:
    """Complaints of a date window from landed API pages: one response per file, or per line."""
    rows = flatten_api_pages(spark.read.schema(API_PAGE_SCHEMA).option("multiLine", multi_line).json(path))
    if date_min:
        rows = rows.filter(F.col("date_received") >= F.lit(date_min).cast("timestamp_ntz"))
    if date_max:
        rows = rows.filter(F.to_date("date_received") <= F.lit(date_max).cast("date"))
    return rows


def ingest_metadata(df: DataFrame, limited: bool = False) -> DataFrame:
    """Row count, date span and narrative count of an ingest."""
    return df.agg(
        F.count(F.lit(1)).alias("record_count"), F.to_date(F.min("date_received")).alias("date_min"),
        F.to_date(F.max("date_received")).alias("date_max"), F.count("consumer_complaint_narrative").alias("narrative_count"),
    ).withColumn("limited_extract", F.lit(limited))


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(STORE_PARTITION, F.coalesce(F.date_format("date_received", "yyyy-MM"), F.lit("none")))


def write_store(df: DataFrame, path: str, limited: bool = False, check: Callable[[DataFrame], None] | None = None) -> dict[str, Any]:
    """Write the store partitioned by month and return the metadata of what was written.

    The new version is written beside the old one, counted and, with ``check``, validated; only then the list of current folders names it. An empty or
    invalid ingest leaves the old store as it was. The rebalance hint lets adaptive execution split a hot month and merge small ones.
    """
    spark, version = df.sparkSession, new_version()
    try:
        with freed_shuffles(spark):
            with_partition(df).hint("rebalance", STORE_PARTITION) \
                .write.partitionBy(STORE_PARTITION).option("compression", "snappy").parquet(f"{path}/{VERSION}={version}")
        rows = read_version(spark, path, version)
        metadata = ingest_metadata(rows, limited).first().asDict()
        if not metadata["record_count"]:
            raise ValueError("no complaint rows were ingested")
        if check is not None:
            check(rows.drop(STORE_PARTITION))
    except BaseException:
        delete_folder(spark, f"{path}/{VERSION}={version}")
        raise
    commit(spark, path, {month: version for month in months_of(rows)})
    for key in ("date_min", "date_max"):
        metadata[key] = str(metadata[key]) if metadata[key] else None
    return {**metadata, "output_path": path}


def write_metadata(spark: SparkSession, metadata: dict[str, Any], path: str) -> None:
    spark.createDataFrame([(json.dumps(metadata, default=str),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def ingest_bulk(spark: SparkSession, csv_path: str, store_path: str, multi_line: bool = True,
                check: Callable[[DataFrame], None] | None = None) -> dict[str, Any]:
    """Bulk CSV to Parquet store."""
    return write_store(read_bulk_csv(spark, csv_path, multi_line), store_path, check=check)


STORE_SCHEMA = T.StructType([*COMPLAINT_SCHEMA.fields, T.StructField(STORE_PARTITION, T.StringType())])


VERSION = "version"
CURRENT = "_current"  # folder of the lists of current folders; readers of Parquet skip names with an underscore


def new_version() -> str:
    return f"v{uuid.uuid4().hex}"


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(f"{path}/{VERSION}={version}")


def months_of(rows: DataFrame) -> list[str]:
    return sorted(r[0] for r in rows.select(STORE_PARTITION).distinct().collect())


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the lists of current folders, the newest last."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{CURRENT}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def current(spark: SparkSession, path: str, number: int | None = None) -> dict[str, str]:
    """The version of each month, as of the newest commit or of a given one."""
    numbers = commits(spark, path)
    if not numbers:
        return {}
    rows = spark.read.text(f"{path}/{CURRENT}/{numbers[-1] if number is None else number}").collect()  # a line for each month
    return dict(r["value"].split("\t") for r in rows)


def commit(spark: SparkSession, path: str, months: dict[str, str]) -> None:
    """Make these folders the store. One rename puts their list in place, so a reader sees the store before or after, never a mix.

    Folders that neither this list nor the one before names are deleted; readers of the one before keep theirs until the next commit.
    """
    numbers = commits(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    staged = f"{path}/{CURRENT}/.{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(hadoop, False)
    out.write(bytearray("\n".join(f"{m}\t{v}" for m, v in sorted(months.items())).encode()))
    out.close()
    if not _rename(spark, staged, f"{path}/{CURRENT}/{number}"):
        raise OSError(f"cannot commit to {path}")
    kept = set(months.items()) | (set(current(spark, path, number - 1).items()) if numbers else set())
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    for folder in files.listStatus(root):
        name = folder.getPath().getName()
        if name.startswith(f"{VERSION}="):
            version = name.split("=", 1)[1]
            parts = [f.getPath().getName() for f in files.listStatus(folder.getPath())]
            stale = [p for p in parts if p.startswith(f"{STORE_PARTITION}=") and (p.split("=", 1)[1], version) not in kept]
            if not any(v == version for _, v in kept):
                delete_folder(spark, f"{path}/{name}")
            else:
                for part in stale:
                    delete_folder(spark, f"{path}/{name}/{part}")
    for old in numbers[:-1]:
        delete_folder(spark, f"{path}/{CURRENT}/{old}")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The store as of its newest commit. The frame goes on reading that state when a refresh commits another; a plain Parquet folder is read as it is."""
    folders = [f"{path}/{VERSION}={v}/{STORE_PARTITION}={m}" for m, v in sorted(current(spark, path).items())]
    if not folders:
        return spark.read.schema(STORE_SCHEMA).parquet(path)
    return spark.read.schema(STORE_SCHEMA).option("basePath", path).parquet(*folders).select(STORE_SCHEMA.fieldNames())


def changes_of(window: DataFrame) -> DataFrame:
    """The rows of a window that count: of every id the one received last, and of the rows without id one of each content."""
    ordered = F.struct(*[F.col(c) for c in ["date_received", *[c for c in window.columns if c != "date_received"]]])
    keyed = window.filter(F.col("complaint_id").isNotNull())
    newest = keyed.groupBy("complaint_id").agg(F.max(ordered).alias("r")).select("r.*").select(window.columns)
    return newest.unionByName(window.filter(F.col("complaint_id").isNull()).distinct())


def merge_changes(base: DataFrame, replaced: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows of ``base`` without those of the ``replaced`` ids, and the changes; one without id only if no row there is equal."""
    anonymous = changes.filter(F.col("complaint_id").isNull()).select(base.columns)
    known = base.filter(F.col("complaint_id").isNull())
    same = [anonymous[c].eqNullSafe(known[c]) for c in base.columns if c != "complaint_id"]
    return base.join(replaced, "complaint_id", "left_anti").select(base.columns) \
        .unionByName(changes.filter(F.col("complaint_id").isNotNull()).select(base.columns)) \
        .unionByName(anonymous.join(known, reduce(lambda a, b: a & b, same), "left_anti"))


def merge_window(base: DataFrame, window: DataFrame) -> DataFrame:
    """Upsert by complaint id: window rows replace base rows of the same id, all other rows stay.

    When the window holds an id more than once, the row received last wins. Rows without an id are told apart by their content: equal ones in a
    window are one row, and a window row equal to one that is there is not added again, so merging a window twice changes nothing.
    """
    return merge_changes(base, window.select("complaint_id"), changes_of(window))


TURN_BYTES = 1 << 30  # stored bytes of the months that a refresh rewrites at a time


def turns_of(spark: SparkSession, path: str, months: list[str], before: dict[str, str]) -> list[list[str]]:
    """The months in order, cut where their stored folders exceed :data:`TURN_BYTES`."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    turns, size = [], 0
    for month in sorted(months):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}={before.get(month)}/{STORE_PARTITION}={month}")
        own = files.getContentSummary(folder).getLength() if month in before else 0
        if not turns or size + own > TURN_BYTES:
            turns, size = [*turns, []], 0
        turns[-1].append(month)
        size += own
    return turns


def refresh_store(spark: SparkSession, store_path: str, window: DataFrame) -> list[str]:
    """Merge a window into the store, rewriting only the months it touches.

    A month is touched when the window has rows in it or when it holds an older version of a window row. Finding
    the latter reads the id and partition columns only. The window is evaluated once. Months are rewritten in turns of bounded size, so that a store in which all months
    are touched is never shuffled as a whole. Returns the rewritten months.
    """
    base, before = read_store(spark, store_path), current(spark, store_path)
    columns = COMPLAINT_SCHEMA.fieldNames()
    changes = materialize(with_partition(changes_of(window.select(columns))), "changes")
    ids = changes.select("complaint_id").filter(F.col("complaint_id").isNotNull())
    replaced = materialize(base.select("complaint_id", STORE_PARTITION).join(ids, "complaint_id", "left_semi"), "replaced")
    months = [r[0] for r in changes.select(STORE_PARTITION).union(replaced.select(STORE_PARTITION)).distinct().collect()]
    # The touched months are computed once, as a version of their own, and one commit puts all of them in place. Should the job end before, the store is as it was, and
    # running it again merges the same rows.
    version = new_version()
    with freed_shuffles(spark):
        for turn in turns_of(spark, store_path, months, before):
            touched, gone, new = (rows.filter(F.col(STORE_PARTITION).isin(turn)) for rows in (base, replaced, changes))
            merged = merge_changes(touched.select(columns), gone.select("complaint_id"), new.select(columns))
            with_partition(merged).hint("rebalance", STORE_PARTITION).write.mode("append").partitionBy(STORE_PARTITION).parquet(f"{store_path}/{VERSION}={version}")
    discard(changes, replaced)
    if not months:
        return []
    # A month whose last row moved to another month has no new folder.
    written = {m: version for m in months_of(read_version(spark, store_path, version))}
    commit(spark, store_path, {m: v for m, v in before.items() if m not in months} | written)
    return sorted(months)


def _rename(spark: SparkSession, path: str, to: str) -> bool:
    source, target = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(source) and files.rename(source, target)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


DOCUMENT_KEY = "doc_key"


def keyed_documents(rows: DataFrame, key: str = DOCUMENT_KEY) -> DataFrame:
    """``rows`` with a key that is never null and never repeated, for one reading: another may number them otherwise.

    The key is the complaint id where exactly one row has it. Other rows, without id or with an id of several rows, get numbers above all ids in the
    order of the input. Ids are counted without the texts; Spark broadcasts the repeated ones if they are few.
    """
    repeated = materialize(rows.groupBy("complaint_id").count().where("count > 1 AND complaint_id IS NOT NULL").select("complaint_id", F.lit(True).alias("repeated")), "repeated_ids")
    numbered = rows.withColumn(key, F.monotonically_increasing_id() + F.lit(1 << 62)).join(repeated, "complaint_id", "left")
    own = F.col("complaint_id").isNotNull() & F.col("repeated").isNull()
    return numbered.withColumn(key, F.when(own, F.col("complaint_id")).otherwise(F.col(key))).select(*rows.columns, key)


def with_document_key(rows: DataFrame, key: str = DOCUMENT_KEY) -> DataFrame:
    """:func:`keyed_documents` as a written table, which can be read again and again."""
    return materialize(keyed_documents(rows, key), "keyed")


def sql_query(spark: SparkSession, sql: str, store: DataFrame, args: dict[str, Any] | list[Any] | None = None) -> DataFrame:
    """Parameterised SQL over the view ``complaints``."""
    store.createOrReplaceTempView("complaints")
    return spark.sql(sql, args=args)


def sample_head(store: DataFrame, n: int = 10_000) -> DataFrame:
    return store.limit(n)
