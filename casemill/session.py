"""Session helpers: the shared scratch folder, and a local session for tests and the bench."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

OWN: dict[str, str] = {}


def local_session(cores: int | str = 8, memory: str = "16g", partitions: int = 8) -> SparkSession:
    """A single-machine session with a scratch folder of its own. On a cluster the session comes from the submitter instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("casemill")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", own_folder())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def own_folder() -> str:
    """A folder of this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="casemill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a one-machine session without that setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in OWN:
        OWN[context.applicationId] = own_folder()
    return OWN[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's part of it."""
    return f"{scratch_root(spark)}/casemill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this application wrote below the shared folder; call it when a job's results are written elsewhere."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/casemill/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when their action ends. Otherwise they stay until the driver happens to collect its garbage, so a job of many steps
    holds those of all of them. Frames whose exchanges are used again have to be made outside."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before) if before is not None else spark.conf.unset(FREE_SHUFFLES)


def write_scratch(df: DataFrame, path: str, *partition: str) -> None:
    """Write a table below the shared folder: small, and without leaving shuffle files behind."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition).parquet(path)


def materialize(df: DataFrame, name: str, *partition: str) -> DataFrame:
    """Write a frame below the shared folder and return the written table.

    Iterative jobs read it on every pass: the lineage stays short and a lost executor costs a re-read only.
    """
    path = scratch_path(df.sparkSession, name)
    write_scratch(df, path, *partition)
    written = df.sparkSession.read.parquet(path)
    written.scratch_folder = path
    return written


def materialize_plain(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialize` with the session's own compression and shuffle files, for which the training-data operators were measured."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*written: DataFrame) -> None:
    """Delete the folders of tables that :func:`materialize` returned; nothing reads them any more, also no frame that is still to be evaluated."""
    for df in written:
        delete_folder(df.sparkSession, df.scratch_folder)
