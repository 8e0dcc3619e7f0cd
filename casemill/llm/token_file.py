"""Token files: ids of all documents in ORC, ascending by document id, read back by stripes.

ORC keeps integers in run-length encoded streams, and per stripe and row group the smallest and largest document id and a Bloom filter of the ids: a
reader that wants some documents skips the stripes and row groups without them, and one that wants all reads stripes in parallel.
Each file holds a range of document ids; a manifest table has, per file, its documents, its tokens and the position of its first token.
A document's row says how many tokens its writer wrote before it, so its position follows from its own row and the manifest.

Null texts count as empty; every document gets the end id. Repeated ids are separate documents, in the order in which they were written. A null
document id sorts first.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.llm.arrow import list_array, map_batches, ragged, texts_of
from casemill.llm.bpe import encoding

STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1_000
# Rows read together by the vectorised reader: arrays of a batch stay within a few megabytes.
READ_ROWS = 512


IDS = "doc_id bigint, n_tokens bigint, ids array<int>, before bigint"


def id_rows(docs: DataFrame, vocabulary: str, end_id: int) -> Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]]:
    """The step of a task that turns ``(doc_id, text)`` into rows of ``IDS``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        library, written = encoding(shared.value), 0

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal written
            texts = texts_of(part.column(1))
            first = 0
            while first < len(texts):  # a few million characters at a time
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= 2_000_000):
                    size += len(texts[last])
                    last += 1
                ids = [np.append(library.encode_to_numpy(t, allowed_special="all").astype(np.int32), np.int32(end_id)) for t in texts[first:last]]
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(first, last - first), pa.array(counts), list_array(np.concatenate(ids), ragged(counts), pa.int32()),
                     pa.array(written + ragged(counts)[:-1])],
                    names=["doc_id", "n_tokens", "ids", "before"])
                written += int(counts.sum())
                first = last

        return step

    return make


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def file_ids(docs: DataFrame, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, before) of every whole text with the end id; ``before`` counts the tokens of the task's earlier texts."""
    return map_batches(id_and_text(docs, doc_id, text), id_rows(docs, vocabulary, end_id), IDS)


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the token files below ``path``/tokens and their manifest at ``path``/manifest.

    Texts, not ids, are dealt out by ranges of document ids: they take less room. Each range is sorted, encoded and written by one task.
    """
    spark = docs.sparkSession
    dealt = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    (file_ids(dealt, vocabulary, end_id)
     .write.option("orc.compress", "ZSTD").option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", INDEX_STRIDE)
     .option("orc.bloom.filter.columns", "doc_id").orc(f"{path}/tokens"))
    files = (spark.read.orc(f"{path}/tokens").select("doc_id", "n_tokens", "before", F.col("_metadata.file_path").alias("file"))
             .groupBy("file").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"),
                                  F.min("before").alias("first_before"), F.count("doc_id").alias("with_id")))
    # One row per file: files, not documents, pass this window. Documents without id lie in the first file, or in files before all others.
    order = Window.orderBy(F.col("with_id") == F.col("docs"), F.col("first_doc").asc_nulls_first(), "last_doc", "first_before", "file").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("tokens").over(order), F.lit(0))).write.parquet(f"{path}/manifest")


def read(spark: SparkSession, path: str, documents: list[int] | None = None) -> DataFrame:
    """Documents of the token files; a list of ids is pushed into the scan, where stripe statistics and Bloom filters prune."""
    rows = spark.read.option("orc.column.batch.size", READ_ROWS).orc(f"{path}/tokens")
    return rows if documents is None else rows.where(F.col("doc_id").isin(documents))


def layout(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the written files: where each document's tokens lie in the whole, and their checksum."""
    rows = read(spark, path).select("doc_id", "n_tokens", "before", "ids", F.col("_metadata.file_path").alias("file"))

    def make():
        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            column = part.column(3)
            ends = np.cumsum(np.fromiter(column.value_lengths(), np.int64, part.num_rows)).tolist()
            data = memoryview(column.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in (0, 1, 2, 4)), pa.array(sums, pa.int64())], names=["doc_id", "n_tokens", "before", "file", "ids_crc32"])

        return step

    sums = map_batches(rows, make, "doc_id bigint, n_tokens bigint, before bigint, file string, ids_crc32 bigint")
    manifest = spark.read.parquet(f"{path}/manifest").select("file", (F.col("start") - F.col("first_before")).alias("shift"))
    return sums.join(manifest, "file").select("doc_id", (F.col("before") + F.col("shift")).alias("start"), "n_tokens", "ids_crc32")
