"""Packing by powers of two: a document's tokens are cut into pieces of the sequence length and, for the rest, of the powers of two in its binary form.

Every piece is a sequence of its own length, so no sequence crosses documents and none needs padding: a sequence is full at the sequence length
or ends at a power of two. Equal lengths form a bucket, which a trainer batches together; sequence numbers run through the buckets, longest first.

Null texts count as empty: such a document is its end id alone, one piece of length 1. Repeated document ids are packed separately.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.arrow import gather, list_array, map_batches, ragged
from casemill.llm.token_file import id_and_text, id_rows
from casemill.session import materialize_plain as materialize

CHUNK_PIECES = 1_000_000


def cut(n: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the pieces of ``n`` tokens; ``longest`` is a power of two."""
    whole = n // longest
    rest = [1 << k for k in range(longest.bit_length() - 2, -1, -1) if n >> k & 1]
    lengths = np.array([longest] * whole + rest, np.int64)
    return ragged(lengths)[:-1], lengths


def pieces(docs: DataFrame, vocabulary: str, end_id: int, longest: int = 1024, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, and the ids if wanted) of every piece. Texts are encoded and cut in one step, so a task has one worker."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    encoder = id_rows(docs, vocabulary, end_id)

    def make():
        encode = encoder()

        def cut_up(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            column = part.column(2)
            counts = np.fromiter(column.value_lengths(), np.int64, part.num_rows)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            cuts = [cut(int(n), longest) for n in counts]
            row = np.repeat(np.arange(counts.size), [c[1].size for c in cuts])
            starts, lengths = (np.concatenate([*(c[k] for c in cuts), np.zeros(0, np.int64)]) for k in (0, 1))
            at = ragged(counts)[row] + starts
            data = memoryview(flat.tobytes())
            sums = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), lengths.tolist(), strict=True)]
            columns = [part.column(0).take(pa.array(row)), pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64()), pa.array(counts[row])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(list_array(flat[gather(at, lengths)].astype(np.int32), ragged(lengths), pa.int32()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for ids in encode(part):
                yield from cut_up(ids)

        return step

    return map_batches(id_and_text(docs, doc_id, text), make, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, vocabulary: str, end_id: int, longest: int = 1024, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A bucket of equal lengths is split into chunks of about ``CHUNK_PIECES`` pieces, so that numbering never gathers a bucket in one task: pieces are numbered
    within (bucket, chunk) and moved up by the sizes of the buckets and chunks before, a table of one row for each million pieces and power of two. A
    chunk is drawn by the written row, so equal rows of a repeated id are spread like any others.
    """
    found = materialize(pieces(docs, vocabulary, end_id, longest, doc_id, text, with_ids).withColumn("row", F.monotonically_increasing_id()), "pieces")
    chunks = found.count() // CHUNK_PIECES + 1
    found = found.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"))
    sizes = found.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.orderBy(F.col("length").desc(), "chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("length", "chunk", "base"), "chunks")
    inside = Window.partitionBy("length", "chunk").orderBy("doc_id", "start", "row")
    return (found.withColumn("place", F.row_number().over(inside))
            .join(sizes, ["length", "chunk"])
            .withColumn("sequence_id", F.col("base") + F.col("place") - 1)
            .withColumn("offset", F.lit(0).cast("long"))
            .drop("base", "place", "chunk", "row"))
