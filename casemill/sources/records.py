"""CSV with line breaks inside quotes, read by as many tasks as its size calls for.

A line break ends a record only if an even number of quotes stands before it in the file. The quotes of each split are counted first; whether a split begins
inside quotes then follows from the splits before it, a table of one row per split. Every task puts the records together that begin and end in its split; the
fragments of the few that do not are put together from a table of at most two rows per split.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from casemill.session import materialize

FRAGMENT = "split bigint, part int, begins boolean, ends boolean, header boolean, value string"


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, file, block)``: lines as the file has them, with the place of their split. A line belongs to the split in which it begins."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def splits(lines: DataFrame) -> DataFrame:
    """``(split, file, block, inside, cut)``: a number for every split, whether it begins inside quotes, and whether a record of it goes on in another split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    upto = F.coalesce(F.sum("quotes").over(Window.partitionBy("file").orderBy("block")), F.lit(0))  # one row per split
    inside = (upto - F.col("quotes")) % 2 == 1
    return counted.select(F.monotonically_increasing_id().alias("split"), "file", "block", inside.alias("inside"), (inside | (upto % 2 == 1)).alias("cut"))


def fragments(lines: DataFrame, places: DataFrame, heads: bool = False) -> DataFrame:
    """``(split, part, begins, ends, header, value)``: records of the given splits in order, whole or the parts of one that lie in the split; with ``heads`` the first of
    each split only. Of a line only the number of its split goes along, and records are joined a batch at a time."""
    def assembled(split: int, open_: bool, first: bool, part: int, values: pa.Array) -> pa.RecordBatch:
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + open_) % 2  # whether quotes are open behind each line
        last = np.flatnonzero(after == 0)
        ends = np.append(last, len(values) - 1) if not last.size or last[-1] != len(values) - 1 else last
        n = ends.size
        begins, header = np.ones(n, bool), np.zeros(n, bool)
        begins[0], header[0] = not open_, first and not part
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, ends + 1).astype(np.int32)), values), "\n")
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, split)), pa.array(np.arange(part, part + n, dtype=np.int32)), pa.array(begins), pa.array(after[ends] == 0), pa.array(header), joined],
            names=["split", "part", "begins", "ends", "header", "value"])

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, part = None, [], 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            """Records of the split so far; the one that is still open waits for its next lines."""
            nonlocal held, part, place
            split, open_, first = place
            values = pa.concat_arrays(held)
            found = assembled(split, open_, first, part, values)
            keep = found.num_rows if last or found.column(3)[found.num_rows - 1].as_py() else found.num_rows - 1
            if keep:
                yield found.slice(0, min(keep, 1) if heads else keep)
                part += keep
                place = (split, False, first)
            used = len(values) if keep == found.num_rows else len(values) - found.column(5)[keep].as_py().count("\n") - 1
            held = [values.slice(used)] if used < len(values) else []

        for batch in batches:
            numbers = batch.column(1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [batch.num_rows]]).tolist() if batch.num_rows else [0]
            for first, end in zip(cuts, cuts[1:]):
                if place is not None and place[0] != numbers[first]:
                    if held:
                        yield from flush(True)
                    place = None
                if place is None:
                    place, held, part = (int(numbers[first]), batch.column(2)[first].as_py(), batch.column(3)[first].as_py()), [], 0
                if heads and part:
                    continue
                held.append(batch.column(0).slice(first, end - first))
                yield from flush(False)
                if heads and part:
                    held = []
        if place is not None and held:
            yield from flush(True)

    # One row per split.
    marked = lines.join(F.broadcast(places), ["file", "block"]).select("value", "split", "inside", (F.col("block") == 0).alias("first"))
    return marked.mapInArrow(body, FRAGMENT)


def cleaned(rows: DataFrame) -> DataFrame:
    """Records without their line end; blank ones are left out. The pattern runs only where a carriage return is near the end."""
    ended = F.when(F.right("value", F.lit(2)).contains("\r"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    return rows.withColumn("value", ended).where("value <> ''")


def joined_pieces(lines: DataFrame, places: DataFrame) -> DataFrame:
    """``(value, header)`` of the records that lie in several splits, or that nothing ends."""
    pieces = fragments(lines, places.where("cut")).where("NOT (begins AND ends)").join(F.broadcast(places.select("split", "file", "block")), "split")
    number = F.sum(F.col("begins").cast("int")).over(Window.partitionBy("file").orderBy("block", "part"))  # at most two rows per split
    return pieces.withColumn("record", number).groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "value"))), lambda p: p["value"]), "\n").alias("value"),
        F.bool_or("header").alias("header")).select("value", "header")


def of_places(lines: DataFrame, places: DataFrame) -> DataFrame:
    whole = fragments(lines, places).where("begins AND ends").select("value", "header")
    cut = places.where("cut").limit(1).count()
    return cleaned(whole.unionByName(joined_pieces(lines, places)) if cut else whole)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, header)``: one row per record, without its line end; ``header`` marks the first one of a file. Blank records are left out.

    Tasks read every line once more for the records that lie in several splits, and only in splits that have some.
    """
    lines = lines_of(spark, path)
    return of_places(lines, materialize(splits(lines), "splits"))


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text, named by the header of the first file; other files' headers are skipped."""
    lines = lines_of(spark, path)
    places = materialize(splits(lines), "splits")
    rows = of_places(lines, places)
    heads = materialize(fragments(lines.where("block = 0"), places.where("block = 0"), heads=True), "headers")  # one row per file
    # A header that lies in several splits is found among all records.
    found = rows.where("header") if heads.where("NOT ends").limit(1).count() else cleaned(heads.where("header"))
    header = found.select(F.min("value")).first()[0]
    if header is None:
        return spark.createDataFrame([], "value string").drop("value")
    names = next(csv.reader([header.lstrip("\ufeff")]))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return rows.where("NOT header").select(F.from_csv("value", schema, {"quote": '"', "escape": '"'}).alias("r")).select("r.*")
