"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors with cosine ``threshold`` or more lie within a known distance, so their projections on a random direction differ by little: within a window of
``WIDTH`` standard deviations of that difference, around the query's own projection, they collide with a known probability. Over many projections
the number of collisions of a pair is binomial; :func:`calibrated` gives the largest count that linked pairs reach with the wanted recall. Pairs that reach
it are verified by their cosine in double precision. The projection that deals the vectors into blocks has a wider window of its own (:func:`reach`), as a
pair outside it is never compared. Each of the two may miss half of what the wanted recall allows.

Only vectors of the same label and length are compared. Vectors with equal components are one class of copies. A label's vectors are sorted by
the first projection into blocks; blocks whose ranges come within the reach of each other form a cell. Cells count collisions in tiles and return, per
vector, the weight of its links and the smallest vector linked with it: no pair leaves a cell. The number of pairs that are looked at still grows
with the square of a label's vectors.

Vectors that are null, zero, or hold null or non-finite components, and rows with a null label link with nothing. Rows without id are left out of the
result; rows that share an id are vectors of their own, each with a row in the result. Norms are taken after division by the largest component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.arrow import gather, list_array, map_batches, ragged, with_columns
from casemill.llm.components import components, local_leads
from casemill.session import materialize_plain as materialize

PROJECTIONS = 32
WIDTH = 2.5
RECALL = 0.999999
BLOCK = 512
CUTS = 64
DENSE = 8


def calibrated(projections: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> int:
    """The largest number of collisions that a pair at the threshold reaches with probability ``recall``."""
    hit = math.erf(width / math.sqrt(2))
    tail = 0.0
    for count in range(projections, -1, -1):
        tail += math.comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
        if tail >= recall:
            return count
    return 0


def reach(recall: float = RECALL) -> float:
    """Standard deviations within which one projection of a pair at the threshold differs with probability ``recall``."""
    return NormalDist().inv_cdf((1 + recall) / 2)


def directions(size: int, projections: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, projections))


def usable(embedding: str) -> str:
    """SQL condition: a vector without null or non-finite components that is not zero."""
    return (f"{embedding} IS NOT NULL AND size({embedding}) > 0 AND NOT exists({embedding}, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
            f" AND exists({embedding}, x -> x <> 0)")


def direction(size: int) -> np.ndarray:
    """The direction that orders the vectors of a length, as long as directions are on average."""
    first = directions(size, PROJECTIONS)[:, 0]
    return first * (math.sqrt(size) / np.linalg.norm(first))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of norm 1; the largest component is taken out first, so that no square gets lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def projected(rows: DataFrame) -> DataFrame:
    """``rows`` with the unit vector instead of the vector, and its projection on the direction of its length."""
    keep = [c for c in rows.columns if c != "vector"]

    def make():
        through: dict[int, np.ndarray] = {}

        def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            column = part.column(part.schema.get_field_index("vector"))
            sizes = column.value_lengths().to_numpy()
            starts, flat = ragged(sizes)[:-1], column.flatten().to_numpy(zero_copy_only=False)
            at, unit = np.zeros(sizes.size), np.zeros(flat.size)
            for size in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == size)
                places = gather(starts[of], sizes[of])
                found = units(flat[places].reshape(of.size, size))
                at[of] = found @ through.setdefault(size, direction(size))
                unit[places] = found.ravel()
            yield with_columns(part, {"at": pa.array(at), "vector": list_array(unit, ragged(sizes), pa.float64())}, keep)

        return step

    kept = rows.select(*keep, "vector")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "vector"]
    return map_batches(kept, make, ", ".join([*fields, "at double", "vector array<double>"]))


def cells_of(rows: DataFrame, span: float, block: int) -> DataFrame:
    """``rows`` once per cell, with columns cell, part (the row's block) and across (whether the cell pairs two blocks).

    A label is cut into ranges of about equal size along the projection, as many as it fills blocks but ``CUTS`` at most, and a range into as many blocks as
    its rows need, dealt by a hash: the array of borders has a fixed length however large a label is, and blocks of one range meet anyway.
    """
    cuts = rows.groupBy("label").agg(F.percentile_approx("at", [i / CUTS for i in range(1, CUTS)], 100 * CUTS).alias("cuts"),
                                     F.least(F.ceil(F.count("*") / block), F.lit(CUTS)).alias("ranges"))
    cuts = materialize(cuts, "cuts")  # written, so that Spark knows how small it is and leaves a hot label's rows where they are
    # Of ``CUTS`` equal ranges a small label joins neighbours until its blocks are full.
    ranged = rows.join(cuts, "label").withColumn("range", (F.expr("size(filter(cuts, c -> c < at))") * F.col("ranges") / CUTS).cast("int")).drop("cuts", "ranges")
    ranged = materialize(ranged, "ranged")
    spans = materialize(ranged.groupBy("label", "range").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.ceil(F.count("*") / block).cast("int").alias("blocks")), "ranges")
    a, b = spans.alias("a"), spans.alias("b")
    near = (a.join(b, F.expr(f"a.label = b.label AND a.low <= b.high + {span} AND b.low <= a.high + {span}"))
            .groupBy(F.col("a.label").alias("label"), F.col("a.range").alias("range")).agg(
                F.first("a.blocks").alias("blocks"), F.flatten(F.collect_list(F.expr("transform(sequence(0, b.blocks - 1), k -> struct(b.range as range, k as block))"))).alias("others")))
    part = F.struct("range", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    return (ranged.join(materialize(near, "near"), ["label", "range"]).withColumn("own", part).withColumn("other", F.explode("others"))
            .withColumn("cell", F.xxhash64("label", F.least("own", "other"), F.greatest("own", "other")))
            .withColumn("across", F.col("own") != F.col("other")).withColumn("part", F.col("own") > F.col("other"))
            .select("cell", "across", "part", "node", "copies", "vector"))


def linked_pairs(left: np.ndarray, right: np.ndarray, same: bool, threshold: float, window: float, count: int, through: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two tiles of unit vectors whose collisions reach ``count`` and whose cosine is at least ``threshold``."""
    a, b = (left @ through).astype(np.float32), (right @ through).astype(np.float32)
    hits = np.zeros((a.shape[0], b.shape[0]), np.int8)
    for k in range(DENSE):
        hits += np.abs(a[:, k, None] - b[None, :, k]) <= window
    one, two = np.nonzero(hits >= count - (through.shape[1] - DENSE))
    if same:
        one, two = one[one < two], two[one < two]
    total = hits[one, two].astype(np.int64)
    for k in range(DENSE, through.shape[1]):
        total += np.abs(a[one, k] - b[two, k]) <= window
        open_ = total >= count - (through.shape[1] - 1 - k)
        if k % 4 == 3 and not open_.all():
            one, two, total = one[open_], two[open_], total[open_]
    passed = total >= count
    one, two = one[passed], two[passed]
    found = [np.zeros(0, bool)]
    for first in range(0, one.size, 100_000):
        found.append(np.einsum("ij,ij->i", left[one[first : first + 100_000]], right[two[first : first + 100_000]]) >= threshold)
    ok = np.concatenate(found)
    return one[ok], two[ok]


def links_within(cell: pa.Table, threshold: float, window: float, count: int) -> pa.Table:
    ids, copies, parts = cell["node"].to_numpy(), cell["copies"].to_numpy(), cell["part"].to_numpy(zero_copy_only=False)
    vectors = cell["vector"].combine_chunks().flatten().to_numpy().reshape(ids.size, -1)  # a cell has one length
    across, through = bool(cell["across"][0].as_py()), directions(vectors.shape[1], PROJECTIONS)
    sides = (np.flatnonzero(~parts), np.flatnonzero(parts)) if across else (np.arange(ids.size),) * 2
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, sides[0].size, BLOCK):
        for j in range(i if not across else 0, sides[1].size, BLOCK):
            a, b = sides[0][i : i + BLOCK], sides[1][j : j + BLOCK]
            x, y = linked_pairs(vectors[a], vectors[b], not across and i == j, threshold, window, count, through)
            one.append(a[x])
            two.append(b[y])
    left, right = np.concatenate(one), np.concatenate(two)
    linked = np.bincount(left, copies[right], ids.size) + np.bincount(right, copies[left], ids.size)
    order = np.argsort(ids)
    place = np.argsort(order)
    leads = ids[order][local_leads(ids.size, place[left], place[right])][place]
    keep = linked > 0
    return pa.table({"node": ids[keep], "linked": linked[keep].astype(np.int64), "lead": leads[keep]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"), F.col(label).alias("label")).where("vec_id IS NOT NULL")
    usable_row = F.expr(f"label IS NOT NULL AND {usable('vector')}")
    rows = materialize(rows.select("vec_id", F.when(usable_row, F.struct("label", F.size("vector").alias("size"))).alias("label"), F.when(usable_row, F.col("vector")).alias("vector"))
                       .withColumn("one", F.xxhash64("vector")).withColumn("two", F.xxhash64(F.reverse("vector"))), "vectors")
    # A class of copies is a node; rows may share an id, so nodes have numbers of their own.
    classes = rows.where("label IS NOT NULL").groupBy("label", "one", "two").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))
    nodes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    deviation = math.sqrt(2 - 2 * threshold)
    each = 1 - (1 - RECALL) / 2
    count, window, span = calibrated(recall=each), WIDTH * deviation, reach(each) * deviation

    def verify(cell: pa.Table) -> pa.Table:
        return links_within(cell, threshold, window, count)

    dealt = cells_of(projected(nodes.select("node", "label", "vector", "copies")), span, block)
    found = materialize(dealt.groupBy("cell").applyInArrow(verify, "node bigint, linked bigint, lead bigint"), "links")
    joined = components(found, "node", "lead")
    counted = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    known = nodes.drop("vector").join(joined, "node", "left").join(counted, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = materialize(known, "known")
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    by_class = known.join(lowest, "component").select("label", "one", "two", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return (rows.select("vec_id", "label", "one", "two").join(by_class, ["label", "one", "two"], "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
