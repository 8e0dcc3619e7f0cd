"""Approximate nearest neighbours by inner product: a navigable small-world graph with layers for each shard, shard results merged.

Vectors get one more coordinate that brings them all to the largest norm, so that the largest inner product is the nearest point. A shard's graph
is a matrix of neighbour numbers for each layer (-1 where there is none), written as flat arrays in one row per shard: a table that later
searches read. Points enter a graph in small batches: each batch is searched in the graph so far, its points are compared with each other, neighbours are
chosen for diversity and filled up, and full lists of their neighbours are pruned by the same rule. Searches walk many queries in step.

Each graph is tried when it is built: the beam of its searches is the smallest of ``BEAMS`` that finds ``LEAST_RECALL`` of the true neighbours of some of its own
points, compared with exact scores. If none does, which is so for vectors without any structure and many components, the shard is scored exactly.

Equal vectors are one node, so copies do not fill each other's lists or a beam. A node carries the ids of its rows, of many copies the ``k`` + 1 smallest,
which is exact for the best ``k`` without the query. Every valid row has its node and every query meets every shard, in blocks; the beam's vectors are scored
again in double precision. Should a query reach fewer rows than wanted in a shard, that shard's other nodes are scored too, so short tables give all their rows.

Vectors are compared with those of their own length. Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without id.
Rows with the same id are neighbours of their own, but never of a query with that id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.arrow import gather, map_batches, ragged
from casemill.llm.embed_dedup import usable
from casemill.session import materialize_plain as materialize

LINKS = 16
BUILD_BEAM = 64
BEAMS = (128, 256, 512, 1_024)
LEAST_RECALL, TRIED, TRIED_NEAREST = 0.95, 96, 20
EXACT = 0  # the beam of a shard that is scored exactly
SHARD_ROWS = 8_192
QUERY_ROWS = 16_384
BATCH = 128
STEP = 4
INDEX_SCHEMA = "dims int, shard int, size int, ids binary, counts binary, vectors binary, entry int, layers array<binary>, beam int"


def beam_search(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of a beam per query, best first; -1 where the beam is not full."""
    n = queries.shape[0]
    ids = np.full((n, beam), -1, np.int64)
    near = np.full((n, beam), -np.inf, np.float32)
    done = np.ones((n, beam), bool)
    visited = np.zeros((n, points.shape[0] + 1), bool)  # the last column stands for "no node"
    visited[:, -1] = True
    width = min(beam, entries.shape[1])
    ids[:, :width] = entries[:, :width]
    near[:, :width] = np.where(ids[:, :width] >= 0, np.einsum("qkd,qd->qk", points[ids[:, :width]], queries), -np.inf)
    done[:, :width] = ids[:, :width] < 0
    np.put_along_axis(visited, ids[:, :width], True, axis=1)
    active = np.arange(n)
    while active.size:
        open_ = np.where(done[active], -np.inf, near[active])
        pick = np.argsort(-open_, axis=1, kind="stable")[:, :STEP]
        real = np.take_along_axis(open_, pick, axis=1) > -np.inf
        live = real.any(axis=1)
        active, pick, real = active[live], pick[live], real[live]
        if not active.size:
            break
        at = np.where(real, ids[active[:, None], pick], -1)
        done[active[:, None], pick] = True
        new = np.where(at[:, :, None] >= 0, links[at], -1)
        for k in range(new.shape[1]):
            one = new[:, k]
            one[visited[active[:, None], one]] = -1
            visited[active[:, None], one] = True
        new = new.reshape(active.size, -1)
        # Only the fresh nodes are fetched.
        row, col = np.nonzero(new >= 0)
        fresh = new[row, col]
        sims = np.full(new.shape, -np.inf, np.float32)
        sims[row, col] = np.einsum("ij,ij->i", points[fresh], queries[active[row]])
        all_ids, all_near = np.hstack([ids[active], new]), np.hstack([near[active], sims])
        all_done = np.hstack([done[active], new < 0])
        top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        ids[active], near[active], done[active] = (np.take_along_axis(x, top, axis=1) for x in (all_ids, all_near, all_done))
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(np.where(near > -np.inf, ids, -1), order, axis=1), np.take_along_axis(near, order, axis=1)


def choose(points: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates: those nearer to the row's point than to any candidate chosen before, then the nearest of the rest."""
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
    n, width = ids.shape
    valid = near > -np.inf
    out = np.full((n, most), -1, np.int64)
    for first in range(0, n, 64):
        rows = slice(first, first + 64)
        vectors = points[ids[rows]]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        closest = np.full(ids[rows].shape, -np.inf, np.float32)
        chosen = np.zeros(ids[rows].shape, bool)
        for k in range(width):
            take = valid[rows][:, k] & (near[rows][:, k] > closest[:, k]) & (chosen.sum(axis=1) < most)
            chosen[:, k] = take
            closest = np.where(take[:, None], np.maximum(closest, between[:, k]), closest)
        rank = np.where(chosen, 0, np.where(valid[rows], 1, 2)) * width + np.arange(width)
        best = np.argsort(rank, axis=1)[:, :most]
        got = np.where(np.take_along_axis(valid[rows], best, axis=1), np.take_along_axis(ids[rows], best, axis=1), -1)
        out[rows, : got.shape[1]] = got
    return out


@dataclass
class Graph:
    """Points (unit-norm after the extra coordinate, float32), the entry point, and a neighbour matrix per layer."""

    points: np.ndarray
    entry: int
    layers: list[np.ndarray]

    def entries(self, queries: np.ndarray, down_to: int = 0) -> np.ndarray:
        at = np.full((queries.shape[0], 1), self.entry, np.int64)
        for links in self.layers[:down_to:-1]:
            at = beam_search(self.points, links, queries, at, 4)[0]
        return at

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        return beam_search(self.points, self.layers[0], queries, self.entries(queries), beam)[0]


def connect(points: np.ndarray, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Set the lists of the new nodes and add them to their neighbours' lists; a list that gets too long is chosen anew."""
    most = links.shape[1]
    links[new, : chosen.shape[1]] = chosen
    row, col = np.nonzero(chosen >= 0)
    to, back = chosen[row, col], new[row]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    nodes, starts, counts = np.unique(to, return_index=True, return_counts=True)
    have = (links[nodes] >= 0).sum(axis=1)
    place = have[np.searchsorted(nodes, to)] + np.arange(to.size) - np.repeat(starts, counts)
    fits = np.repeat(have + counts <= most, counts)
    links[to[fits], place[fits]] = back[fits]
    crowded = np.flatnonzero(have + counts > most)
    if crowded.size:
        wide = np.full((crowded.size, most + int(counts[crowded].max())), -1, np.int64)
        wide[:, :most] = links[nodes[crowded]]
        index = np.repeat(np.arange(nodes.size), counts)
        over = ~fits
        rank = np.searchsorted(crowded, index[over])
        wide[rank, place[over]] = back[over]
        near = np.where(wide >= 0, np.einsum("nkd,nd->nk", points[wide], points[nodes[crowded]]), -np.inf).astype(np.float32)
        links[nodes[crowded]] = choose(points, wide, near, most)


def build(points: np.ndarray, seed: int = 1) -> Graph:
    n = points.shape[0]
    levels = np.minimum(np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)), 6).astype(int)
    if n:
        levels[0] = levels.max()
    top = int(levels.max()) if n else 0
    layers = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int64) for k in range(top + 1)]
    graph = Graph(points, 0, layers)
    first = 1
    while first < n:
        batch = np.arange(first, min(n, first + min(BATCH, max(1, first // 4))))
        queries = points[batch]
        at = np.zeros((batch.size, 1), np.int64)
        for k in range(top, -1, -1):
            into = np.flatnonzero(levels[batch] >= k)
            found, near = beam_search(points, layers[k], queries, at, BUILD_BEAM if into.size else 4)
            at = found[:, :8]
            if into.size:
                peers = batch[into]
                between = queries[into] @ queries[into].T
                between[np.arange(into.size)[:, None] <= np.arange(into.size)[None, :]] = -np.inf  # earlier ones of the batch only
                ids = np.hstack([found[into], np.broadcast_to(peers, (into.size, into.size))])
                sims = np.hstack([near[into], between.astype(np.float32)])
                connect(points, layers[k], peers, choose(points, *nearest(ids, sims, BUILD_BEAM), LINKS))
        first = int(batch[-1]) + 1
    return graph


def nearest(ids: np.ndarray, near: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    top = np.argsort(-near, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, top, axis=1), np.take_along_axis(near, top, axis=1)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with the coordinate that brings them to the largest norm, scaled by it; the largest component is taken out first, so that no square gets lost."""
    scaled = vectors / max(np.abs(vectors).max(initial=0), np.finfo(float).tiny)
    squares = (scaled**2).sum(axis=1)
    longest = squares.max(initial=0)
    return (np.column_stack([scaled, np.sqrt(np.maximum(longest - squares, 0))]) / np.sqrt(longest)).astype(np.float32)


def directions(queries: np.ndarray) -> np.ndarray:
    """Queries of norm 1 with a zero for the extra coordinate."""
    scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
    return np.column_stack([scaled / np.linalg.norm(scaled, axis=1, keepdims=True), np.zeros(len(queries))]).astype(np.float32)


def tried_beam(graph: Graph, vectors: np.ndarray) -> int:
    """The smallest beam that finds enough of the nearest points of evenly picked ones; ``EXACT`` if none does."""
    n = len(vectors)
    if n <= TRIED_NEAREST:
        return EXACT
    own = np.unique(np.linspace(0, n - 1, TRIED).astype(int))
    queries = directions(vectors[own])
    sims = queries @ graph.points.T
    sims[np.arange(own.size), own] = -np.inf
    border = np.partition(sims, n - TRIED_NEAREST, axis=1)[:, n - TRIED_NEAREST, None]
    for beam in BEAMS:
        found = graph.search(queries, beam)
        hit = (np.where(found >= 0, np.take_along_axis(sims, np.maximum(found, 0), axis=1), -np.inf) >= border).sum(axis=1)
        if np.minimum(hit, TRIED_NEAREST).mean() >= LEAST_RECALL * TRIED_NEAREST:
            return beam
    return EXACT


def nodes_of(valid: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: its smallest vec_id, the vector, and its ids (the ``k`` + 1 smallest, each up to ``k`` times if rows repeat it)."""
    keyed = materialize(valid.withColumn("one", F.xxhash64("vector")).withColumn("two", F.xxhash64(F.reverse("vector"))), "keyed")
    ids = keyed.groupBy("one", "two", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))
    place = Window.partitionBy("one", "two").orderBy("vec_id")
    ids = ids.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)  # limited in each task before the shuffle
    members = ids.groupBy("one", "two").agg(F.sort_array(F.flatten(F.collect_list(F.expr("array_repeat(vec_id, times)")))).alias("members"))
    return keyed.groupBy("one", "two").agg(F.first("vector").alias("vector")).join(members, ["one", "two"]).select(F.col("members")[0].alias("vec_id"), "vector", "members")


def index(nodes: DataFrame, shard_rows: int) -> DataFrame:
    """One row per shard with its graph; ``nodes`` has vec_id, vector (array of double) and members (the ids of the rows with that vector)."""

    def make(rows: pa.Table) -> pa.Table:
        ids = rows["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        members = rows["members"].combine_chunks()
        counts = np.diff(members.offsets.to_numpy())
        starts = ragged(counts)[:-1]
        flat = rows["vector"].combine_chunks().flatten().to_numpy().reshape(ids.size, -1)[order]
        graph = build(lifted(flat))
        return pa.table({
            "dims": pa.array([rows["dims"][0].as_py()], pa.int32()), "shard": pa.array([rows["shard"][0].as_py()], pa.int32()), "size": pa.array([ids.size], pa.int32()),
            "ids": pa.array([members.flatten().to_numpy()[gather(starts[order], counts[order])].astype(np.int64).tobytes()]),
            "counts": pa.array([counts[order].astype(np.int64).tobytes()]),
            "vectors": pa.array([flat.tobytes()]), "entry": pa.array([graph.entry], pa.int32()),
            "layers": pa.array([[x.astype(np.int32).tobytes() for x in graph.layers]], pa.list_(pa.binary())), "beam": pa.array([tried_beam(graph, flat)], pa.int32())})

    sized = nodes.withColumn("dims", F.size("vector"))
    shards = materialize(sized.groupBy("dims").agg(F.floor(F.count("*") / shard_rows + 1).cast("int").alias("shards")), "sizes")
    return sized.join(shards, "dims").withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards")).cast("int")).groupBy("dims", "shard").applyInArrow(make, INDEX_SCHEMA)


def best_of_shard(ids: np.ndarray, counts: np.ndarray, flat: np.ndarray, graph: Graph, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, ...]:
    """(query number, vec_id, score) of the best ``k`` rows of a shard for each query; ``ids`` has the rows of the nodes one after the other."""
    rows, found, scores = [], [], []
    unit, starts = directions(queries), ragged(counts)[:-1]

    def rows_of(at: np.ndarray, score: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        of, score = ids[gather(starts[at], counts[at])], np.repeat(score, counts[at])
        return of[of != own], score[of != own]

    for first in range(0, len(queries), BATCH):
        q = queries[first : first + BATCH]
        if beam == EXACT:  # rounding may swap the last few, so some more are scored again
            sims = unit[first : first + BATCH] @ graph.points.T
            most = min(2 * k + 8, counts.size)
            nodes = np.argpartition(-sims, most - 1, axis=1)[:, :most]
        else:
            nodes = graph.search(unit[first : first + BATCH], max(beam, k + 1))
        dots = exact(flat[nodes], q[:, None, :])
        for i in range(len(q)):
            real = nodes[i] >= 0
            of, score = rows_of(nodes[i][real], dots[i][real], query_ids[first + i])
            if of.size < k and np.count_nonzero(real) < counts.size:
                of, score = rows_of(np.arange(counts.size), exact(flat, q[i]), query_ids[first + i])
            order = np.lexsort((of, -score))[:k]
            rows.append(np.full(order.size, first + i))
            found.append(of[order])
            scores.append(score[order])
    return tuple(np.concatenate([*x, np.zeros(0, x[0].dtype if x else np.int64)]) for x in (rows, found, scores))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=-1)


def search(graphs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the best ``k`` of every shard; ``queries`` has vec_id and vector."""
    sized = queries.withColumn("dims", F.size("vector"))
    blocks = sized.groupBy("dims").agg(F.floor(F.count("*") / QUERY_ROWS + 1).cast("int").alias("blocks"))
    packed = (sized.join(materialize(blocks, "blocks"), "dims").withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).cast("int"))
              .groupBy("dims", "block").agg(F.sort_array(F.collect_list(F.struct("vec_id", "vector"))).alias("q")))  # about QUERY_ROWS rows each
    # Every block meets every shard of its length; cells are dealt out one by one, as each is minutes of work at most.
    cells = graphs.join(materialize(packed, "queries"), "dims").repartition(F.col("dims"), F.col("shard"), F.col("block"))

    def make():
        def step(part: pa.RecordBatch):
            for row in range(part.num_rows):
                cell = {name: part.column(i)[row] for i, name in enumerate(part.schema.names)}
                ids, counts = (np.frombuffer(cell[name].as_buffer(), np.int64) for name in ("ids", "counts"))
                dims, beam = cell["dims"].as_py(), cell["beam"].as_py()
                flat = np.frombuffer(cell["vectors"].as_buffer(), np.float64).reshape(counts.size, dims)
                layers = [np.frombuffer(x.as_buffer(), np.int32).reshape(counts.size, -1).astype(np.int64) for x in cell["layers"]]
                graph = Graph(lifted(flat), cell["entry"].as_py(), layers)
                asked = cell["q"].values
                query_ids = asked.field("vec_id").to_numpy()
                vectors = asked.field("vector").flatten().to_numpy().reshape(query_ids.size, dims)
                at, found, scores = best_of_shard(ids, counts, flat, graph, query_ids, vectors, k, beam)
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[at]), pa.array(found), pa.array(scores)], names=["query_id", "vec_id", "score"])

        return step

    names = ["dims", "beam", "ids", "counts", "vectors", "entry", "layers", "q"]
    return map_batches(cells.select(*names), make, "query_id bigint, vec_id bigint, score double")


def nearest_neighbours(rows: DataFrame, is_query: F.Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of every query row; ``is_query`` is a condition on vec_id."""
    valid = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector")).where(f"vec_id IS NOT NULL AND {usable('vector')}")
    valid = materialize(valid, "vectors")
    graphs = materialize(index(materialize(nodes_of(valid, k), "nodes"), shard_rows), "graphs")
    found = search(graphs, valid.where(is_query), k)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
