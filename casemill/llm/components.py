"""Connected components of an edge table, by alternating stars.

Large stars point every larger neighbour of a node at the smallest of its neighbourhood, small stars point the smaller ones there; edges only ever get
replaced by shorter ways to the component's smallest node. A node with very many edges is no bottleneck: minima are combined before
they are shuffled, and the join back deals a node's edges over ``SALTS`` parts. Every round is a written table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.session import materialize_plain as materialize


SALTS = 16


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return both.where("v > u").withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(low, ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) of every node with an edge to another: the smallest node reachable from it."""
    at = materialize(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct(), "edges")
    seen = state(at)
    while seen[0]:
        at = materialize(small_star(large_star(at)), "edges")
        now = state(at)
        if now == seen:
            break
        seen = now
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")).union(at.select("v", "v").distinct())


def local_leads(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index linked with each of ``n`` rows, directly or over others."""
    lead = np.arange(n)
    while True:
        low = np.minimum(lead[left], lead[right])
        new = lead.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == lead).all():
            return lead
        lead = new
