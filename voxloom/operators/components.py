"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation (the least neighbour, combined before the shuffle) and a
join of the edges with it; a node with very many edges is a skewed join key whose edge
side adaptive execution splits.  Edges are written to the shared folder after each
round, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import materialize, release

def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of the edges ``u, v`` (any orderable type).

    The component is its least node.  Loops and repeated edges are allowed, rows with a
    null end are ignored, no edges give no rows.
    """
    clean = edges.where("u is not null and v is not null")
    nodes = clean.where("u = v").select("u", "v")
    e = clean.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "cc")
    seen = _print(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        nxt = materialize(_small_star(_large_star(e)), "cc")
        now = _print(nxt)
        release(e)
        e = nxt
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    alone = nodes.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
