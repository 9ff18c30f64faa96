"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from caseflow.llm.tables import materialize


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges written once, and their number and a sum of hashes, both taken while they are written."""
    seen = Observation()
    observed = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    return materialize(observed, "edges"), (seen.get["n"], seen.get["h"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (its smallest node) for every node of a link.

    A large-star step hangs each node's larger neighbours under the smallest node beside it; a small-star
    step does so with the smaller ones. Steps alternate until the edges are stars and no longer change. Each
    step is a grouped minimum with map-side partial minima, and a join with what it gave. The minima of the
    large-star step are written first: a hub's rows then meet a plain table, and Spark can split them.
    Links with a null end, from a node to itself, and repeated links add nothing.
    """
    ends = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges, state = _stored(ends.distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "nearest")
        large = materialize(both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select("u", "v", "m")
        small = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))
        before = state
        edges, state = _stored(small.distinct())
        if state == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
