"""Connected components as DataFrame jobs (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from deskmart.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select("dst", "src"))
    least = (both.groupBy("src").agg(F.min("dst").alias("low"))
             .select("src", F.least("src", "low").alias("low")))
    return (both.where("dst > src").join(least, "src")
            .select(F.col("dst").alias("src"), F.col("low").alias("dst")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them. Needs src > dst."""
    least = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = (edges.join(least, "src").where("dst > low")
             .select(F.col("dst").alias("src"), F.col("low").alias("dst")))
    return moved.union(least.select("src", F.col("low").alias("dst")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of undirected ``edges`` (src, dst); the component is named
    after its least node. Self-links and nulls are left out; nodes may be of any ordered type.

    Both stars replace edges by edges to a node's least neighbour, so a hub is one aggregate with
    map-side combine and the joins are plain equi-joins that adaptive execution can split. Each
    round is one job: it is written below the shared checkpoint folder, and two sums that tell whether edges changed are
    observed while it is written. Rounds are about logarithmic in the longest path.
    """
    edges = edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    before = None
    while True:
        seen = Observation()
        moved = _small_star(_large_star(edges)).distinct().observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("sum"))
        edges = written(moved, "edges")
        state = (seen.get["n"], seen.get["sum"])
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.union(edges.select("dst", "dst").distinct())
