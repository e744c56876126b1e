"""Bounded traversal of link graphs by iterated anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.session import cut


def reachable(seeds: DataFrame, edges: DataFrame, depth: int, guard: int | None = None) -> DataFrame:
    """(node, depth): nodes reached from the seeds (node) over edges (src, dst) in at most `depth` steps, at their least depth. Each
    frontier is written, so plans stay short; guard stops after the step that reaches that many nodes."""
    seen = cut(seeds.select("node").distinct().withColumn("depth", F.lit(0)), "seen")
    frontier = seen
    for step in range(1, depth + 1):
        found = frontier.join(edges, frontier.node == edges.src).select(F.col("dst").alias("node")).distinct()
        frontier = cut(found.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(step)), "frontier")
        n = frontier.count()
        if n == 0:
            break
        seen = seen.unionByName(frontier)
        if guard is not None and seen.count() >= guard:
            break
    return seen
