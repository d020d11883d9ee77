"""Connected components of an edge table, by alternating large and small stars.

Every round is a grouped minimum and a join on the same key, so a node with very
many edges is pre-aggregated and its join is split by adaptive execution. Rounds
are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orilla.llm import workspace


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation over (u, v) with u > v; the result has the same shape."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node but the smallest of its component, and that smallest node."""
    now = workspace.materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            return now
        mark = tuple(seen)
        before, now = now, workspace.materialize(_star(_star(now, True), False), "edges")
        workspace.discard(before)
