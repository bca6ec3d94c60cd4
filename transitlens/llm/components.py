"""Connected components by alternating large-star and small-star steps (joins and minima, no collected groups)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import free, written


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """One star step over edges (u, v), u > v. ``both``: large-star, else small-star."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = near.join(least, "u")
    if both:        # greater neighbours go to the least of the neighbourhood
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:           # smaller neighbours and the node itself go to the least
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge but the roots: ``label`` is the least node of its component.

    ``edges`` has columns u, v of one orderable type (structs too); self-links and null ends are ignored. The number of
    rounds grows with the logarithm of the component's size; every round is written to the shared folder.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "edges")
    seen = None
    while True:
        old, now = now, written(_stars(_stars(now, True), False), "stars")
        free(old)
        # a fixpoint has equal edges; count and hash sum stand for the set
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state
