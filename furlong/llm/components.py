"""Connected components of links between documents, as DataFrame jobs.

Alternating large-star and small-star steps: every node's neighbours are
hung on the smallest one, until nothing moves.  A step is one map-side
combined minimum per node and one join, so no group of links is ever
collected; adaptive execution splits the join of a node with very many
links.  Every round is written to the shared folder, and the one before is
deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import discard, staged


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """``edges`` (a, b): large star links every larger neighbour of a node with
    the smallest of the node and its neighbours; small star links the smaller
    neighbours and the node itself."""
    if small:
        e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = e.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m")).withColumn("_m", F.least("_u", "_m"))
    joined = e.join(low, e["u"] == low["_u"])
    if small:
        moved = joined.select(F.col("v").alias("a"), F.col("_m").alias("b")).unionByName(
            low.select(F.col("_u").alias("a"), F.col("_m").alias("b")))
    else:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("_m").alias("b"))
    return moved.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns a, b: long):
    the smallest node that links reach, itself included.  Null ends and loops
    are ignored; no links give no rows.  Runs jobs."""
    e = staged(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               "links")
    sign = None
    while True:
        before, e = e, staged(_star(_star(e, small=False), small=True), "links")
        discard(before)
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == sign:
            break
        sign = (now["n"], now["h"])
    roots = e.select(F.col("b").alias("node")).distinct()
    out = e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
    out._staged_at = e._staged_at  # so that it can be discarded
    return out
