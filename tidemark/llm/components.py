"""Connected components of an edge table by alternating star steps, and nothing held in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``a`` > ``b``: neighbours move to the smallest node of the neighbourhood."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = around.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows ``node``, ``component`` (its smallest node) for the nodes of ``links`` (``a``, ``b``: long) that are not the smallest.

    Edges between a node and itself, repeated edges and either direction are allowed. Each round writes its
    edges to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, seen = stored(edges, "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
        edges = stored(_stars(stored(_stars(edges, large=True), "edges"), large=False), "edges")
