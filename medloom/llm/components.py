"""Connected components of an edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.sources.storage import materialize


def _minimum(pairs: DataFrame) -> DataFrame:
    """Each row (u, v) with the least of u and its v as m. A hot u is split, as both sides shuffle as they are."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(materialize(least, "star"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _minimum(both).filter("v > u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _minimum(down)
    pairs = found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(found.selectExpr("u", "m AS v"))
    return pairs.filter("u != v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list (u, v) of longs; the root is the component's least node.

    Each round writes its edges below the shared folder, so that neither the
    lineage grows nor a lost executor costs more than one round. Stops when a
    round leaves the set of edges as it was: then every edge leads to a root.
    Nodes without an edge, loops and repeated edges give no extra rows.
    """
    edges = materialize(edges.filter("u != v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        edges = materialize(_small_star(materialize(_large_star(edges), "edges")), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
