"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the least of the node and its neighbours."""
    both = _mirrored(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    found = both.filter("b > a").join(least, "a")
    return found.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.withColumnRenamed("m", "b")).filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def roots(edges: DataFrame) -> DataFrame:
    """node, root: for each node that isn't the least of its component, that least node.

    ``edges`` has columns a and b of one type; no row may have a null or a = b. Neither
    nodes nor edges pass through the driver; a node with many neighbours is summed per
    task, and its edges are split by the skew join.
    """
    edges = stored(edges.distinct(), "edges")
    state = _state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
