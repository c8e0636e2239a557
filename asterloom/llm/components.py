"""Connected components of an edge list, by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterloom.llm.chunks import stage


def components(edges: DataFrame, limit: int = 100) -> DataFrame:
    """``(node, root)`` for each node of ``(a, b)`` edges: the smallest node of its component.

    Each round links the neighbours of every node with the smallest one among them (large star,
    then small star), as minima and joins only: no group of neighbours is brought together, so a
    node may have any number of them. A round's edges are written to the shared folder, and the
    rounds end when they stay the same. More rounds than ``limit`` are an error.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "edges")
    before = None
    for _ in range(limit):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours of a go to the smallest neighbour of a (or a itself).
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), "edges")
        # Small star: smaller neighbours of a, and a, go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = stage(small.filter("a <> b").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
    raise RuntimeError(f"components did not settle in {limit} rounds")
