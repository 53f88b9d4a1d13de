"""Connected components by joins and minima only: no node's neighbours are ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import stored


def _pointed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger end (a) to its smaller (b)."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b); root is the smallest node reachable. Loops and repeats are ignored.

    Rounds of two steps hang every node on the smallest neighbour of its smaller neighbours until nothing moves; the
    number of rounds grows with the logarithm of the longest chain. Each round is written before the next.
    """
    now = stored(_pointed(edges.select("a", "b")), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = _pointed(now.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b")))
        down = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(down, F.col("a") == F.col("u")).select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        now = stored(_pointed(small.select("e.a", "e.b")), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
