"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _oriented(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of longs in, ``(node, root)`` out, root being the smallest node that can be reached.

    Each round joins every node's edges with the least neighbour of that node, first towards larger nodes and then
    towards smaller ones, until the edge set no longer changes; the number of rounds grows with the logarithm of the
    longest path. Every step is an aggregate with map-side combining or an equi-join, and each round is written to the
    shared folder. Null ends are dropped, loops and repeated edges have no effect, an empty table gives an empty one.
    """
    now = staged(_oriented(edges.select("u", "v").where("u is not null and v is not null"), "u", "v"), "cc")
    sign = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    mark = sign(now)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("m", "u").alias("m"))
        large = both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = large.join(low, F.col("u") == F.col("n"))
        links = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        then = staged(_oriented(links, "a", "b"), "cc")
        discard(now)
        now, was = then, mark
        mark = sign(now)
        if mark == was:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
