"""Connected components of a graph given as edges, as joins and groupings.

Large and small stars in turn: every node passes its larger (then its smaller)
neighbours on to the least one.  A few rounds leave one star per component,
however long its chains.  Least neighbours are stored before they are joined, so
both sides of the join arrive by their own shuffle and Spark can split a node
with many edges.  Each round is cut off by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _least(edges: DataFrame) -> DataFrame:
    """Least neighbour of every node ``u``, itself included."""
    return cut_lineage(edges.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("_m")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), F.col("u") == F.col("_u"))
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("_m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_least(down), F.col("u") == F.col("_u"))
    passed = joined.where(F.col("v") != F.col("_m")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return passed.union(joined.select("u", F.col("_m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's least node) for every node with an edge (u, v)."""
    now = cut_lineage(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seal = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if tuple(mark) == seal:
            break
        seal = tuple(mark)
        now = cut_lineage(_small_star(_large_star(now).distinct()).where(F.col("u") != F.col("v")).distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
