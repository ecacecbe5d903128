"""Connected components as alternating star contractions, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill.session import materialise


def _towards_minimum(pairs: DataFrame) -> DataFrame:
    """Adds to each (u, v) the smallest of u and all its v.

    The minimum is a partial aggregate, so a hub node costs one row per task; the
    join back is a plain equi-join whose hot side adaptive execution can split.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _towards_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _towards_minimum(down)
    return (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(near.select("u", F.col("m").alias("v"))).where("u != v").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum; two equal marks in a row mean a fixed point."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of every node that has an edge to another node.

    ``component`` is the smallest node of the component.  Repeated edges, loops and
    edges with a NULL end are harmless: the last two are dropped.  An empty table
    gives an empty table.  Each round is written to the shared folder, so lineage
    stays short; there are about log2 of the longest path many rounds.
    """
    now = (edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
           .where("u is not null and v is not null and u != v").distinct())
    now = materialise(now, "edges")
    mark = _mark(now)
    while mark[0]:
        after = materialise(_small_star(_large_star(now)), "stars")
        found = _mark(after)
        if found == mark:
            break
        now, mark = after, found
    # at the fixed point every edge is (node, smallest node)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
