"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import save


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has one edge, to its centre."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("centre")).union(
        edges.select("lo", F.lit(0), F.lit(1))
    )
    degrees = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("centre").alias("centre"))
    return degrees.where("out > 1 OR (out = 1 AND centre = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; a component is named by its smallest node.

    Large-star and small-star steps in turn, until the edges are stars around the smallest node:
    a number of rounds that is logarithmic in the longest path. A node's smallest neighbour is a
    partial aggregate and is written before it is joined, so both sides of the join are plain
    scans and adaptive execution splits a hub that holds a large part of all edges. Nothing but
    one answer a round reaches the driver. Edges with a null end, loops and repeated edges are
    ignored; no edges give no rows.
    """
    known = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    ends = edges.where(known).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    stars = save(ends.distinct(), "edges")
    while not _are_stars(stars):
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(stars.select("lo", "hi"))
        least = save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = save(large.where("hi != lo").distinct(), "large-star")
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(smallest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi != lo")
        stars = save(moved.union(smallest.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
    centres = stars.select(F.col("lo").alias("node")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        centres.select("node", F.col("node").alias("component"))
    )
