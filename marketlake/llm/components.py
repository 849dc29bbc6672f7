"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_written, written


def _stars(edges: DataFrame) -> DataFrame:
    """One round: the neighbours of each node that are larger, then those that are smaller, are hung on the smallest."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    # now v < u in every edge: v are the smaller neighbours of u
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(down, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
    return small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of edges (u, v: longs), roots not listed.

    Alternates large-star and small-star rounds until every edge leads to a root. Edges stay in Spark: each round
    joins them with the smallest neighbour of their node, so no task holds the neighbours of a node together, and is
    written to the shared folder, which ends the lineage. The driver sees two numbers a round.
    """
    now, before = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"), None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, last = mark, now
        now = written(_stars(last), "edges")
        drop_written(last)
