"""Connected components by alternating star contraction; no neighbour list is ever collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. Every vertex links its larger (large star) or its smaller neighbours and
    itself (small star) to the least vertex it knows. A hub's neighbours stay rows, streamed past
    its one label; repeats of a large star are left to the small star that follows."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))  # a: vertex, b: neighbour
        low = both.groupBy("a").agg(F.min("b").alias("lo")).withColumn("lo", F.least("lo", "a"))
        return both.filter("b > a").join(low, "a").select(F.col("lo").alias("a"), "b")
    low = edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("lo"))
    near = edges.select(F.col("b").alias("v"), F.col("a").alias("x")).join(low, "v")
    # the row of the least neighbour itself carries the vertex: every row stays one row
    return near.select(F.col("lo").alias("a"), F.when(F.col("x") == F.col("lo"), F.col("v")).otherwise(F.col("x")).alias("b")).distinct()


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the least vertex that each vertex of ``edges`` reaches. Each round is
    written to the shared folder; rounds grow with the logarithm of the longest path. A reader to
    whom a vertex without a row is its own component filters node > comp, which also drops the
    shuffle of the second part from the plan."""
    e = scratch.write(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct())
    while True:
        # a star forest has no vertex with two parents, and no parent that has a parent
        seen = e.select(F.col("b").alias("v"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
            e.select(F.col("a").alias("v"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        seen = seen.groupBy("v").agg(F.sum("below").alias("below"), F.sum("above").alias("above"))
        if not seen.agg(F.max(F.expr("below > 1 or (below > 0 and above > 0)"))).head()[0]:
            break
        nxt = scratch.write(_star(_star(e, True), False))
        scratch.drop(e)
        e = nxt
    return e.select(F.col("b").alias("node"), F.col("a").alias("comp")).union(
        e.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())


def joined(scratch: Scratch, label: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``label`` (node, comp) of the components so far, after ``edges`` (a, b) came in. Edges run
    between the components they join, so the stars known need no contraction from the start."""
    if label is None:
        return components(scratch, edges)
    if not edges.take(1):
        return label
    between = (edges.join(label.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left")
               .join(label.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    return components(scratch, label.filter("node > comp").select(F.col("comp").alias("a"), F.col("node").alias("b")).union(between))
