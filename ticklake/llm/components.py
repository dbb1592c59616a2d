"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for each vertex of ``edges`` (a, b): root is the least vertex of its component.

    In a round each vertex points to its least neighbour and edges are rewritten
    to the pointed-to vertices; a star shrinks to a point in one round and any
    component by at least half. The edges stay distributed and shrink; the
    driver only learns whether some are left.
    """
    left = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(left.select(F.col("b").alias("v"), F.col("a").alias("w")))
        points = written(both.groupBy("v").agg(F.least("v", F.min("w")).alias("root")), "points")
        if labels is None:
            labels = points
        else:
            step = points.select(F.col("v").alias("root"), F.col("root").alias("next"))
            labels = written(labels.join(step, "root", "left").select("v", F.coalesce("next", "root").alias("root")), "labels")
        a = points.select(F.col("v").alias("a"), F.col("root").alias("ra"))
        b = points.select(F.col("v").alias("b"), F.col("root").alias("rb"))
        new = left.join(a, "a").join(b, "b").filter("ra <> rb")
        left = written(new.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return settled(labels)


def settled(labels: DataFrame) -> DataFrame:
    """Follow the pointers until each vertex has a root that points to itself."""
    while True:
        step = labels.select(F.col("v").alias("root"), F.col("root").alias("next"))
        ahead = written(labels.join(step, "root").select("v", F.col("next").alias("to"), (F.col("next") != F.col("root")).alias("moved")), "labels")
        labels = ahead.select("v", F.col("to").alias("root"))
        if ahead.filter("moved").isEmpty():
            return labels
