"""Interval algebra on (key, start, end) rows by windows over their ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(spans: DataFrame, *key: str) -> DataFrame:
    """Union of each key's spans; touching ones join, empty ones go."""
    w = Window.partitionBy(*key).orderBy("start", "end")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = spans.filter("start < end").select(*key, "start", "end")
    rows = rows.withColumn("_new", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(*key, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def swept(a: DataFrame, b: DataFrame, key: tuple[str, ...], inside: Callable[[Column, Column], Column]) -> DataFrame:
    """The stretches of each key in which ``inside`` holds of how many spans of ``a`` and of ``b`` are open.

    All ends of both sides meet in one sorted group of their key and are counted
    as they pass; spans never meet each other, so a key with many of them costs
    a sort, and neither side needs to be merged first.
    """

    def ends(rows: DataFrame, side: int) -> DataFrame:
        def turn(at: str, by: int) -> Column:
            return F.struct(F.col(at).alias("at"), F.lit(by if side == 0 else 0).alias("da"), F.lit(by if side else 0).alias("db"))

        return rows.filter("start < end").select(*key, F.inline(F.array(turn("start", 1), turn("end", -1))))

    order = Window.partitionBy(*key).orderBy("at")
    upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ends(a, 0).unionByName(ends(b, 1)).withColumns({"_a": F.sum("da").over(upto), "_b": F.sum("db").over(upto), "_to": F.lead("at").over(order)})
    rows = rows.withColumn("_in", inside(F.col("_a"), F.col("_b"))).filter("_to is null or at < _to")  # of the ends at one moment the last one says what follows
    turns = rows.withColumn("_was", F.lag("_in").over(order)).filter("_in <> coalesce(_was, false)")
    return turns.withColumn("end", F.lead("at").over(order)).filter("_in").select(*key, F.col("at").alias("start"), "end")


def intersect(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """What both cover, in pieces of positive length; a null key has no spans."""
    named = None
    for k in key:
        named = F.col(k).isNotNull() if named is None else named & F.col(k).isNotNull()
    return swept(a.filter(named), b.filter(named), key, lambda x, y: (x > 0) & (y > 0))


def subtract(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """What ``a`` covers and ``b`` doesn't."""
    return swept(a, b, key, lambda x, y: (x > 0) & (y == 0))


def fold_transitions(changes: DataFrame, *key: str, end: int | None = None) -> DataFrame:
    """Spans from start/stop events ``(key, ns, on)``; repeats are ignored, an open span ends at ``end`` (null: stays open)."""
    w = Window.partitionBy(*key).orderBy("ns", "on")
    turns = changes.withColumn("_was", F.lag("on").over(w)).filter("on <> coalesce(_was, false)")
    spans = turns.withColumn("end", F.coalesce(F.lead("ns").over(w), F.lit(end).cast("bigint"))).filter("on")
    return spans.select(*key, F.col("ns").alias("start"), "end").filter("end is null or start < end")


def by_hour(spans: DataFrame, hour: int, *key: str) -> DataFrame:
    """Each span cut at whole hours: key, hour (number), start, end."""
    first, last = F.expr(f"start div {hour}"), F.expr(f"(end - 1) div {hour}")
    rows = spans.filter("start < end").withColumn("hour", F.explode(F.sequence(first, last)))
    return rows.select(*key, "hour", F.greatest("start", F.col("hour") * hour).alias("start"), F.least("end", (F.col("hour") + 1) * hour).alias("end"))


def contiguous(hours: DataFrame, *key: str) -> DataFrame:
    """Runs of consecutive hours ``(key, hour)`` as [from_hour, to_hour)."""
    w = Window.partitionBy(*key).orderBy("hour")
    rows = hours.select(*key, "hour").distinct().withColumn("_island", F.col("hour") - F.row_number().over(w))
    return rows.groupBy(*key, "_island").agg(F.min("hour").alias("from_hour"), (F.max("hour") + 1).alias("to_hour")).drop("_island")
