"""Running values of a key over all time, without all of its rows meeting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.order import RECV, ord_
from ticklake.schema import NS_PER_HOUR
from ticklake.sources.scratch import stored


#: Rows of a key that meet in one sorted group.
LONG = 1 << 18


def parted(rows: DataFrame, key: tuple[str, ...], most: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys (not null) that have ``most`` rows at most, and stored ones of longer keys, if there are any."""
    rows = rows.dropna(subset=list(key))
    long = rows.groupBy(*key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > most).select(*key)
    if long.isEmpty():
        return rows, None
    long = F.broadcast(stored(long, "long"))  # fewer keys than rows by a factor of ``most``
    return rows.join(long, list(key), "left_anti"), stored(rows.join(long, list(key), "left_semi").select(rows.columns), "long_rows")


def carried(rows: DataFrame, key: tuple[str, ...], before: dict[str, Column] | None = None, counts: dict[str, Column] | None = None) -> DataFrame:
    """Adds the last known value before the row (``before``) and the sum up to and with it (``counts``), in arrival order of ``key`` (not null).

    A key of up to LONG rows is one sorted group. Of a longer one each hour is;
    what it starts from comes from a small table with a row for each hour.
    """
    before, counts = before or {}, counts or {}
    short, long = parted(rows, key, LONG)
    w = Window.partitionBy(*key).orderBy(RECV, "seq")
    upto, prior = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
    out = {n: F.coalesce(F.sum(c.cast("bigint")).over(upto), F.lit(0)) for n, c in counts.items()}
    out |= {n: F.last(c, ignorenulls=True).over(prior) for n, c in before.items()}
    short = short.withColumns(out)
    return short if long is None else short.unionByName(carried_by_hour(long, key, before, counts).select(short.columns))


def carried_by_hour(rows: DataFrame, key: tuple[str, ...], before: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    rows = rows.withColumn("_hour", F.expr(f"{RECV} div {NS_PER_HOUR}"))
    sums = [F.sum(c.cast("bigint")).alias(f"_s_{n}") for n, c in counts.items()]
    lasts = [F.max_by(c, F.when(c.isNotNull(), ord_())).alias(f"_l_{n}") for n, c in before.items()]
    past = Window.partitionBy(*key).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = rows.groupBy(*key, "_hour").agg(*sums, *lasts)
    hours = hours.select(*key, "_hour", *(F.coalesce(F.sum(f"_s_{n}").over(past), F.lit(0)).alias(f"_s_{n}") for n in counts), *(F.last(f"_l_{n}", ignorenulls=True).over(past).alias(f"_l_{n}") for n in before))
    order = Window.partitionBy(*key, "_hour").orderBy(RECV, "seq")
    upto, prior = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, -1)
    out = {n: F.col(f"_s_{n}") + F.coalesce(F.sum(c.cast("bigint")).over(upto), F.lit(0)) for n, c in counts.items()}
    out |= {n: F.coalesce(F.last(c, ignorenulls=True).over(prior), F.col(f"_l_{n}")) for n, c in before.items()}
    return rows.join(hours, [*key, "_hour"]).withColumns(out).drop("_hour", *(f"_s_{n}" for n in counts), *(f"_l_{n}" for n in before))
