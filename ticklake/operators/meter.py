"""Byte and clock metering of a frames table."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.health import fixed
from ticklake.operators.order import RECV
from ticklake.operators.quality import venue_ns
from ticklake.schema import feed

MINUTE = 60 * 1_000_000_000
DAY_MINUTES = 1440
MONTH_SECONDS = 30 * 86_400


def quantile_edges() -> list[float]:
    """Bucket edges in ms: quarters to 20, ones to 200, tens to 2,000, hundreds to 20,000."""
    return [q / 4 for q in range(81)] + [float(x) for a, b, s in ((21, 201, 1), (210, 2001, 10), (2100, 20001, 100)) for x in range(a, b, s)]


def bytes_by_minute(frames: DataFrame) -> DataFrame:
    """Bytes of each minute by key: ``all``, ``tier:T`` and ``feed:T:class`` from one pass with grouping sets."""
    rows = frames.withColumn("minute", F.expr(f"recv_ns div {MINUTE}"))
    level = F.grouping("tier") + F.grouping("feed")
    key = F.when(level == 2, F.lit("all")).when(level == 1, F.concat(F.lit("tier:"), F.col("tier"))).otherwise(F.concat(F.lit("feed:"), F.col("tier"), F.lit(":"), F.col("feed")))
    sets = rows.groupingSets([["minute"], ["minute", "tier"], ["minute", "tier", "feed"]], "minute", "tier", "feed")
    return sets.agg(key.alias("key"), F.sum("bytes").alias("bytes")).select("key", "minute", "bytes")


def trailing(minutes: DataFrame) -> DataFrame:
    """Adds the sum of the last 1,440 minutes, the total so far and the minutes of the window that were seen.

    The sum is that of two running totals, which grow by a row at a time, where a
    sliding frame would be summed anew for every minute.
    """
    before = Window.partitionBy("key").orderBy("minute").rangeBetween(Window.unboundedPreceding, -DAY_MINUTES)
    ever = Window.partitionBy("key").orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.least(F.lit(DAY_MINUTES), F.greatest(F.lit(0), F.col("minute") - F.min("minute").over(ever)))
    return minutes.withColumns({"last_day": F.sum("bytes").over(ever) - F.coalesce(F.sum("bytes").over(before), F.lit(0)), "total": F.sum("bytes").over(ever), "seen": seen})


def month_gb(last_day: str = "last_day", seen: str = "seen") -> F.Column:
    """Monthly projection in GB; null with less than an hour of data."""
    return F.when(F.col(seen) >= 60, F.greatest(F.col(last_day), F.lit(0)) / (F.col(seen) * 60) * MONTH_SECONDS / 1e9)


def shed_plan(pairs: DataFrame, projected: float, limit: float) -> DataFrame:
    """Pairs ``(pos, tier, feed, gb)`` that must go, in order, until the projection is within the limit."""
    before = Window.partitionBy(F.lit(0)).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    gone = F.coalesce(F.sum("gb").over(before), F.lit(0.0))
    return pairs.withColumn("_gone", gone).filter(F.lit(projected) - F.col("_gone") > limit).drop("_gone")


def budget_ticks(ticks: DataFrame, order: list[str], limit: float, restore_below: float, act_every: int) -> DataFrame:
    """Shed and restored pairs at each tick: (recorder, tick, projected, shed).

    ``ticks``: recorder, tick (minutes), total_gb and gb (map of pair to GB a
    month). A tick's decision depends on the one before, so each recorder's ticks
    are streamed in order; the state is how many pairs of the order are gone.
    """

    place = {p: i for i, p in enumerate(order)}

    def decided(gone: int, acted: int | None, row: dict, paid: list[float]) -> tuple[int, bool]:
        """How many pairs of the order are gone after a tick, and whether it acted."""
        gb = [row["gb"].get(p, 0.0) for p in order]
        if acted is not None and row["tick"] - acted < act_every:
            return gone, False
        if row["projected"] > limit:
            sums = itertools.accumulate(gb[gone:], initial=0.0)  # what each longer cut saves
            cut = next((k for k, saved in enumerate(sums) if row["projected"] - saved <= limit), len(gb) - gone)
            paid[gone : gone + cut] = gb[gone : gone + cut]
            return gone + cut, True
        back = gone > 0 and row["projected"] + paid[gone - 1] < limit * restore_below
        return gone - back, back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, gone, acted, paid = None, 0, None, []
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                if r["recorder"] != who:
                    who, gone, acted, paid = r["recorder"], 0, None, [0.0] * len(order)
                r["gb"] = {p: v for p, v in (r["gb"] or []) if p in place}
                r["projected"] = max(0.0, r["total_gb"] - sum(r["gb"].get(p, 0.0) for p in order[:gone]))
                gone, acts = decided(gone, acted, r, paid)
                acted = r["tick"] if acts else acted
                r["shed"] = ",".join(order[:gone])
            columns = [pa.array([r[c] for r in rows], k) for c, k in (("recorder", pa.string()), ("tick", pa.int64()), ("projected", pa.float64()), ("shed", pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["recorder", "tick", "projected", "shed"])

    n = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ticks.repartition(n, "recorder").sortWithinPartitions("recorder", "tick").mapInArrow(run, "recorder string, tick bigint, projected double, shed string")


def budget_status(told: DataFrame, gb: DataFrame, order: list[str], limit: float) -> DataFrame:
    """A budget's row in the status document after each recorder's last tick: projected, over, shed, shed_gb, shed_order and the tick at which the shed pairs last changed.

    ``told``: rows of ``budget_ticks``; ``gb``: recorder, tick, pair and its GB a
    month. A shed pair shows what it cost at the last tick before it went.
    """
    turn = F.lag("shed", 1, "").over(Window.partitionBy("recorder").orderBy("tick"))
    rows = told.withColumn("_turn", F.when(F.col("shed") != turn, F.col("tick")))
    last = rows.groupBy("recorder").agg(F.max_by(F.struct("projected", "shed"), "tick").alias("_x"), F.max("_turn").alias("last_action"))
    gone = last.select("recorder", F.explode(F.filter(F.split("_x.shed", ","), lambda p: p != "")).alias("pair"))
    held = rows.select("recorder", "tick", F.split("shed", ",").alias("_gone")).withColumn("_before", F.coalesce(F.lag("_gone").over(Window.partitionBy("recorder").orderBy("tick")), F.array().cast("array<string>")))
    went = held.select("recorder", "tick", F.explode(F.array_except("_gone", "_before")).alias("pair")).groupBy("recorder", "pair").agg(F.max("tick").alias("tick"))
    cost = gone.join(went, ["recorder", "pair"]).join(gb, ["recorder", "tick", "pair"], "left").select("recorder", "pair", F.coalesce("gb", F.lit(0.0)).alias("gb"))
    costs = cost.groupBy("recorder").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("pair", F.round("gb", 1).alias("gb"))))).alias("shed_gb"))
    out = last.join(costs, "recorder", "left")
    return out.select(
        "recorder", F.lit(limit).alias("monthly_gb"), F.round("_x.projected", 1).alias("projected_month_gb"), (F.col("_x.projected") > limit).alias("over"),
        F.filter(F.split("_x.shed", ","), lambda p: p != "").alias("shed"), F.coalesce("shed_gb", F.create_map().cast("map<string,double>")).alias("shed_gb_month"),
        F.array(*(F.lit(p) for p in order)).alias("shed_order"), "last_action",
    )


def bytes_status(frames: DataFrame, now_ns: int) -> DataFrame:
    """The traffic row of the status document at ``now_ns``: received_total, received_24h and by_feed_24h, from sums by minute."""
    minute = now_ns // MINUTE
    rows = bytes_by_minute(frames.filter(F.col("recv_ns") <= now_ns)).withColumn("_day", F.when(F.col("minute") > minute - DAY_MINUTES, F.col("bytes")))
    keys = rows.groupBy("key").agg(F.sum("bytes").alias("total"), F.coalesce(F.sum("_day"), F.lit(0)).alias("day"))
    feed = F.when(F.col("key").startswith("feed:"), F.struct(F.expr("substring(key, 6)").alias("feed"), F.col("day")))
    one = {n: F.coalesce(F.sum(F.when(F.col("key") == "all", F.col(c))), F.lit(0)).alias(n) for n, c in (("received_total", "total"), ("received_24h", "day"))}
    return keys.agg(*one.values(), F.map_from_entries(F.sort_array(F.collect_list(feed))).alias("by_feed_24h"))


def clock_status(tape: DataFrame) -> DataFrame:
    """Each feed class's row of the status document: samples, p50 and p99 of receipt less send, and of send less the engine's stamp, in ms; rows without a send stamp don't count."""
    sent, engine = venue_ns(), F.coalesce("exchange_engine_ts_ns", F.lit(0))
    rows = tape.select(F.split(feed(), ":")[0].alias("feed"), ((F.col(RECV) - sent) / 1e6).alias("wire"), F.when(engine > 0, (sent - engine) / 1e6).alias("venue"), sent.alias("_sent")).filter("_sent > 0 and feed <> ''")
    parts = [bucketed_quantiles(rows.select("feed", F.col(c).alias("ms")), {f"{n}_p50_ms": 0.5, f"{n}_p99_ms": 0.99}, "feed") for c, n in (("wire", "skew"), ("venue", "venue"))]
    return parts[0].join(parts[1].drop("samples"), "feed", "left")


def clock_windows(readings: DataFrame, seconds: int) -> DataFrame:
    """Count, mean, least and largest reading (ms) of each interval."""
    slot = F.expr(f"recv_ns div {seconds * 1_000_000_000}")
    return readings.groupBy(slot.alias("slot")).agg(F.count("ms").alias("n"), *(fixed(v, F.lit(3)).alias(n) for n, v in (("mean", F.avg("ms")), ("least", F.min("ms")), ("most", F.max("ms")))))


def bucketed_quantiles(readings: DataFrame, fractions: dict[str, float], *key: str) -> DataFrame:
    """Quantiles read to the upper edge of the bucket that reaches them.

    Readings become counts of at most 621 buckets for each key before anything is
    ordered, and counts of parts add up, so rollups and streams share the form.
    """
    edges = quantile_edges()
    ms = F.col("ms")

    def step(low: float, width: float) -> F.Column:
        return F.lit(low) + F.ceil((ms - low) / width) * width

    edge = F.when(ms <= 0, 0.0).when(ms <= 20, step(0.0, 0.25)).when(ms <= 200, step(20.0, 1.0)).when(ms <= 2000, step(200.0, 10.0)).when(ms <= 20000, step(2000.0, 100.0)).otherwise(edges[-1])
    counts = readings.filter("ms is not null").groupBy(*key, edge.alias("edge")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*key)
    upto = F.sum("n").over(w.orderBy("edge").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = counts.withColumn("upto", upto).withColumn("total", F.sum("n").over(w))
    picks = [F.min(F.when(F.col("upto") >= F.lit(f) * F.col("total"), F.col("edge"))).alias(name) for name, f in fractions.items()]
    return rows.groupBy(*key).agg(F.max("total").alias("samples"), *picks)
