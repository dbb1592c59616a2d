"""Streams over the given tables, run to their end and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.plans.lake_queries import NORMALIZE_TRADES_SQL
from ticklake.plans.tape_queries import BARS_FULL_SQL, rounded, whole_tape
from ticklake.sources import frame_stream, normalize, testbed
from ticklake.sources.scratch import scratch
from ticklake.streaming import live_bars, state


def drained(stream: DataFrame, name: str, home: str | None = None) -> DataFrame:
    """All that a stream gives for the input there is, from a table it was appended to; with the same ``home`` it goes on where it stopped."""
    spark = stream.sparkSession
    home = home or scratch(spark, name)
    query = stream.writeStream.format("parquet").option("path", f"{home}/rows").option("checkpointLocation", f"{home}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/rows")


def replayed(tape: DataFrame, name: str, operator: Callable[[DataFrame], DataFrame], runs: int = 3) -> DataFrame:
    """What ``operator`` gives for ``tape`` that lands in arrival order: a micro-batch for each of ``runs``, which goes on from the checkpoint of the one before.

    A run's files are written by as many tasks as hold its rows: the run, not one
    file, makes the micro-batch.
    """
    spark, root = tape.sparkSession, scratch(tape.sparkSession, name)
    home, last, out = scratch(spark, f"{name}_stream"), tape.agg(F.max("seq")).first()[0] or 0, None
    for i in range(runs):
        tape.filter(f"seq div {last // runs + 1} = {i}").write.mode("append").parquet(root)
        out = drained(operator(spark.readStream.schema(tape.schema).parquet(root)), name, home)
    return out


def stream_bars_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-day bars that a stream of the whole tape has closed: all but each symbol's last."""
    return rounded(replayed(whole_tape(spark, sf_dir), "tape", lambda rows: live_bars.stream_bars(rows, 86_400, idle=None)))


STREAM_BARS_SQL = f"SELECT * FROM ({BARS_FULL_SQL}) QUALIFY bucket_start_ns < max(bucket_start_ns) OVER (PARTITION BY symbol)"


#: Arrival numbers of a landed file at most: one task writes and one reads it, so it must not grow with the table.
PER_FILE = 50_000


def stream_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of landed frame files, replayed in two runs: the second starts from the first one's checkpoint after more files have landed."""
    frames, found = testbed.frames(spark, sf_dir), None
    last = frames.agg(F.max("arrival_seq")).first()[0] or 0
    per_file = min(last // 8 + 1, PER_FILE)
    cut = (last // per_file + 1) // 2 * per_file  # a file belongs to one run
    for venue in ("bybit", "binance"):
        root, home = scratch(spark, f"landed_{venue}"), scratch(spark, f"stream_{venue}")
        own = frames.filter(F.col("venue") == venue)
        for half in (own.filter(f"arrival_seq < {cut}"), own.filter(f"arrival_seq >= {cut}")):
            frame_stream.land_frames(half, root, per_file)
            rows = drained(normalize.normalized(frame_stream.read_frames(spark, root, venue, stream=True)), "rows", home)
        found = rows if found is None else found.unionByName(rows)
    return found.filter("kind = 'public_trade'").select("venue", "symbol", "trade_id", "price", "qty", "side", "exchange_ts_ns", "local_receive_ts_ns")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in a disturbed arrival order, clamped as they come."""
    rows = testbed.tape(spark, sf_dir)
    moved = rows.withColumn("local_receive_ts_ns", F.col("local_receive_ts_ns") - F.when(F.col("seq") % 7 == 0, 10**15).otherwise(0))
    return replayed(moved, "late", state.stream_clamped).select("seq", "symbol", "local_receive_ts_ns", "local_receive_mono_ns")


STREAM_LATE_SQL = f"""{testbed.TAPE_SQL}, a AS (SELECT *, recv_ns - CASE WHEN seq % 7 = 0 THEN 1000000000000000 ELSE 0 END AS stamp FROM tape),
b AS (SELECT *, max(stamp) OVER (PARTITION BY symbol ORDER BY seq ROWS UNBOUNDED PRECEDING) AS top FROM a)
SELECT seq, symbol, top AS local_receive_ts_ns, CASE WHEN mono_ns > 0 THEN mono_ns + top - stamp ELSE mono_ns END AS local_receive_mono_ns FROM b"""

QUERIES = {"stream_bars_closed": stream_bars_closed, "stream_frames": stream_frames, "stream_late_rows": stream_late_rows}
SQL = {"stream_bars_closed": STREAM_BARS_SQL, "stream_frames": f"SELECT venue, symbol, trade_id, price, qty, side, exchange_ts_ns, local_receive_ts_ns FROM ({NORMALIZE_TRADES_SQL})", "stream_late_rows": STREAM_LATE_SQL}
