"""Structured Streaming forms of the tape operators.

Windowed sums of bytes and clock readings use watermarks; what depends on arrival
order keeps a small state for each key and drops no row. Bars are in ``live_bars``.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from ticklake.operators.order import RECV


def event_time(rows: DataFrame, delay: str, column: str = RECV) -> DataFrame:
    """Adds ``event_ts`` (µs) with a watermark; the stamp in ns stays the key."""
    return rows.withColumn("event_ts", F.timestamp_micros(F.expr(f"{column} div 1000"))).withWatermark("event_ts", delay)


def stream_bytes(frames: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Bytes of each minute by tier and feed."""
    rows = event_time(frames, delay, "recv_ns").groupBy("tier", "feed", F.window("event_ts", "1 minute"))
    return rows.agg(F.sum("bytes").alias("bytes")).select("tier", "feed", F.expr("unix_seconds(window.start) div 60").alias("minute"), "bytes")


def stream_clock(readings: DataFrame, interval: str, delay: str = "10 minutes") -> DataFrame:
    """Count, mean and bounds of clock readings (ms) of each interval."""
    rows = event_time(readings, delay, "recv_ns").groupBy(F.window("event_ts", interval))
    return rows.agg(F.count("ms").alias("n"), F.avg("ms").alias("mean"), F.min("ms").alias("least"), F.max("ms").alias("most")).select((F.unix_micros("window.start") * 1000).alias("start_ns"), "n", "mean", "least", "most")


#: States that the symbols of a tape share. A checkpoint holds for the number that it began with.
LANES = 1024


def lane() -> F.Column:
    """The state that a symbol belongs to: Spark hands states over one by one, which takes milliseconds each, whatever they hold, so small ones of many symbols would take most of the time."""
    return F.pmod(F.xxhash64("venue", "symbol"), F.lit(LANES))


def keyed(rows: DataFrame, keys: list[str], step: Callable, first: tuple, state: str, out: str, order: tuple[str, ...] = (RECV, "seq")) -> DataFrame:
    """``step(state, row) -> (state, columns)`` over each key's rows in order; the state is one tuple.

    A micro-batch's rows of a key are sorted by ``order``; the tuple is all that is kept between batches.
    """
    names = [c.split()[0] for c in out.split(", ")]

    def run(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now = held.get if held.exists else first
        made = []
        whole = pd.concat(list(parts), ignore_index=True)
        for row in whole.sort_values(list(order)).itertuples(index=False):
            now, columns = step(now, row)
            if columns is not None:
                made.append((*key, *columns))
        held.update(now)
        yield pd.DataFrame(made, columns=names)

    return rows.groupBy(*keys).applyInPandasWithState(run, out, state, "append", "NoTimeout")


def stream_gaps(book_rows: DataFrame) -> DataFrame:
    """Sequence marks of each book frame: the id before it, whether it gaps, and the verdict."""

    def step(state: tuple, row) -> tuple[tuple, tuple]:
        last, healthy, begun = state
        snapshot = row.kind == "orderbook_snapshot"
        gap = not snapshot and (not healthy or (last > 0 and row.update_id != last + 1))
        verdict = "rebase" if snapshot else "before_snapshot" if not begun else "gap" if gap else "apply"
        return (int(row.update_id), bool(snapshot or not gap), begun or snapshot), (int(row.seq), last, bool(gap), verdict)

    out = "venue string, symbol string, depth int, seq bigint, previous_update_id bigint, sequence_gap boolean, verdict string"
    # before the first snapshot a book is unhealthy
    return keyed(book_rows.select("venue", "symbol", "depth", "kind", RECV, "seq", "update_id"), ["venue", "symbol", "depth"], step, (0, False, False), "last bigint, healthy boolean, begun boolean", out)


def stream_clamped(tape: DataFrame) -> DataFrame:
    """Receive stamps clamped to the largest of the symbol's earlier arrivals; rows come by ``seq``, the arrival order."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        tops: dict[tuple, int] = pickle.loads(held.get[0]) if held.exists else {}
        rows = pd.concat(list(parts), ignore_index=True).sort_values("seq", kind="stable")
        symbols = list(zip(rows["venue"], rows["symbol"], strict=True))
        before = np.array([tops.get(s, -(2**62)) for s in symbols], "int64")
        stamp, mono = rows[RECV].to_numpy("int64"), rows["local_receive_mono_ns"].to_numpy("int64")
        top = np.maximum(before, rows.groupby(["venue", "symbol"], dropna=False, sort=False)[RECV].cummax().to_numpy("int64"))
        tops.update(zip(symbols, top.tolist(), strict=True))  # the last of a symbol's is the largest
        held.update((pickle.dumps(tops),))
        yield rows.assign(**{RECV: top, "local_receive_mono_ns": np.where(mono > 0, mono + top - stamp, mono)})[names]

    out = f"venue string, symbol string, seq bigint, {RECV} bigint, local_receive_mono_ns bigint"
    names = [c.split()[0] for c in out.split(", ")]
    rows = tape.select("venue", "symbol", "seq", RECV, F.coalesce("local_receive_mono_ns", F.lit(0)).alias("local_receive_mono_ns"))
    return rows.withColumn("lane", lane()).groupBy("lane").applyInPandasWithState(run, out, "tops binary", "append", "NoTimeout")


def stream_spans(changes: DataFrame) -> DataFrame:
    """Closed spans from start/stop events (key, ns, on); repeats are ignored, an open span waits for its stop."""

    def step(state: tuple, row) -> tuple[tuple, tuple | None]:
        since = state[0]
        if row.on:
            return (int(row.ns) if since < 0 else since,), None
        closed = (since, int(row.ns)) if 0 <= since < row.ns else None
        return (-1,), closed

    return keyed(changes.select("key", "ns", "on"), ["key"], step, (-1,), "since bigint", "key string, start bigint, end bigint", ("ns", "on"))


def stream_live_state(tickers: DataFrame) -> DataFrame:
    """Last known price and open interest after each ticker row."""

    def step(state: tuple, row) -> tuple[tuple, tuple]:
        price, oi = state
        values = dict(row.values or {})
        if "mark_price" in values:
            price = values["mark_price"]
        elif price is None:
            price = values.get("last_price")
        oi = values.get("open_interest", oi)
        return (price, oi), (int(row.seq), price, oi)

    rows = tickers.filter("kind = 'ticker'").select("symbol", RECV, "seq", "values")
    return keyed(rows, ["symbol"], step, (None, None), "price double, open_interest double", "symbol string, seq bigint, price double, open_interest double")


def stream_history(history: DataFrame, stamp: str, delay: str = "2 days") -> DataFrame:
    """REST history rows once each: a venue's stamp of a (kind, symbol) that was seen is dropped."""
    rows = history.withColumn("stamp_ts", F.timestamp_micros(F.col(stamp) * 1000)).withWatermark("stamp_ts", delay)
    return rows.dropDuplicatesWithinWatermark(["kind", "symbol", stamp])


def sink_tape(tape: DataFrame, path: str, checkpoint: str, **trigger):
    """Append each micro-batch to the columnar tape, by venue, day and hour of the receive stamp."""
    from ticklake.sources.tape_files import filed

    def write(batch: DataFrame, _: int) -> None:
        filed(batch).sortWithinPartitions("symbol", "kind", RECV, "seq").write.mode("append").partitionBy("venue", "day", "hour").parquet(path)

    return tape.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
