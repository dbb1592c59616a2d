"""Streams over files of the events table against the batch operators."""

import tempfile
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ticklake.operators import bars, book, order, spans, universe
from ticklake.plans.tape_queries import late_diff_tape
from ticklake.sources import testbed
from ticklake.streaming import live_bars, state

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def source(spark):
    def make(batch, cut="seq"):
        path = tempfile.mkdtemp(prefix="spark-")
        n = batch.agg(F.max(cut)).first()[0] // 3 + 1
        for i in range(3):
            batch.filter(f"{cut} div {n} = {i}").coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path)

    return make


def drained(spark, stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name)


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_gap_marks(spark, source):
    tape = testbed.book(spark, SF)
    got = drained(spark, state.stream_gaps(source(tape)), "gaps").select("symbol", "seq", "sequence_gap", "verdict")
    want = book.mark_gaps(book.book_rows(tape)).select("symbol", "seq", "sequence_gap", "verdict")
    assert rows_of(got) == rows_of(want)


def test_clamp(spark, source):
    tape = testbed.tape(spark, SF).withColumn("local_receive_ts_ns", F.col("local_receive_ts_ns") - F.when(F.col("seq") % 5 == 0, 10**15).otherwise(0))
    columns = ["symbol", "seq", "local_receive_ts_ns", "local_receive_mono_ns"]
    got = drained(spark, state.stream_clamped(source(tape)), "clamped").select(*columns)
    assert rows_of(got) == rows_of(order.clamp_late(tape).select(*columns))


def test_live_state(spark, source):
    tape = testbed.tape(spark, SF)
    got = drained(spark, state.stream_live_state(source(tape)), "live").select("symbol", "seq", "price", "open_interest")
    assert rows_of(got.na.fill(0.0)) == rows_of(universe.live_state(tape).select("symbol", "seq", "price", "open_interest").na.fill(0.0))


def rounded(rows):
    return sorted(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)


def closed_bars(spark, stream, name, expected):
    """Run with a timer of two seconds until all bars are out."""
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(processingTime="1 second").start()
    try:
        for _ in range(120):
            if query.exception() or spark.table(name).count() >= expected:
                break
            time.sleep(1)
        assert query.exception() is None
    finally:
        query.stop()
    return spark.table(name)


def live_tape(spark):
    """Rows of all kinds in arrival order, many of them behind their time: plain books, diff books whose snapshots come late, tickers with every value."""
    plain, diffs = testbed.book(spark, SF), late_diff_tape(spark, SF)
    flow = testbed.tape(spark, SF)
    more = F.map_concat("values", F.create_map(F.lit("index_price"), F.col("local_receive_ts_ns") / 1e18, F.lit("funding_rate"), F.lit(0.001)))
    flow = flow.withColumn("values", F.when(F.col("kind") == "ticker", more))
    rows = [flow, plain, plain.filter("seq % 3 = 0").withColumns({"depth": F.lit(1), "kind": F.lit("orderbook_snapshot")}), diffs]
    parts = [r.withColumns({"venue": F.lit("binance"), "seq": F.col("seq") * 4 + i}) for i, r in enumerate(rows)]
    tape = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return tape.withColumn("local_receive_ts_ns", F.col("local_receive_ts_ns") - F.when(F.col("seq") % 5 == 0, 10**15).otherwise(0))


def test_bars_of_a_shuffled_stream(spark, source):
    tape = live_tape(spark).orderBy(F.xxhash64("seq", "depth"))
    want = bars.build_bars(order.clamp_late(tape), 86_400)
    rows = want.collect()
    got = closed_bars(spark, live_bars.stream_bars(source(tape), 86_400, "2 seconds"), "bars", len(rows))
    assert rounded(got.select(want.columns).collect()) == rounded(rows)
    assert sum(r.best_bid is not None for r in rows) > 50 and sum(r.trades for r in rows) == tape.filter("kind = 'public_trade'").count()


def test_rows_behind_a_closed_bar_count_in_the_next():
    def row(ns):
        return SimpleNamespace(**{"local_receive_ts_ns": ns, "kind": "public_trade", "price": 1.0, "qty": 2.0, "side": "Buy", "depth": None})

    symbol = live_bars.Symbol()
    assert symbol.take(row(5), 10) is None
    assert symbol.silent(10).columns()[:3] == (0, 1, 2.0) and symbol.silent(10) is None
    assert symbol.take(row(7), 10) is None and symbol.bar.start == 10
    assert symbol.take(row(31), 10).start == 10 and symbol.bar.start == 30


def test_spans(spark, source):
    e = testbed.events(spark, SF).filter("event_type in ('signup', 'error')").select(F.col("symbol").alias("key"), F.col("recv_ns").alias("ns"), (F.col("event_type") == "signup").alias("on"), "seq")
    got = drained(spark, state.stream_spans(source(e)), "spans")
    want = spans.fold_transitions(e, "key").filter("end is not null").select("key", "start", "end")
    assert rows_of(got) == rows_of(want)
