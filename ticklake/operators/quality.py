"""Data quality: one row for each symbol and feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.book import KEY as BOOK_KEY
from ticklake.operators.book import book_rows, verdicts
from ticklake.operators.carry import carried, parted
from ticklake.operators.order import RECV, ord_
from ticklake.schema import LANE_KINDS, feed
from ticklake.sources.scratch import stored

#: A wall clock that moves against the monotonic one by more than this, plus the share of the gap, has stepped.
STEP_NS, SLEW = 1_000_000, 0.001
#: Distinct trade ids among which a repeated one counts.
ID_WINDOW = 4096
CELL = ("venue", "symbol", "feed")


def venue_ns() -> F.Column:
    """When the venue sent the row: 0 if unknown; a trade falls back to its own time, history rows have none."""
    sent = F.coalesce("exchange_system_ts_ns", F.lit(0))
    own = F.coalesce("exchange_ts_ns", F.lit(0))
    return F.when(F.col("kind").isin(*LANE_KINDS), 0).when((F.col("kind") == "public_trade") & (sent == 0), own).otherwise(sent)


def measured(tape: DataFrame) -> DataFrame:
    """Rows of a feed with ``feed`` and skew in whole ms (floor)."""
    late = F.col(RECV) - venue_ns()
    skew = F.when(venue_ns() > 0, F.expr("0") + (late - F.pmod(late, F.lit(1_000_000))) / 1_000_000)
    return tape.withColumns({"feed": feed(), "skew": skew.cast("bigint")}).filter("feed <> ''")


def clocked(tape: DataFrame) -> DataFrame:
    """``measured`` rows with the silence before the row in ns and whether the clock stepped."""
    lane = F.col("kind").isin(*LANE_KINDS)
    mono = F.when(~lane & (F.coalesce("local_receive_mono_ns", F.lit(0)) > 0), F.col("local_receive_mono_ns"))
    rows = carried(measured(tape).withColumn("_mono", mono), CELL, before={"_wall": F.col(RECV), "_last": F.col("_mono")})
    moved = F.abs((F.col(RECV) - F.col("_mono")) - (F.col("_wall") - F.col("_last")))
    allowed = F.lit(STEP_NS) + (F.abs(F.col("_mono") - F.col("_last")) * SLEW).cast("bigint")
    silence = F.greatest(F.coalesce(F.col(RECV) - F.col("_wall"), F.lit(0)), F.lit(0))
    return rows.withColumns({"step": F.coalesce(moved > allowed, F.lit(False)), "silence": silence}).drop("_mono", "_wall", "_last")


def skew_quantiles(rows: DataFrame) -> DataFrame:
    """Order statistics of the skews at (n - 1) // 2 and min(n - 1, 99 n // 100).

    Counts of equal skews come first, so that a feed's rows never gather; the
    running count over its distinct values finds the two places.
    """
    counts = rows.filter("skew is not null").groupBy(*CELL, "skew").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*CELL)
    upto = F.sum("n").over(w.orderBy("skew").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumn("upto", upto).withColumn("total", F.sum("n").over(w))
    middle = F.expr("(total - 1) div 2")
    high = F.least(F.col("total") - 1, F.expr("99 * total div 100"))
    pick = [F.min(F.when(F.col("upto") > at, F.col("skew"))) for at in (middle, high)]
    agg = placed.groupBy(*CELL).agg(F.min("skew").alias("skew_min_ms"), pick[0].alias("skew_p50_ms"), pick[1].alias("skew_p99_ms"), F.max("skew").alias("skew_max_ms"))
    return agg.select(*CELL, *(F.col(c).cast("double").alias(c) for c in agg.columns[3:]))


#: Trades of a symbol among which ``duplicate_ids`` looks for a place to cut.
CUT_EVERY = 1 << 16


def segmented(trades: DataFrame, window: int) -> DataFrame:
    """Trades with ``segment`` and ``seed``, cut where the ids before them no longer matter.

    Behind ``window`` trades in a row whose ids had never come before, the memory
    of ids holds just those, whatever came earlier. In each CUT_EVERY trades of a
    symbol the first such place ends a segment, and its ``window`` trades come
    again as the seed of the next one.
    """
    key = ("venue", "symbol")
    firsts = trades.groupBy(*key, "trade_id").agg(F.min(ord_()).alias("_first"))  # partial sums and a plain join, so that a hot id can be split
    rows = trades.join(firsts, [*key, "trade_id"]).withColumn("_again", ord_() > F.col("_first")).drop("_first")
    rows = stored(carried(rows, key, counts={"_n": F.lit(1)}), "numbered")
    rows = carried(rows, key, before={"_before": F.when(F.col("_again"), F.col("_n"))})
    repeat = F.coalesce(F.when(F.col("_again"), F.col("_n")), F.col("_before"), F.lit(0))
    every = max(CUT_EVERY, window)
    rows = rows.withColumns({"_block": F.expr(f"_n div {every}"), "_clean": F.col("_n") - repeat >= window})
    rows = stored(rows.select(*key, "trade_id", "_n", "_block", "_clean"), "trades")
    cuts = rows.groupBy(*key, "_block").agg(F.min(F.when(F.col("_clean"), F.col("_n"))).alias("_cut"))
    w = Window.partitionBy(*key).orderBy("_block")
    past = F.last("_cut", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.withColumns({"_past": F.coalesce(past, F.lit(0)), "_next": F.lead("_cut").over(w)})
    met = rows.join(cuts, [*key, "_block"])
    own = F.struct(F.when(F.col("_n") > F.col("_cut"), F.col("_cut")).otherwise(F.col("_past")).alias("segment"), F.lit(False).alias("seed"))
    seeds = [F.when((F.col("_n") <= F.col(c)) & (F.col("_n") > F.col(c) - window), F.struct(F.col(c).alias("segment"), F.lit(True).alias("seed"))) for c in ("_cut", "_next")]
    return met.select(*key, "trade_id", "_n", F.explode(F.array(own, *seeds)).alias("x")).filter("x is not null").select(*key, "x.segment", "_n", "trade_id", "x.seed")


def duplicate_ids(tape: DataFrame, window: int = ID_WINDOW) -> DataFrame:
    """Trades whose id is among the last ``window`` distinct ids of the symbol.

    An id's first sight within the window gets the next number; a repeat counts
    while fewer than ``window`` new ids have come since. A symbol's trades, of a
    symbol with many its segments, are streamed in order, each through a bounded
    memory of ids.
    """

    def run(batches):
        from collections import OrderedDict

        import pyarrow as pa

        key, seen = None, OrderedDict()
        for batch in batches:
            out: list[list] = [[], [], []]
            for venue, symbol, segment, i, seed in zip(*(batch.column(c).to_pylist() for c in ("venue", "symbol", "segment", "trade_id", "seed")), strict=True):
                if key != (venue, symbol, segment):
                    key, seen = (venue, symbol, segment), OrderedDict()
                again = i in seen
                if not again:
                    seen[i] = None
                    if len(seen) > window:
                        seen.popitem(last=False)
                for c, v in zip(out, (venue, symbol, int(again and not seed)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["venue", "symbol", "again"])

    n = int(tape.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trades = tape.filter("kind = 'public_trade' and coalesce(trade_id, '') <> ''").select("venue", "symbol", RECV, "seq", "trade_id")
    segment = ("venue", "symbol", "segment")

    def counted(rows: DataFrame, *order: str) -> DataFrame:
        return rows.repartition(n, *segment).sortWithinPartitions(*segment, *order).select(*segment, "trade_id", "seed").mapInArrow(run, "venue string, symbol string, again bigint")

    short, long = parted(trades, segment[:2], max(CUT_EVERY, window))
    found = counted(short.withColumns({"segment": F.lit(0).cast("bigint"), "seed": F.lit(False)}), RECV, "seq")
    if long is not None:
        found = found.unionByName(counted(segmented(long, window), "_n"))
    return found.groupBy("venue", "symbol").agg(F.sum("again").alias("duplicate_trade_ids"))


def build_quality(tape: DataFrame) -> DataFrame:
    """The 20 columns of every (symbol, feed)."""
    rows = clocked(tape)
    book = F.col("kind").isin("orderbook_snapshot", "orderbook_delta")
    snapshot = F.col("kind") == "orderbook_snapshot"
    said = F.col("message_type") == "snapshot"
    base = rows.groupBy(*CELL).agg(
        F.count("*").alias("rows"), F.min_by(RECV, ord_()).alias("first_receive_ns"), F.max_by(RECV, ord_()).alias("last_receive_ns"),
        (F.max("silence") / 1e6).alias("max_silence_ms"), F.count_if(snapshot).alias("snapshots"), F.count_if(F.col("kind") == "orderbook_delta").alias("deltas"),
        F.count_if((F.col("kind") == "orderbook_delta") & F.coalesce("sequence_gap", F.lit(False))).alias("sequence_gaps"),
        F.min_by(F.when(book, snapshot), F.when(book, ord_())).alias("_first"), F.bool_or(F.when(F.col("kind") == "ticker", F.coalesce(said, F.lit(False)))).alias("_any"),
        F.count_if("step").alias("clock_steps"),
    )
    plain = measured(tape)  # what needs no neighbours
    names = plain.filter("kind = 'ticker'").select(*CELL, F.explode(F.map_keys("values")).alias("name")).distinct().groupBy(*CELL).agg(F.count("*").alias("ticker_fields"))
    chained = verdicts(book_rows(tape)).withColumn("feed", feed())
    judged = chained.groupBy(*CELL).agg(F.count_if(~F.col("snapshot") & ~F.col("valid")).alias("refused"), F.max_by("valid", ord_()).alias("chained"))
    twice = duplicate_ids(tape).withColumn("feed", F.lit("trades"))
    out = base.join(skew_quantiles(plain), list(CELL), "left").join(names, list(CELL), "left").join(judged, list(CELL), "left").join(twice, list(CELL), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("refused", "ticker_fields", "duplicate_trade_ids")]
    return out.select(
        *CELL, "rows", "first_receive_ns", "last_receive_ns", "max_silence_ms", "skew_min_ms", "skew_p50_ms", "skew_p99_ms", "skew_max_ms",
        "snapshots", "deltas", "sequence_gaps", zero[0], "chained", F.coalesce("_first", "_any").alias("anchored"), *zero[1:], "clock_steps",
    )


def summarize(quality: DataFrame) -> DataFrame:
    """One row for each feed and one, with a null feed, for all: symbols, rows, clock and the first 20 names that need a look."""

    def names(test) -> F.Column:
        return F.slice(F.sort_array(F.collect_set(F.when(test, F.col("symbol")))), 1, 20)

    columns = [
        F.countDistinct("symbol").alias("symbols"), F.sum("rows").alias("rows"), F.percentile("skew_p50_ms", 0.5).alias("skew_p50_ms"), F.max("skew_p99_ms").alias("skew_p99_ms"),
        F.max("max_silence_ms").alias("max_silence_ms"), F.sum("clock_steps").alias("clock_steps"), F.sum("sequence_gaps").alias("sequence_gaps"), F.sum("refused").alias("refused"),
        F.sum("duplicate_trade_ids").alias("duplicate_trade_ids"), names(F.col("chained") == False).alias("unchained"), names(F.col("anchored") == False).alias("unanchored"),  # noqa: E712
    ]
    return quality.groupBy("feed").agg(*columns).unionByName(quality.agg(*columns).withColumn("feed", F.lit(None).cast("string")))
