"""Order, filters, limits and the late-row clamp of tape rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.schema import NS_PER_HOUR, feed

RECV = "local_receive_ts_ns"


def arrival(*keys: str) -> Window:
    """Rows of one key in arrival order; operators never sort globally."""
    return Window.partitionBy(*keys).orderBy(RECV, "seq")


def ord_() -> F.Column:
    return F.struct(F.col(RECV), F.col("seq"))


def utc_day_hour(ns: str = RECV) -> tuple[F.Column, F.Column]:
    """Day and hour of a stamp by integer arithmetic."""
    start = F.timestamp_seconds((F.expr(f"{ns} div {NS_PER_HOUR}")) * 3600)
    return F.date_format(start, "yyyy-MM-dd"), F.date_format(start, "HH")


def total_order(tape: DataFrame) -> DataFrame:
    """All rows by receive time; ties by symbol, then by their place in the symbol's files."""
    return tape.orderBy(RECV, "symbol", "seq")


def scan(tape: DataFrame, symbols=None, kinds=None, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
    """Rows of some symbols (any case) and kinds in ``[start_ns, end_ns)``; plain predicates that Parquet can push down."""
    if symbols is not None:
        tape = tape.filter(F.col("symbol").isin(*(s.upper() for s in symbols)))
    if kinds is not None:
        tape = tape.filter(F.col("kind").isin(*kinds))
    if start_ns is not None:
        tape = tape.filter(F.col(RECV) >= start_ns)
    return tape if end_ns is None else tape.filter(F.col(RECV) < end_ns)


#: Arrival numbers of a symbol that one group of ``clamp_late`` spans (as a power of two).
ARRIVALS = 20


def clamp_late(tape: DataFrame, arrival_seq: str = "seq") -> DataFrame:
    """A row behind an earlier arrival of its symbol takes that row's stamp; its monotonic stamp moves along if it has one.

    Rows are kept, never dropped. The largest stamp before each stretch of
    arrivals comes from a small table, so a symbol's rows meet only within one.
    """
    key = ["venue", "symbol", "_stretch"]
    rows = tape.withColumn("_stretch", F.shiftright(arrival_seq, ARRIVALS))
    past = Window.partitionBy("venue", "symbol").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*key).agg(F.max(RECV).alias("_max")).withColumn("_past", F.max("_max").over(past)).drop("_max")
    names = {k: f"_{k}" for k in ("venue", "symbol")}
    same = F.col("venue").eqNullSafe(F.col("_venue")) & F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_stretch") == F.col("_at"))
    rows = rows.join(tops.withColumnsRenamed(names | {"_stretch": "_at"}), same).drop("_venue", "_symbol", "_at")
    w = Window.partitionBy(*key).orderBy(arrival_seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mono = F.col("local_receive_mono_ns")
    moved = rows.withColumn("_top", F.greatest("_past", F.max(RECV).over(w)))
    moved = moved.withColumn("local_receive_mono_ns", F.when(mono > 0, mono + F.col("_top") - F.col(RECV)).otherwise(mono))
    return moved.withColumn(RECV, F.col("_top")).drop("_top", "_past", "_stretch")


def clean_hours(tape: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose (hour, symbol, feed) is complete in the ledger."""
    day, hour = utc_day_hour()
    rows = tape.withColumn("hour", F.concat(day, F.lit("T"), hour)).withColumn("feed", feed())
    complete = ledger.filter("status = 'complete'").select("hour", "symbol", "feed")
    return rows.join(complete, ["hour", "symbol", "feed"], "left_semi").drop("hour", "feed")


def statistics(tape: DataFrame) -> DataFrame:
    """Rows, first and last stamp by symbol and kind."""
    return tape.groupBy("symbol", "kind").agg(F.count("*").alias("n"), F.min(RECV).alias("first_ns"), F.max(RECV).alias("last_ns"))


def final_candles(tape: DataFrame) -> DataFrame:
    """The last confirmed row of each (symbol, interval, start)."""
    w = Window.partitionBy("venue", "symbol", "interval", "start_ms").orderBy(F.desc(RECV), F.desc("seq"))
    rows = tape.filter("kind = 'kline' and confirmed").withColumn("_n", F.row_number().over(w))
    return rows.filter("_n = 1").drop("_n")
