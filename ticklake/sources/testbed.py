"""Tape tables that stand for the given events, orders and lineitem tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.schema import widened

VENUE = "testbed"
#: A snapshot comes every so many updates of a symbol; every so many events an update id is skipped.
SNAPSHOT_EVERY, SKIP_EVERY = 20, 37


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the tape's keys: seq, symbol, recv_ns, k."""
    rows = read(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return rows.select(
        F.col("event_id").alias("seq"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"), (micros * 1000).alias("recv_ns"),
        "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades (purchase, click, view), tickers (signup) and liquidations (error) as wide rows, with ``seq`` for ties."""
    e = events(spark, sf_dir)
    trade = F.col("event_type").isin("purchase", "click", "view")
    kind = F.when(trade, "public_trade").when(F.col("event_type") == "signup", "ticker").otherwise("liquidation")
    side = F.when(F.col("seq") % 2 == 0, "Buy").otherwise("Sell")
    sparse = F.col("seq") % 3 == 0
    mark = F.create_map(F.lit("mark_price"), F.col("value"))
    values = F.when(sparse, mark).otherwise(F.map_concat(mark, F.create_map(F.lit("open_interest"), F.col("k").cast("double"))))
    sent = F.col("recv_ns") - (F.col("k") - 20) * 1_500_000
    rows = e.select(
        kind.alias("kind"), F.lit(VENUE).alias("venue"), "symbol", F.col("recv_ns").alias("local_receive_ts_ns"),
        F.when(F.col("seq") % 11 == 0, 0).otherwise(F.col("recv_ns") - 1_000_000_000_000 + F.when(F.col("seq") % 13 == 0, 5_000_000_000_000).otherwise(0)).alias("local_receive_mono_ns"),
        sent.alias("exchange_system_ts_ns"), sent.alias("exchange_ts_ns"),
        F.when(trade, F.concat(F.lit("t"), F.floor(F.col("seq") / 2).cast("string"))).alias("trade_id"),
        F.when(trade, F.col("value")).alias("price"),
        F.when(trade, 1.0 + F.col("k") % 5).when(kind == "liquidation", F.col("value")).alias("qty"),
        F.when(trade, side).alias("side"), F.when(kind == "liquidation", side).alias("position_side"),
        F.when(kind == "liquidation", F.col("value") + 1).alias("bankruptcy_price"),
        F.when(kind == "ticker", F.when(F.col("seq") % 5 == 0, "snapshot").otherwise("delta")).alias("message_type"),
        F.when(kind == "ticker", values).alias("values"), "seq",
    )
    return widened(rows, "seq")


#: The same rows in SQL, as the start of a WITH list.
TAPE_SQL = """
WITH e AS (
  SELECT event_id AS seq, 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS recv_ns, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
tape AS (
  SELECT seq, symbol, recv_ns, value, k,
    CASE WHEN event_type IN ('purchase', 'click', 'view') THEN 'public_trade' WHEN event_type = 'signup' THEN 'ticker' ELSE 'liquidation' END AS kind,
    CASE WHEN event_type IN ('purchase', 'click', 'view') THEN 'trades' WHEN event_type = 'signup' THEN 'ticker' ELSE 'liquidations' END AS feed,
    CASE WHEN seq % 2 = 0 THEN 'Buy' ELSE 'Sell' END AS side, 1.0 + k % 5 AS tqty,
    recv_ns - (k - 20) * 1500000 AS sent_ns,
    CASE WHEN seq % 11 = 0 THEN 0 ELSE recv_ns - 1000000000000 + CASE WHEN seq % 13 = 0 THEN 5000000000000 ELSE 0 END END AS mono_ns,
    't' || (seq // 2) AS trade_id, CASE WHEN seq % 3 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS oi,
    CASE WHEN seq % 5 = 0 THEN 'snapshot' ELSE 'delta' END AS message_type
  FROM e)
"""


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as updates of one book for each symbol (depth 50), with ``seq``.

    Every SNAPSHOT_EVERY-th update of a symbol is a snapshot; an event divisible
    by SKIP_EVERY shifts the later update ids by one, which breaks the chain.
    """
    from pyspark.sql import Window

    e = events(spark, sf_dir)
    w = Window.partitionBy("symbol").orderBy("recv_ns", "seq")
    e = e.withColumn("i", F.row_number().over(w)).withColumn("skips", F.sum((F.col("seq") % SKIP_EVERY == 0).cast("int")).over(w))
    snapshot = F.col("i") % SNAPSHOT_EVERY == 1

    def levels(sign: int):
        price = F.floor("value") + F.lit(0 if sign < 0 else 1)
        size = (F.col("k") % 4).cast("string")
        one = F.array(price.cast("string"), size)
        return F.when(snapshot, F.array(one, F.array((price + sign).cast("string"), F.lit("2")), F.array((price + 2 * sign).cast("string"), F.lit("3")))).otherwise(F.array(one))

    rows = e.select(
        F.when(snapshot, "orderbook_snapshot").otherwise("orderbook_delta").alias("kind"), F.lit(VENUE).alias("venue"), "symbol",
        F.col("recv_ns").alias("local_receive_ts_ns"), F.col("recv_ns").alias("local_receive_mono_ns"), F.lit(50).alias("depth"),
        (F.col("recv_ns") - 5_000_000).alias("exchange_system_ts_ns"), F.when(F.col("k") % 2 == 0, levels(-1)).otherwise(F.array().cast("array<array<string>>")).alias("bids"),
        F.when((F.col("k") % 2 == 1) | snapshot, levels(1)).otherwise(F.array().cast("array<array<string>>")).alias("asks"),
        (F.col("i") + F.col("skips") + 100).cast("bigint").alias("update_id"), F.lit(False).alias("restart_snapshot"), F.lit(False).alias("sequence_gap"), "seq",
    )
    return widened(rows, "seq")


BOOK_SQL = """
WITH e AS (
  SELECT event_id AS seq, 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS recv_ns, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
n AS (SELECT *, row_number() OVER w AS i, sum(CASE WHEN seq % 37 = 0 THEN 1 ELSE 0 END) OVER w AS skips
      FROM e WINDOW w AS (PARTITION BY symbol ORDER BY recv_ns, seq)),
b AS (SELECT seq, symbol, recv_ns, k, i, i % 20 = 1 AS snapshot, CAST(i + skips + 100 AS BIGINT) AS u, floor(value) AS p FROM n),
v1 AS (SELECT *, sum(CASE WHEN snapshot THEN 1 ELSE 0 END) OVER w AS epoch, lag(u) OVER w AS pu FROM b WINDOW w AS (PARTITION BY symbol ORDER BY recv_ns, seq)),
v AS (SELECT *, epoch > 0 AND sum(CASE WHEN NOT snapshot AND u <> pu + 1 THEN 1 ELSE 0 END)
         OVER (PARTITION BY symbol, epoch ORDER BY recv_ns, seq) = 0 AS valid FROM v1),
lv AS (
  SELECT symbol, seq, recv_ns, i, epoch, 'bid' AS side, 0 AS pos, p AS price, CAST(k % 4 AS DOUBLE) AS size FROM v WHERE valid AND k % 2 = 0
  UNION ALL SELECT symbol, seq, recv_ns, i, epoch, 'bid', 1, p - 1, 2.0 FROM v WHERE valid AND k % 2 = 0 AND snapshot
  UNION ALL SELECT symbol, seq, recv_ns, i, epoch, 'bid', 2, p - 2, 3.0 FROM v WHERE valid AND k % 2 = 0 AND snapshot
  UNION ALL SELECT symbol, seq, recv_ns, i, epoch, 'ask', 0, p + 1, CAST(k % 4 AS DOUBLE) FROM v WHERE valid AND (k % 2 = 1 OR snapshot)
  UNION ALL SELECT symbol, seq, recv_ns, i, epoch, 'ask', 1, p + 2, 2.0 FROM v WHERE valid AND snapshot
  UNION ALL SELECT symbol, seq, recv_ns, i, epoch, 'ask', 2, p + 3, 3.0 FROM v WHERE valid AND snapshot)
"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as raw venue frames: even users on one venue, odd ones on the other."""
    e = events(spark, sf_dir)
    bybit = F.substring("symbol", 2, 9).cast("int") % 2 == 0
    ms = F.expr("recv_ns div 1000000 - 3").cast("string")
    v, q = F.col("value").cast("string"), (1 + F.col("k") % 5).cast("string")
    buy = F.col("seq") % 2 == 0
    low = F.lower("symbol")
    liquid, ticker = F.col("event_type") == "error", F.col("event_type") == "signup"
    side = F.when(buy, "Buy").otherwise("Sell")
    first = (
        F.when(liquid, F.format_string('{"topic":"allLiquidation.%s","ts":%s,"data":[{"s":"%s","S":"%s","T":%s,"v":"%s","p":"%s"}]}', "symbol", ms, "symbol", side, ms, q, v))
        .when(ticker, F.format_string('{"topic":"tickers.%s","type":"%s","ts":%s,"cs":%d,"data":{"symbol":"%s","markPrice":"%s","lastPrice":"","openInterest":"%d"}}', "symbol", F.when(buy, "snapshot").otherwise("delta"), ms, "k", "symbol", v, "k"))
        .otherwise(F.format_string('{"topic":"publicTrade.%s","ts":%s,"data":[{"s":"%s","S":"%s","T":%s,"i":"t%d","p":"%s","v":"%s"}]}', "symbol", ms, low, side, ms, "seq", v, q))
    )
    second = (
        F.when(liquid, F.format_string('{"stream":"!forceOrder@arr","data":{"E":%s,"o":{"s":"%s","S":"%s","q":"%s","p":"%s","T":%s}}}', ms, "symbol", F.when(buy, "SELL").otherwise("BUY"), q, v, ms))
        .when(ticker, F.format_string('{"stream":"%s@markPrice@1s","data":{"s":"%s","E":%s,"p":"%s","i":"x","r":"","T":0}}', low, "symbol", ms, v))
        .otherwise(F.format_string('{"stream":"%s@trade","data":{"s":"%s","E":%s,"T":%s,"t":%d,"p":"%s","q":"%s","m":%s,"X":"%s"}}', low, "symbol", ms, ms, "seq", v, q, F.when(buy, "false").otherwise("true"), F.when(F.col("k") % 7 == 0, "NA").otherwise("MARKET")))
    )
    return e.select(
        F.when(bybit, "bybit").otherwise("binance").alias("venue"), F.when(bybit, first).otherwise(second).alias("raw"), "recv_ns",
        F.col("recv_ns").alias("mono_ns"), F.col("seq").alias("arrival_seq"), F.lit("all").alias("tier"),
    )
