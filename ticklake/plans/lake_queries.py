"""Queries of normalisation, export, file inventories, audits and stored tapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.operators import audit, export, order, retention
from ticklake.plans.tape_queries import DAY, HOUR, rounded
from ticklake.schema import feed
from ticklake.sources import normalize, tape_files
from ticklake.sources.scratch import scratch
from ticklake.sources.testbed import TAPE_SQL, events, frames, read, tape


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalized(frames(spark, sf_dir))


NORM_SQL = """WITH e AS (SELECT event_id AS seq, 'U' || user_id AS symbol, user_id % 2 = 0 AS first, epoch_us(ts) * 1000 AS recv_ns, ((epoch_us(ts) * 1000) // 1000000 - 3) * 1000000 AS sent,
  event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 2 = 0 THEN 'Buy' ELSE 'Sell' END AS side FROM events)"""


def normalize_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalized(spark, sf_dir).filter("kind = 'public_trade'")
    return rows.select("venue", "symbol", "seq", "local_receive_ts_ns", "exchange_system_ts_ns", "exchange_ts_ns", "trade_id", "price", "qty", "side")


NORMALIZE_TRADES_SQL = f"""{NORM_SQL} SELECT CASE WHEN first THEN 'bybit' ELSE 'binance' END AS venue, symbol, seq, recv_ns AS local_receive_ts_ns, sent AS exchange_system_ts_ns, sent AS exchange_ts_ns,
  CASE WHEN first THEN 't' ELSE '' END || seq AS trade_id, value AS price, CAST(1 + k % 5 AS DOUBLE) AS qty, side
FROM e WHERE event_type IN ('purchase', 'click', 'view') AND (first OR k % 7 <> 0)"""


def normalize_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalized(spark, sf_dir).filter("kind = 'ticker'")
    return rows.select("venue", "symbol", "seq", "exchange_system_ts_ns", "message_type", F.map_keys("values").alias("names"), F.coalesce(F.try_element_at("values", F.lit("mark_price")), F.lit(0.0)).alias("mark_price")).withColumn("names", F.concat_ws(",", F.sort_array("names")))


NORMALIZE_TICKERS_SQL = f"""{NORM_SQL} SELECT CASE WHEN first THEN 'bybit' ELSE 'binance' END AS venue, symbol, seq, sent AS exchange_system_ts_ns,
  CASE WHEN first AND seq % 2 = 0 THEN 'snapshot' ELSE 'delta' END AS message_type, CASE WHEN first THEN 'mark_price,open_interest' ELSE 'mark_price,next_funding_time_ms' END AS names, value AS mark_price FROM e WHERE event_type = 'signup'"""


def normalize_liquidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalized(spark, sf_dir).filter("kind = 'liquidation'")
    return rows.select("venue", "symbol", "seq", "exchange_ts_ns", "position_side", "qty", "bankruptcy_price")


NORMALIZE_LIQUIDATIONS_SQL = f"""{NORM_SQL} SELECT CASE WHEN first THEN 'bybit' ELSE 'binance' END AS venue, symbol, seq, sent AS exchange_ts_ns, side AS position_side, CAST(1 + k % 5 AS DOUBLE) AS qty, value AS bankruptcy_price FROM e WHERE event_type = 'error'"""


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final daily candles from kline frames that repeat each day's candle after every event, confirmed by every second."""
    e = events(spark, sf_dir).withColumn("day", F.expr(f"recv_ns div {DAY}"))
    w = Window.partitionBy("symbol", "day").orderBy("recv_ns", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumns({"o": F.first("value").over(w), "h": F.max("value").over(w), "l": F.min("value").over(w)})
    start = (F.col("day") * 86_400_000).cast("bigint")
    text = F.format_string(
        '{"topic":"kline.D.%s","ts":1,"data":[{"start":%d,"end":%d,"open":"%s","high":"%s","low":"%s","close":"%s","volume":"1","turnover":"2","confirm":%s}]}',
        "symbol", start, start + 86_399_999, F.col("o").cast("string"), F.col("h").cast("string"), F.col("l").cast("string"), F.col("value").cast("string"), F.when(F.col("seq") % 2 == 0, "true").otherwise("false"),
    )
    raw = e.select(F.lit("bybit").alias("venue"), text.alias("raw"), "recv_ns", F.lit(0).cast("bigint").alias("mono_ns"), F.col("seq").alias("arrival_seq"))
    return order.final_candles(normalize.bybit(raw)).select("symbol", "interval", "start_ms", "open", "high", "low", "close")


CANDLES_SQL = f"""WITH e AS (SELECT event_id AS seq, 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS recv_ns, value, (epoch_us(ts) * 1000) // {DAY} AS day FROM events),
w AS (SELECT *, first_value(value) OVER o AS "open", max(value) OVER o AS high, min(value) OVER o AS low FROM e WINDOW o AS (PARTITION BY symbol, day ORDER BY recv_ns, seq ROWS UNBOUNDED PRECEDING)),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol, day ORDER BY recv_ns DESC, seq DESC) AS n FROM w WHERE seq % 2 = 0)
SELECT symbol, '1d' AS interval, day * 86400000 AS start_ms, "open", high, low, value AS "close" FROM n WHERE n = 1"""


def merged_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables of per-user values merged, the later non-null field winning."""
    e = events(spark, sf_dir)
    one = e.filter("event_type = 'click'").groupBy("symbol").agg(F.max("value").alias("price"), F.min("value").alias("low"))
    two = e.filter("event_type = 'error'").groupBy("symbol").agg(F.max("value").alias("price"))
    three = e.filter("event_type = 'signup' and k > 60").groupBy("symbol").agg(F.min("value").alias("low"), F.count("*").alias("n"))
    out = normalize.merge_tickers(one, two, three)
    return out.select("symbol", "price", "low", F.coalesce("n", F.lit(0)).alias("n"))


MERGED_TICKERS_SQL = """WITH e AS (SELECT 'U' || user_id AS symbol, value, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
a AS (SELECT symbol, max(value) AS price, min(value) AS low FROM e WHERE event_type = 'click' GROUP BY 1), b AS (SELECT symbol, max(value) AS price FROM e WHERE event_type = 'error' GROUP BY 1),
c AS (SELECT symbol, min(value) AS low, count(*) AS n FROM e WHERE event_type = 'signup' AND k > 60 GROUP BY 1)
SELECT symbol, coalesce(b.price, a.price) AS price, coalesce(c.low, a.low) AS low, coalesce(n, 0) AS n FROM a FULL JOIN b USING (symbol) FULL JOIN c USING (symbol)"""


# ---------------------------------------------------------------------- export
def export_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.trades(tape(spark, sf_dir)).drop("venue", "restamped", "local_receive_ts_ns")


_US = "recv_ns // 1000"
EXPORT_TRADES_SQL = f"""{TAPE_SQL} SELECT symbol, strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%d') AS day, seq, sent_ns // 1000 AS "timestamp", {_US} AS local_timestamp, trade_id AS id, lower(side) AS side,
  regexp_replace(CAST(value AS VARCHAR), '[.]0$', '') AS price, regexp_replace(CAST(tqty AS VARCHAR), '[.]0$', '') AS amount FROM tape WHERE kind = 'public_trade'"""


def export_liquidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.liquidations(tape(spark, sf_dir)).select("symbol", "day", "seq", "local_timestamp", "side", "price")


EXPORT_LIQUIDATIONS_SQL = f"""{TAPE_SQL} SELECT symbol, strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%d') AS day, seq, {_US} AS local_timestamp, CASE side WHEN 'Buy' THEN 'sell' ELSE 'buy' END AS side,
  regexp_replace(CAST(value + 1 AS VARCHAR), '[.]0$', '') AS price FROM tape WHERE kind = 'liquidation'"""


def export_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.derivative_ticker(tape(spark, sf_dir)).select("symbol", "day", "seq", "timestamp", *export.TICKER, "restamped")


EXPORT_TICKER_SQL = f"""{TAPE_SQL}, t AS (SELECT symbol, seq, recv_ns, sent_ns, strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%d') AS day, value,
  last_value(oi IGNORE NULLS) OVER (PARTITION BY symbol, recv_ns // {DAY} ORDER BY recv_ns, seq ROWS UNBOUNDED PRECEDING) AS o FROM tape WHERE kind = 'ticker'),
s AS (SELECT *, coalesce(CAST(CAST(o AS BIGINT) AS VARCHAR), '') AS oi, regexp_replace(CAST(value AS VARCHAR), '[.]0$', '') AS mark FROM t),
c AS (SELECT *, lag(oi) OVER w AS po, lag(mark) OVER w AS pm FROM s WINDOW w AS (PARTITION BY symbol, day ORDER BY recv_ns, seq))
SELECT symbol, day, seq, sent_ns // 1000 AS "timestamp", oi AS open_interest, mark AS mark_price, '' AS funding_timestamp, '' AS funding_rate, '' AS last_price, '' AS index_price, false AS restamped FROM c WHERE po IS NULL OR oi <> po OR mark <> pm"""


def export_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.receipts(export.trades(tape(spark, sf_dir)), "trades")


EXPORT_RECEIPTS_SQL = f"""{TAPE_SQL} SELECT strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%d') AS day, symbol, count(*) AS rows, count(DISTINCT recv_ns // {HOUR}) AS hours, 'trades' AS type FROM tape WHERE kind = 'public_trade' GROUP BY ALL"""


def export_planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and symbols to export: of the days with events in all hours, minus users divisible by 4."""
    t = order_day(tape(spark, sf_dir))
    done = t.filter(F.substring("symbol", 2, 9).cast("int") % 4 == 0).select("day", "symbol").distinct()
    return export.to_export(t, done, t.select("day", "hour").distinct())


def order_day(rows: DataFrame) -> DataFrame:
    day, hour = order.utc_day_hour()
    return rows.withColumns({"day": day, "hour": hour})


EXPORT_PLANNED_SQL = f"""{TAPE_SQL}, t AS (SELECT *, strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%d') AS day FROM tape),
f AS (SELECT day FROM t GROUP BY day HAVING count(DISTINCT recv_ns // {HOUR}) = 24)
SELECT DISTINCT day, symbol FROM t WHERE day IN (SELECT day FROM f) AND CAST(substr(symbol, 2) AS INTEGER) % 4 <> 0"""


# ------------------------------------------------------------ stored tapes
def stored_json_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tape written as JSON segments and read again: rows, stamps and sums by symbol and kind."""
    path = scratch(spark, "tape")
    tape_files.write_json_tape(tape(spark, sf_dir), path, by=("day",))
    rows = tape_files.read_partitioned_json(spark, path)
    out = rows.groupBy("symbol", "kind").agg(F.count("*").alias("n"), F.min("local_receive_ts_ns").alias("first_ns"), F.max("local_receive_ts_ns").alias("last_ns"), F.coalesce(F.sum("price"), F.lit(0.0)).alias("prices"))
    return rounded(out, 4)


STORED_SQL = f"""{TAPE_SQL} SELECT symbol, kind, count(*) AS n, min(recv_ns) AS first_ns, max(recv_ns) AS last_ns, round(coalesce(sum(value) FILTER (kind = 'public_trade'), 0), 4) AS prices FROM tape GROUP BY ALL"""


def stored_columnar_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tape written as Parquet and one day's trades read again in order."""
    path = scratch(spark, "columnar")
    tape_files.write_columnar(tape(spark, sf_dir), path, by=("venue", "day"))
    rows = spark.read.parquet(path).filter("day = '2024-01-05' and kind = 'public_trade'").withColumn("day", F.col("day").cast("string"))
    return rows.select("symbol", "seq", "local_receive_ts_ns", "price", feed().alias("feed"))


STORED_COLUMNAR_SQL = f"{TAPE_SQL} SELECT symbol, seq, recv_ns AS local_receive_ts_ns, value AS price, feed FROM tape WHERE kind = 'public_trade' AND recv_ns // {DAY} = {1_704_412_800 // 86_400}"


def receipts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of made files, one for each (day, user); every fifth user's later files are deleted again."""
    e = order_day(events(spark, sf_dir).withColumnRenamed("recv_ns", "local_receive_ts_ns"))
    files = e.groupBy("day", "symbol").agg(F.count("*").alias("records"), F.min("local_receive_ts_ns").alias("first_receive_ns"), F.max("local_receive_ts_ns").alias("last_receive_ns"), F.min("seq").alias("line"))
    files = files.withColumns({"path": F.concat_ws("/", "day", "symbol", F.lit("segment-0.jsonl")), "kind": F.lit("segment"), "hour": F.col("day"), "sha256": F.sha2(F.concat("day", "symbol"), 256), "bytes": F.col("records") * 400})
    gone = files.filter((F.substring("symbol", 2, 9).cast("int") % 5 == 0) & (F.dayofmonth(F.to_date("day")) > 20)).withColumns({"kind": F.lit("segment_deleted"), "line": F.col("line") + 1_000_000})
    return files.unionByName(gone)


RECEIPTS_SQL = f"""WITH e AS (SELECT event_id AS seq, 'U' || user_id AS symbol, user_id, epoch_us(ts) * 1000 AS ns, strftime(ts, '%Y-%m-%d') AS day FROM events),
f AS (SELECT day, symbol, user_id, count(*) AS records, min(ns) AS first_ns, max(ns) AS last_ns, day || '/' || symbol || '/segment-0.jsonl' AS path FROM e GROUP BY ALL),
kept AS (SELECT * FROM f WHERE NOT (user_id % 5 = 0 AND CAST(substr(day, 9) AS INTEGER) > 20))"""


def receipts_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tape_files.fold_receipts(receipts_of(spark, sf_dir)).select("path", "records", "first_receive_ns", "last_receive_ns")


def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings on made files: user 1's digest differs, user 2's files are gone, user 3 has no receipts, user 4 lost rows, day 7 has no coverage."""
    rec = tape_files.fold_receipts(receipts_of(spark, sf_dir))
    number = F.substring("symbol", 2, 9).cast("int")
    files = rec.filter(number != 2).select("hour", "path", F.when(number == 1, "x").otherwise(F.col("sha256")).alias("sha256"))
    content = rec.select("hour", "path", (F.col("records") - F.when(number == 4, 1).otherwise(0)).alias("seen"), F.col("first_receive_ns").alias("first_ns"), F.col("last_receive_ns").alias("last_ns"), F.lit(None).cast("bigint").alias("late_line"), F.lit(0).alias("bad_lines"))
    hours = rec.filter(~F.col("hour").endswith("-07")).select("hour").distinct()
    return audit.findings(files, rec.filter(number != 3), content, hours)


AUDIT_SQL = f"""{RECEIPTS_SQL} SELECT day AS hour, path, CASE user_id WHEN 1 THEN 'digest' WHEN 2 THEN 'missing' WHEN 3 THEN 'unreceipted' ELSE 'rows' END AS finding FROM kept WHERE user_id IN (1, 2, 3, 4)
UNION ALL SELECT DISTINCT day, '', 'no_coverage' FROM kept WHERE day LIKE '%-07'"""


def walked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rows of the made files say: lines in arrival order, but user 5's files have their first line last, and user 6 has a torn line in each."""
    e = order_day(events(spark, sf_dir).withColumnRenamed("recv_ns", "local_receive_ts_ns"))
    number = F.substring("symbol", 2, 9).cast("int")
    w = Window.partitionBy("day", "symbol").orderBy("local_receive_ts_ns", "seq")
    rows = e.select("day", "symbol", "local_receive_ts_ns", F.row_number().over(w).alias("line"), number.alias("n"))
    rows = rows.withColumn("line", F.when((F.col("n") == 5) & (F.col("line") == 1), 1_000_000).otherwise(F.col("line"))).withColumn("bad", (F.col("n") == 6) & (F.col("line") == 1))
    return audit.walked(rows.select(F.col("day").alias("hour"), F.concat_ws("/", "day", "symbol", F.lit("segment-0.jsonl")).alias("path"), "line", "local_receive_ts_ns", "bad"))


def audit_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = tape_files.fold_receipts(receipts_of(spark, sf_dir))
    number = F.substring("symbol", 2, 9).cast("int")
    files = rec.filter(number != 2).select("hour", "path", "sha256")
    return audit.audit(files, rec, walked_files(spark, sf_dir), rec.select("hour").distinct()).select("hour", "files", "receipts", "findings", "ok", "sound")


AUDIT_HOURS_SQL = f"""{RECEIPTS_SQL} SELECT day AS hour, count(*) FILTER (user_id <> 2) AS files, count(*) AS receipts, count(*) FILTER (fault) AS findings,
  count(*) FILTER (fault) = 0 AS ok, count(*) FILTER (fault) = 0 AS sound FROM (SELECT *, user_id IN (2, 6) OR (user_id = 5 AND first_ns < last_ns) AS fault FROM kept) GROUP BY day"""


# ----------------------------------------------------------------- inventories
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as stored files, written on their ship date."""
    line = read(spark, sf_dir, "lineitem")
    path = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return line.select(path.alias("path"), F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("written_s"), (F.col("l_quantity") * 1000).cast("bigint").alias("size"), (F.col("l_linenumber") == 7).alias("meta"), "l_suppkey", "l_orderkey")


INVENTORY_SQL = """WITH i AS (SELECT *, row_number() OVER (ORDER BY written_s, path) AS pos FROM (SELECT l_orderkey || '/' || l_linenumber AS path, epoch_us(l_shipdate) // 1000000 AS written_s,
  CAST(l_quantity * 1000 AS BIGINT) AS size, l_linenumber = 7 AS meta, l_suppkey, l_orderkey FROM lineitem))"""
EXPIRED = 820_454_400  # 1996-01-01


def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to delete so that files from before 1996 go and the rest fits half of its size."""
    files = inventory(spark, sf_dir)
    cap = files.agg(F.expr("sum(size) div 2")).first()[0] or 0
    return retention.retention_plan(files, EXPIRED, cap).select("path", "size", "why")


RETENTION_SQL = f"""{INVENTORY_SQL}, t AS (SELECT CAST(sum(size) AS BIGINT) AS total, CAST(sum(size) FILTER (written_s < {EXPIRED}) AS BIGINT) AS aged FROM i),
r AS (SELECT i.*, total // 2 AS cap, total - coalesce(aged, 0) - coalesce(sum(CASE WHEN written_s >= {EXPIRED} AND NOT meta THEN size END) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM i, t)
SELECT path, size, CASE WHEN written_s < {EXPIRED} THEN 'age' ELSE 'space' END AS why FROM r WHERE written_s < {EXPIRED} OR (NOT meta AND rest > cap)"""


def ranges_coalesced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of every supplier's line items, laid one after another, of which each third is wanted."""
    w = Window.partitionBy("l_suppkey").orderBy("written_s", "path")
    files = inventory(spark, sf_dir).withColumn("offset", F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    wanted = files.filter(F.col("l_orderkey") % 3 == 0).select(F.col("l_suppkey").alias("archive"), "offset", "size")
    return retention.coalesced_ranges(wanted, gap=60_000)


RANGES_SQL = f"""{INVENTORY_SQL}, o AS (SELECT l_suppkey AS archive, l_orderkey, size, CAST(coalesce(sum(size) OVER (PARTITION BY l_suppkey ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM i),
n AS (SELECT *, CASE WHEN off - max(off + size) OVER (PARTITION BY archive ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 60000 THEN 0 ELSE 1 END AS new FROM o WHERE l_orderkey % 3 = 0),
g AS (SELECT *, sum(new) OVER (PARTITION BY archive ORDER BY off ROWS UNBOUNDED PRECEDING) AS r FROM n)
SELECT archive, min(off) AS "offset", max(off + size) - min(off) AS size, count(*) AS members FROM g GROUP BY archive, r"""


def fetch_planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols asked for by day (purchases), as one list for each, newest day first."""
    e = order_day(events(spark, sf_dir).withColumnRenamed("recv_ns", "local_receive_ts_ns"))
    asked = e.filter("event_type = 'purchase'").select(F.lit("t").alias("tape"), "day", F.lit("00").alias("hour"), F.lower("symbol").alias("symbol"))
    return retention.fetch_plan(asked).select("day", F.concat_ws(",", "symbols").alias("symbols"))


FETCH_SQL = "SELECT day, string_agg(symbol, ',' ORDER BY symbol) AS symbols FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, 'U' || user_id AS symbol FROM events WHERE event_type = 'purchase') GROUP BY day"


def hour_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = tape_files.fold_receipts(receipts_of(spark, sf_dir))
    files = rec.withColumn("h", F.unix_seconds(F.to_timestamp("day")).cast("bigint") / 3600).withColumn("h", F.col("h").cast("bigint"))
    out = retention.hour_manifest(files.select("h", "path", "bytes", "symbol"), rec.filter("records > 2"))
    return out.select("h", "files", "bytes", "records", F.size("symbols").alias("symbols"))


MANIFEST_SQL = f"""{RECEIPTS_SQL} SELECT epoch_us(CAST(day AS TIMESTAMP)) // 3600000000 AS h, count(*) AS files, CAST(sum(records * 400) AS BIGINT) AS bytes, CAST(coalesce(sum(records) FILTER (records > 2), 0) AS BIGINT) AS records,
  CAST(count(DISTINCT symbol) AS INTEGER) AS symbols FROM kept GROUP BY ALL"""

QUERIES = {
    "normalize_trades": normalize_trades, "normalize_tickers": normalize_tickers, "normalize_liquidations": normalize_liquidations, "candles_final": candles, "tickers_merged": merged_tickers,
    "export_trades": export_trades, "export_liquidations": export_liquidations, "export_ticker": export_ticker, "export_receipts": export_receipts, "export_planned": export_planned,
    "stored_json_tape": stored_json_tape, "stored_columnar_tape": stored_columnar_tape, "receipts_folded": receipts_folded, "audit_findings": audit_findings, "audit_hours": audit_hours,
    "retention_plan": retention_plan, "ranges_coalesced": ranges_coalesced, "fetch_planned": fetch_planned, "hour_manifest": hour_manifest,
}
SQL = {
    "normalize_trades": NORMALIZE_TRADES_SQL, "normalize_tickers": NORMALIZE_TICKERS_SQL, "normalize_liquidations": NORMALIZE_LIQUIDATIONS_SQL, "candles_final": CANDLES_SQL, "tickers_merged": MERGED_TICKERS_SQL,
    "export_trades": EXPORT_TRADES_SQL, "export_liquidations": EXPORT_LIQUIDATIONS_SQL, "export_ticker": EXPORT_TICKER_SQL, "export_receipts": EXPORT_RECEIPTS_SQL, "export_planned": EXPORT_PLANNED_SQL,
    "stored_json_tape": STORED_SQL, "stored_columnar_tape": STORED_COLUMNAR_SQL, "receipts_folded": f"{RECEIPTS_SQL} SELECT path, records, first_ns AS first_receive_ns, last_ns AS last_receive_ns FROM kept",
    "audit_findings": AUDIT_SQL, "audit_hours": AUDIT_HOURS_SQL, "retention_plan": RETENTION_SQL, "ranges_coalesced": RANGES_SQL, "fetch_planned": FETCH_SQL, "hour_manifest": MANIFEST_SQL,
}
