"""Further queries: ladders, exports of books, clean hours, histories, tiers, health and scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.functions import scalars
from ticklake.operators import book, export, health, meter, order, universe
from ticklake.plans.history_queries import FRAMES_SQL, frames
from ticklake.plans.tape_queries import AT_SQL, MOMENTS, chained, rounded
from ticklake.sources import normalize, tape_files, testbed
from ticklake.sources.testbed import BOOK_SQL, TAPE_SQL, events, tape


def book_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best levels of each side of every book at four moments."""
    rows = chained(spark, sf_dir)
    moments = rows.select("symbol").distinct().withColumn("at_ns", F.explode(F.array(*(F.lit(m) for m in MOMENTS))))
    shape = book.shapes(book.books_at(rows, moments), n=2)
    parts = [shape.select("symbol", "at_ns", F.lit(s).alias("side"), F.posexplode(c).alias("pos", "x")) for s, c in (("bid", "bids"), ("ask", "asks"))]
    return parts[0].unionByName(parts[1]).select("symbol", "at_ns", "side", "pos", "x.price", "x.size")


BOOK_LADDER_SQL = f"""{BOOK_SQL}{AT_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol, at_ns, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) - 1 AS pos FROM lvl)
SELECT symbol, at_ns, side, CAST(pos AS INTEGER) AS pos, price, size FROM r WHERE pos < 2"""


def export_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level rows of the day files: chains start anew each day."""
    out = export.incremental_book(testbed.book(spark, sf_dir), 50)
    return out.select("symbol", "day", "seq", "is_snapshot", "side", "pos", "price", "amount")


EXPORT_BOOK_SQL = f"""{BOOK_SQL}, d1 AS (SELECT symbol, seq, recv_ns, k, snapshot, u, p, strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%d') AS day FROM b),
d2 AS (SELECT *, sum(CASE WHEN snapshot THEN 1 ELSE 0 END) OVER w AS epoch, lag(u) OVER w AS pu FROM d1 WINDOW w AS (PARTITION BY symbol, day ORDER BY recv_ns, seq)),
d AS (SELECT *, epoch > 0 AND sum(CASE WHEN NOT snapshot AND u IS DISTINCT FROM pu + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, day, epoch ORDER BY recv_ns, seq) = 0 AS good FROM d2),
o AS (SELECT symbol, day, seq, snapshot, 'bid' AS side, 0 AS pos, CAST(p AS BIGINT) AS price, CAST(k % 4 AS VARCHAR) AS amount FROM d WHERE good AND k % 2 = 0
  UNION ALL SELECT symbol, day, seq, snapshot, 'bid', 1, CAST(p AS BIGINT) - 1, '2' FROM d WHERE good AND k % 2 = 0 AND snapshot UNION ALL SELECT symbol, day, seq, snapshot, 'bid', 2, CAST(p AS BIGINT) - 2, '3' FROM d WHERE good AND k % 2 = 0 AND snapshot
  UNION ALL SELECT symbol, day, seq, snapshot, 'ask', 0, CAST(p AS BIGINT) + 1, CAST(k % 4 AS VARCHAR) FROM d WHERE good AND (k % 2 = 1 OR snapshot)
  UNION ALL SELECT symbol, day, seq, snapshot, 'ask', 1, CAST(p AS BIGINT) + 2, '2' FROM d WHERE good AND snapshot UNION ALL SELECT symbol, day, seq, snapshot, 'ask', 2, CAST(p AS BIGINT) + 3, '3' FROM d WHERE good AND snapshot)
SELECT symbol, day, seq, snapshot AS is_snapshot, side, pos, CAST(price AS VARCHAR) AS price, amount FROM o"""


def clean_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the hours in which their symbol and feed had at least two rows."""
    rows = tape(spark, sf_dir)
    from ticklake.schema import feed

    cells = rows.select(scalars.hour_key("local_receive_ts_ns").alias("hour"), "symbol", feed().alias("feed")).groupBy("hour", "symbol", "feed").agg(F.count("*").alias("n"))
    ledger = cells.withColumn("status", F.when(F.col("n") >= 2, "complete").otherwise("excluded"))
    return order.clean_hours(rows, ledger).select("symbol", "seq", "kind")


CLEAN_HOURS_SQL = f"{TAPE_SQL} SELECT symbol, seq, kind FROM (SELECT *, count(*) OVER (PARTITION BY symbol, feed, recv_ns // 3600000000000) AS n FROM tape) WHERE n >= 2"


def open_interest_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each liquidation as an open interest poll, valued at the last mark price (-1: none yet)."""
    t = tape(spark, sf_dir)
    polls = t.filter("kind = 'liquidation'").select("symbol", "local_receive_ts_ns", "seq", F.col("qty").alias("open_interest"))
    rows = normalize.open_interest_rows(polls, t)
    return rounded(rows.select("symbol", "seq", F.coalesce(F.try_element_at("values", F.lit("open_interest_value")), F.lit(-1.0)).alias("worth")))


OPEN_INTEREST_SQL = f"""{TAPE_SQL}, m AS (SELECT symbol, recv_ns, seq, kind, value, last_value(CASE WHEN kind = 'ticker' THEN value END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY recv_ns, seq ROWS UNBOUNDED PRECEDING) AS mark FROM tape)
SELECT symbol, seq, coalesce(round(value * mark, 6), -1) AS worth FROM m WHERE kind = 'liquidation'"""


def history_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily values after the last one written (the first ten days); names never written keep their newest only."""
    e = events(spark, sf_dir).filter("event_type = 'click'").withColumn("day", F.expr("recv_ns div 86400000000000"))
    rows = e.groupBy(F.lit("funding_settlement").alias("kind"), "symbol", (F.col("day") * 86_400_000).alias("funding_time_ms")).agg(F.max("value").alias("funding_rate"))
    done = rows.filter((F.col("funding_time_ms") < 1_704_931_200_000) & (F.substring("symbol", 2, 9).cast("int") % 2 == 0))
    return normalize.incremental(rows, done, "funding_time_ms", newest_only=True)


HISTORY_SQL = """WITH r AS (SELECT 'funding_settlement' AS kind, 'U' || user_id AS symbol, user_id, (epoch_us(ts) // 86400000000) * 86400000 AS funding_time_ms, max(value) AS funding_rate FROM events WHERE event_type = 'click' GROUP BY ALL),
s AS (SELECT *, max(CASE WHEN funding_time_ms < 1704931200000 AND user_id % 2 = 0 THEN funding_time_ms END) OVER (PARTITION BY symbol) AS seen, row_number() OVER (PARTITION BY symbol ORDER BY funding_time_ms DESC) AS n FROM r)
SELECT kind, symbol, funding_time_ms, funding_rate FROM s WHERE CASE WHEN seen IS NULL THEN n = 1 ELSE funding_time_ms > seen END"""


def tiers_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily tiers: users with a purchase, and users with an error that aren't in the first."""
    e = events(spark, sf_dir).withColumn("tick_ns", F.expr("recv_ns div 86400000000000"))
    tier = F.when(F.col("event_type") == "purchase", "deep").when(F.col("event_type") == "error", "wide")
    tiers = e.select("tick_ns", tier.alias("tier"), "symbol").filter("tier is not null").distinct()
    return universe.resolve(tiers, {"wide": ["deep"]}, ["deep", "wide"])


TIERS_SQL = """WITH t AS (SELECT DISTINCT epoch_us(ts) // 86400000000 AS tick_ns, CASE event_type WHEN 'purchase' THEN 'deep' ELSE 'wide' END AS tier, 'U' || user_id AS symbol FROM events WHERE event_type IN ('purchase', 'error'))
SELECT * FROM t WHERE NOT (tier = 'wide' AND EXISTS (SELECT 1 FROM t d WHERE d.tier = 'deep' AND d.tick_ns = t.tick_ns AND d.symbol = t.symbol))"""


def health_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of a recorder for each user: its status comes with each event; every seventh is torn, every fifth an hour old."""
    e = events(spark, sf_dir)
    now = F.expr("recv_ns div 1000000")
    stamp = F.col("recv_ns") - F.when(F.col("seq") % 5 == 0, 3_600_000_000_000).otherwise(5_000_000)
    text = F.format_string(
        '{"venue":"v","recorded_at_ns":%d,"queued_frames":%d,"queue_capacity":100,"disk_blocked":%s,"shards":[{"connected":true,"reconnects":%d},{"connected":false,"reconnects":1}],"budget":{"over":false,"shed":["a","b"]}}',
        stamp, "k", F.when(F.col("k") > 50, "true").otherwise("false"), "k",
    )
    docs = e.select(F.col("symbol").alias("realm"), now.alias("now_ms"), F.when(F.col("seq") % 7 == 0, "{torn").otherwise(text).alias("raw"), "seq")
    out = health.samples(docs)
    zero = {c: F.coalesce(F.col(c), F.lit(d)) for c, d in (("queue_fill", -1.0), ("blocked", -1.0), ("reconnects", -1), ("shards_connected", -1), ("status_age_ms", -1))}
    return out.select("realm", "now_ms", "state", *(v.cast("bigint" if c in ("reconnects", "shards_connected", "status_age_ms") else "double").alias(c) for c, v in zero.items()))


HEALTH_SQL = """WITH e AS (SELECT event_id AS seq, 'U' || user_id AS realm, (epoch_us(ts) * 1000) // 1000000 AS now_ms, epoch_us(ts) * 1000 AS ns, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
s AS (SELECT *, CASE WHEN seq % 7 = 0 THEN 'unreadable' WHEN seq % 5 = 0 THEN 'stale' ELSE 'live' END AS state FROM e)
SELECT realm, now_ms, state, CASE WHEN state = 'live' THEN round(k / 100.0, 6) ELSE -1 END AS queue_fill, CASE WHEN state <> 'live' THEN -1.0 WHEN k > 50 THEN 1.0 ELSE 0.0 END AS blocked,
  CASE WHEN state = 'live' THEN k + 1 ELSE -1 END AS reconnects, CASE WHEN state = 'live' THEN 1 ELSE -1 END AS shards_connected,
  CASE WHEN state = 'live' THEN CAST(round_even(now_ms - (ns - 5000000) / 1e6, 0) AS BIGINT) ELSE -1 END AS status_age_ms FROM s"""


def budget_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shed pairs hour by hour for each tier as a recorder, with an allowance of 60 percent of its mean traffic."""
    f = frames(spark, sf_dir).withColumn("tick", F.expr("recv_ns div 60000000000 div 60 * 60"))
    by = f.groupBy(F.col("tier").alias("recorder"), "tick", "feed").agg((F.sum("bytes") / 1e3).alias("gb"))
    ticks = by.groupBy("recorder", "tick").agg(F.sum("gb").alias("total_gb"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("feed", "gb")))).alias("gb"))
    mean = ticks.agg(F.avg("total_gb")).first()[0] or 1.0
    return rounded(meter.budget_ticks(ticks, ["view", "click", "signup"], 0.6 * mean, 0.9, 120))


BUDGET_TICKS_SQL = """WITH RECURSIVE f AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS recorder, event_type AS feed, (epoch_us(ts) // 60000000) // 60 * 60 AS tick,
  CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 + length(event_type) AS bytes FROM events),
t AS (SELECT recorder, tick, sum(bytes) / 1e3 AS total, coalesce(sum(bytes) FILTER (feed = 'view'), 0) / 1e3 AS a, coalesce(sum(bytes) FILTER (feed = 'click'), 0) / 1e3 AS b, coalesce(sum(bytes) FILTER (feed = 'signup'), 0) / 1e3 AS c,
  row_number() OVER (PARTITION BY recorder ORDER BY tick) AS i FROM f GROUP BY recorder, tick), m AS (SELECT 0.6 * avg(total) AS top FROM t),
r AS (
  SELECT DISTINCT recorder, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS tick, CAST(0 AS DOUBLE) AS projected, 0 AS gone, CAST(-1000000 AS BIGINT) AS acted, CAST(0 AS DOUBLE) AS pa, CAST(0 AS DOUBLE) AS pb, CAST(0 AS DOUBLE) AS pc FROM t
  UNION ALL
  SELECT recorder, i, tick, projected, new, CASE WHEN NOT waits AND (projected > top OR new < gone) THEN tick ELSE acted END, CASE WHEN new > gone AND gone < 1 THEN a ELSE pa END, CASE WHEN new >= 2 AND gone < 2 THEN b ELSE pb END, CASE WHEN new >= 3 AND gone < 3 THEN c ELSE pc END
  FROM (SELECT *, CASE WHEN waits THEN gone WHEN projected > top THEN CASE WHEN gone >= 2 THEN 3 WHEN gone = 1 THEN CASE WHEN projected - b <= top THEN 2 ELSE 3 END WHEN projected - a <= top THEN 1 WHEN projected - (a + b) <= top THEN 2 ELSE 3 END
      WHEN gone > 0 AND projected + CASE gone WHEN 1 THEN pa WHEN 2 THEN pb ELSE pc END < top * 0.9 THEN gone - 1 ELSE gone END AS new
    FROM (SELECT t.recorder, t.i, t.tick, a, b, c, r.gone, r.acted, pa, pb, pc, top, t.tick - r.acted < 120 AS waits,
        greatest(0, total - CASE WHEN gone > 0 THEN a ELSE 0 END - CASE WHEN gone > 1 THEN b ELSE 0 END - CASE WHEN gone > 2 THEN c ELSE 0 END) AS projected FROM r JOIN t ON t.recorder = r.recorder AND t.i = r.i + 1, m) x) y)
SELECT recorder, tick, round(projected, 6) AS projected, CASE gone WHEN 0 THEN '' WHEN 1 THEN 'view' WHEN 2 THEN 'view,click' ELSE 'view,click,signup' END AS shed FROM r WHERE i > 0"""


def budget_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the status document says of each recorder's budget after its last tick."""
    f = frames(spark, sf_dir).withColumn("tick", F.expr("recv_ns div 60000000000 div 60 * 60"))
    by = f.groupBy(F.col("tier").alias("recorder"), "tick", F.col("feed").alias("pair")).agg((F.sum("bytes") / 1e3).alias("gb"))
    mean = by.groupBy("recorder", "tick").agg(F.sum("gb").alias("gb")).agg(F.avg("gb")).first()[0] or 1.0
    row = meter.budget_status(budget_ticks(spark, sf_dir), by, ["view", "click", "signup"], 0.6 * mean)
    return row.select("recorder", "projected_month_gb", "over", F.array_join("shed", ",").alias("shed"), F.array_join("shed_order", ",").alias("shed_order"), F.coalesce("last_action", F.lit(-1)).alias("last_action"))


def receipts_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path parts of made receipt paths, and rows by day."""
    e = events(spark, sf_dir)
    path = F.concat(F.lit("root/"), F.date_format(F.timestamp_seconds(F.expr("recv_ns div 1000000000")), "yyyy-MM-dd/HH"), F.lit("/"), "symbol", F.lit("/segment-1.jsonl.zst"))
    rows = e.select(path.alias("path")).withColumns(scalars.path_parts("path"))
    return rows.groupBy("day", "hour").agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols"))


BUDGET_STATUS_SQL = f"""SELECT recorder, round(arg_max(projected, tick), 1) AS projected_month_gb, arg_max(projected, tick) > (SELECT 0.6 * avg(total) FROM (SELECT sum(CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 + length(event_type)) / 1e3 AS total
    FROM events GROUP BY user_id % 2 = 0, (epoch_us(ts) // 60000000) // 60)) AS over, arg_max(shed, tick) AS shed, 'view,click,signup' AS shed_order, coalesce(max(tick) FILTER (shed <> was), -1) AS last_action
FROM (SELECT *, coalesce(lag(shed) OVER (PARTITION BY recorder ORDER BY tick), '') AS was FROM ({BUDGET_TICKS_SQL})) GROUP BY recorder"""
RECEIPTS_BY_HOUR_SQL = "SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour, count(*) AS n, count(DISTINCT user_id) AS symbols FROM events GROUP BY ALL"


def meta_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first snapshot of each kind for each day."""
    e = events(spark, sf_dir).select(F.lit("v").alias("venue"), F.col("event_type").alias("kind"), F.col("recv_ns").alias("recorded_at_ns"))
    return tape_files.first_of_cadence(e, "day").select("kind", "slot", "recorded_at_ns")


META_SQL = "SELECT event_type AS kind, strftime(ts, '%Y-%m-%d') AS slot, min(epoch_us(ts) * 1000) AS recorded_at_ns FROM events GROUP BY ALL"


def tier_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols, topics and names of planned tiers."""
    from ticklake.plans.history_queries import universe_topics

    return universe.tier_status(universe_topics(spark, sf_dir)).select("tier", "symbols", "topics", F.concat_ws(",", "names").alias("names"))


def tier_status_sql() -> str:
    from ticklake.plans.history_queries import UNIVERSE_TOPICS_SQL

    return f"""WITH p AS (SELECT * FROM ({UNIVERSE_TOPICS_SQL})) SELECT tier, count(DISTINCT symbol) AS symbols, count(*) AS topics,
      CASE WHEN count(DISTINCT symbol) <= 64 THEN string_agg(DISTINCT symbol, ',' ORDER BY symbol) ELSE '' END AS names FROM p GROUP BY tier"""


def rows_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the tape as compact JSON with sorted keys, counted by symbol, kind and keys."""
    rows = tape_files.rows_as_json(tape(spark, sf_dir))
    keys = F.concat_ws(",", F.json_object_keys("value"))
    told = {n: F.get_json_object("value", f"$.{n}") for n in ("kind", "local_receive_ts_ns", "symbol")}
    return rows.select(keys.alias("keys"), *(v.alias(n) for n, v in told.items())).groupBy("symbol", "kind", "keys").agg(F.count("*").alias("n"), F.min(F.col("local_receive_ts_ns").cast("bigint")).alias("first_ns"), F.max(F.col("local_receive_ts_ns").cast("bigint")).alias("last_ns"))


def rows_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the tape as its line of compact JSON with sorted keys."""
    return tape_files.rows_as_json(tape(spark, sf_dir))


ROWS_JSON_LINES_SQL = f"""{TAPE_SQL} SELECT '{{' || CASE kind WHEN 'liquidation' THEN '"bankruptcy_price":' || CAST(value + 1 AS VARCHAR) || ',' ELSE '' END || '"exchange_system_ts_ns":' || sent_ns || ',"exchange_ts_ns":' || sent_ns
  || ',"kind":"' || kind || '","local_receive_mono_ns":' || mono_ns || ',"local_receive_ts_ns":' || recv_ns || CASE kind
    WHEN 'public_trade' THEN ',"price":' || CAST(value AS VARCHAR) || ',"qty":' || CAST(tqty AS VARCHAR) || ',"side":"' || side || '","symbol":"' || symbol || '","trade_id":"' || trade_id || '"'
    WHEN 'ticker' THEN ',"message_type":"' || message_type || '","symbol":"' || symbol || '","values":{{"mark_price":' || CAST(value AS VARCHAR) || CASE WHEN oi IS NULL THEN '' ELSE ',"open_interest":' || CAST(oi AS VARCHAR) END || '}}'
    ELSE ',"position_side":"' || side || '","qty":' || CAST(value AS VARCHAR) || ',"symbol":"' || symbol || '"' END || ',"venue":"testbed"}}' AS value FROM tape"""


KEYS_OF = {
    "public_trade": "exchange_system_ts_ns,exchange_ts_ns,kind,local_receive_mono_ns,local_receive_ts_ns,price,qty,side,symbol,trade_id,venue",
    "ticker": "exchange_system_ts_ns,exchange_ts_ns,kind,local_receive_mono_ns,local_receive_ts_ns,message_type,symbol,values,venue",
    "liquidation": "bankruptcy_price,exchange_system_ts_ns,exchange_ts_ns,kind,local_receive_mono_ns,local_receive_ts_ns,position_side,qty,symbol,venue",
}
ROWS_JSON_SQL = f"""{TAPE_SQL} SELECT symbol, kind, CASE kind {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KEYS_OF.items())} END AS keys, count(*) AS n, min(recv_ns) AS first_ns, max(recv_ns) AS last_ns FROM tape GROUP BY ALL"""


def rows_json_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 500 liquidations in total order as compact JSON with sorted keys (a top-k report)."""
    t = tape(spark, sf_dir).filter("kind = 'liquidation'").select("symbol", "kind", "position_side", "qty", "local_receive_ts_ns", "seq")
    rows = t.orderBy("local_receive_ts_ns", "symbol", "seq").limit(500)
    return rows.select("seq", scalars.sorted_json(["symbol", "kind", "position_side", "qty"]).alias("value"))


ROWS_JSON_TOP_SQL = f"""{TAPE_SQL} SELECT seq, '{{"kind":"liquidation","position_side":"' || side || '","qty":' || CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) || '.0' ELSE CAST(value AS VARCHAR) END || ',"symbol":"' || symbol || '"}}' AS value
FROM tape WHERE kind = 'liquidation' ORDER BY recv_ns, symbol, seq LIMIT 500"""


def bytes_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair's bytes and rank within its tier."""
    rows = frames(spark, sf_dir).groupBy("tier", "feed").agg(F.sum("bytes").alias("bytes"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("tier").orderBy(F.desc("bytes"), "feed")))


BYTES_RANK_SQL = f"{FRAMES_SQL} SELECT tier, feed, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(row_number() OVER (PARTITION BY tier ORDER BY sum(bytes) DESC, feed) AS INTEGER) AS rank FROM f GROUP BY tier, feed"

QUERIES = {
    "book_ladder": book_ladder, "export_book": export_book, "clean_hours": clean_hours, "open_interest_polls": open_interest_polls, "history_incremental": history_incremental, "tiers_resolved": tiers_resolved,
    "health_samples": health_samples, "budget_status": budget_status, "budget_ticks": budget_ticks, "receipts_by_hour": receipts_by_hour, "meta_cadence": meta_cadence, "tier_status": tier_status, "rows_json": rows_json, "rows_json_lines": rows_json_lines, "rows_json_top": rows_json_top, "bytes_rank": bytes_rank,
}
SQL = {
    "book_ladder": BOOK_LADDER_SQL, "export_book": EXPORT_BOOK_SQL, "clean_hours": CLEAN_HOURS_SQL, "open_interest_polls": OPEN_INTEREST_SQL, "history_incremental": HISTORY_SQL, "tiers_resolved": TIERS_SQL,
    "health_samples": HEALTH_SQL, "budget_status": BUDGET_STATUS_SQL, "budget_ticks": BUDGET_TICKS_SQL, "receipts_by_hour": RECEIPTS_BY_HOUR_SQL, "meta_cadence": META_SQL, "tier_status": tier_status_sql(), "rows_json": ROWS_JSON_SQL, "rows_json_lines": ROWS_JSON_LINES_SQL, "rows_json_top": ROWS_JSON_TOP_SQL, "bytes_rank": BYTES_RANK_SQL,
}
