"""Queries of interval algebra, coverage, universes and metering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import coverage, coverage_log, meter, spans, universe
from ticklake.plans.tape_queries import DAY, HOUR, rounded
from ticklake.sources import tape_files
from ticklake.sources.scratch import scratch, stored
from ticklake.sources.testbed import TAPE_SQL, events, read, tape

# ------------------------------------------------------------ interval algebra


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span of days for each order, by customer."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), day.alias("start"), (day + F.col("o_orderkey") % 40).alias("end"))


def cut_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span of two weeks from each order's ship dates, by customer."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    lines = read(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select("l_orderkey", day.alias("start"))
    owner = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    return lines.join(owner, lines["l_orderkey"] == owner["o_orderkey"]).select("key", "start", (F.col("start") + 14).alias("end"))


SPANS_SQL = """WITH a0 AS (SELECT o_custkey AS key, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS s, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + o_orderkey % 40 AS e FROM orders),
b0 AS (SELECT o_custkey AS key, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS s, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + 14 AS e
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1),
ad AS (SELECT DISTINCT key, unnest(range(s, e)) AS day FROM a0), bd AS (SELECT DISTINCT key, unnest(range(s, e)) AS day FROM b0)"""


def _islands(table: str) -> str:
    """Spans from a set of days."""
    return f"""SELECT key, min(day) AS "start", max(day) + 1 AS "end" FROM (SELECT key, day, day - row_number() OVER (PARTITION BY key ORDER BY day) AS island FROM {table}) GROUP BY key, island"""


def spans_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.merge(order_spans(spark, sf_dir), "key")


def spans_intersected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.intersect(order_spans(spark, sf_dir), cut_spans(spark, sf_dir), "key")


def spans_subtracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.subtract(order_spans(spark, sf_dir), cut_spans(spark, sf_dir), "key")


def spans_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive days with an order of a customer's nation."""
    owner = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    days = order_spans(spark, sf_dir).join(owner, F.col("key") == F.col("c_custkey")).select("nation", F.col("start").alias("hour"))
    return spans.contiguous(days, "nation")


def spans_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' spans cut at weeks."""
    return spans.by_hour(order_spans(spark, sf_dir), 7, "key")


def transitions_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is on from a signup or purchase until an error."""
    e = events(spark, sf_dir).filter("event_type in ('signup', 'purchase', 'error')")
    changes = e.select("symbol", (F.col("recv_ns") * 1).alias("ns"), (F.col("event_type") != "error").alias("on"))
    return spans.fold_transitions(changes, "symbol", end=1_706_745_600 * 10**9).select("symbol", "start", "end")


# -------------------------------------------------------------------- coverage
def coverage_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Coverage of a made recorder over the events' hours.

    Seen symbols are granted from their first event of the hour, a third of them
    for all of it; every seventh
    hour starts late, every fifth ends early, every sixth sheds the ticker for
    its first half, every eleventh blocks the disk for a minute; an error
    disconnects its symbol's trades for a minute, some tickers' events break the
    book of every fourth symbol, the only ones with a book.
    """
    e = events(spark, sf_dir).withColumn("h", F.expr(f"recv_ns div {HOUR}"))
    hour = F.date_format(F.timestamp_seconds(F.col("h") * 3600), "yyyy-MM-dd'T'HH").alias("hour")
    start, end = F.col("h") * HOUR, (F.col("h") + 1) * HOUR
    hours = stored(e.select("h").distinct(), "h")
    first = e.groupBy("h", "symbol").agg(F.min("recv_ns").alias("start"))
    number = F.substring("symbol", 2, 9).cast("int")
    some = F.array(F.lit("trades"), F.lit("ticker"))
    feeds = F.explode(F.when(number % 4 == 0, F.array_append(some, F.lit("book:50"))).otherwise(some))
    whole = number % 3 == 0
    first = first.withColumn("start", F.when(whole, start).otherwise(F.col("start")))
    grants = first.select(hour, F.lit(1).alias("rec"), F.lit("all").alias("tier"), "symbol", feeds.alias("feed"), "start", end.alias("end"))
    grants = stored(grants.withColumn("topic", F.concat_ws(".", "feed", "symbol")), "grants")
    minute = 60 * 10**9
    return {
        "hours": hours.select(hour, start.alias("start"), end.alias("end")),
        "windows": hours.select(hour, (start + F.when(F.col("h") % 7 == 0, 5 * minute).otherwise(0)).alias("start"), (end - F.when(F.col("h") % 5 == 0, 10 * minute).otherwise(0)).alias("end")),
        "grants": grants,
        "shed": hours.filter("h % 6 = 0").select(hour, F.lit(1).alias("rec"), F.lit("all").alias("tier"), F.lit("ticker").alias("feed"), start.alias("start"), (start + 30 * minute).alias("end")),
        "disconnects": e.filter("event_type = 'error'").select(hour, F.lit(1).alias("rec"), F.concat(F.lit("trades."), "symbol").alias("topic"), F.col("recv_ns").alias("start"), (F.col("recv_ns") + minute).alias("end")),
        "book_gaps": e.filter("event_type = 'signup' and k % 9 = 0").select(hour, "symbol", F.lit("book:50").alias("feed"), F.col("recv_ns").alias("start"), (F.col("recv_ns") + minute).alias("end")),
        "disk_blocked": hours.filter("h % 11 = 0").select(hour, (start + minute).alias("start"), (start + 2 * minute).alias("end")),
        "overruns": e.filter("event_type = 'purchase' and k = 7").select(hour, F.lit(1).alias("rec"), F.concat(F.lit("ticker."), "symbol").alias("topic"), F.col("recv_ns").alias("ns")),
    }


def coverage_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = coverage.ledger(coverage_tables(spark, sf_dir))
    return rows.select("hour", "symbol", "feed", "status", F.concat_ws(",", "reason_codes").alias("codes"))


COVERAGE_SQL = f"""WITH e AS (SELECT 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS ns, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, (epoch_us(ts) * 1000) // {HOUR} AS h FROM events),
g AS (SELECT h, symbol, feed, CASE WHEN CAST(substr(symbol, 2) AS INTEGER) % 3 = 0 THEN h * {HOUR} ELSE min(ns) END AS ms, h * {HOUR} AS s, (h + 1) * {HOUR} AS x,
  h * {HOUR} + CASE WHEN h % 7 = 0 THEN 300000000000 ELSE 0 END AS ws, (h + 1) * {HOUR} - CASE WHEN h % 5 = 0 THEN 600000000000 ELSE 0 END AS we
  FROM e, (VALUES ('trades'), ('ticker'), ('book:50')) f(feed) WHERE feed <> 'book:50' OR CAST(substr(symbol, 2) AS INTEGER) % 4 = 0 GROUP BY h, symbol, feed),
r AS (
  SELECT h, symbol, feed, 'recorder_down' AS code, s AS from_ns FROM g WHERE ws > s
  UNION ALL SELECT h, symbol, feed, 'recorder_down', we FROM g WHERE we < x
  UNION ALL SELECT h, symbol, feed, 'tier_membership_partial', ws FROM g WHERE least(ms, we) > ws
  UNION ALL SELECT h, symbol, feed, 'shed', ms FROM g WHERE feed = 'ticker' AND h % 6 = 0 AND ms < s + 1800000000000
  UNION ALL SELECT g.h, g.symbol, feed, 'shard_disconnected', e.ns FROM g JOIN e ON e.h = g.h AND e.symbol = g.symbol AND event_type = 'error' WHERE feed = 'trades'
  UNION ALL SELECT g.h, g.symbol, feed, 'book_gap', e.ns FROM g JOIN e ON e.h = g.h AND e.symbol = g.symbol AND event_type = 'signup' AND k % 9 = 0 WHERE feed = 'book:50'
  UNION ALL SELECT h, symbol, feed, 'disk_blocked', greatest(ms, s + 60000000000) FROM g WHERE h % 11 = 0 AND ms < s + 120000000000
  UNION ALL SELECT g.h, g.symbol, feed, 'queue_overrun', e.ns FROM g JOIN e ON e.h = g.h AND e.symbol = g.symbol AND event_type = 'purchase' AND k = 7 WHERE feed = 'ticker'),
c AS (SELECT h, symbol, feed, string_agg(code, ',' ORDER BY from_ns, code) AS codes FROM (SELECT h, symbol, feed, code, min(from_ns) AS from_ns FROM r GROUP BY ALL) GROUP BY ALL),
cells AS (SELECT strftime(make_timestamp(g.h * 3600000000), '%Y-%m-%dT%H') AS hour, g.h, g.symbol, g.feed, CASE WHEN codes IS NULL THEN 'complete' ELSE 'excluded' END AS status, coalesce(codes, '') AS codes
  FROM g LEFT JOIN c ON c.h = g.h AND c.symbol = g.symbol AND c.feed = g.feed)"""


def recorder_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a recorder that ran a process for each hour of ``coverage_tables``: what those tables say, as events."""
    t = coverage_tables(spark, sf_dir)
    hour_ns = F.unix_seconds(F.to_timestamp("hour", "yyyy-MM-dd'T'HH")) * 10**9
    names = [f.split()[0] for f in coverage_log.EVENT.split(", ")]
    number = F.substring("symbol", 2, 9).cast("bigint")

    def turns(what: str, rows: DataFrame, **columns) -> DataFrame:
        """A start and a stop event for each span, or one event for each moment."""
        rows = rows.withColumn("pid", hour_ns)
        made = rows.withColumns({"what": F.lit(what), "venue": F.lit("bybit"), "market": F.lit("linear"), **columns})
        both = F.array(F.struct(F.col("start").alias("ns"), F.lit(True).alias("on")), *([F.struct(F.col("end").alias("ns"), F.lit(False).alias("on"))] if "end" in rows.columns else []))
        made = made.select("*", F.inline(both))
        kinds = dict(f.split() for f in coverage_log.EVENT.split(", "))
        return made.select(*(F.col(n).cast(kinds[n]).alias(n) if n in made.columns else F.lit(None).cast(kinds[n]).alias(n) for n in names))

    lost = t["disconnects"].withColumn("symbol", F.substring_index("topic", ".", -1))
    over = t["overruns"].withColumn("symbol", F.substring_index("topic", ".", -1)).withColumnRenamed("ns", "start")
    ticker = {"shard": number + 10**6, "tier": F.lit("all"), "topics": F.array(F.concat(F.lit("tickers."), "symbol"))}
    trades = {"shard": number, "tier": F.lit("all"), "topics": F.array(F.concat(F.lit("publicTrade."), "symbol"))}
    parts = [
        turns("up", t["windows"]), turns("member", t["grants"].select("hour", "tier", "symbol", "start", "end").distinct()), turns("shed", t["shed"]), turns("disk", t["disk_blocked"]),
        turns("gap", t["book_gaps"].select("hour", "symbol", "start", "end"), topic=F.concat(F.lit("orderbook.50."), "symbol"), depth=F.lit(50)),
        turns("shard", lost.select("hour", "symbol", "start", "end"), **trades).withColumn("on", ~F.col("on")), turns("shard", over.select("hour", "symbol", "start"), **ticker), turns("overrun", over.select("hour", "symbol", "start"), **ticker),
    ]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log


def coverage_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of coverage documents that were made of a recorder's log, written, and read again."""
    tiers = spark.sql("SELECT 'bybit' AS venue, 'linear' AS market, 'all' AS tier, array('trades', 'ticker', 'book:50') AS feeds")
    root = scratch(spark, "coverage")
    tape_files.write_coverage(coverage_log.hour_documents(recorder_log(spark, sf_dir), tiers), root)
    tables = coverage.exploded(stored(tape_files.read_stored_coverage(spark, root), "documents"))  # parsed once
    tables["grants"] = stored(tables["grants"], "grants")  # read by every reason
    rows = coverage.ledger(tables)
    return rows.select("hour", "symbol", "feed", "status", F.concat_ws(",", "reason_codes").alias("codes"))


#: As the ledger of the tables, of what lies in the time that the process was up; every symbol has all three feeds.
DOCUMENTS_SQL = f"""WITH e AS (SELECT 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS ns, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, (epoch_us(ts) * 1000) // {HOUR} AS h FROM events),
g0 AS (SELECT h, symbol, CASE WHEN CAST(substr(symbol, 2) AS INTEGER) % 3 = 0 THEN h * {HOUR} ELSE min(ns) END AS ms, h * {HOUR} AS s, (h + 1) * {HOUR} AS x,
  h * {HOUR} + CASE WHEN h % 7 = 0 THEN 300000000000 ELSE 0 END AS ws, (h + 1) * {HOUR} - CASE WHEN h % 5 = 0 THEN 600000000000 ELSE 0 END AS we FROM e GROUP BY h, symbol),
g AS (SELECT h, symbol, feed, greatest(ms, ws) AS ms, s, x, ws, we FROM g0, (VALUES ('trades'), ('ticker'), ('book:50')) f(feed) WHERE greatest(ms, ws) < we),
m AS (SELECT g.*, e.ns, e.event_type, e.k, greatest(e.ns, ms) AS a, least(e.ns + 60000000000, we) AS z FROM g JOIN e ON e.h = g.h AND e.symbol = g.symbol),
r AS (
  SELECT h, symbol, feed, 'recorder_down' AS code, s AS from_ns FROM g WHERE ws > s UNION ALL SELECT h, symbol, feed, 'recorder_down', we FROM g WHERE we < x
  UNION ALL SELECT h, symbol, feed, 'tier_membership_partial', ws FROM g WHERE ms > ws
  UNION ALL SELECT h, symbol, feed, 'shed', ms FROM g WHERE feed = 'ticker' AND h % 6 = 0 AND ms < s + 1800000000000
  UNION ALL SELECT h, symbol, feed, 'shard_disconnected', a FROM m WHERE feed = 'trades' AND event_type = 'error' AND a < z
  UNION ALL SELECT h, symbol, feed, 'book_gap', a FROM m WHERE feed = 'book:50' AND event_type = 'signup' AND k % 9 = 0 AND a < z
  UNION ALL SELECT h, symbol, feed, 'disk_blocked', greatest(ms, s + 60000000000) FROM g WHERE h % 11 = 0 AND greatest(ms, s + 60000000000) < least(we, s + 120000000000)
  UNION ALL SELECT h, symbol, feed, 'queue_overrun', ns FROM m WHERE feed = 'ticker' AND event_type = 'purchase' AND k = 7 AND ns >= ms AND ns < we),
c AS (SELECT h, symbol, feed, string_agg(code, ',' ORDER BY from_ns, code) AS codes FROM (SELECT h, symbol, feed, code, min(from_ns) AS from_ns FROM r GROUP BY ALL) GROUP BY ALL)
SELECT strftime(make_timestamp(g.h * 3600000000), '%Y-%m-%dT%H') AS hour, g.symbol, g.feed, CASE WHEN codes IS NULL THEN 'complete' ELSE 'excluded' END AS status, coalesce(codes, '') AS codes
FROM g LEFT JOIN c ON c.h = g.h AND c.symbol = g.symbol AND c.feed = g.feed"""


def coverage_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.complete_windows(coverage.ledger(coverage_tables(spark, sf_dir)))


def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.summary(coverage.ledger(coverage_tables(spark, sf_dir))).select("what", "name", "n")


# ------------------------------------------------------------------- universes
def daily_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnover and change of every user at the end of each day with events."""
    e = events(spark, sf_dir).withColumn("tick_ns", F.expr(f"recv_ns div {DAY} + 1") * DAY)
    order = F.struct("recv_ns", "seq")
    first, last = F.min_by("value", order), F.max_by("value", order)
    ratio = F.when(first == 0, F.signum(last) * float("inf")).otherwise(F.try_divide(last, first))  # as doubles divide: a change from 0 is without bound, 0 after 0 is no number
    return e.groupBy("tick_ns", "symbol").agg(F.round(F.sum("value"), 2).alias("turnover"), (ratio - 1).alias("change"))


TICKS_SQL = f"""WITH e AS (SELECT event_id AS seq, 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS recv_ns, value FROM events),
t AS (SELECT (recv_ns // {DAY} + 1) * {DAY} AS tick_ns, symbol, round(sum(value), 2) AS turnover,
  arg_max(value, CAST(recv_ns AS HUGEINT) * 100000000 + seq) / arg_min(value, CAST(recv_ns AS HUGEINT) * 100000000 + seq) - 1 AS change FROM e GROUP BY ALL)"""


def universe_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the ten of highest turnover, that leave behind rank twenty."""
    return universe.ranked(daily_ticks(spark, sf_dir).withColumn("score", F.col("turnover")), 10, 20)


UNIVERSE_RANKED_SQL = f"""{TICKS_SQL},
r AS (SELECT tick_ns, symbol, row_number() OVER (PARTITION BY tick_ns ORDER BY turnover DESC, symbol) AS rank FROM t),
d AS (SELECT tick_ns, lag(tick_ns) OVER (ORDER BY tick_ns) AS before FROM (SELECT DISTINCT tick_ns FROM t)),
s AS (SELECT r.*, CASE WHEN lag(r.tick_ns) OVER w IS DISTINCT FROM d.before THEN 1 ELSE 0 END AS new FROM r JOIN d ON d.tick_ns = r.tick_ns WINDOW w AS (PARTITION BY symbol ORDER BY r.tick_ns)),
u AS (SELECT *, sum(new) OVER (PARTITION BY symbol ORDER BY tick_ns) AS run FROM s),
v AS (SELECT *, last_value(CASE WHEN rank <= 10 THEN 1 WHEN rank > 20 THEN 0 END IGNORE NULLS) OVER (PARTITION BY symbol, run ORDER BY tick_ns ROWS UNBOUNDED PRECEDING) AS member FROM u)
SELECT tick_ns, symbol, CAST(rank AS INTEGER) AS rank FROM v WHERE member = 1"""


def universe_sticky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose value at least doubled within a day, for three days; a user who misses the list (id 13, 26...) on a fifth day is cleared."""
    ticks = daily_ticks(spark, sf_dir)
    number = F.substring("symbol", 2, 9).cast("int")
    listed = ~((number % 13 == 0) & (F.expr(f"tick_ns div {DAY}") % 5 == 0))
    return universe.sticky(ticks.select("tick_ns", "symbol", (F.abs("change") >= 1.0).alias("qualifies"), listed.alias("listed")), 3 * DAY)


UNIVERSE_STICKY_SQL = f"""{TICKS_SQL},
q AS (SELECT *, abs(change) >= 1.0 AS good, NOT (CAST(substr(symbol, 2) AS INTEGER) % 13 = 0 AND (tick_ns // {DAY}) % 5 = 0) AS listed FROM t),
z AS (SELECT *, max(CASE WHEN NOT listed THEN tick_ns END) OVER w AS cleared, max(CASE WHEN good AND listed THEN tick_ns END) OVER w AS stamp FROM q WINDOW w AS (PARTITION BY symbol ORDER BY tick_ns ROWS UNBOUNDED PRECEDING))
SELECT tick_ns, symbol FROM z WHERE tick_ns - stamp < {3 * DAY} AND (cleared IS NULL OR stamp > cleared)"""


def universe_live_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last known open interest and price after each ticker row (0: none yet)."""
    out = universe.live_state(tape(spark, sf_dir))
    return out.select("symbol", "seq", F.coalesce("open_interest", F.lit(0.0)).alias("open_interest"), F.coalesce("price", F.lit(0.0)).alias("price"))


UNIVERSE_LIVE_SQL = f"""{TAPE_SQL} SELECT symbol, seq, coalesce(last_value(oi IGNORE NULLS) OVER w, 0) AS open_interest, value AS price FROM tape WHERE kind = 'ticker'
WINDOW w AS (PARTITION BY symbol ORDER BY recv_ns, seq ROWS UNBOUNDED PRECEDING)"""


def universe_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of price and open interest against the last row up to three days back (ties: by seq); a price that wasn't above zero then has none."""
    state = universe.live_state(tape(spark, sf_dir))
    out = universe.windowed(state, state, 3 * DAY).filter("then_price is not null and open_interest is not null")
    return rounded(out.select("symbol", "seq", "price_burst", F.coalesce("oi_change", F.lit(-1.0)).alias("oi_change")))


UNIVERSE_LOOKBACK_SQL = f"""WITH s AS ({TAPE_SQL} SELECT symbol, seq, recv_ns, last_value(oi IGNORE NULLS) OVER w AS oi, value AS price FROM tape WHERE kind = 'ticker'
WINDOW w AS (PARTITION BY symbol ORDER BY recv_ns, seq ROWS UNBOUNDED PRECEDING))
SELECT a.symbol, a.seq, CASE WHEN b.price > 0 THEN round(abs(a.price / b.price - 1), 6) END AS price_burst, coalesce(CASE WHEN b.oi > 0 THEN round(abs(a.oi / b.oi - 1), 6) END, -1) AS oi_change
FROM s a ASOF JOIN (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY symbol, recv_ns ORDER BY seq DESC) = 1) b ON a.symbol = b.symbol AND a.recv_ns - {3 * DAY} >= b.recv_ns WHERE a.oi IS NOT NULL"""


def universe_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker rows kept at least six hours apart (greedy)."""
    return universe.spaced(universe.live_state(tape(spark, sf_dir)), 6 * HOUR).select("symbol", "seq", "local_receive_ts_ns")


UNIVERSE_SAMPLES_SQL = f"""WITH RECURSIVE t AS (SELECT * FROM ({TAPE_SQL} SELECT symbol, seq, recv_ns FROM tape WHERE kind = 'ticker')),
f AS (SELECT symbol, arg_min(seq, recv_ns) AS seq, min(recv_ns) AS recv_ns FROM t GROUP BY symbol
  UNION ALL SELECT symbol, seq, recv_ns FROM (SELECT f.symbol, t.seq, t.recv_ns, row_number() OVER (PARTITION BY f.symbol, f.recv_ns ORDER BY t.recv_ns, t.seq) AS n
    FROM f JOIN t ON t.symbol = f.symbol AND t.recv_ns - f.recv_ns >= {6 * HOUR}) WHERE n = 1)
SELECT symbol, seq, recv_ns AS local_receive_ts_ns FROM f"""


def universe_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of two tiers: the thirty users of most turnover, and all; each topic is claimed once."""
    total = events(spark, sf_dir).groupBy("symbol").agg(F.round(F.sum("value"), 2).alias("v"))
    first = total.orderBy(F.desc("v"), "symbol").limit(30)
    members = first.select(F.lit("deep").alias("tier"), F.lit(0).alias("tier_pos"), "symbol").unionByName(total.select(F.lit("wide").alias("tier"), F.lit(1).alias("tier_pos"), "symbol"))
    feeds = spark.createDataFrame([("deep", "book:50", 0), ("deep", "trades", 1), ("wide", "trades", 0), ("wide", "ticker", 1), ("wide", "book:1", 2)], "tier string, feed string, feed_pos int")
    return universe.plan_topics(members, feeds, spark.createDataFrame([("wide", "book:1")], "tier string, feed string"))


UNIVERSE_TOPICS_SQL = """WITH v AS (SELECT 'U' || user_id AS symbol, round(sum(value), 2) AS v FROM events GROUP BY 1),
d AS (SELECT symbol FROM (SELECT symbol, row_number() OVER (ORDER BY v DESC, symbol) AS n FROM v) WHERE n <= 30)
SELECT feed || '.' || symbol AS topic, 'deep' AS tier, symbol, feed FROM d, (VALUES ('book:50'), ('trades')) f(feed)
UNION ALL SELECT 'trades.' || symbol, 'wide', symbol, 'trades' FROM v WHERE symbol NOT IN (SELECT symbol FROM d)
UNION ALL SELECT 'ticker.' || symbol, 'wide', symbol, 'ticker' FROM v"""


# -------------------------------------------------------------------- metering
def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every event's properties and text, by tier (even or odd user) and feed."""
    e = events(spark, sf_dir)
    tier = F.when(F.substring("symbol", 2, 9).cast("int") % 2 == 0, "even").otherwise("odd")
    return e.select(tier.alias("tier"), F.col("event_type").alias("feed"), "recv_ns", (F.col("k") * 100 + F.length("event_type")).alias("bytes"))


FRAMES_SQL = """WITH f AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tier, event_type AS feed, epoch_us(ts) * 1000 AS recv_ns,
  CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 + length(event_type) AS bytes FROM events),
m AS (SELECT 'all' AS key, recv_ns // 60000000000 AS minute, sum(bytes) AS bytes FROM f GROUP BY ALL
  UNION ALL SELECT 'tier:' || tier, recv_ns // 60000000000, sum(bytes) FROM f GROUP BY ALL UNION ALL SELECT 'feed:' || tier || ':' || feed, recv_ns // 60000000000, sum(bytes) FROM f GROUP BY ALL),
w AS (SELECT key, minute, bytes, sum(bytes) OVER (PARTITION BY key ORDER BY minute RANGE BETWEEN 1439 PRECEDING AND CURRENT ROW) AS last_day,
  sum(bytes) OVER (PARTITION BY key ORDER BY minute ROWS UNBOUNDED PRECEDING) AS total, least(1440, greatest(0, minute - min(minute) OVER (PARTITION BY key ORDER BY minute))) AS seen FROM m)"""


def meter_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meter.trailing(meter.bytes_by_minute(frames(spark, sf_dir)))


METER_TRAILING_SQL = f"{FRAMES_SQL} SELECT key, minute, CAST(bytes AS BIGINT) AS bytes, CAST(last_day AS BIGINT) AS last_day, CAST(total AS BIGINT) AS total, seen FROM w"


def meter_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly GB of each key at its last minute of each day."""
    rows = meter.trailing(meter.bytes_by_minute(frames(spark, sf_dir))).withColumn("gb", meter.month_gb()).filter("gb is not null")
    day = F.expr("minute div 1440").alias("day")
    return rows.groupBy("key", day).agg(F.round(F.max_by("gb", "minute"), 9).alias("gb"))


METER_PROJECTION_SQL = f"{FRAMES_SQL} SELECT key, minute // 1440 AS day, round(arg_max(last_day / (seen * 60) * 2592000 / 1e9, minute), 9) AS gb FROM w WHERE seen >= 60 GROUP BY ALL"


def meter_shed_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pairs to give up so that the whole traffic falls to 60 percent."""
    f = frames(spark, sf_dir)
    pairs = f.groupBy("tier", "feed").agg((F.sum("bytes") / 1e6).alias("gb"))
    from pyspark.sql import Window

    pairs = pairs.withColumn("pos", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("feed", "tier")))
    total = f.agg(F.sum("bytes") / 1e6).first()[0] or 0.0
    return rounded(meter.shed_plan(pairs, total, 0.6 * total).select("pos", "tier", "feed", "gb"))


METER_SHED_SQL = f"""{FRAMES_SQL}, p AS (SELECT *, row_number() OVER (ORDER BY feed, tier) AS pos FROM (SELECT tier, feed, sum(bytes) / 1e6 AS gb FROM f GROUP BY tier, feed)),
s AS (SELECT *, coalesce(sum(gb) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone, sum(gb) OVER () AS total FROM p)
SELECT CAST(pos AS INTEGER) AS pos, tier, feed, round(gb, 6) AS gb FROM s WHERE total - gone > 0.6 * total"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select("event_type", "recv_ns", ((F.col("k") - 20) * F.col("value") / 10).alias("ms"))


def clock_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock readings by day: count, mean and bounds."""
    return meter.clock_windows(readings(spark, sf_dir), 86_400)


READINGS_SQL = "WITH r AS (SELECT event_type, epoch_us(ts) * 1000 AS recv_ns, (CAST(json_extract_string(props, '$.k') AS BIGINT) - 20) * value / 10 AS ms FROM events)"
CLOCK_WINDOWS_SQL = f"{READINGS_SQL} SELECT recv_ns // {DAY} AS slot, count(*) AS n, round(avg(ms), 3) AS mean, round(min(ms), 3) AS least, round(max(ms), 3) AS most FROM r GROUP BY ALL"


def clock_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucketed median and 99th percentile of the readings by event type."""
    return meter.bucketed_quantiles(readings(spark, sf_dir), {"p50": 0.5, "p99": 0.99}, "event_type")


CLOCK_QUANTILES_SQL = f"""{READINGS_SQL}, b AS (SELECT event_type, CASE WHEN ms <= 0 THEN 0.0 WHEN ms <= 20 THEN ceil(ms / 0.25) * 0.25 WHEN ms <= 200 THEN 20 + ceil(ms - 20)
  WHEN ms <= 2000 THEN 200 + ceil((ms - 200) / 10) * 10 WHEN ms <= 20000 THEN 2000 + ceil((ms - 2000) / 100) * 100 ELSE 20000 END AS edge FROM r),
o AS (SELECT event_type, edge, row_number() OVER (PARTITION BY event_type ORDER BY edge) AS n, count(*) OVER (PARTITION BY event_type) AS total FROM b)
SELECT event_type, max(total) AS samples, CAST(min(edge) FILTER (n >= 0.5 * total) AS DOUBLE) AS p50, CAST(min(edge) FILTER (n >= 0.99 * total) AS DOUBLE) AS p99 FROM o GROUP BY event_type"""

NOON = (1_704_067_200 + 20 * 86_400 + 43_200) * 10**9


def bytes_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic row of the status document at noon of the 21st day."""
    row = meter.bytes_status(frames(spark, sf_dir), NOON)
    return row.select("received_total", "received_24h", F.array_join(F.transform(F.map_entries("by_feed_24h"), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("by_feed_24h"))


BYTES_STATUS_SQL = f"""WITH f AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tier, event_type AS feed, epoch_us(ts) * 1000 AS ns,
  CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 + length(event_type) AS bytes FROM events),
g AS (SELECT tier || ':' || feed AS name, sum(bytes) FILTER (ns // 60000000000 > {NOON // 60_000_000_000 - 1440}) AS day FROM f WHERE ns <= {NOON} GROUP BY 1)
SELECT (SELECT CAST(sum(bytes) AS BIGINT) FROM f WHERE ns <= {NOON}) AS received_total, (SELECT CAST(sum(day) AS BIGINT) FROM g) AS received_24h,
  (SELECT string_agg(name || '=' || CAST(coalesce(day, 0) AS BIGINT), ',' ORDER BY name) FROM g) AS by_feed_24h"""


def clock_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire and venue lags of each feed class; the engine stamps an even row k ms before it is sent."""
    rows = tape(spark, sf_dir).withColumn("exchange_engine_ts_ns", F.when(F.col("seq") % 2 == 0, F.col("exchange_system_ts_ns") - (F.col("seq") % 50) * 1_300_000))
    return meter.clock_status(rows)


def _edge(ms: str) -> str:
    return f"CASE WHEN {ms} <= 0 THEN 0.0 WHEN {ms} <= 20 THEN ceil({ms} / 0.25) * 0.25 WHEN {ms} <= 200 THEN 20 + ceil({ms} - 20) WHEN {ms} <= 2000 THEN 200 + ceil(({ms} - 200) / 10) * 10 ELSE 20000 END"


CLOCK_STATUS_SQL = f"""{TAPE_SQL}, c AS (SELECT feed, (recv_ns - sent_ns) / 1e6 AS wire, CASE WHEN seq % 2 = 0 THEN (seq % 50) * 1.3 END AS venue FROM tape WHERE sent_ns > 0),
w AS (SELECT feed, edge, row_number() OVER (PARTITION BY feed ORDER BY edge) AS n, count(*) OVER (PARTITION BY feed) AS total FROM (SELECT feed, {_edge("wire")} AS edge FROM c)),
v AS (SELECT feed, edge, row_number() OVER (PARTITION BY feed ORDER BY edge) AS n, count(*) OVER (PARTITION BY feed) AS total FROM (SELECT feed, {_edge("venue")} AS edge FROM c WHERE venue IS NOT NULL)),
a AS (SELECT feed, max(total) AS samples, CAST(min(edge) FILTER (n >= 0.5 * total) AS DOUBLE) AS skew_p50_ms, CAST(min(edge) FILTER (n >= 0.99 * total) AS DOUBLE) AS skew_p99_ms FROM w GROUP BY feed),
b AS (SELECT feed, CAST(min(edge) FILTER (n >= 0.5 * total) AS DOUBLE) AS venue_p50_ms, CAST(min(edge) FILTER (n >= 0.99 * total) AS DOUBLE) AS venue_p99_ms FROM v GROUP BY feed)
SELECT a.*, venue_p50_ms, venue_p99_ms FROM a LEFT JOIN b USING (feed)"""

QUERIES = {
    "bytes_status": bytes_status, "clock_status": clock_status,
    "spans_merged": spans_merged, "spans_intersected": spans_intersected, "spans_subtracted": spans_subtracted, "spans_contiguous": spans_contiguous, "spans_by_hour": spans_by_hour,
    "transitions_folded": transitions_folded, "coverage_documents": coverage_documents, "coverage_ledger": coverage_ledger, "coverage_windows": coverage_windows, "coverage_summary": coverage_summary,
    "universe_ranked": universe_ranked, "universe_sticky": universe_sticky, "universe_live_state": universe_live_state, "universe_lookback": universe_lookback, "universe_samples": universe_samples,
    "universe_topics": universe_topics, "meter_trailing": meter_trailing, "meter_projection": meter_projection, "meter_shed_plan": meter_shed_plan, "clock_windows": clock_windows, "clock_quantiles": clock_quantiles,
}
SQL = {
    "bytes_status": BYTES_STATUS_SQL, "clock_status": CLOCK_STATUS_SQL,
    "spans_merged": f"{SPANS_SQL} {_islands('ad')}", "spans_intersected": f"{SPANS_SQL} {_islands('(SELECT * FROM ad INTERSECT SELECT * FROM bd)')}",
    "spans_subtracted": f"{SPANS_SQL} {_islands('(SELECT * FROM ad EXCEPT SELECT * FROM bd)')}",
    "spans_contiguous": """SELECT nation, min(d) AS from_hour, max(d) + 1 AS to_hour FROM (SELECT nation, d, d - row_number() OVER (PARTITION BY nation ORDER BY d) AS island FROM (
        SELECT DISTINCT c_nationkey AS nation, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders JOIN customer ON o_custkey = c_custkey)) GROUP BY nation, island""",
    "spans_by_hour": f"""{SPANS_SQL} SELECT key, hour, greatest(s, hour * 7) AS "start", least(e, (hour + 1) * 7) AS "end" FROM (SELECT *, unnest(range(s // 7, (e - 1) // 7 + 1)) AS hour FROM a0 WHERE s < e)""",
    "transitions_folded": """WITH e AS (SELECT 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS ns, event_type <> 'error' AS up FROM events WHERE event_type IN ('signup', 'purchase', 'error')),
        t AS (SELECT * FROM (SELECT *, lag(up) OVER (PARTITION BY symbol ORDER BY ns, up) AS was FROM e) WHERE up <> coalesce(was, false)),
        s AS (SELECT symbol, up, ns AS "start", coalesce(lead(ns) OVER (PARTITION BY symbol ORDER BY ns, up), 1706745600000000000) AS "end" FROM t)
        SELECT symbol, "start", "end" FROM s WHERE up AND "start" < "end" """,
    "coverage_documents": DOCUMENTS_SQL, "coverage_ledger": f"{COVERAGE_SQL} SELECT hour, symbol, feed, status, codes FROM cells",
    "coverage_windows": f"""{COVERAGE_SQL} SELECT symbol, feed, min(h) AS from_hour, max(h) + 1 AS to_hour FROM (SELECT symbol, feed, h, h - row_number() OVER (PARTITION BY symbol, feed ORDER BY h) AS island FROM cells WHERE status = 'complete') GROUP BY symbol, feed, island""",
    "coverage_summary": f"""{COVERAGE_SQL} SELECT 'status' AS what, status AS name, count(*) AS n FROM cells GROUP BY 2 UNION ALL SELECT 'reason', code, count(*) FROM (SELECT DISTINCT h, symbol, feed, code FROM r) GROUP BY 2""",
    "universe_ranked": UNIVERSE_RANKED_SQL, "universe_sticky": UNIVERSE_STICKY_SQL, "universe_live_state": UNIVERSE_LIVE_SQL, "universe_lookback": UNIVERSE_LOOKBACK_SQL, "universe_samples": UNIVERSE_SAMPLES_SQL,
    "universe_topics": UNIVERSE_TOPICS_SQL, "meter_trailing": METER_TRAILING_SQL, "meter_projection": METER_PROJECTION_SQL, "meter_shed_plan": METER_SHED_SQL, "clock_windows": CLOCK_WINDOWS_SQL, "clock_quantiles": CLOCK_QUANTILES_SQL,
}
