"""Queries of stored hours, ledgers of uploads, observed cells, hour records, thresholds, REST histories and status links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.operators import coverage, health, retention, universe
from ticklake.plans.lake_queries import RECEIPTS_SQL, receipts_of
from ticklake.plans.tape_queries import DAY, HOUR, rounded
from ticklake.sources import normalize, tape_files
from ticklake.sources.scratch import scratch
from ticklake.sources.testbed import TAPE_SQL, events, read, tape

NOW_H = 10_227  # 1998-01-01, a day standing for an hour
LINE_SQL = """WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_quantity * 1000 AS BIGINT) AS bytes, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS h, l_returnflag FROM lineitem)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    return line.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", (F.col("l_quantity") * 1000).cast("bigint").alias("bytes"), day.alias("h"), "l_returnflag")


# --------------------------------------------------------- hours of a store
def hours_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours (days of shipping) that ended two hours ago and hold archived files only; lines of few suppliers are raw."""
    files = lines(spark, sf_dir).select("h", (F.col("l_suppkey") % 50 == 0).alias("raw"))
    return retention.finished_hours(files, NOW_H * 3600, 7200)


HOURS_FINISHED_SQL = f"{LINE_SQL} SELECT h FROM l GROUP BY h HAVING (h + 1) * 3600 + 7200 <= {NOW_H} * 3600 AND count(*) FILTER (l_suppkey % 50 = 0) = 0"


def upload_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as uploads: of an order, each line writes the same remote path again, to one of three stores."""
    rows = lines(spark, sf_dir)
    return rows.select(F.col("l_orderkey").alias("path"), ((F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")).alias("line"), (F.col("l_suppkey") % 3).alias("store"), "bytes", (F.col("h") * DAY).alias("uploaded_ns"), "h")


def uploads_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last upload of each path: what current stores (0 and 1) hold, and what only a given-up one does."""
    stores = spark.range(2).select(F.col("id").alias("store"))
    confirmed, others = retention.last_of_ledger(upload_ledger(spark, sf_dir), stores)
    both = confirmed.withColumn("confirmed", F.lit(True)).unionByName(others.withColumn("confirmed", F.lit(False)))
    return both.select("path", "line", "store", "bytes", "confirmed")


LEDGER_SQL = f"{LINE_SQL}, last AS (SELECT l_orderkey AS path, (l_linenumber * 10000000 + l_partkey) * 100000 + l_suppkey AS line, l_suppkey % 3 AS store, bytes, h FROM l QUALIFY row_number() OVER (PARTITION BY path ORDER BY line DESC) = 1)"
UPLOADS_SQL = f"{LEDGER_SQL} SELECT path, line, store, bytes, store < 2 AS confirmed FROM last"


def uploaded_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.bytes_since(upload_ledger(spark, sf_dir), NOW_H * DAY)


UPLOADED_SINCE_SQL = f"{LINE_SQL} SELECT CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM l WHERE h >= {NOW_H}"


def hours_prunable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that a supplier's upload covers, kept for 100 hours more."""
    rows = lines(spark, sf_dir)
    return retention.prunable(rows.select("h"), rows.filter("l_suppkey = 7").select("h").distinct(), NOW_H * 3600, 100)


HOURS_PRUNABLE_SQL = f"{LINE_SQL} SELECT DISTINCT h FROM l WHERE h + 101 <= {NOW_H} AND h IN (SELECT h FROM l WHERE l_suppkey = 7)"


def hours_past_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of each tape (return flag) behind its keep window: one tape has its own."""
    hours = lines(spark, sf_dir).select(F.col("l_returnflag").alias("tape"), "h").distinct()
    keep = hours.filter("tape = 'A'").select("tape").distinct().withColumn("keep_hours", F.lit(700))
    return retention.past_window(hours, keep, 300, NOW_H)


HOURS_PAST_SQL = f"{LINE_SQL} SELECT DISTINCT l_returnflag AS tape, h FROM l WHERE h < {NOW_H} - CASE WHEN l_returnflag = 'A' THEN 700 ELSE 300 END"


def members_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that orders of urgent symbols (parts) need and that aren't held alike, each once; parts that no member has are named."""
    rows = lines(spark, sf_dir)
    base = rows.select(F.lit("t").alias("tape"), F.lit("d").alias("day"), (F.col("h") % 24).cast("string").alias("hour"), F.concat(F.lit("P"), F.col("l_partkey") % 40).alias("symbol"), "l_orderkey", "l_linenumber", "bytes")
    members = base.select("tape", "day", "hour", "symbol", F.concat_ws("-", F.lit("segment"), "l_orderkey", "l_linenumber").alias("member"), F.col("bytes").alias("size"), F.sha2(F.col("l_orderkey").cast("string"), 256).alias("sha256"))
    asked = base.filter("l_linenumber = 7").select("tape", "day", "hour", "symbol")
    plan = retention.fetch_plan(asked)
    wanted, missing = retention.wanted_members(plan, members.filter("symbol <> 'P3'"))
    held = wanted.filter(F.col("size") % 3000 == 0).select("tape", F.col("member").alias("path"), (F.col("size") + F.when(F.col("size") % 2000 == 0, 1).otherwise(0)).alias("size"), "sha256")
    fetch = retention.still_to_fetch(wanted.withColumnRenamed("member", "path"), held)
    return fetch.select("hour", "symbol", "path").unionByName(missing.select("hour", "symbol", F.lit("missing").alias("path")))


#: A member is listed once, however often the table repeats its line.
MEMBERS_SQL = f"""{LINE_SQL}, m AS (SELECT DISTINCT CAST(h % 24 AS VARCHAR) AS hour, 'P' || (l_partkey % 40) AS symbol, 'segment-' || l_orderkey || '-' || l_linenumber AS path, bytes, l_linenumber FROM l),
a AS (SELECT DISTINCT hour, symbol FROM m WHERE l_linenumber = 7)
SELECT hour, symbol, path FROM m SEMI JOIN a USING (hour, symbol) WHERE symbol <> 'P3' AND NOT (bytes % 3000 = 0 AND bytes % 2000 <> 0)
UNION ALL SELECT hour, symbol, 'missing' FROM a WHERE symbol = 'P3'"""


# ------------------------------------------------------------ observed cells
def observed_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each (day, symbol) by receipts."""
    return coverage.observed_by_symbol(tape_files.fold_receipts(receipts_of(spark, sf_dir)))


OBSERVED_SYMBOLS_SQL = f"{RECEIPTS_SQL} SELECT day AS hour, symbol, CAST(records AS BIGINT) AS records, first_ns AS first_receive_ns, last_ns AS last_receive_ns FROM kept"


def observed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each (hour, symbol, feed) by reading the tape."""
    return coverage.observed_by_feed(tape(spark, sf_dir))


OBSERVED_FEEDS_SQL = f"{TAPE_SQL} SELECT strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%dT%H') AS hour, symbol, feed, count(*) AS records, min(recv_ns) AS first_receive_ns, max(recv_ns) AS last_receive_ns FROM tape GROUP BY ALL"


def told_hours(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Coverage of even hours, of trades only."""
    e = events(spark, sf_dir).withColumn("h", F.expr(f"recv_ns div {HOUR}")).filter("h % 2 = 0")
    hour = F.date_format(F.timestamp_seconds(F.col("h") * 3600), "yyyy-MM-dd'T'HH").alias("hour")
    start, end = (F.col("h") * HOUR).alias("start"), ((F.col("h") + 1) * HOUR).alias("end")
    hours = e.select(hour, start, end).distinct()
    base = e.select(hour, F.lit(1).alias("rec"), F.lit("all").alias("tier"), "symbol", F.lit("trades").alias("feed"), start, end).distinct()
    grants = base.withColumn("topic", F.concat_ws(".", "feed", "symbol"))
    nothing = {n: base.limit(0).select(*c) for n, c in {"shed": ("hour", "rec", "tier", "feed", "start", "end"), "book_gaps": ("hour", "symbol", "feed", "start", "end"), "disk_blocked": ("hour", "start", "end")}.items()}
    topics = grants.limit(0).select("hour", "rec", "topic", "start", "end")
    return {"hours": hours, "windows": hours, "grants": grants, "disconnects": topics, "overruns": topics.select("hour", "rec", "topic", F.col("start").alias("ns")), **nothing}


def ledger_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of cells that were observed, most in hours without a record."""
    return coverage.ledger(told_hours(spark, sf_dir), observed=observed_feeds(spark, sf_dir)).select("hour", "symbol", "feed", "status", "records")


def ledger_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every third user in every hour, where only receipts by symbol were kept."""
    e = events(spark, sf_dir)
    hour = F.date_format(F.timestamp_seconds(F.expr("recv_ns div 3600000000000 * 3600")), "yyyy-MM-dd'T'HH").alias("hour")
    receipts = e.groupBy(hour, "symbol").agg(F.count("*").alias("records"), F.min("recv_ns").alias("first_receive_ns"), F.max("recv_ns").alias("last_receive_ns")).withColumn("path", F.concat("symbol", F.lit("/segment-0.jsonl")))
    asked = e.select("symbol").distinct().filter(F.substring("symbol", 2, 9).cast("int") % 3 == 0)
    rows = coverage.symbol_ledger(told_hours(spark, sf_dir), coverage.observed_by_symbol(receipts), asked)
    return rows.select("hour", "symbol", "feed", "status", "records", F.coalesce("last_receive_ns", F.lit(0)).alias("last_receive_ns"))


LEDGER_GRID_SQL = f"""WITH e AS (SELECT 'U' || user_id AS symbol, user_id, epoch_us(ts) * 1000 AS ns, (epoch_us(ts) * 1000) // {HOUR} AS h FROM events),
c AS (SELECT h, symbol, count(*) AS n, max(ns) AS last FROM e GROUP BY ALL),
g AS (SELECT x.h, y.symbol, coalesce(n, 0) AS n, coalesce(last, 0) AS last FROM (SELECT DISTINCT h FROM e) x CROSS JOIN (SELECT DISTINCT symbol FROM e WHERE user_id % 3 = 0) y LEFT JOIN c ON c.h = x.h AND c.symbol = y.symbol)
SELECT strftime(make_timestamp(h * 3600000000), '%Y-%m-%dT%H') AS hour, symbol, CASE WHEN h % 2 = 0 AND n > 0 THEN 'trades' ELSE '*' END AS feed,
  CASE WHEN n = 0 THEN 'absent' WHEN h % 2 = 0 THEN 'complete' ELSE 'observed' END AS status, n AS records, last AS last_receive_ns FROM g"""


LEDGER_OBSERVED_SQL = f"""{TAPE_SQL}, o AS (SELECT recv_ns // {HOUR} AS h, symbol, feed, count(*) AS records FROM tape GROUP BY ALL), g AS (SELECT DISTINCT recv_ns // {HOUR} AS h, symbol, 'trades' AS feed FROM tape WHERE (recv_ns // {HOUR}) % 2 = 0),
c AS (SELECT h, symbol, feed, coalesce(records, 0) AS records, g.h IS NOT NULL AS granted FROM o FULL JOIN g USING (h, symbol, feed))
SELECT strftime(make_timestamp(h * 3600000000), '%Y-%m-%dT%H') AS hour, symbol, feed, CASE WHEN h % 2 = 1 THEN 'observed' WHEN feed = 'trades' THEN 'complete' ELSE 'absent' END AS status, records FROM c"""


def hour_rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every hour's record tells of gaps that begin with an error and last for the value in minutes; late ones are still open."""
    e = events(spark, sf_dir)
    last = e.agg(F.expr(f"(max(recv_ns) div {HOUR} + 1) * {HOUR}")).first()[0] or 0
    gaps = e.filter("event_type = 'error'").select("symbol", "seq", F.col("recv_ns").alias("start"), (F.col("recv_ns") + (F.col("k") + 1).cast("bigint") * 600_000_000_000).alias("end"))
    gaps = gaps.withColumn("end", F.when(F.col("end") < last, F.col("end")))
    hours = e.select(F.expr(f"recv_ns div {HOUR}").alias("h")).distinct()
    windows = hours.select(F.col("h").alias("hour"), (F.col("h") * HOUR + F.when(F.col("h") % 7 == 0, 300_000_000_000).otherwise(0)).alias("from_ns"), ((F.col("h") + 1) * HOUR).alias("to_ns"))
    return coverage.rolled(gaps, windows, "symbol", "seq", keep_open=True).withColumn("to_ns", F.coalesce("to_ns", F.lit(0)))


HOUR_ROLLS_SQL = f"""WITH e AS (SELECT event_id AS seq, 'U' || user_id AS symbol, epoch_us(ts) * 1000 AS ns, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
z AS (SELECT (max(ns) // {HOUR} + 1) * {HOUR} AS z FROM e), w AS (SELECT DISTINCT ns // {HOUR} AS hour, (ns // {HOUR}) * {HOUR} + CASE WHEN (ns // {HOUR}) % 7 = 0 THEN 300000000000 ELSE 0 END AS a, (ns // {HOUR} + 1) * {HOUR} AS b FROM e),
g AS (SELECT symbol, seq, ns AS s, ns + (k + 1) * 600000000000 AS x FROM e WHERE event_type = 'error')
SELECT hour, symbol, seq, greatest(s, a) AS from_ns, CASE WHEN x > b OR x >= z THEN 0 ELSE least(x, b) END AS to_ns FROM g, w, z WHERE s < b AND x > a AND greatest(s, a) < least(x, b)"""


def counter_rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recorder's running count of events at the end of each day, as what each day added."""
    e = events(spark, sf_dir).groupBy("symbol", F.expr(f"recv_ns div {DAY}").alias("to_ns")).agg(F.sum("k").alias("k"))
    running = e.withColumn("frames", F.sum("k").over(Window.partitionBy("symbol").orderBy("to_ns").rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("k")
    return coverage.counter_deltas(running, ["frames"], "symbol")


COUNTER_ROLLS_SQL = f"SELECT 'U' || user_id AS symbol, epoch_us(ts) * 1000 // {DAY} AS to_ns, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS frames FROM events GROUP BY ALL"


# ------------------------------------------------------------------ tape files
def tape_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of the files of a tape written by day, folded to days: every file has a digest, every row is in one."""
    path = scratch(spark, "receipts")
    tape_files.write_json_tape(tape(spark, sf_dir), path, by=("day",))
    receipts = tape_files.segment_receipts(spark, path, tape_files.read_partitioned_json(spark, path))
    day = F.regexp_extract("file", "day=([0-9-]+)", 1)
    ok = F.col("sha256").rlike("^[0-9a-f]{64}$") & (F.col("compressed_bytes") > 0)
    return receipts.groupBy(day.alias("day")).agg(F.sum("records").alias("records"), F.min("first_receive_ns").alias("first_ns"), F.max("last_receive_ns").alias("last_ns"), F.bool_and(ok).alias("ok"))


TAPE_RECEIPTS_SQL = f"{TAPE_SQL} SELECT strftime(make_timestamp(recv_ns // 1000), '%Y-%m-%d') AS day, count(*) AS records, min(recv_ns) AS first_ns, max(recv_ns) AS last_ns, true AS ok FROM tape GROUP BY ALL"


def columnar_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index of a columnar tape sums up to: rows and stamps by kind."""
    path = scratch(spark, "index")
    tape_files.write_columnar(tape(spark, sf_dir), path, by=("venue",))
    index = tape_files.index_summary(spark.read.parquet(path))
    return index.groupBy("kind").agg(F.sum("n").alias("n"), F.min("first_ns").alias("first_ns"), F.max("last_ns").alias("last_ns"))


COLUMNAR_INDEX_SQL = f"{TAPE_SQL} SELECT kind, count(*) AS n, min(recv_ns) AS first_ns, max(recv_ns) AS last_ns FROM tape GROUP BY kind"


# ------------------------------------------------------------------ thresholds
def universe_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which thresholds each user's state reaches: values as funding, turnover and change, against the user's mean turnover."""
    e = events(spark, sf_dir)
    state = e.select("symbol", "seq", ((F.col("k") - 20) / 10_000).alias("funding_rate"), F.col("value").alias("turnover_24h"), ((F.col("k") - 20) / 100).alias("price_change_24h"))
    table = e.groupBy("symbol").agg(F.avg("value").alias("turnover_24h"))
    rows = universe.with_baseline(state, table)
    asked = {"funding_below": 10, "funding_above": 15, "turnover_surge": 1.5, "price_move": 0.15}
    return rows.select("symbol", "seq", *(universe.qualifies(n, v).alias(n) for n, v in asked.items()))


UNIVERSE_THRESHOLDS_SQL = """WITH e AS (SELECT 'U' || user_id AS symbol, event_id AS seq, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, avg(value) OVER (PARTITION BY user_id) AS mean FROM events)
SELECT symbol, seq, -((k - 20) / 10000.0) * 10000.0 >= 10 AS funding_below, ((k - 20) / 10000.0) * 10000.0 >= 15 AS funding_above, coalesce(mean > 0 AND value >= 1.5 * mean, false) AS turnover_surge, abs((k - 20) / 100.0) >= 0.15 AS price_move FROM e"""


# -------------------------------------------------------------- venue tables
def history_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REST lists of each history feed: a day's events of a user are a list's entries, some blank or not finite; what was seen before the fifth is left out for even users."""
    e = events(spark, sf_dir).withColumn("day", F.expr(f"recv_ns div {DAY}"))
    ms = F.expr("recv_ns div 1000000").cast("string")
    value = F.when(F.col("k") % 10 == 0, "").when(F.col("k") % 10 == 1, "NaN").otherwise(F.col("value").cast("string"))
    names = {"bybit": ("fundingRateTimestamp", "fundingRate", "timestamp", "buyRatio", "sellRatio"), "binance": ("fundingTime", "fundingRate", "timestamp", "longAccount", "shortAccount", "buyVol", "sellVol")}
    parts = []
    for venue, feed in normalize.HISTORIES:
        stamps = {n: ms if n.lower().endswith(("time", "timestamp")) else value for n in names[venue]}
        entry = F.to_json(F.struct(*(v.alias(n) for n, v in stamps.items())))
        answers = e.groupBy("symbol", "day").agg(F.concat(F.lit("["), F.array_join(F.collect_list(entry), ","), F.lit("]")).alias("payload")).select(F.lit(venue).alias("venue"), "symbol", (F.col("day") * DAY).alias("recv_ns"), "payload")
        even = F.substring("symbol", 2, 9).cast("int") % 2 == 0
        after = e.select("symbol").distinct().filter(even).withColumn("seen_ms", F.lit(1_704_412_800_000).cast("bigint"))
        rows = normalize.histories(answers, venue, feed, after, period="1h")
        stamp = F.coalesce("funding_time_ms", "ts_ms")
        parts.append(rows.groupBy(F.lit(venue).alias("venue"), "kind", "symbol", F.coalesce("period", F.lit("")).alias("period")).agg(F.count("*").alias("n"), F.min(stamp).alias("first_ms"), F.sum(F.coalesce("funding_rate", "buy_ratio", "buy_volume")).alias("total")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return rounded(out, 4)


HISTORY_LISTS_SQL = """WITH e AS (SELECT 'U' || user_id AS symbol, user_id, epoch_us(ts) // 1000 AS ms, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
s AS (SELECT symbol, count(*) AS n, min(ms) AS first_ms, round(sum(value), 4) AS total FROM e WHERE k % 10 > 1 AND (user_id % 2 = 1 OR ms > 1704412800000) GROUP BY symbol),
f(venue, kind, period) AS (VALUES ('bybit', 'funding_settlement', ''), ('bybit', 'account_ratio', '1h'), ('binance', 'funding_settlement', ''), ('binance', 'account_ratio', '5min'), ('binance', 'top_account_ratio', '5min'), ('binance', 'top_position_ratio', '5min'), ('binance', 'taker_volume', '5min'))
SELECT venue, kind, symbol, period, n, first_ms, total FROM s, f"""


def listed_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as instruments of both venues: which are listed, and how many of each type aren't of the domain."""
    p = read(spark, sf_dir, "part")
    number = F.col("p_partkey")
    base = p.select(
        F.when(number % 7 == 0, F.concat(F.lit("P-"), number)).otherwise(F.concat(F.lit("P"), number)).alias("symbol"), F.when(number % 5 == 0, "Closed").otherwise("Trading").alias("status"),
        F.lit("LinearPerpetual").alias("contractType"), F.lit("USDT").alias("quoteCoin"), F.when(number % 3 == 0, "USDC").otherwise("USDT").alias("settleCoin"), F.when(number % 4 == 0, "stock").when(number % 4 == 1, "innovation").alias("symbolType"),
    )
    second = base.select("symbol", F.upper("status").alias("status"), F.lit("PERPETUAL").alias("contractType"), F.col("quoteCoin").alias("quoteAsset"), F.col("settleCoin").alias("marginAsset"))
    parts = [normalize.listed_bybit(base, "USDT").select(F.lit("bybit").alias("what"), "symbol", F.lit(1).cast("bigint").alias("n")), normalize.listed_binance(second, "USDT").select(F.lit("binance").alias("what"), "symbol", F.lit(1).cast("bigint").alias("n"))]
    left_out = normalize.excluded_by_type(base, "symbolType", ("", "innovation")).select(F.lit("excluded").alias("what"), F.col("type").alias("symbol"), "n")
    return parts[0].unionByName(parts[1]).unionByName(left_out)


LISTED_SQL = """WITH p AS (SELECT p_partkey AS n, CASE WHEN p_partkey % 7 = 0 THEN 'P-' ELSE 'P' END || p_partkey AS symbol FROM part), o AS (SELECT * FROM p WHERE n % 7 <> 0 AND n % 5 <> 0 AND n % 3 <> 0)
SELECT 'bybit' AS what, symbol, CAST(1 AS BIGINT) AS n FROM o WHERE n % 4 <> 0 UNION ALL SELECT 'binance', symbol, 1 FROM o UNION ALL SELECT * FROM (SELECT 'excluded', 'stock', count(*) AS c FROM p WHERE n % 4 = 0) WHERE c > 0"""


def table_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnover and funding by both venues' ticker tables of suppliers; a third is blank, some isn't a number."""
    s = read(spark, sf_dir, "supplier")
    text = F.when(F.col("s_suppkey") % 3 == 0, "").when(F.col("s_suppkey") % 5 == 0, "x").otherwise(F.col("s_suppkey").cast("string"))
    out = None
    for venue, (turnover, rate) in {"bybit": ("turnover24h", "fundingRate"), "binance": ("quoteVolume", "lastFundingRate")}.items():
        row = F.create_map(F.lit("symbol"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), F.lit(turnover), text, F.lit(rate), text)
        turnovers, rates = normalize.table_numbers(s.select(row.alias("row")), venue)
        part = turnovers.join(rates, "symbol", "full").select(F.lit(venue).alias("venue"), "symbol", F.coalesce("turnover_24h", F.lit(-1.0)).alias("turnover"), F.coalesce("funding_rate", F.lit(-1.0)).alias("funding"))
        out = part if out is None else out.unionByName(part)
    return out


TABLE_NUMBERS_SQL = """WITH s AS (SELECT s_suppkey AS k FROM supplier) SELECT 'bybit' AS venue, 'S' || k AS symbol, CASE WHEN k % 3 = 0 THEN 0.0 ELSE CAST(k AS DOUBLE) END AS turnover, CASE WHEN k % 3 = 0 THEN -1.0 ELSE CAST(k AS DOUBLE) END AS funding
FROM s WHERE k % 3 = 0 OR k % 5 <> 0 UNION ALL SELECT 'binance', 'S' || k, CAST(k AS DOUBLE), CAST(k AS DOUBLE) FROM s WHERE k % 3 <> 0 AND k % 5 <> 0"""


# -------------------------------------------------------------------- health
def health_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, bytes by class and tape fields of each event's status document."""
    e = events(spark, sf_dir)
    text = F.format_string(
        '{"venue":"v","recorded_at_ns":%d,"shards":[{"connected":true,"link":{"tcp":{"min_rtt_us":%d,"rtt_us":%d,"data_segs_in":100,"rcv_ooopack":%d},"reads":4,"frames":%d}},{"connected":true,"link":{"tcp":{"rtt_us":7000},"ping_rtt_ms":%d}},{"connected":false,"link":{"ping_rtt_ms":900}}],'
        '"bytes":{"received_24h":5,"by_feed_24h":{"deep:book:50":%d,"wide:book:1":1,"wide:other":2,"kline":3}},"tiers":[{"symbols":2,"topics":%d},{"symbols":1}],"compressor":{"pending":%d},"clock":{"feeds":{"book":{"skew_p50_ms":%d}}}}',
        "recv_ns", "k", F.col("k") * 100, "k", "k", "k", "k", "k", "k", "k",
    )
    docs = e.select(F.concat(F.lit("r"), F.col("seq").cast("string")).alias("realm"), F.expr("recv_ns div 1000000").alias("now_ms"), text.alias("raw"))
    live = health.samples(docs).filter("state = 'live'")
    links, parts = health.link_fields(live), health.tape_fields(live).select("realm", "symbols", "topics", "compressor_pending", "compressor_alive", "skew_book_p50_ms")
    classes = health.bytes_by_class(live).select("realm", "book", "kline", "other")
    return rounded(links.drop("now_ms", "reader_dwell_max_ms").join(parts, "realm").join(classes, "realm"), 6)


HEALTH_PARTS_SQL = """WITH e AS (SELECT 'r' || event_id AS realm, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
SELECT realm, round(k / 1000, 6) AS link_min_rtt_ms, round(greatest(7.0, k / 10), 6) AS link_rtt_ms, k AS link_ping_rtt_ms, round(k / 100, 6) AS link_out_of_order, k / 4 AS reader_frames_per_read, CAST(3 AS BIGINT) AS symbols, CAST(k AS BIGINT) AS topics,
  k AS compressor_pending, 0.0::DOUBLE AS compressor_alive, k AS skew_book_p50_ms, k + 1 AS book, 3.0::DOUBLE AS kline, 2.0::DOUBLE AS other FROM e"""

QUERIES = {
    "hours_finished": hours_finished, "uploads_confirmed": uploads_confirmed, "uploaded_since": uploaded_since, "hours_prunable": hours_prunable, "hours_past_window": hours_past_window, "members_to_fetch": members_to_fetch,
    "observed_symbols": observed_symbols, "observed_feeds": observed_feeds, "ledger_grid": ledger_grid, "ledger_observed": ledger_observed, "hour_rolls": hour_rolls, "counter_rolls": counter_rolls, "tape_receipts": tape_receipts, "columnar_index": columnar_index,
    "universe_thresholds": universe_thresholds, "history_lists": history_lists, "listed_symbols": listed_symbols, "table_numbers": table_numbers, "health_parts": health_parts,
}
SQL = {
    "hours_finished": HOURS_FINISHED_SQL, "uploads_confirmed": UPLOADS_SQL, "uploaded_since": UPLOADED_SINCE_SQL, "hours_prunable": HOURS_PRUNABLE_SQL, "hours_past_window": HOURS_PAST_SQL, "members_to_fetch": MEMBERS_SQL,
    "observed_symbols": OBSERVED_SYMBOLS_SQL, "observed_feeds": OBSERVED_FEEDS_SQL, "ledger_grid": LEDGER_GRID_SQL, "ledger_observed": LEDGER_OBSERVED_SQL, "hour_rolls": HOUR_ROLLS_SQL, "counter_rolls": COUNTER_ROLLS_SQL, "tape_receipts": TAPE_RECEIPTS_SQL,
    "columnar_index": COLUMNAR_INDEX_SQL, "universe_thresholds": UNIVERSE_THRESHOLDS_SQL, "history_lists": HISTORY_LISTS_SQL, "listed_symbols": LISTED_SQL, "table_numbers": TABLE_NUMBERS_SQL, "health_parts": HEALTH_PARTS_SQL,
}
