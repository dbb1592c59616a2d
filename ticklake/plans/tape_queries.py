"""Queries over the testbed's tape and books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import bars, book, order, quality
from ticklake.schema import feed, reject_reason, validated
from ticklake.sources.testbed import BOOK_SQL, TAPE_SQL, VENUE
from ticklake.sources.testbed import book as book_tape
from ticklake.sources.testbed import tape

#: The book's tables behind the events, for queries that already have those.
BOOK_TAIL = ", " + BOOK_SQL[BOOK_SQL.index("n AS (") :]
HOUR = 3_600_000_000_000
DAY = 24 * HOUR


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: sums of doubles depend on the order of the rows in their last bits."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def whole_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tape(spark, sf_dir).unionByName(book_tape(spark, sf_dir))


def bars_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-day bars of trades, tickers, liquidations and books."""
    return rounded(bars.build_bars(whole_tape(spark, sf_dir), 86_400))


_BAR_COLUMNS = """
    count(*) FILTER (kind = 'public_trade') AS trades,
    coalesce(sum(tqty) FILTER (kind = 'public_trade'), 0) AS volume,
    coalesce(sum(tqty) FILTER (kind = 'public_trade' AND side = 'Buy'), 0) AS buy_volume,
    coalesce(sum(tqty) FILTER (kind = 'public_trade' AND side <> 'Buy'), 0) AS sell_volume,
    round(coalesce(sum(tqty * value) FILTER (kind = 'public_trade'), 0), 6) AS notional,
    arg_min(value, recv_ns * 1000000 + seq) FILTER (kind = 'public_trade') AS open,
    max(value) FILTER (kind = 'public_trade') AS high, min(value) FILTER (kind = 'public_trade') AS low,
    arg_max(value, recv_ns * 1000000 + seq) FILTER (kind = 'public_trade') AS "close",
    arg_max(value, recv_ns * 1000000 + seq) FILTER (kind = 'ticker') AS mark_price,
    arg_max(oi, recv_ns * 1000000 + seq) FILTER (kind = 'ticker' AND oi IS NOT NULL) AS open_interest,
    count(*) FILTER (kind = 'liquidation') AS liquidations,
    round(coalesce(sum(value) FILTER (kind = 'liquidation'), 0), 6) AS liquidation_qty
""".replace("recv_ns * 1000000 + seq", "CAST(recv_ns AS HUGEINT) * 100000000 + seq")

TOPS_SQL = """
, st AS (SELECT r.symbol, r.seq, r.recv_ns, r.i, l.side, l.price, arg_max(l.size, l.i * 10 + l.pos) AS size
         FROM v r JOIN lv l ON l.symbol = r.symbol AND l.epoch = r.epoch AND l.i <= r.i WHERE r.valid GROUP BY ALL),
tops AS (SELECT r.symbol, r.seq, r.recv_ns, r.i, max(price) FILTER (side = 'bid' AND size > 0) AS best_bid, min(price) FILTER (side = 'ask' AND size > 0) AS best_ask
         FROM v r LEFT JOIN st ON st.symbol = r.symbol AND st.i = r.i WHERE r.valid GROUP BY ALL)
"""

BARS_FULL_SQL = f"""
{TAPE_SQL}
{BOOK_TAIL}
{TOPS_SQL}
, flow AS (SELECT symbol, recv_ns - recv_ns % {DAY} AS bucket_start_ns, {_BAR_COLUMNS}, count(*) AS book_updates FROM tape GROUP BY ALL),
top AS (SELECT symbol, recv_ns - recv_ns % {DAY} AS bucket_start_ns, arg_max(best_bid, i) FILTER (best_bid IS NOT NULL) AS best_bid,
               arg_max(best_ask, i) FILTER (best_ask IS NOT NULL) AS best_ask FROM tops GROUP BY ALL)
SELECT '{VENUE}' AS venue, flow.symbol, flow.bucket_start_ns, trades, volume, buy_volume, sell_volume, notional, open, high, low, "close",
  CASE WHEN volume > 0 THEN round(notional / volume, 6) END AS vwap, best_bid, best_ask, (best_bid + best_ask) / 2 AS mid,
  CASE WHEN best_bid + best_ask <> 0 THEN round((best_ask - best_bid) / ((best_bid + best_ask) / 2) * 10000, 6) END AS spread_bp,
  book_updates, mark_price, CAST(NULL AS DOUBLE) AS index_price, CAST(NULL AS DOUBLE) AS funding_rate, open_interest, liquidations, liquidation_qty
FROM flow LEFT JOIN top USING (symbol, bucket_start_ns)
"""


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hour bars without books."""
    out = bars.build_bars(tape(spark, sf_dir), 3600, with_book=False)
    return rounded(out.select("symbol", "bucket_start_ns", "trades", "volume", "buy_volume", "sell_volume", "notional", "open", "high", "low", "close", "mark_price", "open_interest", "liquidations", "liquidation_qty"))


BARS_HOURLY_SQL = f"{TAPE_SQL} SELECT symbol, recv_ns - recv_ns % {HOUR} AS bucket_start_ns, {_BAR_COLUMNS} FROM tape GROUP BY ALL"


def bars_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars rolled up from one-hour bars."""
    fine = bars.build_bars(tape(spark, sf_dir), 3600, with_book=False)
    return rounded(bars.roll_up(fine, 7 * 86_400).select("symbol", "bucket_start_ns", "trades", "volume", "buy_volume", "sell_volume", "notional", "open", "high", "low", "close", "liquidations"))


BARS_ROLLED_SQL = f"""SELECT symbol, bucket_start_ns, trades, volume, buy_volume, sell_volume, notional, open, high, low, "close", liquidations
FROM ({TAPE_SQL} SELECT symbol, recv_ns - recv_ns % {7 * DAY} AS bucket_start_ns, {_BAR_COLUMNS} FROM tape GROUP BY ALL)"""


def tape_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.statistics(whole_tape(spark, sf_dir))


TAPE_STATISTICS_SQL = f"""{TAPE_SQL}
SELECT symbol, kind, count(*) AS n, min(recv_ns) AS first_ns, max(recv_ns) AS last_ns FROM tape GROUP BY ALL
UNION ALL SELECT symbol, kind, count(*), min(recv_ns), max(recv_ns) FROM (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY recv_ns, seq) % 20 = 1 THEN 'orderbook_snapshot' ELSE 'orderbook_delta' END AS kind FROM e) GROUP BY ALL"""


def scan_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and tickers of a week, all symbols that end in 5, in total order with their feed."""
    rows = order.scan(tape(spark, sf_dir), kinds=("public_trade", "ticker"), start_ns=1_704_067_200 * 10**9, end_ns=(1_704_067_200 + 7 * 86_400) * 10**9)
    rows = order.total_order(rows.filter(F.col("symbol").endswith("5")))
    return rows.select("local_receive_ts_ns", "symbol", "seq", feed().alias("feed"))


SCAN_FILTERED_SQL = f"""{TAPE_SQL} SELECT recv_ns AS local_receive_ts_ns, symbol, seq, feed FROM tape
WHERE kind IN ('public_trade', 'ticker') AND symbol LIKE '%5' AND recv_ns >= 1704067200000000000 AND recv_ns < {(1704067200 + 7 * 86400) * 10**9}"""


def late_rows_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in a disturbed arrival order, clamped."""
    rows = tape(spark, sf_dir).withColumn("arrived", F.col("seq") + F.when(F.col("seq") % 7 == 0, 25).otherwise(0))
    out = order.clamp_late(rows.withColumn("arrived", F.col("arrived") * 10 + F.when(F.col("seq") % 7 == 0, 1).otherwise(0)), "arrived")
    return out.select("seq", "symbol", "local_receive_ts_ns", "local_receive_mono_ns")


LATE_ROWS_SQL = f"""{TAPE_SQL}, a AS (SELECT *, max(recv_ns) OVER (PARTITION BY symbol ORDER BY
    (seq + CASE WHEN seq % 7 = 0 THEN 25 ELSE 0 END) * 10 + CASE WHEN seq % 7 = 0 THEN 1 ELSE 0 END ROWS UNBOUNDED PRECEDING) AS top FROM tape)
SELECT seq, symbol, top AS local_receive_ts_ns, CASE WHEN mono_ns > 0 THEN mono_ns + top - recv_ns ELSE mono_ns END AS local_receive_mono_ns FROM a"""


def rows_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by verdict of the contract, after some were spoiled."""
    s = F.col("seq")
    rows = tape(spark, sf_dir)
    rows = rows.withColumn("side", F.when(s % 17 == 0, "Both").otherwise(F.col("side"))).withColumn("price", F.when(s % 19 == 0, float("nan")).otherwise(F.col("price")))
    rows = rows.withColumn("symbol", F.when(s % 23 == 0, "").otherwise(F.col("symbol"))).withColumn("kind", F.when(s % 29 == 0, "quote").otherwise(F.col("kind")))
    rows = rows.withColumn("values", F.when((s % 31 == 0) & F.col("values").isNotNull(), F.create_map(F.lit("colour"), F.lit(1.0))).otherwise(F.col("values")))
    good, bad = validated(rows)
    both = good.withColumn("reason", F.lit("ok")).unionByName(bad)
    return both.groupBy("reason").agg(F.count("*").alias("n"))


ROWS_VALIDATED_SQL = f"""{TAPE_SQL} SELECT CASE WHEN seq % 29 = 0 THEN 'unknown kind' WHEN seq % 23 = 0 THEN 'no symbol'
  WHEN kind = 'public_trade' AND seq % 19 = 0 THEN 'bad number' WHEN kind = 'public_trade' AND seq % 17 = 0 THEN 'bad side'
  WHEN kind = 'ticker' AND seq % 31 = 0 THEN 'unknown ticker name' ELSE 'ok' END AS reason, count(*) AS n FROM tape GROUP BY 1"""


def chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.verdicts(book.book_rows(book_tape(spark, sf_dir)))


def book_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chained(spark, sf_dir).select("symbol", "seq", "epoch", "valid")


BOOK_CHAIN_SQL = f"{BOOK_SQL} SELECT symbol, seq, CAST(epoch AS BIGINT) AS epoch, valid FROM v"


def book_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence marks and verdicts of the raw updates."""
    return book.mark_gaps(book.book_rows(book_tape(spark, sf_dir))).select("symbol", "seq", "previous_update_id", "sequence_gap", "verdict")


BOOK_MARKS_SQL = f"""{BOOK_SQL} SELECT symbol, seq, coalesce(pu, 0) AS previous_update_id, NOT valid AS sequence_gap,
  CASE WHEN snapshot THEN 'rebase' WHEN valid THEN 'apply' ELSE 'gap' END AS verdict FROM v"""


def book_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.gap_spans(book.mark_gaps(book.book_rows(book_tape(spark, sf_dir)))).select("symbol", "from_ns", F.coalesce("to_ns", F.lit(0)).alias("to_ns"))


BOOK_GAPS_SQL = f"""{BOOK_SQL} SELECT a.symbol, a.from_ns, coalesce(s.recv_ns, 0) AS to_ns FROM (
  SELECT symbol, epoch, min(recv_ns) AS from_ns FROM v WHERE NOT valid GROUP BY ALL) a
LEFT JOIN v s ON s.symbol = a.symbol AND s.epoch = a.epoch + 1 AND s.snapshot"""


def book_tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.tops(chained(spark, sf_dir)).select("symbol", "seq", "best_bid", "best_ask")


BOOK_TOPS_SQL = f"{BOOK_SQL}{TOPS_SQL} SELECT symbol, seq, best_bid, best_ask FROM tops"

MOMENTS = tuple((1_704_067_200 + d * 86_400) * 10**9 for d in (3, 10, 20, 29))


def book_levels_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of every book at four moments."""
    rows = chained(spark, sf_dir)
    moments = rows.select("symbol").distinct().withColumn("at_ns", F.explode(F.array(*(F.lit(m) for m in MOMENTS))))
    return book.books_at(rows, moments).select("symbol", "at_ns", "side", "price", "size")


AT_SQL = f"""
, m AS (SELECT DISTINCT symbol, unnest([{", ".join(map(str, MOMENTS))}]) AS at_ns FROM v),
ep AS (SELECT m.symbol, m.at_ns, max(v.epoch) AS epoch FROM m JOIN v ON v.symbol = m.symbol AND v.snapshot AND v.recv_ns <= m.at_ns GROUP BY ALL),
ok AS (SELECT ep.* FROM ep WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.symbol = ep.symbol AND v.epoch = ep.epoch AND NOT v.valid AND v.recv_ns <= ep.at_ns)),
lvl AS (SELECT ok.symbol, ok.at_ns, lv.side, lv.price, arg_max(lv.size, lv.i * 10 + lv.pos) AS size
  FROM ok JOIN lv ON lv.symbol = ok.symbol AND lv.epoch = ok.epoch AND lv.recv_ns <= ok.at_ns GROUP BY ALL HAVING arg_max(lv.size, lv.i * 10 + lv.pos) > 0)
"""
BOOK_LEVELS_AT_SQL = f"{BOOK_SQL}{AT_SQL} SELECT symbol, at_ns, side, price, size FROM lvl"


def book_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chained(spark, sf_dir)
    moments = rows.select("symbol").distinct().withColumn("at_ns", F.explode(F.array(*(F.lit(m) for m in MOMENTS))))
    out = book.shapes(book.books_at(rows, moments), bp=100.0).select("symbol", "at_ns", "best_bid", "best_ask", "bid_size", "ask_size", "mid", "spread_bp", "bid_depth", "ask_depth")
    return rounded(out)


BOOK_SHAPES_SQL = f"""{BOOK_SQL}{AT_SQL}
, t AS (SELECT symbol, at_ns, max(price) FILTER (side = 'bid') AS best_bid, min(price) FILTER (side = 'ask') AS best_ask,
  arg_max(size, price) FILTER (side = 'bid') AS bid_size, arg_min(size, price) FILTER (side = 'ask') AS ask_size FROM lvl GROUP BY ALL),
u AS (SELECT *, (best_bid + best_ask) / 2 AS mid FROM t)
SELECT u.symbol, u.at_ns, best_bid, best_ask, bid_size, ask_size, mid,
  CASE WHEN mid <> 0 THEN round((best_ask - best_bid) / mid * 10000, 6) END AS spread_bp,
  coalesce((SELECT sum(price * size) FROM lvl WHERE lvl.symbol = u.symbol AND lvl.at_ns = u.at_ns AND side = 'bid' AND price >= u.mid * (1 - 100.0 / 10000)), 0) AS bid_depth,
  coalesce((SELECT sum(price * size) FROM lvl WHERE lvl.symbol = u.symbol AND lvl.at_ns = u.at_ns AND side = 'ask' AND price <= u.mid * (1 + 100.0 / 10000)), 0) AS ask_depth
FROM u"""


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quality columns of every symbol and feed."""
    return quality.build_quality(whole_tape(spark, sf_dir)).drop("venue")


QUALITY_SQL = f"""
{TAPE_SQL}
{BOOK_TAIL}
, r AS (
  SELECT symbol, feed, kind, seq, recv_ns, sent_ns, mono_ns, message_type, oi, trade_id, NULL AS snapshot, NULL AS valid FROM tape
  UNION ALL SELECT symbol, 'book:50', 'book', seq, recv_ns, recv_ns - 5000000, recv_ns, NULL, NULL, NULL, snapshot, valid FROM v),
w AS (SELECT *, recv_ns - lag(recv_ns) OVER o AS silence, lag(recv_ns) OVER o AS wall, CASE WHEN mono_ns > 0 THEN mono_ns END AS mono,
   last_value(CASE WHEN mono_ns > 0 THEN mono_ns END IGNORE NULLS) OVER (PARTITION BY symbol, feed ORDER BY recv_ns, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_mono
   FROM r WINDOW o AS (PARTITION BY symbol, feed ORDER BY recv_ns, seq)),
x AS (SELECT *, CASE WHEN abs((recv_ns - mono) - (wall - last_mono)) > 1000000 + trunc(abs(mono - last_mono) * 0.001) THEN 1 ELSE 0 END AS step,
   CASE WHEN sent_ns > 0 THEN (recv_ns - sent_ns - ((recv_ns - sent_ns) % 1000000 + 1000000) % 1000000) // 1000000 END AS skew FROM w),
s AS (SELECT symbol, feed, skew, row_number() OVER (PARTITION BY symbol, feed ORDER BY skew) - 1 AS place, count(*) OVER (PARTITION BY symbol, feed) AS total FROM x WHERE skew IS NOT NULL),
sk AS (SELECT symbol, feed, CAST(min(skew) AS DOUBLE) AS skew_min_ms, CAST(min(skew) FILTER (place = (total - 1) // 2) AS DOUBLE) AS skew_p50_ms,
   CAST(min(skew) FILTER (place = least(total - 1, 99 * total // 100)) AS DOUBLE) AS skew_p99_ms, CAST(max(skew) AS DOUBLE) AS skew_max_ms FROM s GROUP BY ALL),
du AS (SELECT symbol, 'trades' AS feed, count(*) - count(DISTINCT trade_id) AS dup FROM tape WHERE kind = 'public_trade' GROUP BY 1)
SELECT x.symbol, x.feed, count(*) AS rows, min(recv_ns) AS first_receive_ns, max(recv_ns) AS last_receive_ns, greatest(coalesce(max(silence), 0), 0) / 1e6 AS max_silence_ms,
  skew_min_ms, skew_p50_ms, skew_p99_ms, skew_max_ms, count(*) FILTER (snapshot) AS snapshots, count(*) FILTER (NOT snapshot) AS deltas, 0 AS sequence_gaps,
  count(*) FILTER (NOT snapshot AND NOT valid) AS refused, arg_max(valid, CAST(recv_ns AS HUGEINT) * 100000000 + seq) AS chained,
  CASE WHEN x.feed = 'book:50' THEN arg_min(snapshot, CAST(recv_ns AS HUGEINT) * 100000000 + seq) WHEN x.feed = 'ticker' THEN bool_or(message_type = 'snapshot') END AS anchored,
  CASE WHEN x.feed = 'ticker' THEN 1 + max(CASE WHEN oi IS NOT NULL THEN 1 ELSE 0 END) ELSE 0 END AS ticker_fields, coalesce(max(dup), 0) AS duplicate_trade_ids, CAST(sum(step) AS BIGINT) AS clock_steps
FROM x LEFT JOIN sk ON sk.symbol = x.symbol AND sk.feed = x.feed LEFT JOIN du ON du.symbol = x.symbol AND du.feed = x.feed
GROUP BY x.symbol, x.feed, skew_min_ms, skew_p50_ms, skew_p99_ms, skew_max_ms
"""


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.summarize(quality.build_quality(whole_tape(spark, sf_dir))).withColumns({c: F.concat_ws(",", c) for c in ("unchained", "unanchored")}))


QUALITY_SUMMARY_SQL = f"""WITH q AS ({QUALITY_SQL}),
g AS (SELECT feed, symbol, rows, skew_p50_ms, skew_p99_ms, max_silence_ms, clock_steps, sequence_gaps, refused, duplicate_trade_ids, chained, anchored FROM q
  UNION ALL SELECT NULL, symbol, rows, skew_p50_ms, skew_p99_ms, max_silence_ms, clock_steps, sequence_gaps, refused, duplicate_trade_ids, chained, anchored FROM q),
a AS (SELECT feed, count(DISTINCT symbol) AS symbols, CAST(sum(rows) AS BIGINT) AS rows, median(skew_p50_ms) AS skew_p50_ms, max(skew_p99_ms) AS skew_p99_ms, round(max(max_silence_ms), 6) AS max_silence_ms,
  CAST(sum(clock_steps) AS BIGINT) AS clock_steps, CAST(sum(sequence_gaps) AS BIGINT) AS sequence_gaps, CAST(sum(refused) AS BIGINT) AS refused, CAST(sum(duplicate_trade_ids) AS BIGINT) AS duplicate_trade_ids,
  list_sort(coalesce(list(DISTINCT symbol) FILTER (NOT chained), [])) AS uc, list_sort(coalesce(list(DISTINCT symbol) FILTER (NOT anchored), [])) AS ua FROM g GROUP BY feed)
SELECT feed, symbols, rows, skew_p50_ms, skew_p99_ms, max_silence_ms, clock_steps, sequence_gaps, refused, duplicate_trade_ids,
  array_to_string(uc[1:20], ',') AS unchained, array_to_string(ua[1:20], ',') AS unanchored FROM a"""

# ---------------------------------------------------------------- diff streams
def diff_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same books as a diff stream: every delta names the id before its own, and may span that of the snapshot before it."""
    rows = book_tape(spark, sf_dir).withColumns({"venue": F.lit("binance"), "depth": F.lit(1000)})
    return rows.withColumns({"previous_update_id": F.col("update_id") - 1, "first_update_id": F.col("update_id") - 1})


def late_diff_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diff-stream books whose snapshots come as REST reads do: up to four diffs late, some far too old, some ahead of the diffs; each diff names the one before it unless ids were skipped."""
    rows = book_tape(spark, sf_dir).withColumns({"venue": F.lit("binance"), "depth": F.lit(1000), "_shot": F.col("kind") == "orderbook_snapshot"})
    behind = F.when(F.col("seq") % 3 == 0, 30).when(F.col("seq") % 7 == 0, -3).otherwise(F.col("seq") % 5)
    after = F.coalesce(F.lag("_shot").over(order.arrival("symbol")), F.lit(False))
    rows = rows.withColumn("_named", F.col("update_id") - 1 - after.cast("int"))
    told = {"previous_update_id": F.when(~F.col("_shot"), F.col("_named")), "first_update_id": F.when(~F.col("_shot"), F.col("_named") + 1), "update_id": F.col("update_id") - F.when(F.col("_shot"), behind).otherwise(0)}
    return rows.withColumns(told).drop("_shot", "_named")


def diff_late_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts where snapshots must be held for, replayed, re-based on and passed over."""
    return book.verdicts(book.book_rows(late_diff_tape(spark, sf_dir))).select("symbol", "seq", "valid")


def diff_late_tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.tops(book.verdicts(book.book_rows(late_diff_tape(spark, sf_dir)))).select("symbol", "seq", "best_bid", "best_ask")


#: A book is whole if the newest snapshot by id lies in the present run of diffs, or ahead of it; that snapshot is its base.
LATE_SQL = BOOK_SQL[: BOOK_SQL.index("v1 AS (")] + """
s1 AS (SELECT *, CASE WHEN snapshot THEN u - CASE WHEN seq % 3 = 0 THEN 30 WHEN seq % 7 = 0 THEN -3 ELSE seq % 5 END ELSE u END AS id,
    u - CASE WHEN coalesce(lag(snapshot) OVER (PARTITION BY symbol ORDER BY recv_ns, seq), false) THEN 2 ELSE 1 END AS named FROM b),
s2 AS (SELECT *, last_value(CASE WHEN NOT snapshot THEN id END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY recv_ns, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s1),
s3 AS (SELECT *, last_value(CASE WHEN NOT snapshot AND named IS DISTINCT FROM before THEN named + 1 END IGNORE NULLS) OVER w AS run_first,
    max(CASE WHEN snapshot THEN id END) OVER w AS newest, max(CASE WHEN snapshot THEN CAST(id AS HUGEINT) * 1000000000 + i END) OVER w % 1000000000 AS base_i
    FROM s2 WINDOW w AS (PARTITION BY symbol ORDER BY recv_ns, seq)),
v AS (SELECT *, newest IS NOT NULL AND (run_first IS NULL OR newest >= run_first) AS valid FROM s3)
"""
LATE_TOPS_SQL = LATE_SQL + """
, lx AS (SELECT symbol, i, id, snapshot, 'bid' AS side, 0 AS pos, p AS price, CAST(k % 4 AS DOUBLE) AS size FROM v WHERE k % 2 = 0
  UNION ALL SELECT symbol, i, id, snapshot, 'bid', 1, p - 1, 2.0 FROM v WHERE k % 2 = 0 AND snapshot UNION ALL SELECT symbol, i, id, snapshot, 'bid', 2, p - 2, 3.0 FROM v WHERE k % 2 = 0 AND snapshot
  UNION ALL SELECT symbol, i, id, snapshot, 'ask', 0, p + 1, CAST(k % 4 AS DOUBLE) FROM v WHERE k % 2 = 1 OR snapshot
  UNION ALL SELECT symbol, i, id, snapshot, 'ask', 1, p + 2, 2.0 FROM v WHERE snapshot UNION ALL SELECT symbol, i, id, snapshot, 'ask', 2, p + 3, 3.0 FROM v WHERE snapshot),
st AS (SELECT r.symbol, r.i, l.side, l.price, arg_max(l.size, CASE WHEN l.snapshot THEN 0 ELSE l.i END * 10 + l.pos) AS size
  FROM v r JOIN lx l ON l.symbol = r.symbol AND ((l.snapshot AND l.i = r.base_i) OR (NOT l.snapshot AND l.i <= r.i AND l.id >= r.newest)) WHERE r.valid GROUP BY ALL)
SELECT r.symbol, r.seq, max(price) FILTER (side = 'bid' AND size > 0) AS best_bid, min(price) FILTER (side = 'ask' AND size > 0) AS best_ask
FROM v r LEFT JOIN st ON st.symbol = r.symbol AND st.i = r.i WHERE r.valid GROUP BY ALL
"""


def diff_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of diff-stream books, which break where an id is skipped until the next snapshot."""
    return book.verdicts(book.book_rows(diff_tape(spark, sf_dir))).select("symbol", "seq", "valid")


def diff_tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.tops(book.verdicts(book.book_rows(diff_tape(spark, sf_dir)))).select("symbol", "seq", "best_bid", "best_ask")


def bars_diff_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-day bars of a tape whose books are diff streams."""
    return rounded(bars.build_bars(tape(spark, sf_dir).withColumn("venue", F.lit("binance")).unionByName(diff_tape(spark, sf_dir)), 86_400))


def quality_diff_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality columns of a tape whose books are diff streams."""
    return quality.build_quality(tape(spark, sf_dir).withColumn("venue", F.lit("binance")).unionByName(diff_tape(spark, sf_dir))).drop("venue")


QUERIES = {
    "diff_late_chain": diff_late_chain, "diff_late_tops": diff_late_tops,
    "diff_chain": diff_chain, "diff_tops": diff_tops, "bars_diff_books": bars_diff_books, "quality_diff_books": quality_diff_books,
    "bars_full": bars_full, "bars_hourly": bars_hourly, "bars_rolled": bars_rolled, "tape_statistics": tape_statistics, "scan_filtered": scan_filtered,
    "late_rows_clamped": late_rows_clamped, "rows_validated": rows_validated, "book_chain": book_chain, "book_marks": book_marks, "book_gaps": book_gaps,
    "book_tops": book_tops, "book_levels_at": book_levels_at, "book_shapes": book_shapes, "quality_report": quality_report, "quality_summary": quality_summary,
}
SQL = {
    "diff_late_chain": f"{LATE_SQL} SELECT symbol, seq, valid FROM v", "diff_late_tops": LATE_TOPS_SQL,
    "diff_chain": f"{BOOK_SQL} SELECT symbol, seq, valid FROM v", "diff_tops": BOOK_TOPS_SQL, "bars_diff_books": BARS_FULL_SQL.replace(f"'{VENUE}'", "'binance'"), "quality_diff_books": QUALITY_SQL.replace("book:50", "book:1000"),
    "bars_full": BARS_FULL_SQL, "bars_hourly": BARS_HOURLY_SQL, "bars_rolled": BARS_ROLLED_SQL, "tape_statistics": TAPE_STATISTICS_SQL, "scan_filtered": SCAN_FILTERED_SQL,
    "late_rows_clamped": LATE_ROWS_SQL, "rows_validated": ROWS_VALIDATED_SQL, "book_chain": BOOK_CHAIN_SQL, "book_marks": BOOK_MARKS_SQL, "book_gaps": BOOK_GAPS_SQL,
    "book_tops": BOOK_TOPS_SQL, "book_levels_at": BOOK_LEVELS_AT_SQL, "book_shapes": BOOK_SHAPES_SQL, "quality_report": QUALITY_SQL, "quality_summary": QUALITY_SUMMARY_SQL,
}
