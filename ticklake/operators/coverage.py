"""The coverage ledger: what was recorded of each (hour, symbol, feed), and why not all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.scalars import hour_key
from ticklake.operators.order import RECV
from ticklake.operators.spans import contiguous, intersect, merge, subtract
from ticklake.schema import NS_PER_HOUR
from ticklake.sources.normalize import BYBIT_INTERVALS
from ticklake.sources.scratch import stored

SPAN = "array<bigint>"
#: The fields of a coverage document of one process and hour.
RECORD = (
    "venue string, market string, day string, hour string, pid bigint, window struct<from_ns:bigint,to_ns:bigint>, hour_span struct<from_ns:bigint,to_ns:bigint>, "
    f"tiers array<struct<name:string,feeds:array<string>,members:map<string,array<{SPAN}>>>>, shards array<struct<index:bigint,tier:string,topics:array<string>>>, "
    "disconnects array<struct<shard:bigint,tier:string,topics:array<string>,from_ns:bigint,to_ns:bigint>>, overruns array<struct<shard:bigint,ns:bigint>>, "
    "book_gaps array<struct<topic:string,symbol:string,depth:bigint,from_ns:bigint,to_ns:bigint>>, shed array<struct<tier:string,feed:string,from_ns:bigint,to_ns:bigint>>, "
    f"disk_blocked array<{SPAN}>"
)
CELL = ("hour", "symbol", "feed")


def exploded(records: DataFrame) -> dict[str, DataFrame]:
    """The tables inside coverage documents, each keyed by hour; ``rec`` tells documents of an hour apart."""
    r = records.select("*", F.concat("day", F.lit("T"), "hour").alias("h"), F.xxhash64("venue", "market", "day", "hour", "pid", "window").alias("rec")).drop("hour").withColumnRenamed("h", "hour")
    base = ["hour", "rec", "venue", "market"]
    tiers = r.select(*base, F.explode("tiers").alias("t"))
    members = tiers.select(*base, F.col("t.name").alias("tier"), F.col("t.feeds").alias("feeds"), F.explode("t.members").alias("symbol", "spans"))
    grants = members.select(*base, "tier", F.upper("symbol").alias("symbol"), F.explode("feeds").alias("feed"), "spans").withColumn("s", F.explode("spans"))
    shards = r.select("hour", "rec", F.explode("shards").alias("s")).select("hour", "rec", F.col("s.index").alias("shard"), F.explode("s.topics").alias("topic"))
    return {
        "hours": r.select("hour", F.col("hour_span.from_ns").alias("start"), F.col("hour_span.to_ns").alias("end")).distinct(),
        "windows": r.select("hour", F.col("window.from_ns").alias("start"), F.col("window.to_ns").alias("end")),
        "grants": grants.select(*base, "tier", "symbol", "feed", F.col("s")[0].alias("start"), F.col("s")[1].alias("end")),
        "shed": r.select("hour", "rec", F.explode("shed").alias("x")).select("hour", "rec", "x.tier", "x.feed", F.col("x.from_ns").alias("start"), F.col("x.to_ns").alias("end")),
        "disconnects": r.select(*base, F.explode("disconnects").alias("x")).select(*base, F.explode("x.topics").alias("topic"), F.col("x.from_ns").alias("start"), F.col("x.to_ns").alias("end")),
        "book_gaps": r.select("hour", "window", F.explode("book_gaps").alias("x")).select("hour", F.upper("x.symbol").alias("symbol"), F.concat(F.lit("book:"), F.col("x.depth").cast("string")).alias("feed"), F.col("x.from_ns").alias("start"), F.coalesce("x.to_ns", "window.to_ns").alias("end")),
        "disk_blocked": r.select("hour", F.explode("disk_blocked").alias("x")).select("hour", F.col("x")[0].alias("start"), F.col("x")[1].alias("end")),
        "overruns": r.select(*base, F.explode("overruns").alias("x")).select(*base, F.col("x.shard").alias("shard"), F.col("x.ns").alias("ns")).join(shards, ["hour", "rec", "shard"]).select(*base, "topic", "ns"),
    }


def topic() -> F.Column:
    """The venue's topic of (venue, symbol, feed); empty for venues and feeds without one."""
    name, arg, low = F.split("feed", ":")[0], F.try_element_at(F.split("feed", ":"), F.lit(2)), F.lower("symbol")
    code = F.try_element_at(F.create_map(*(F.lit(x) for code, interval in BYBIT_INTERVALS.items() for x in (interval, code))), arg)
    bybit = (
        F.when(name == "book", F.concat_ws(".", F.lit("orderbook"), arg, "symbol")).when(name == "trades", F.concat(F.lit("publicTrade."), "symbol"))
        .when(name == "ticker", F.concat(F.lit("tickers."), "symbol")).when(name == "liquidations", F.concat(F.lit("allLiquidation."), "symbol"))
        .when(name == "kline", F.concat_ws(".", F.lit("kline"), F.coalesce(code, arg), "symbol")).otherwise("")
    )
    binance = (
        F.when((name == "book") & (arg == "1"), F.concat(low, F.lit("@bookTicker"))).when((name == "book") & (arg == "1000"), F.concat(low, F.lit("@depth@100ms")))
        .when(name == "book", F.concat(low, F.lit("@depth"), arg, F.lit("@100ms"))).when(name == "trades", F.concat(low, F.lit("@trade")))
        .when(name == "ticker", F.concat(low, F.lit("@markPrice@1s"))).when(name == "liquidations", F.lit("!forceOrder@arr"))
        .when(name == "kline", F.concat(low, F.lit("@kline_"), arg)).otherwise("")
    )
    return F.when(F.col("venue") == "bybit", bybit).when(F.col("venue") == "binance", binance).otherwise("")


def reasons(tables: dict[str, DataFrame]) -> DataFrame:
    """Why cells aren't complete: (hour, symbol, feed, code, from_ns, to_ns), spans by interval algebra for all cells at once.

    ``tables``: as from ``exploded``; ``grants`` may carry its own ``topic`` column.
    """
    grants = tables["grants"]
    if "topic" not in grants.columns:
        grants = grants.withColumn("topic", topic())
    hours = stored(merge(tables["hours"], "hour"), "hours")  # tables of hours are stored, so that Spark knows how small they are
    granted = stored(granted_spans(grants, hours), "granted")  # read by every reason
    covered = stored(intersect(merge(tables["windows"], "hour"), hours, "hour"), "covered")
    named = granted.select(*CELL).distinct()
    down = stored(subtract(hours, covered, "hour"), "down").join(named, "hour")
    partial = subtract(covered.join(named, "hour"), granted, *CELL)
    tier = ("rec", "tier", *CELL)
    shed = stored(tables["shed"], "shed")
    cut = shed.join(grants.select(*tier).distinct(), ["hour", "rec", "tier", "feed"])
    touched = cut.select(*CELL).distinct()
    left = merge(subtract(grants.join(touched, list(CELL), "left_semi"), cut, *tier), *CELL)
    live = clipped(left, hours)
    shed = subtract(granted.join(touched, list(CELL), "left_semi"), live, *CELL)
    heard = grants.filter("topic <> ''").select("rec", *CELL, "topic").distinct()
    off = intersect_each(tables["disconnects"].join(heard, ["hour", "rec", "topic"]), granted)
    gaps = intersect_each(tables["book_gaps"], granted)
    blocked = intersect_each(stored(tables["disk_blocked"], "blocked"), granted, "hour")
    over = tables["overruns"].join(heard, ["hour", "rec", "topic"]).join(granted, list(CELL)).filter("start <= ns and ns <= end")
    over = over.select(*CELL, F.col("ns").alias("start"), F.col("ns").alias("end")).distinct()
    parts = {"recorder_down": down, "tier_membership_partial": partial, "shed": shed, "shard_disconnected": off, "book_gap": gaps, "disk_blocked": blocked, "queue_overrun": over}
    out = None
    for code, part in parts.items():
        part = part.select(*CELL, F.lit(code).alias("code"), F.col("start").alias("from_ns"), F.col("end").alias("to_ns"))
        out = part if out is None else out.unionByName(part)
    return out


def granted_spans(grants: DataFrame, hours: DataFrame) -> DataFrame:
    """What the records grant each cell inside its hour (``hours`` merged)."""
    return clipped(merge(grants, *CELL), hours)


def clipped(spans: DataFrame, hours: DataFrame) -> DataFrame:
    """The parts of cells' merged spans inside the merged spans of their hour; a null key has no spans."""
    return intersect_each(spans.dropna(subset=list(CELL)), hours, "hour")


def intersect_each(spans: DataFrame, others: DataFrame, *key: str) -> DataFrame:
    """Each span's part inside each of the other side's of its ``key`` (a cell, if none is given); spans of one side aren't joined with each other."""
    other = others.withColumnsRenamed({"start": "_s", "end": "_e"})
    both = spans.join(other, list(key or CELL)).filter("start < _e and _s < end")
    return both.select(*CELL, F.greatest("start", "_s").alias("start"), F.least("end", "_e").alias("end"))


def observed_by_symbol(receipts: DataFrame) -> DataFrame:
    """Rows and stamps of (hour, symbol) from file receipts; meta files and empty receipts don't count."""
    rows = receipts.withColumn("symbol", F.upper(F.coalesce("symbol", F.split("path", "/")[0]))).filter("symbol <> '_META' and records > 0")
    stamp = {c: F.when(F.col(c) > 0, F.col(c)) for c in ("first_receive_ns", "last_receive_ns")}
    return rows.groupBy("hour", "symbol").agg(F.sum("records").alias("records"), F.min(stamp["first_receive_ns"]).alias("first_receive_ns"), F.max(stamp["last_receive_ns"]).alias("last_receive_ns"))


def observed_by_feed(tape: DataFrame) -> DataFrame:
    """Rows and stamps of (hour, symbol, feed) from the rows themselves; rows of no feed don't count, stamps of 0 tell nothing."""
    from ticklake.schema import feed

    stamp = F.when(F.col(RECV) > 0, F.col(RECV))
    rows = tape.select(hour_key(RECV).alias("hour"), F.upper(F.coalesce("symbol", F.lit(""))).alias("symbol"), feed().alias("feed"), stamp.alias("ns")).filter("feed <> ''")
    return rows.groupBy(*CELL).agg(F.count("*").alias("records"), F.min("ns").alias("first_receive_ns"), F.max("ns").alias("last_receive_ns"))


def rolled(spans: DataFrame, windows: DataFrame, *key: str, keep_open: bool = False, of: tuple[str, ...] = ()) -> DataFrame:
    """What each hour's record tells of spans that run over hours: (hour, key, from_ns, to_ns).

    ``spans``: key, start, end (null: still open); ``windows``: hour, from_ns,
    to_ns of the time that the process was up in it, of which spans meet the
    hours they cover only. A span is cut to the window; one that is open at its
    end is cut there too, or with ``keep_open`` has no end. ``of``: the columns,
    of both tables and of the result, that say whose windows and spans they are.
    """
    last = windows.agg(F.max("to_ns")).first()[0] or 0
    rows = spans.withColumn("_last", F.coalesce("end", F.lit(last).cast("bigint")) - 1).filter("start <= _last")
    rows = rows.withColumn("_h", F.explode(F.sequence(F.expr(f"start div {NS_PER_HOUR}"), F.expr(f"_last div {NS_PER_HOUR}"))))
    both = rows.join(windows.withColumn("_h", F.expr(f"from_ns div {NS_PER_HOUR}")), ["_h", *of])
    start, end = F.greatest("start", "from_ns"), F.least(F.coalesce("end", "to_ns"), "to_ns")
    still = F.col("end").isNull() | (F.col("end") > F.col("to_ns")) if keep_open else F.lit(False)
    return both.filter(start < end).select("hour", *of, *key, start.alias("from_ns"), F.when(~still, end).alias("to_ns"))


def counter_deltas(readings: DataFrame, counters: list[str], *key: str) -> DataFrame:
    """Counters as what they grew by since the record before: ``readings`` has key, to_ns and running totals; a process starts at 0."""
    w = Window.partitionBy(*key).orderBy("to_ns")
    return readings.withColumns({c: F.col(c) - F.coalesce(F.lag(c).over(w), F.lit(0)) for c in counters})


def ledger(tables: dict[str, DataFrame], observed: DataFrame | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """One row for each cell: status, reason_codes (distinct, by their first span), records and stamps.

    ``observed``: rows by hour, symbol and feed (or ``*``); ``wanted``: the cells
    to answer for, else those granted or observed. Hours without a record are
    observed or absent; with one, cells that no record grants are absent.
    """
    tables = tables | {"hours": stored(tables["hours"], "told")}
    why = reasons(tables)
    inside = tables["grants"].join(tables["hours"].select("hour", F.col("start").alias("_s"), F.col("end").alias("_e")), "hour").filter("start < end and start < _e and _s < end")
    granted = inside.select(*CELL).distinct().withColumn("granted", F.lit(True))
    ordered = why.groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("from_ns", "code", "to_ns"))).alias("x"))
    codes = ordered.select(*CELL, F.array_distinct(F.transform("x", lambda x: x["code"])).alias("reason_codes"))
    cells = granted.select(*CELL)
    if observed is not None:
        cells = cells.unionByName(observed.select(*CELL)).distinct()
    cells = wanted.select(*CELL).distinct() if wanted is not None else cells
    alone = observed is None and wanted is None
    out = granted if alone else cells.join(granted, list(CELL), "left")
    out = out.join(tables["hours"].select("hour", F.lit(True).alias("told")), "hour", "left").join(codes, list(CELL), "left")
    if observed is not None:
        out = out.join(observed, list(CELL), "left")
    else:
        out = out.withColumns({c: F.lit(None).cast("bigint") for c in ("records", "first_receive_ns", "last_receive_ns")})
    listed = F.coalesce("reason_codes", F.array().cast("array<string>"))
    status = (
        F.when(F.col("told").isNull(), F.when(F.coalesce("records", F.lit(0)) > 0, "observed").otherwise("absent"))
        .when(F.col("granted").isNull(), "absent").when(F.size(listed) > 0, "excluded").otherwise("complete")
    )
    return out.select(*CELL, status.alias("status"), listed.alias("reason_codes"), F.coalesce("records", F.lit(0)).alias("records"), "first_receive_ns", "last_receive_ns")


#: The feed of a cell when only a symbol's rows are known.
ANY_FEED = "*"


def grid(tables: dict[str, DataFrame], by_symbol: DataFrame, symbols: DataFrame | None = None, feeds: list[str] | None = None) -> DataFrame:
    """The cells to answer for, with the rows and stamps of their symbol's receipts.

    Cells are those granted and, in hours without a record, the symbols that have
    receipts (``by_symbol``, from ``observed_by_symbol``) under the feed ``*``.
    ``symbols`` (a table with a column symbol) asks for these in every hour that
    is told or observed, ``feeds`` for these of each symbol; a symbol of which
    nothing is known in an hour has the feed ``*``.
    """
    told, counts = tables["hours"].select("hour").distinct(), by_symbol.select("hour", "symbol", "records", "first_receive_ns", "last_receive_ns")
    granted = tables["grants"].select(*CELL).distinct()
    dark = counts.join(told, "hour", "left_anti").select("hour", "symbol", F.lit(ANY_FEED).alias("feed"))
    pairs = granted.unionByName(dark).distinct()
    if symbols is not None:
        hours = told.unionByName(counts.select("hour")).distinct()
        asked = symbols.select(F.upper("symbol").alias("symbol")).distinct()
        if hours.isEmpty():
            return pairs.join(counts, ["hour", "symbol"], "left")
        first, last = (F.to_timestamp(F.lit(x), "yyyy-MM-dd'T'HH") for x in hours.agg(F.min("hour"), F.max("hour")).first())
        every = F.transform(F.sequence(first, last, F.expr("interval 1 hour")), lambda h: F.date_format(h, "yyyy-MM-dd'T'HH"))
        names = asked.select(F.explode(every).alias("hour"), "symbol").join(hours, "hour", "left_semi")
    else:
        names = pairs.select("hour", "symbol").distinct()
    if feeds is not None:
        cells = names.withColumn("feed", F.explode(F.array(*(F.lit(f) for f in feeds))))
    else:
        cells = names.join(pairs, ["hour", "symbol"], "left").withColumn("feed", F.coalesce("feed", F.lit(ANY_FEED)))
    return cells.join(counts, ["hour", "symbol"], "left")


def symbol_ledger(tables: dict[str, DataFrame], by_symbol: DataFrame, symbols: DataFrame | None = None, feeds: list[str] | None = None) -> DataFrame:
    """The ledger of ``grid``'s cells."""
    cells = stored(grid(tables, by_symbol, symbols, feeds), "grid")
    return ledger(tables, observed=cells, wanted=cells)


def complete_windows(cells: DataFrame) -> DataFrame:
    """Runs of complete hours of each (symbol, feed): [from_hour, to_hour) as numbers of hours since 1970."""
    hour = F.expr("unix_seconds(to_timestamp(concat(hour, ':00:00'), \"yyyy-MM-dd'T'HH:mm:ss\")) div 3600")
    return contiguous(cells.filter("status = 'complete'").withColumn("hour", hour), "symbol", "feed")


def summary(cells: DataFrame) -> DataFrame:
    """Cells by status and by reason."""
    by_status = cells.groupBy(F.col("status").alias("name")).agg(F.count("*").alias("n")).withColumn("what", F.lit("status"))
    by_reason = cells.select(F.explode("reason_codes").alias("name")).groupBy("name").agg(F.count("*").alias("n")).withColumn("what", F.lit("reason"))
    return by_status.unionByName(by_reason)


__all__ = ["CELL", "RECORD", "complete_windows", "exploded", "ledger", "merge", "observed_by_symbol", "reasons", "summary", "topic"]
