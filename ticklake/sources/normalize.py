"""Raw venue frames to tape rows in one pass: JSON functions and projections only.

A frames table has venue, raw, recv_ns, mono_ns and arrival_seq. Objects are
parsed as maps of text, since the venues' keys differ in case only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.schema import LEVELS, finite, widened

# --- fixed values: venue names of fields and codes --------------------------
BYBIT_TICKER = {
    "lastPrice": "last_price", "markPrice": "mark_price", "indexPrice": "index_price", "openInterest": "open_interest", "openInterestValue": "open_interest_value",
    "fundingRate": "funding_rate", "nextFundingTime": "next_funding_time_ms", "bid1Price": "bid_price", "bid1Size": "bid_size", "ask1Price": "ask_price", "ask1Size": "ask_size",
    "turnover24h": "turnover_24h", "volume24h": "volume_24h", "price24hPcnt": "price_change_24h_pct", "prevPrice1h": "prev_price_1h", "prevPrice24h": "prev_price_24h",
    "highPrice24h": "high_price_24h", "lowPrice24h": "low_price_24h",
}
BINANCE_MARK = {"p": "mark_price", "i": "index_price", "r": "funding_rate", "T": "next_funding_time_ms"}
BINANCE_DAY = {"c": "last_price", "q": "turnover_24h", "v": "volume_24h", "P": "price_change_24h_pct"}
BYBIT_INTERVALS = {"1": "1m", "3": "3m", "5": "5m", "15": "15m", "30": "30m", "60": "1h", "120": "2h", "240": "4h", "360": "6h", "720": "12h", "D": "1d", "W": "1w", "M": "1M"}
BINANCE_PRINTS = ("MARKET", "RPI")
DIFF_DEPTH = 1000
# ----------------------------------------------------------------------------

OBJECT, LIST = "map<string,string>", "array<map<string,string>>"
KEYS = ("venue", "local_receive_ts_ns", "local_receive_mono_ns", "seq")


def at(m: str, key: str) -> Column:
    return F.try_element_at(F.col(m), F.lit(key))


def whole(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def ns(text: Column) -> Column:
    """Milliseconds as text to ns; absent is 0."""
    return whole(text) * 1_000_000


def number(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("double"), F.lit(0.0))


def number_or_null(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("double")


def levels(text: Column) -> Column:
    return F.coalesce(F.from_json(text, LEVELS), F.array().cast(LEVELS))


def one_level(price: Column, size: Column) -> Column:
    given = (F.coalesce(price, F.lit("")) != "") & (F.coalesce(size, F.lit("")) != "")
    return F.when(given, F.array(F.array(price, size))).otherwise(F.array().cast(LEVELS))


def ticker_values(m: str, names: dict[str, str], percent: bool = False) -> Column:
    """Renamed numbers of a sparse object; absent, blank and unparsable ones are left out."""
    parts = []
    for venue_name, name in names.items():
        value = at(m, venue_name)
        value = F.nullif(value, F.lit("")).try_cast("bigint").cast("double") if name == "next_funding_time_ms" else number_or_null(value)
        parts.append(F.struct(F.lit(name).alias("key"), (value / 100 if percent and name == "price_change_24h_pct" else value).alias("value")))
    return F.map_from_entries(F.filter(F.array(*parts), lambda x: x["value"].isNotNull()))


def as_list(text: Column) -> Column:
    """A JSON list of objects, or one object as a list of it."""
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, LIST)).otherwise(F.array(F.from_json(text, OBJECT)))


def _symbol(c: Column) -> Column:
    return F.upper(F.coalesce(c, F.lit("")))


#: What a frame's envelope may hold; ``data`` stays text until its kind is known.
ENVELOPE = "topic string, type string, ts string, cts string, cs string, stream string, data string"
BYBIT_TOPICS = ("orderbook", "publicTrade", "tickers", "allLiquidation", "kline")


def frame_kind() -> Column:
    """``venue.what`` of a frame, told by its topic or stream; null for frames that hold no rows."""
    prefix, tail = F.split("topic", "[.]")[0], F.col("tail")
    first = F.when(prefix.isin(*BYBIT_TOPICS) & F.contains("topic", F.lit(".")), F.concat(F.lit("bybit."), prefix))
    second = (
        F.when(F.col("stream") == "!forceOrder@arr", "binance.forceOrder").when(tail == "bookTicker", "binance.top").when(tail.startswith("depth"), "binance.depth").when(tail == "trade", "binance.trade")
        .when(tail.startswith("markPrice"), "binance.mark").when(tail == "ticker", "binance.day").when(tail.startswith("kline_"), "binance.kline")
    )
    return F.when(F.col("venue") == "bybit", first).when(F.col("venue") == "binance", second)


def entries(frames: DataFrame) -> DataFrame:
    """One row for each entry of each frame: its frame's kind and envelope, the entry ``d`` and the object ``o`` inside it.

    Every text is parsed once: a generator stands between parsing and use, and no
    filter or projection is pushed through it.
    """
    rows = frames.select(
        "venue", F.col("recv_ns").alias("local_receive_ts_ns"), F.col("mono_ns").alias("local_receive_mono_ns"), F.col("arrival_seq").alias("seq"), F.inline(F.array(F.from_json("raw", ENVELOPE)))
    )
    rows = rows.withColumn("tail", F.regexp_replace("stream", "^[^@]*@", "")).withColumn("what", frame_kind()).filter("what is not null")
    what = F.col("what")
    held = (
        F.when(what.isin("bybit.publicTrade", "bybit.kline"), F.from_json("data", LIST)).when(what.isin("bybit.allLiquidation", "binance.forceOrder"), as_list(F.col("data")))
        .otherwise(F.array(F.from_json("data", OBJECT)))
    )
    rows = rows.select("*", F.explode(held).alias("d"))
    inner = F.when(what == "binance.forceOrder", at("d", "o")).when(what == "binance.kline", at("d", "k"))
    return rows.select("*", F.explode(F.array(F.from_json(inner, OBJECT))).alias("o"))


def bybit_fields() -> dict[str, tuple[Column, dict[str, Column]]]:
    """For each kind of frame: which entries count, and their columns."""
    topic, sent, kind = F.split("topic", "[.]"), ns(F.col("ts")), F.lower(F.coalesce("type", F.lit("")))
    symbol = _symbol(at("d", "s"))
    told = at("d", "S").isin("Buy", "Sell") & (symbol != "")
    update = whole(at("d", "u"))
    depth = topic[1].try_cast("int")
    own = F.when(whole(at("d", "T")) != 0, ns(at("d", "T"))).otherwise(sent)
    names = F.create_map(*(F.lit(v) for kv in BYBIT_INTERVALS.items() for v in kv))
    return {
        "bybit.orderbook": ((symbol != "") & depth.isNotNull(), {
            "symbol": symbol, "depth": depth, "kind": F.when((kind != "delta") | (update == 1), "orderbook_snapshot").otherwise("orderbook_delta"), "exchange_system_ts_ns": sent,
            "exchange_engine_ts_ns": ns(F.col("cts")), "bids": levels(at("d", "b")), "asks": levels(at("d", "a")), "update_id": update, "first_update_id": F.lit(0),
            "cross_sequence": whole(at("d", "seq")), "restart_snapshot": update == 1,
        }),
        "bybit.publicTrade": (told, {
            "symbol": symbol, "kind": F.lit("public_trade"), "exchange_system_ts_ns": sent, "exchange_ts_ns": own, "trade_id": F.coalesce(at("d", "i"), F.lit("")),
            "price": number(at("d", "p")), "qty": number(at("d", "v")), "side": at("d", "S"),
        }),
        "bybit.tickers": (_symbol(at("d", "symbol")) != "", {
            "symbol": _symbol(at("d", "symbol")), "kind": F.lit("ticker"), "exchange_system_ts_ns": sent, "message_type": kind, "cross_sequence": whole(F.col("cs")), "values": ticker_values("d", BYBIT_TICKER),
        }),
        "bybit.allLiquidation": (told, {
            "symbol": symbol, "kind": F.lit("liquidation"), "exchange_system_ts_ns": sent, "exchange_ts_ns": ns(at("d", "T")), "position_side": at("d", "S"), "qty": number(at("d", "v")),
            "bankruptcy_price": number(at("d", "p")),
        }),
        "bybit.kline": (F.size(topic) == 3, {
            "symbol": F.upper(F.get(topic, F.lit(2))), "kind": F.lit("kline"), "interval": F.coalesce(F.try_element_at(names, topic[1]), topic[1]), "exchange_system_ts_ns": sent,
            "start_ms": whole(at("d", "start")), "end_ms": whole(at("d", "end")), **{n: number(at("d", n)) for n in ("open", "high", "low", "close", "volume", "turnover")},
            "confirmed": F.coalesce(at("d", "confirm") == "true", F.lit(False)),
        }),
    }


def binance_fields() -> dict[str, tuple[Column, dict[str, Column]]]:
    """As ``bybit_fields``. Diff books have the depth of ``DIFF_DEPTH``."""
    tail, symbol = F.col("tail"), _symbol(at("d", "s"))
    named = symbol != ""
    sent = {"exchange_system_ts_ns": ns(at("d", "E"))}
    both = sent | {"exchange_engine_ts_ns": ns(at("d", "T"))}
    diff = tail == "depth@100ms"
    depth = F.when(diff, DIFF_DEPTH).otherwise(F.regexp_extract("tail", "^depth([0-9]+)", 1).try_cast("int"))
    price, qty = number_or_null(at("d", "p")), number_or_null(at("d", "q"))
    own = F.when(whole(at("d", "T")) != 0, ns(at("d", "T"))).otherwise(ns(at("d", "E")))
    closed = F.when(F.upper(at("o", "S")) == "SELL", "Buy").when(F.upper(at("o", "S")) == "BUY", "Sell")
    lost, at_price = number_or_null(at("o", "q")), number_or_null(at("o", "p"))
    ticker = {"symbol": symbol, "kind": F.lit("ticker"), **sent, "message_type": F.lit("delta")}
    prices = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v", "turnover": "q"}
    return {
        "binance.forceOrder": ((_symbol(at("o", "s")) != "") & closed.isNotNull() & lost.isNotNull() & at_price.isNotNull(), {
            "symbol": _symbol(at("o", "s")), "kind": F.lit("liquidation"), **sent, "exchange_ts_ns": ns(at("o", "T")), "position_side": closed, "qty": lost, "bankruptcy_price": at_price,
        }),
        "binance.top": (named, {
            "symbol": symbol, "depth": F.lit(1), "kind": F.lit("orderbook_snapshot"), **both, "bids": one_level(at("d", "b"), at("d", "B")), "asks": one_level(at("d", "a"), at("d", "A")),
            "update_id": whole(at("d", "u")),
        }),
        "binance.depth": (named & depth.isNotNull(), {
            "symbol": symbol, "depth": depth, "kind": F.when(diff, "orderbook_delta").otherwise("orderbook_snapshot"), **both, "bids": levels(at("d", "b")), "asks": levels(at("d", "a")),
            "update_id": whole(at("d", "u")), "previous_update_id": whole(at("d", "pu")), "first_update_id": whole(at("d", "U")),
        }),
        "binance.trade": (named & (at("d", "X").isNull() | at("d", "X").isin(*BINANCE_PRINTS)) & price.isNotNull() & qty.isNotNull(), {
            "symbol": symbol, "kind": F.lit("public_trade"), **sent, "exchange_ts_ns": own, "trade_id": F.coalesce(at("d", "t"), F.lit("")), "price": price, "qty": qty,
            "side": F.when(at("d", "m") == "true", "Sell").otherwise("Buy"),
        }),
        "binance.mark": (named, ticker | {"values": ticker_values("d", BINANCE_MARK)}),
        "binance.day": (named, ticker | {"values": ticker_values("d", BINANCE_DAY, percent=True)}),
        "binance.kline": (named & F.col("o").isNotNull(), {
            "symbol": symbol, "kind": F.lit("kline"), "interval": F.coalesce(at("o", "i"), F.substring("tail", 7, 9)), **sent, "start_ms": whole(at("o", "t")), "end_ms": whole(at("o", "T")),
            **{n: number(at("o", v)) for n, v in prices.items()}, "confirmed": F.coalesce(at("o", "x") == "true", F.lit(False)),
        }),
    }


def normalized(frames: DataFrame) -> DataFrame:
    """Tape rows of both venues' frames in one pass over them; other frames and entries give nothing.

    Of each column only the expression of the frame's own kind is evaluated.
    """
    fields = bybit_fields() | binance_fields()

    def chosen(by_kind: dict[str, Column]) -> Column:
        out = F
        for what, value in by_kind.items():
            out = out.when(F.col("what") == what, value)
        return out

    rows = entries(frames).filter(chosen({what: keep for what, (keep, _) in fields.items()}))
    names = dict.fromkeys(n for _, columns in fields.values() for n in columns)
    columns = {n: chosen({what: columns[n] for what, (_, columns) in fields.items() if n in columns}) for n in names}
    return widened(rows.select(*KEYS, *(c.alias(n) for n, c in columns.items())), "seq")


def bybit(frames: DataFrame) -> DataFrame:
    """Rows of one venue's frames: books, trades, tickers, liquidations and klines, told by their topic."""
    return normalized(frames.filter("venue = 'bybit'"))


def binance(frames: DataFrame) -> DataFrame:
    """Rows of the other venue's: top of book, partial and diff books, trades, tickers, liquidations and klines, told by their stream."""
    return normalized(frames.filter("venue = 'binance'"))


def mark_diffs(rows: DataFrame, resets: DataFrame | None = None) -> DataFrame:
    """``sequence_gap`` of diff rows: the last id is unknown, or isn't the one the diff names.

    ``resets``: (venue, symbol, local_receive_ts_ns) at which a stream was subscribed anew, which forgets the last id.
    """
    w = Window.partitionBy("venue", "symbol").orderBy("local_receive_ts_ns", "seq")
    diffs = rows.withColumn("_id", F.col("update_id"))
    if resets is not None:
        diffs = diffs.unionByName(resets.select("venue", "symbol", "local_receive_ts_ns", F.lit(-1).cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("_id")), allowMissingColumns=True)
    before = F.lag("_id").over(w)
    marked = diffs.withColumn("sequence_gap", ~F.coalesce(F.col("previous_update_id") == before, F.lit(False)))
    return marked.filter("seq >= 0").drop("_id")


def open_interest_rows(polls: DataFrame, tickers: DataFrame) -> DataFrame:
    """Poll answers (symbol, local_receive_ts_ns, seq, open_interest) as ticker rows; the value needs the last mark price, if known."""
    from ticklake.operators.universe import as_of, live_state

    both = as_of(polls, live_state(tickers), ["price"], "local_receive_ts_ns")
    oi = F.map_from_arrays(F.array(F.lit("open_interest")), F.array("open_interest"))
    worth = F.map_from_arrays(F.array(F.lit("open_interest_value")), F.array(F.col("open_interest") * F.col("then_price")))
    values = F.when(F.col("then_price").isNull(), oi).otherwise(F.map_concat(oi, worth))
    return both.select("symbol", "local_receive_ts_ns", "seq", F.lit("ticker").alias("kind"), F.lit("poll").alias("message_type"), values.alias("values"))


# ------------------------------------------------------------------ REST lists
def history_rows(answers: DataFrame, kind: str, stamp: str, fields: dict[str, str], column: str, after: DataFrame | None = None) -> DataFrame:
    """Rows of a REST history: (venue, symbol, recv_ns, payload) with a JSON list of objects.

    ``fields``: tape column by venue name; entries with a missing or bad number are
    skipped. ``after``: (symbol, seen_ms), above which stamps count.
    """
    rows = answers.select("venue", "symbol", F.col("recv_ns").alias("local_receive_ts_ns"), F.posexplode(F.from_json("payload", LIST)).alias("seq", "d"))
    rows = rows.withColumn(column, at("d", stamp).try_cast("bigint")).withColumns({c: number_or_null(at("d", v)) for v, c in fields.items()})
    rows = rows.filter(F.col(column).isNotNull())
    for c in fields.values():
        rows = rows.filter(finite(c))
    if after is not None:
        rows = rows.join(after, "symbol", "left").filter(F.col(column) > F.coalesce("seen_ms", F.lit(-1))).drop("seen_ms")
    return rows.withColumn("kind", F.lit(kind)).drop("d")


#: Fixed values: (kind, stamp, fields, column) of each REST history by venue and feed; the second venue's statistics are stored under one period.
RATIOS = {"longAccount": "buy_ratio", "shortAccount": "sell_ratio"}
HISTORIES = {
    ("bybit", "funding"): ("funding_settlement", "fundingRateTimestamp", {"fundingRate": "funding_rate"}, "funding_time_ms"),
    ("bybit", "account_ratio"): ("account_ratio", "timestamp", {"buyRatio": "buy_ratio", "sellRatio": "sell_ratio"}, "ts_ms"),
    ("binance", "funding"): ("funding_settlement", "fundingTime", {"fundingRate": "funding_rate"}, "funding_time_ms"),
    ("binance", "account_ratio"): ("account_ratio", "timestamp", RATIOS, "ts_ms"),
    ("binance", "top_account_ratio"): ("top_account_ratio", "timestamp", RATIOS, "ts_ms"),
    ("binance", "top_position_ratio"): ("top_position_ratio", "timestamp", RATIOS, "ts_ms"),
    ("binance", "taker_volume"): ("taker_volume", "timestamp", {"buyVol": "buy_volume", "sellVol": "sell_volume"}, "ts_ms"),
}
STORED_PERIOD = "5min"


def histories(answers: DataFrame, venue: str, feed: str, after: DataFrame | None = None, period: str | None = None) -> DataFrame:
    """Tape rows of one venue's REST history, by ``history_rows``; ratios and taker volumes carry their period."""
    kind, stamp, fields, column = HISTORIES[venue, feed]
    rows = history_rows(answers.filter(F.col("venue") == venue), kind, stamp, fields, column, after)
    if feed != "funding":
        rows = rows.withColumn("period", F.lit(STORED_PERIOD if venue == "binance" else period))
    return widened(rows, "seq")


def table_numbers(table: DataFrame, venue: str) -> tuple[DataFrame, DataFrame]:
    """Turnovers (symbol, turnover_24h) and funding rates (symbol, funding_rate) that a venue's ticker table tells.

    ``table``: a map of text ``row`` for each symbol. The first venue's missing or
    blank turnover counts as 0, the second's says nothing; unreadable numbers say nothing.
    """
    turnover, rate = {"bybit": ("turnover24h", "fundingRate"), "binance": ("quoteVolume", "lastFundingRate")}[venue]
    rows = table.select(_symbol(at("row", "symbol")).alias("symbol"), F.nullif(at("row", turnover), F.lit("")).alias("turnover"), number_or_null(at("row", rate)).alias("funding_rate")).filter("symbol <> ''")
    value = F.col("turnover").try_cast("double")
    value = F.when(F.col("turnover").isNull(), 0.0).otherwise(value) if venue == "bybit" else value
    turnovers = rows.select("symbol", value.alias("turnover_24h")).filter("turnover_24h is not null")
    return turnovers, rows.select("symbol", "funding_rate").filter("funding_rate is not null")


def depth_answers(answers: DataFrame) -> DataFrame:
    """REST depth answers as snapshot rows; the update id is the answer's last."""
    rows = answers.withColumn("d", F.from_json("payload", OBJECT))
    return rows.select("venue", "symbol", F.col("recv_ns").alias("local_receive_ts_ns"), F.lit("orderbook_snapshot").alias("kind"), F.lit(DIFF_DEPTH).alias("depth"), ns(at("d", "E")).alias("exchange_system_ts_ns"),
                       ns(at("d", "T")).alias("exchange_engine_ts_ns"), levels(at("d", "bids")).alias("bids"), levels(at("d", "asks")).alias("asks"), whole(at("d", "lastUpdateId")).alias("update_id"))


def catch_up(seen: str, now: str, step: str, limit: str, most: str) -> Column:
    """How many entries to ask for: what has come since, within limits."""
    return F.least(F.greatest(F.col(limit), F.expr(f"({now} - {seen}) div {step}") + 1), F.col(most))


def merge_tickers(*tables: DataFrame) -> DataFrame:
    """One row for each symbol of several venue tables; a later table's non-null field wins."""
    out = tables[0]
    for more in tables[1:]:
        shared = [c for c in more.columns if c in out.columns and c != "symbol"]
        right = more.withColumnsRenamed({c: f"_{c}" for c in shared})
        out = out.join(right, "symbol", "full").withColumns({c: F.coalesce(f"_{c}", c) for c in shared}).drop(*(f"_{c}" for c in shared))
    return out


def incremental(history: DataFrame, written: DataFrame, stamp: str, newest_only: bool = False) -> DataFrame:
    """Rows above the last stamp written of their (kind, symbol); a first pull may keep the newest only."""
    seen = written.groupBy("kind", "symbol").agg(F.max(stamp).alias("_seen"))
    rows = history.join(seen, ["kind", "symbol"], "left").filter(F.col("_seen").isNull() | (F.col(stamp) > F.col("_seen")))
    if newest_only:
        newest = Window.partitionBy("kind", "symbol").orderBy(F.desc(stamp))
        rows = rows.withColumn("_n", F.row_number().over(newest)).filter("_seen is not null or _n = 1").drop("_n")
    return rows.drop("_seen")


# ------------------------------------------------------------- listed symbols
def listed_bybit(instruments: DataFrame, quote: str) -> DataFrame:
    keep = (F.col("status") == "Trading") & (F.col("contractType") == "LinearPerpetual") & (F.col("quoteCoin") == quote) & (F.col("settleCoin") == quote)
    return instruments.filter(keep & F.coalesce("symbolType", F.lit("")).isin("", "innovation") & F.col("symbol").rlike("^[A-Za-z0-9]+$")).select("symbol").distinct()


def listed_binance(instruments: DataFrame, quote: str) -> DataFrame:
    keep = (F.col("status") == "TRADING") & (F.col("contractType") == "PERPETUAL") & (F.col("quoteAsset") == quote) & (F.col("marginAsset") == quote)
    return instruments.filter(keep & F.col("symbol").rlike("^[A-Za-z0-9]+$")).select("symbol").distinct()


def excluded_by_type(instruments: DataFrame, kind: str, allowed: tuple[str, ...]) -> DataFrame:
    """Instruments outside the domain, counted by type."""
    return instruments.filter(~F.coalesce(kind, F.lit("")).isin(*allowed)).groupBy(F.col(kind).alias("type")).agg(F.count("*").alias("n"))
