"""Fixed-interval bars of a tape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.operators.book import book_rows, spread_bp, tops, verdicts
from ticklake.operators.order import RECV, ord_

TICKER_COLUMNS = ("mark_price", "index_price", "funding_rate", "open_interest")
KEY = ("venue", "symbol", "bucket_start_ns")


def step_ns(seconds: float) -> int:
    step = round(seconds * 1e9)
    if step <= 0:
        raise ValueError("the interval must be above zero")
    return step


def bucket(step: int) -> F.Column:
    return F.col(RECV) - F.pmod(F.col(RECV), F.lit(step))


def flow_columns() -> dict[str, F.Column]:
    """Additive and OHLC columns: they roll up from finer bars and fold in a stream."""
    trade, liquidation = F.col("kind") == "public_trade", F.col("kind") == "liquidation"
    price, qty = F.when(trade, F.col("price")), F.when(trade, F.col("qty"))
    at = F.when(trade, ord_())
    zero = F.lit(0.0)
    return {
        "trades": F.count_if(trade),
        "volume": F.coalesce(F.sum(qty), zero),
        "buy_volume": F.coalesce(F.sum(F.when(F.col("side") == "Buy", qty)), zero),
        "sell_volume": F.coalesce(F.sum(F.when(F.coalesce(F.col("side") != "Buy", F.lit(True)), qty)), zero),
        "notional": F.coalesce(F.sum(price * qty), zero),
        "open": F.min_by(price, at),
        "high": F.max(price),
        "low": F.min(price),
        "close": F.max_by(price, at),
        "book_updates": F.count_if(F.col("kind").isin("orderbook_snapshot", "orderbook_delta")),
        "liquidations": F.count_if(liquidation),
        "liquidation_qty": F.coalesce(F.sum(F.when(liquidation, F.col("qty"))), zero),
    }


def ticker_columns() -> dict[str, F.Column]:
    """The last value pushed in the bar, never carried over."""
    out = {}
    for name in TICKER_COLUMNS:
        value = F.when(F.col("kind") == "ticker", F.try_element_at("values", F.lit(name)))
        out[name] = F.max_by(value, F.when(value.isNotNull(), ord_()))
    return out


def top_columns(top: DataFrame, step: int) -> DataFrame:
    """Best bid and ask of each bar: the last ones of depth 1, else of any deeper book, each side by itself."""
    rows = top.withColumn("bucket_start_ns", bucket(step))
    columns = []
    for side in ("best_bid", "best_ask"):
        own = [F.max_by(side, F.when(F.col(side).isNotNull() & test, ord_())) for test in (F.col("depth") == 1, F.col("depth") != 1)]
        columns.append(F.coalesce(*own).alias(side))
    return rows.groupBy(*KEY).agg(*columns)


def build_bars(tape: DataFrame, seconds: float = 60.0, with_book: bool = True) -> DataFrame:
    """The 24 columns of each (venue, symbol, bucket) that has a row of any kind.

    One partial-aggregated pass over the rows, joined with the tops of the books;
    without book rows (``with_book=False``) there is no join.
    """
    step = step_ns(seconds)
    rows = tape.withColumn("bucket_start_ns", bucket(step))
    aggregates = flow_columns() | ticker_columns()
    bars = rows.groupBy(*KEY).agg(*(c.alias(n) for n, c in aggregates.items()))
    if with_book:
        bars = bars.join(top_columns(tops(verdicts(book_rows(tape))), step), list(KEY), "left")
    else:
        bars = bars.withColumns({"best_bid": F.lit(None).cast("double"), "best_ask": F.lit(None).cast("double")})
    return bars.select(
        *KEY, "trades", "volume", "buy_volume", "sell_volume", "notional", "open", "high", "low", "close",
        F.when(F.col("volume") > 0, F.col("notional") / F.col("volume")).alias("vwap"), "best_bid", "best_ask",
        ((F.col("best_bid") + F.col("best_ask")) / 2).alias("mid"), spread_bp("best_bid", "best_ask").alias("spread_bp"),
        "book_updates", *TICKER_COLUMNS, "liquidations", "liquidation_qty",
    )


def roll_up(bars: DataFrame, seconds: float) -> DataFrame:
    """Coarser bars from finer ones: additive and OHLC columns only."""
    step = step_ns(seconds)
    start = F.col("bucket_start_ns")
    rows = bars.withColumn("_to", start - F.pmod(start, F.lit(step)))
    sums = [F.sum(c).alias(c) for c in ("trades", "volume", "buy_volume", "sell_volume", "notional", "book_updates", "liquidations", "liquidation_qty")]
    traded = F.when(F.col("trades") > 0, start)
    out = rows.groupBy("venue", "symbol", "_to").agg(*sums, F.min_by("open", traded).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", traded).alias("close"))
    return out.withColumnRenamed("_to", "bucket_start_ns").withColumn("vwap", F.when(F.col("volume") > 0, F.col("notional") / F.col("volume")))
