"""The tape's row contract: one wide nullable row with a ``kind`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values of the row contract -------------------------------------
KINDS = (
    "orderbook_snapshot", "orderbook_delta", "public_trade", "ticker", "liquidation", "kline",
    "funding_settlement", "account_ratio", "top_account_ratio", "top_position_ratio", "taker_volume",
)
RATIO_KINDS = ("account_ratio", "top_account_ratio", "top_position_ratio")
LANE_KINDS = ("funding_settlement", *RATIO_KINDS, "taker_volume")
SIDES = ("Buy", "Sell")
TICKER_NAMES = (
    "last_price", "mark_price", "index_price", "open_interest", "open_interest_value", "funding_rate",
    "next_funding_time_ms", "bid_price", "bid_size", "ask_price", "ask_size", "turnover_24h", "volume_24h",
    "price_change_24h_pct", "prev_price_1h", "prev_price_24h", "high_price_24h", "low_price_24h",
)
# ---------------------------------------------------------------------------

NS_PER_HOUR = 3_600_000_000_000
NS_PER_DAY = 24 * NS_PER_HOUR
LEVELS = "array<array<string>>"

COMMON = "kind string, venue string, symbol string, local_receive_ts_ns bigint, local_receive_mono_ns bigint"
BOOK = (
    f"depth int, exchange_system_ts_ns bigint, exchange_engine_ts_ns bigint, bids {LEVELS}, asks {LEVELS}, update_id bigint, "
    "previous_update_id bigint, first_update_id bigint, cross_sequence bigint, previous_cross_sequence bigint, "
    "restart_snapshot boolean, sequence_gap boolean"
)
OTHERS = (
    "exchange_ts_ns bigint, trade_id string, price double, qty double, side string, message_type string, "
    "values map<string,double>, position_side string, bankruptcy_price double, interval string, start_ms bigint, end_ms bigint, "
    "open double, high double, low double, close double, volume double, turnover double, confirmed boolean, "
    "funding_time_ms bigint, funding_rate double, period string, ts_ms bigint, buy_ratio double, sell_ratio double, "
    "buy_volume double, sell_volume double"
)
#: The wide row as it lies on disk.
TAPE = f"{COMMON}, {BOOK}, {OTHERS}"


def tape_columns() -> list[tuple[str, str]]:
    from pyspark.sql.types import StructType

    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(TAPE).fields]


def widened(rows: DataFrame, *more: str) -> DataFrame:
    """``rows`` with every column of the wide row, absent ones null, and the columns ``more``."""
    have = set(rows.columns)
    columns = [F.col(f"`{n}`").cast(t).alias(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in tape_columns()]
    return rows.select(*columns, *more)


def feed() -> Column:
    """The feed that a row belongs to, as a tier names it; empty for other kinds."""
    kind = F.col("kind")
    return (
        F.when(kind.isin("orderbook_snapshot", "orderbook_delta"), F.concat(F.lit("book:"), F.col("depth").cast("string")))
        .when(kind == "public_trade", "trades")
        .when(kind == "ticker", "ticker")
        .when(kind == "liquidation", "liquidations")
        .when(kind == "kline", F.concat(F.lit("kline:"), F.col("interval")))
        .when(kind == "funding_settlement", "funding")
        .when(kind.isin(*RATIO_KINDS, "taker_volume"), kind)
        .otherwise("")
    )


def finite(c: str) -> Column:
    """Not null, NaN or infinite."""
    x = F.col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def level_numbers(c: str) -> Column:
    """``[[price, size], ...]`` text as structs of doubles."""
    return F.transform(F.col(c), lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("size")))


def reject_reason() -> Column:
    """Why a row breaks the contract, or null: unknown kind, missing key, bad number, side, ticker name or level."""
    kind = F.col("kind")
    needs = {
        "public_trade": ("price", "qty"),
        "liquidation": ("qty", "bankruptcy_price"),
        "kline": ("open", "high", "low", "close", "volume", "turnover"),
        "funding_settlement": ("funding_rate",),
        "taker_volume": ("buy_volume", "sell_volume"),
        **{k: ("buy_ratio", "sell_ratio") for k in RATIO_KINDS},
    }
    bad_number = F.lit(False)
    for k, names in needs.items():
        for n in names:
            bad_number = bad_number | ((kind == k) & ~finite(n))
    stamp = {"kline": "start_ms", "funding_settlement": "funding_time_ms", "taker_volume": "ts_ms", **{k: "ts_ms" for k in RATIO_KINDS}}
    no_stamp = F.lit(False)
    for k, n in stamp.items():
        no_stamp = no_stamp | ((kind == k) & F.col(n).isNull())

    def bad_levels(c: str) -> Column:
        return F.exists(
            F.coalesce(F.col(c), F.array().cast(LEVELS)),
            lambda x: (F.size(x) != 2) | F.get(x, F.lit(0)).try_cast("double").isNull() | F.get(x, F.lit(1)).try_cast("double").isNull(),
        )

    names = F.coalesce(F.map_keys("values"), F.array().cast("array<string>"))
    allowed = F.array(*(F.lit(n) for n in TICKER_NAMES))
    numbers = F.coalesce(F.map_values("values"), F.array().cast("array<double>"))
    book = kind.isin("orderbook_snapshot", "orderbook_delta")
    return (
        F.when(kind.isNull() | ~kind.isin(*KINDS), "unknown kind")
        .when(F.coalesce("venue", F.lit("")) == "", "no venue")
        .when(F.coalesce("symbol", F.lit("")) == "", "no symbol")
        .when(F.col("local_receive_ts_ns").isNull(), "no receive stamp")
        .when(bad_number, "bad number")
        .when(no_stamp, "no stamp")
        .when((kind == "public_trade") & ~F.coalesce(F.col("side").isin(*SIDES), F.lit(False)), "bad side")
        .when((kind == "liquidation") & ~F.coalesce(F.col("position_side").isin(*SIDES), F.lit(False)), "bad side")
        .when((kind == "ticker") & (F.size(F.array_except(names, allowed)) > 0), "unknown ticker name")
        .when((kind == "ticker") & F.exists(numbers, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), "bad number")
        .when(book & (F.col("depth").isNull() | bad_levels("bids") | bad_levels("asks")), "bad level")
    )


def validated(tape: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that follow the contract, and the others with their ``reason``: together all rows of the input."""
    judged = tape.withColumn("reason", reject_reason())
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def kind_view(tape: DataFrame, *kinds: str) -> DataFrame:
    """The rows of some kinds; the filter reaches the Parquet scan."""
    return tape.filter(F.col("kind").isin(*kinds))
