"""Bars of a live tape: late rows clamped, books held, and a bar closed by the next one or by silence."""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import namedtuple
from collections.abc import Iterator
from operator import attrgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ticklake.operators.bars import TICKER_COLUMNS, step_ns
from ticklake.operators.book import HELD, RECENT, is_diff_stream, takes, whole_at
from ticklake.operators.order import RECV
from ticklake.schema import level_numbers
from ticklake.streaming.state import lane

BAR = (
    "venue string, symbol string, bucket_start_ns bigint, trades bigint, volume double, buy_volume double, sell_volume double, notional double, open double, high double, low double, close double, "
    "vwap double, best_bid double, best_ask double, mid double, spread_bp double, book_updates bigint, mark_price double, index_price double, funding_rate double, open_interest double, "
    "liquidations bigint, liquidation_qty double"
)
BAR_COLUMNS = [c.split()[0] for c in BAR.split(", ")]


class LiveBook:
    """One book between micro-batches: its levels, and for a diff stream the diffs that a snapshot may still need."""

    def __init__(self, diff_stream: bool):
        self.diff_stream = diff_stream
        self.sides: tuple[dict, dict] = ({}, {})
        self.whole, self.last_id = False, None
        self.base: dict | None = None
        self.log: list[tuple] = []  # kept diffs: id, place, first id, run, levels
        self.seen = self.run = 0

    def _set(self, levels: tuple, fresh: bool = False) -> None:
        for side, changes in zip(self.sides, levels, strict=True):
            if fresh:
                side.clear()
            for price, size in changes:
                if size > 0:
                    side[price] = size
                else:
                    side.pop(price, None)

    def take(self, row, levels: tuple) -> bool:
        """Whether the book after this row is the venue's; the rules are those of ``book.chain`` and ``book.diff_chain``."""
        snapshot = row.kind == "orderbook_snapshot"
        if self.diff_stream:
            return self._snapshot(row, levels) if snapshot else self._diff(row, levels)
        follows = self.last_id is not None and row.update_id is not None and row.update_id == self.last_id + 1
        self.whole = snapshot or (self.whole and follows and not row.sequence_gap)
        self.last_id = row.update_id
        if self.whole:
            self._set(levels, fresh=snapshot)
        return self.whole

    def _diff(self, row, levels: tuple) -> bool:
        place, base = self.seen, self.base
        broken = bool(row.sequence_gap) or self.last_id is None or row.previous_update_id != self.last_id
        self.seen, self.run, self.last_id = place + 1, self.run + broken, row.update_id
        self.log.append((row.update_id, place, row.first_update_id, self.run, levels))
        if base is not None:
            if base["anchor"] is None:
                if row.update_id >= base["id"]:
                    base.update(anchor=place, fits=row.first_update_id <= base["id"])
            elif broken and base["last"] is None and place > base["anchor"]:
                base["last"] = place - 1
        self.whole = base is not None and whole_at(base, self.seen)
        if self.whole and base["anchor"] is not None and place >= base["anchor"]:
            self._set(levels)
        del self.log[: -RECENT if self.whole else -HELD]
        return self.whole

    def _snapshot(self, row, levels: tuple) -> bool:
        at = bisect_left(self.log, row.update_id, key=lambda d: d[0])
        shot = {"id": row.update_id, "arrived": self.seen, "anchor": None, "fits": False, "last": None}
        chained = self.log[at:]
        if chained:
            run = chained[0][3]
            chained = [d for d in chained if d[3] == run]
            ended = chained[-1][1] + 1 < self.seen
            shot.update(anchor=chained[0][1], fits=chained[0][2] <= row.update_id, last=chained[-1][1] if ended else None)
        if takes(self.base, shot):
            self.base = shot
            self._set(levels, fresh=True)
            for d in chained if shot["fits"] else ():
                self._set(d[4])
        self.whole = whole_at(self.base, self.seen)
        return self.whole

    def best(self) -> tuple[float | None, float | None]:
        bids, asks = self.sides
        return max(bids, default=None), min(asks, default=None)


class OpenBar:
    """The columns of ``bars.build_bars`` while their interval lasts."""

    def __init__(self, start: int):
        self.start = start
        self.trades = self.book_updates = self.liquidations = 0
        self.volume = self.buy_volume = self.sell_volume = self.notional = self.liquidation_qty = 0.0
        self.open = self.high = self.low = self.close = None
        self.said: dict[str, float] = {}
        self.top: dict[tuple[bool, int], float] = {}  # (of depth 1, side): the last price

    def add(self, row, tops: tuple | None) -> None:
        if row.kind == "public_trade":
            self.trades += 1
            price, qty = row.price, row.qty
            if qty is not None:
                self.volume += qty
                if row.side == "Buy":
                    self.buy_volume += qty
                else:
                    self.sell_volume += qty
                if price is not None:
                    self.notional += price * qty
            if price is not None:
                self.high = price if self.high is None else max(self.high, price)
                self.low = price if self.low is None else min(self.low, price)
            if self.trades == 1:
                self.open = price
            self.close = price
        elif row.kind == "liquidation":
            self.liquidations += 1
            self.liquidation_qty += row.qty or 0.0
        elif row.kind == "ticker":
            self.said.update((n, v) for n in TICKER_COLUMNS if (v := getattr(row, n)) is not None)
        elif row.kind in ("orderbook_snapshot", "orderbook_delta"):
            self.book_updates += 1
            for side, price in enumerate(tops or ()):
                if price is not None:
                    self.top[row.depth == 1, side] = price

    def columns(self) -> tuple:
        bid, ask = (self.top.get((True, side), self.top.get((False, side))) for side in (0, 1))
        mid = None if bid is None or ask is None else (bid + ask) / 2
        spread = (ask - bid) / mid * 1e4 if mid else None
        vwap = self.notional / self.volume if self.volume > 0 else None
        return (
            self.start, self.trades, self.volume, self.buy_volume, self.sell_volume, self.notional, self.open, self.high, self.low, self.close, vwap, bid, ask, mid, spread,
            self.book_updates, *(self.said.get(n) for n in TICKER_COLUMNS), self.liquidations, self.liquidation_qty,
        )


class Symbol:
    """What one symbol keeps between micro-batches."""

    def __init__(self):
        self.stamp = -(2**62)  # the largest stamp so far; later arrivals are clamped to it
        self.bar: OpenBar | None = None
        self.books: dict[int, LiveBook] = {}
        self.heard = 0  # processing time (ms) of the last row

    def take(self, row, step: int) -> OpenBar | None:
        """Take one row; the bar that it closes, if any."""
        self.stamp = max(self.stamp, getattr(row, RECV))
        start = self.stamp - self.stamp % step
        closed = None
        if self.bar is None or self.bar.start != start:
            closed, self.bar = self.bar, OpenBar(start)
        tops = None
        if row.depth is not None and row.kind in ("orderbook_snapshot", "orderbook_delta"):
            book = self.books.setdefault(row.depth, LiveBook(row.diff_stream))
            levels = tuple([] if side is None else list(zip((flat := side.tolist())[::2], flat[1::2], strict=True)) for side in (row.bids, row.asks))
            tops = book.best() if book.take(row, levels) else None
        self.bar.add(row, tops)
        return closed

    def silent(self, step: int) -> OpenBar | None:
        """Close the open bar; what still comes for its interval counts in the next one."""
        closed, self.bar = self.bar, None
        if closed is not None:
            self.stamp = max(self.stamp, closed.start + step)
        return closed


def in_order(parts: Iterator[pd.DataFrame]) -> list[tuple]:
    """A lane's rows by ``seq`` as named tuples of plain values, null for what is missing."""
    rows, kind = [], None
    for part in parts:
        kind = kind or namedtuple("Row", part.columns)
        columns = [part[c] for c in part.columns]
        values = [[None if v != v else v for v in c.tolist()] if c.dtype.kind == "f" else c.tolist() for c in columns]
        rows.extend(map(kind._make, zip(*values, strict=True)))
    return sorted(rows, key=attrgetter("seq"))


def stream_bars(tape: DataFrame, seconds: float = 60.0, idle: str | None = "10 minutes") -> DataFrame:
    """The 24 columns of ``bars.build_bars`` of the clamped tape, each bar once it is closed.

    A symbol's rows are taken in arrival order (``seq``; a later micro-batch
    holds later arrivals). A row behind an earlier one takes that one's stamp, as
    ``order.clamp_late`` does, so no row is late for a watermark and none is
    dropped. A bar closes at the symbol's first row beyond it; a symbol that is
    silent for ``idle`` of processing time closes its bar by a timer, and rows of
    that interval that still come count in the next bar. Without ``idle`` there is
    no timer; with it the query runs until it is stopped, as Spark then starts
    batches without input. Symbols share the states of ``state.lane``. Books are part of a symbol's state: their levels, and at most HELD diffs while a diff stream
    waits for its snapshot.
    """
    step = step_ns(seconds)
    wait_ms = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else None

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbols: dict[tuple, Symbol] = pickle.loads(state.get[0]) if state.exists else {}
        now, closed = state.getCurrentProcessingTimeMs() if wait_ms else 0, []
        for row in () if state.hasTimedOut else in_order(parts):
            symbol = symbols.get((row.venue, row.symbol))
            if symbol is None:
                symbol = symbols[row.venue, row.symbol] = Symbol()
            bar, symbol.heard = symbol.take(row, step), now
            if bar is not None:
                closed.append((row.venue, row.symbol, *bar.columns()))
        if wait_ms:
            for name, symbol in symbols.items():
                if symbol.bar is not None and symbol.heard + wait_ms <= now:
                    closed.append((*name, *symbol.silent(step).columns()))
            waiting = [symbol.heard for symbol in symbols.values() if symbol.bar is not None]
            if waiting:
                state.setTimeoutDuration(min(waiting) + wait_ms - now)
        state.update((pickle.dumps(symbols),))
        if closed:
            yield pd.DataFrame(closed, columns=BAR_COLUMNS)

    def flat(side: str) -> F.Column:
        """Price and size of each whole level in turn."""
        whole = F.filter(level_numbers(side), lambda x: x["price"].isNotNull() & x["size"].isNotNull())
        return F.flatten(F.transform(whole, lambda x: F.array(x["price"], x["size"]))).alias(side)

    named = [F.try_element_at("values", F.lit(n)).alias(n) for n in TICKER_COLUMNS]
    ids = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("update_id", "previous_update_id", "first_update_id")]
    rows = tape.select(
        "venue", "symbol", "seq", RECV, "kind", "price", "qty", "side", "depth", F.coalesce("sequence_gap", F.lit(False)).alias("sequence_gap"),
        *ids, F.coalesce(is_diff_stream(), F.lit(False)).alias("diff_stream"), flat("bids"), flat("asks"), *named,
    )
    return rows.withColumn("lane", lane()).groupBy("lane").applyInPandasWithState(run, BAR, "symbols binary", "append", GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout)
