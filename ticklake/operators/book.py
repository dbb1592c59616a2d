"""Order books: chain verdicts, levels at a moment, shapes, and gaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.carry import carried, parted
from ticklake.operators.order import RECV, ord_
from ticklake.operators.universe import as_of
from ticklake.schema import NS_PER_HOUR, level_numbers
from ticklake.sources.normalize import DIFF_DEPTH
from ticklake.sources.scratch import stored

KEY = ("venue", "symbol", "depth")


def book_rows(tape: DataFrame) -> DataFrame:
    return tape.filter(F.col("kind").isin("orderbook_snapshot", "orderbook_delta")).withColumn("snapshot", F.col("kind") == "orderbook_snapshot")


def epochs(rows: DataFrame, more: dict[str, F.Column] | None = None) -> DataFrame:
    """Adds ``epoch``: how many snapshots the book has had up to the row, and the update id before it."""
    return carried(rows, KEY, before={"last_id": F.col("update_id")} | (more or {}), counts={"epoch": F.col("snapshot")})


def mark_gaps(rows: DataFrame) -> DataFrame:
    """Sequence marks of raw frames: previous ids, ``gap`` and the verdict apply, rebase, gap or before_snapshot.

    A delta gaps if its id isn't one above the last (positive) one, or if an
    earlier delta since the snapshot did. Before the first snapshot the topic
    counts as unhealthy once a delta has come.
    """
    rows = epochs(rows, {"_cross": F.col("cross_sequence")}).withColumn("previous_cross_sequence", F.coalesce("_cross", F.lit(0))).drop("_cross")
    broken = ~F.col("snapshot") & (F.coalesce("last_id", F.lit(0)) > 0) & (F.col("update_id") != F.col("last_id") + 1)
    rows = unbroken(rows, F.coalesce(broken, F.lit(False)))
    gap = ~F.col("unbroken")
    verdict = F.when(F.col("snapshot"), "rebase").when(F.col("epoch") == 0, "before_snapshot").when(gap, "gap").otherwise("apply")
    rows = rows.withColumn("sequence_gap", gap).withColumn("verdict", verdict)
    return rows.withColumn("previous_update_id", F.coalesce("last_id", F.lit(0))).drop("last_id", "unbroken")


def unbroken(rows: DataFrame, broken: F.Column) -> DataFrame:
    """Adds ``unbroken``: there is a snapshot up to the row, and no ``broken`` row since the last one. An epoch's rows needn't meet for it: the places of both are carried over hours."""
    rows = carried(rows.withColumn("_broken", broken), KEY, before={"_bad": F.when(F.col("_broken"), ord_()), "_shot": F.when(F.col("snapshot"), ord_())})
    kept = F.col("_shot").isNotNull() & (F.col("_bad").isNull() | (F.col("_bad") < F.col("_shot")))
    return rows.withColumn("unbroken", F.col("snapshot") | (~F.col("_broken") & kept)).drop("_broken", "_bad", "_shot")


#: What a diff-stream book stands on (null for other books).
BASE = "struct<taken:boolean,fits:boolean,anchor:bigint,last:bigint,arrived:bigint>"


def chain(rows: DataFrame) -> DataFrame:
    """Adds ``valid``: the book after this row is the venue's book.

    A snapshot makes it so; a delta keeps it so if it isn't flagged and its id is
    one above the last. Inside an unbroken epoch the row before is the last one
    applied, so windows alone decide.
    """
    rows = epochs(rows)
    broken = ~F.col("snapshot") & (F.coalesce("sequence_gap", F.lit(False)) | ~F.coalesce(F.col("update_id") == F.col("last_id") + 1, F.lit(False)))
    rows = unbroken(rows, broken).withColumnRenamed("unbroken", "valid").drop("last_id")
    return rows.withColumns({"used": F.col("snapshot"), **{n: F.lit(None).cast(t) for n, t in (("diffs", "bigint"), ("at", "bigint"), ("base", BASE))}})


def level_changes(applied: DataFrame) -> DataFrame:
    """A row for each level of each row of ``applied_rows``: side, price, size, in the order of ``seq``, ``sub`` and ``pos``."""
    parts = []
    for side, column in (("bid", "bids"), ("ask", "asks")):
        parts.append(applied.select(*KEY, "epoch", RECV, "seq", "sub", F.lit(side).alias("side"), F.posexplode(level_numbers(column)).alias("pos", "level")))
    return parts[0].unionByName(parts[1]).select("*", "level.price", "level.size").drop("level")


def books_at(judged: DataFrame, moments: DataFrame) -> DataFrame:
    """Levels of every book at every moment ``(symbol, at_ns)``: symbol, depth, at_ns, side, price, size.

    ``judged``: rows of ``verdicts``. A moment meets the last row of its book by
    one as-of step; if the book was the venue's then, the last size of each price
    in that row's epoch counts if it is above zero.
    """
    books = judged.select(*KEY).distinct()
    asked = moments.join(books, "symbol").withColumn("book", F.concat_ws("\x1f", *KEY))
    states = judged.select(F.concat_ws("\x1f", *KEY).alias("book"), RECV, F.struct("seq", F.struct("valid", "epoch").alias("s")).alias("state"))
    states = states.groupBy("book", RECV).agg(F.max("state").alias("state"))  # several rows of one stamp: the last
    begun = as_of(asked, states, ["state"], "at_ns", key="book").filter("then_state.s.valid").select(*KEY, "at_ns", F.col("then_state.s.epoch").alias("epoch"))
    changes = level_changes(applied_rows(judged)).join(begun, [*KEY, "epoch"]).filter(F.col(RECV) <= F.col("at_ns"))
    last = changes.groupBy(*KEY, "at_ns", "side", "price").agg(F.max_by("size", F.struct(RECV, "seq", "sub", "pos")).alias("size"))
    return last.filter("size > 0")


def shapes(levels: DataFrame, bp: float = 10.0, n: int = 3, key=(*KEY, "at_ns")) -> DataFrame:
    """Best prices and sizes, mid, spread in basis points, depth within ``bp`` of mid and the ``n`` best levels of each book."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    best = levels.groupBy(*key).agg(
        F.max(F.when(bid, F.col("price"))).alias("best_bid"), F.min(F.when(ask, F.col("price"))).alias("best_ask"),
        F.max_by(F.when(bid, F.col("size")), F.when(bid, F.col("price"))).alias("bid_size"),
        F.min_by(F.when(ask, F.col("size")), F.when(ask, F.col("price"))).alias("ask_size"),
        F.array_sort(F.collect_list(F.when(bid, F.struct((-F.col("price")).alias("p"), F.col("size"))))).alias("b"),
        F.array_sort(F.collect_list(F.when(ask, F.struct(F.col("price").alias("p"), F.col("size"))))).alias("a"),
    )
    mid = (F.col("best_bid") + F.col("best_ask")) / 2

    def depth(side: str, inside) -> F.Column:
        worth = F.transform(F.filter(side, inside), lambda x: F.abs(x["p"]) * x["size"])
        return F.when(F.col("mid").isNull(), 0.0).otherwise(F.aggregate(worth, F.lit(0.0), lambda s, v: s + v))

    best = best.withColumn("mid", mid)
    low, high = F.col("mid") * (1 - bp / 1e4), F.col("mid") * (1 + bp / 1e4)
    return best.select(
        *key, "best_bid", "best_ask", "bid_size", "ask_size", "mid", spread_bp("best_bid", "best_ask").alias("spread_bp"),
        depth("b", lambda x: -x["p"] >= low).alias("bid_depth"), depth("a", lambda x: x["p"] <= high).alias("ask_depth"),
        F.transform(F.slice("b", 1, n), lambda x: F.struct((-x["p"]).alias("price"), x["size"].alias("size"))).alias("bids"),
        F.transform(F.slice("a", 1, n), lambda x: F.struct(x["p"].alias("price"), x["size"].alias("size"))).alias("asks"),
    )


def spread_bp(bid: str, ask: str) -> F.Column:
    mid = (F.col(bid) + F.col(ask)) / 2
    return F.when(mid != 0, (F.col(ask) - F.col(bid)) / mid * 1e4)


TOP = "venue string, symbol string, depth int, local_receive_ts_ns bigint, seq bigint, best_bid double, best_ask double, bid_size double, ask_size double"


#: Rows of a book after which a new stretch of hours begins, so that a long epoch splits.
STRETCH = 100_000


def stretches(steps: DataFrame) -> DataFrame:
    """Adds ``stretch``: whole hours of a book, of STRETCH rows and the rest of an hour at most."""
    rows = steps.withColumn("_hour", F.expr(f"{RECV} div {NS_PER_HOUR}"))
    past = Window.partitionBy(*KEY).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = rows.groupBy(*KEY, "_hour").agg(F.count("*").alias("_n"))
    hours = hours.withColumn("_past", F.coalesce(F.sum("_n").over(past), F.lit(0)))
    return rows.join(hours.select(*KEY, "_hour", F.expr(f"_past div {STRETCH}").alias("stretch")), [*KEY, "_hour"]).drop("_hour")


def openings(steps: DataFrame) -> DataFrame:
    """The levels with which each later stretch of an epoch starts, as one snapshot step: the last size of each price before it, where above zero.

    Only epochs of several stretches have any. A price's last sizes by stretch
    (sums of parts, so its changes don't meet) are spread over the stretches that
    they hold for.
    """
    held = steps.groupBy(*KEY, "epoch", "stretch").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*KEY, "epoch")
    held = held.select(*KEY, "epoch", "stretch", F.row_number().over(w.orderBy("stretch")).alias("_i"), F.count("*").over(w).alias("_of")).filter("_of > 1")
    rows = steps.join(held, [*KEY, "epoch", "stretch"])
    changes = None
    for side, column in (("bid", "bids"), ("ask", "asks")):
        part = rows.select(*KEY, "epoch", "_i", "_of", RECV, "seq", "sub", F.lit(side).alias("side"), F.posexplode(column).alias("pos", "level"))
        changes = part if changes is None else changes.unionByName(part)
    place = F.struct(RECV, "seq", "sub", "pos")
    last = changes.groupBy(*KEY, "epoch", "side", F.col("level.price").alias("price"), "_i", "_of").agg(F.max_by("level.size", place).alias("size"))
    then = F.lead("_i").over(Window.partitionBy(*KEY, "epoch", "side", "price").orderBy("_i"))
    live = last.withColumn("_to", F.coalesce(then, F.col("_of"))).filter("size > 0 and _i < _of")
    spread = live.select(*KEY, "epoch", "side", "price", "size", F.explode(F.sequence(F.col("_i") + 1, F.col("_to"))).alias("_i"))
    level = F.struct("price", "size")
    sides = [F.collect_list(F.when(F.col("side") == s, level)).alias(c) for s, c in (("bid", "bids"), ("ask", "asks"))]
    opened = spread.groupBy(*KEY, "epoch", "_i").agg(*sides)
    return held.filter("_i > 1").join(opened, [*KEY, "epoch", "_i"], "left")


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best prices and sizes after each row that ends a step; rows come sorted by book, epoch, stretch and order, and one book is held at a time."""
    key, sides, best = None, ({}, {}), [None, None]
    for batch in batches:
        out: list[list] = [[] for _ in range(9)]
        for r in batch.to_pylist():
            now = (r["venue"], r["symbol"], r["depth"], r["epoch"], r["stretch"])
            if now != key:
                key, sides, best = now, ({}, {}), [None, None]
            for i, name in enumerate(("bids", "asks")):
                book, pick = sides[i], (max, min)[i]
                if r["snapshot"]:
                    book.clear()
                    best[i] = None
                for level in r[name] or []:
                    price, size = level["price"], level["size"]
                    if size > 0:
                        book[price] = size
                        best[i] = price if best[i] is None else pick(best[i], price)
                    elif book.pop(price, None) is not None and price == best[i]:
                        best[i] = pick(book, default=None)
            if r["final"]:
                for column, v in zip(out, (*now[:3], r[RECV], r["seq"], *best, sides[0].get(best[0]), sides[1].get(best[1])), strict=True):
                    column.append(v)
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), *(pa.float64(),) * 4)
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=[x.split()[0] for x in TOP.split(", ")])


def tops(judged: DataFrame) -> DataFrame:
    """Best bid and ask, and their sizes, after each valid row of ``verdicts``.

    A snapshot replaces everything, so books are dealt by epoch, not by symbol, and
    a long epoch by stretches of its hours, each of which starts from the levels
    that it found. No task walks more than a stretch of a book at a time.
    """
    n = int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = applied_rows(judged).select(*KEY, "epoch", RECV, "seq", "sub", "final", "snapshot", level_numbers("bids").alias("bids"), level_numbers("asks").alias("asks"))
    short, long = parted(stored(rows, "steps"), KEY, STRETCH)
    rows = short.withColumn("stretch", F.lit(0).cast("bigint"))
    none = F.array().cast(rows.schema["bids"].dataType)
    first = {RECV: F.lit(-(2**62)), "seq": F.lit(-1).cast("bigint"), "sub": F.lit(-1).cast("bigint"), "final": F.lit(False), "snapshot": F.lit(True), "bids": F.coalesce("bids", none), "asks": F.coalesce("asks", none)}
    if long is not None:  # else every epoch lies in one stretch
        long = stored(stretches(long), "stretches").select(rows.columns)
        rows = rows.unionByName(long).unionByName(openings(long).withColumns(first).select(rows.columns))
    dealt = rows.repartition(n, *KEY, "epoch", "stretch").sortWithinPartitions(*KEY, "epoch", "stretch", RECV, "seq", "sub")
    return dealt.mapInArrow(_tops, TOP)


def gap_spans(marked: DataFrame) -> DataFrame:
    """Spans in which a book was broken: from the first flagged delta to the next snapshot (null: none came)."""
    first = marked.filter("sequence_gap").groupBy(*KEY, "epoch").agg(F.min(RECV).alias("from_ns"))
    after = marked.filter("snapshot").select(*KEY, (F.col("epoch") - 1).alias("epoch"), F.col(RECV).alias("to_ns"))
    return first.join(after, [*KEY, "epoch"], "left").drop("epoch")


# ---------------------------------------------------------------- diff streams
#: Diffs kept while no snapshot fits, and applied ones kept to re-base by.
HELD, RECENT = 12_000, 1_200
DIFF_VENUES = ("binance",)
BASES = "venue string, symbol string, depth int, local_receive_ts_ns bigint, seq bigint, taken boolean, fits boolean, anchor bigint, last bigint, arrived bigint, passed bigint, id bigint, flagged bigint"


def is_diff_stream() -> F.Column:
    """Books whose snapshots arrive beside their stream of diffs."""
    return F.regexp_extract("venue", "^[a-z]+", 0).isin(*DIFF_VENUES) & (F.col("depth") == DIFF_DEPTH)


def runs(rows: DataFrame) -> DataFrame:
    """Adds ``diffs`` (that had arrived with the row), for a diff its place ``at``, ``run``: the island of diffs that each name the one before them, and ``flagged``: the place of the last diff before that the recorder flagged."""
    diff = ~F.col("snapshot")
    rows = carried(rows, KEY, before={"_before": F.when(diff, F.col("update_id"))}, counts={"diffs": diff})
    broken = diff & (F.coalesce("sequence_gap", F.lit(False)) | ~F.coalesce(F.col("previous_update_id") == F.col("_before"), F.lit(False)))
    rows = rows.withColumns({"_broken": broken, "at": F.when(diff, F.col("diffs") - 1)})
    return carried(rows, KEY, before={"flagged": F.when(diff & F.coalesce("sequence_gap", F.lit(False)), F.col("at"))}, counts={"run": F.col("_broken")}).drop("_before")


def anchors(rows: DataFrame) -> DataFrame:
    """For each snapshot of ``runs`` its id, what had arrived, and the first diff whose ids reach its id: anchor (its place), fits (it spans the id), last (the place at which its run ends).

    Ids grow with arrival, so the hour that holds the anchor is found on a table
    of hours, and the anchor among that hour's diffs.
    """
    diffs = rows.filter("not snapshot").withColumn("_hour", F.expr(f"{RECV} div {NS_PER_HOUR}"))
    shots = rows.filter("snapshot").select(*KEY, RECV, "seq", F.col("update_id").alias("id"), F.col("diffs").alias("arrived"), "flagged")
    who = "struct<ns:bigint,seq:bigint,arrived:bigint,flagged:bigint>"
    hours = diffs.groupBy(*KEY, "_hour").agg(F.max("update_id").alias("id"))
    blank = hours.withColumns({"_who": F.lit(None).cast(who), "_last": F.lit(1)})
    probe = shots.select(*KEY, F.lit(None).cast("bigint").alias("_hour"), "id", F.struct(F.col(RECV).alias("ns"), "seq", "arrived", "flagged").alias("_who"), F.lit(0).alias("_last"))
    ahead = Window.partitionBy(*KEY).orderBy("id", "_last").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = blank.select(probe.columns).unionByName(probe).withColumn("_hour", F.first("_hour", ignorenulls=True).over(ahead)).filter("_last = 0")
    inside = diffs.select(*KEY, "_hour", F.col("update_id").alias("id"), F.lit(None).cast(who).alias("_who"), F.lit(1).alias("_last"), F.struct("at", F.col("first_update_id").alias("first"), "run").alias("_diff"))
    asked = found.filter("_hour is not null").withColumn("_diff", F.lit(None).cast(inside.schema["_diff"].dataType))
    near = Window.partitionBy(*KEY, "_hour").orderBy("id", "_last").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    met = inside.unionByName(asked.select(inside.columns)).withColumn("_diff", F.min("_diff").over(near)).filter("_last = 0")
    none = found.filter("_hour is null").withColumn("_diff", F.lit(None).cast(inside.schema["_diff"].dataType))
    met = met.unionByName(none.select(met.columns)).select(*KEY, F.col("_who.ns").alias(RECV), F.col("_who.seq").alias("seq"), F.col("_who.arrived").alias("arrived"), F.col("_who.flagged").alias("flagged"), "id", F.col("_diff.at").alias("anchor"), (F.col("_diff.first") <= F.col("id")).alias("fits"), F.col("_diff.run").alias("run"))
    ends = rows.filter("_broken").select(*KEY, (F.col("run") - 1).alias("run"), (F.col("at") - 1).alias("last"))
    return met.join(ends, [*KEY, "run"], "left").drop("run")


def walk(choose: Callable[[dict | None, dict], bool]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Which snapshots a book takes as its base, in arrival order; the only step that depends on the one before, over snapshots alone.

    ``choose(base, snapshot)`` says whether it is taken, and may set what it stands on.
    """
    names = [x.split()[0] for x in BASES.split(", ")]
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *(pa.int64(),) * 6)

    def bases(shots: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, base, passed = None, None, 0
        for batch in shots:
            rows = batch.to_pylist()
            for r in rows:
                if book != (now := (r["venue"], r["symbol"], r["depth"])):
                    book, base, passed = now, None, 0
                r["fits"] = bool(r["fits"])
                r["taken"] = choose(base, r)
                base, passed = (r, passed) if r["taken"] else (base, passed + 1)
                r["passed"] = passed
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return bases


def takes(base: dict | None, shot: dict) -> bool:
    """A book that isn't whole takes any snapshot. A whole one takes one ahead of all its diffs and not behind its base, or one that its last RECENT diffs bracket; it passes over others."""
    seen, anchor = shot["arrived"], shot["anchor"]
    behind = anchor is not None and anchor < seen
    shot["fits"] = shot["fits"] and not (behind and anchor < seen - HELD)
    if base is None or not whole_at(base, seen):
        return True
    if not behind:
        return base["id"] <= shot["id"]
    return shot["fits"] and anchor >= max(seen - RECENT, base["anchor"] if base["anchor"] is not None else seen)


def whole_at(base: dict, diffs: int) -> bool:
    """Whether a book on ``base`` is the venue's once ``diffs`` diffs have arrived."""
    anchor, last = base["anchor"], base["last"]
    return anchor is None or anchor >= diffs or (base["fits"] and (last is None or diffs - 1 <= last))


def diff_chain(rows: DataFrame, choose: Callable[[dict | None, dict], bool] = takes) -> DataFrame:
    """Rows of diff-stream books with ``valid``, ``epoch`` (the base's number), ``base``, ``diffs``, ``at`` and the counters held, passed and rows_applied.

    Links between neighbouring diffs make runs; a snapshot is good from its
    arrival until the run of the diff that spans its id ends. Only the choice
    among snapshots is a walk, over snapshots alone. Update ids must not fall
    with arrival. Covered diffs count as applied.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select(*KEY, RECV, "seq", "snapshot", "sequence_gap", *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("update_id", "previous_update_id", "first_update_id")))
    linked = stored(runs(ids), "runs")
    shots = anchors(linked).select(*KEY, RECV, "seq", F.lit(False).alias("taken"), "fits", "anchor", "last", "arrived", F.lit(0).cast("bigint").alias("passed"), "id", "flagged")
    bases = shots.repartition(n, *KEY).sortWithinPartitions(*KEY, RECV, "seq").mapInArrow(walk(choose), BASES)
    told = stored(bases.select(*KEY, RECV, "seq", F.struct("taken", "fits", "anchor", "last", "arrived").alias("_own"), "passed"), "bases")
    all_ = linked.join(told, [*KEY, RECV, "seq"], "left")
    taken = F.coalesce(F.col("_own.taken"), F.lit(False))
    all_ = carried(all_, KEY, before={"_old": F.when(taken, F.col("_own")), "_passed": F.col("passed")}, counts={"epoch": taken, "_rows": F.lit(1)})
    base = F.when(taken, F.col("_own")).otherwise(F.col("_old"))
    all_ = all_.withColumns({"base": base, "passed": F.coalesce("passed", "_passed", F.lit(0))})
    ahead = F.col("base.anchor").isNull() | (F.col("base.anchor") >= F.col("diffs"))
    chained = F.col("base.fits") & (F.col("base.last").isNull() | (F.col("diffs") - 1 <= F.col("base.last")))
    valid = F.col("base").isNotNull() & (ahead | F.coalesce(chained, F.lit(False)))
    since = F.when(F.col("base").isNull(), F.lit(0)).when(F.coalesce(F.col("base.fits"), F.lit(False)), F.col("base.last") + 1).otherwise(F.col("base.anchor"))
    waiting = F.when(valid, F.lit(0)).otherwise(F.col("diffs") - since)
    all_ = all_.withColumns({"valid": valid, "held": F.least(waiting, F.lit(HELD)), "rows_applied": F.col("_rows") - waiting - F.col("passed"), "used": taken})
    told = stored(all_.select(*KEY, RECV, "seq", "epoch", "valid", "used", "diffs", "at", "base", "held", "passed", "rows_applied"), "verdicts")
    return rows.join(told, [*KEY, RECV, "seq"])


JUDGED = ("epoch", "valid", "used", "diffs", "at", "base")


def verdicts(rows: DataFrame, choose: Callable[[dict | None, dict], bool] = takes) -> DataFrame:
    """Every book row with ``valid`` (the book after it is the venue's) and ``epoch``, by the rule of its venue; ``choose`` is that of diff streams."""
    same = [c for c in rows.columns if c not in JUDGED]
    plain = chain(rows.filter(~is_diff_stream())).select(*same, *JUDGED)
    diffs = rows.filter(is_diff_stream())
    return plain if diffs.isEmpty() else plain.unionByName(diff_chain(diffs, choose).select(*same, *JUDGED))


def applied_rows(judged: DataFrame, broken_off: bool = False) -> DataFrame:
    """The steps of each epoch's book: the valid rows, and after a base snapshot the earlier diffs that it replays, at its place.

    ``sub`` orders steps of one place, ``final`` marks the last of them. Rows
    that change nothing (covered diffs, snapshots passed over) come without levels.
    ``broken_off``: also bases whose replay meets a break, with the diffs up to it.
    """
    base = F.col("base")
    none = F.array().cast("array<array<string>>")
    upto = F.least(base["arrived"], F.coalesce(base["last"] + 1, base["arrived"]))
    replays = F.when(base.isNotNull() & F.col("used") & base["fits"] & (base["anchor"] < base["arrived"]), upto - base["anchor"]).otherwise(0)
    idle = base.isNotNull() & F.when(F.col("snapshot"), ~F.col("used")).otherwise(F.coalesce(F.col("at") < base["anchor"], F.lit(True)))
    own = judged.filter("valid or used" if broken_off else "valid").withColumns({"sub": F.lit(0).cast("bigint"), "_n": replays})
    steps = own.withColumns({"final": F.col("_n") == 0, **{c: F.when(idle, none).otherwise(F.col(c)) for c in ("bids", "asks")}, "snapshot": F.col("used")})
    bases = own.filter("_n > 0").select(*KEY, RECV, "seq", "epoch", F.col("base.anchor").alias("_from"), F.col("_n"), F.explode(F.sequence(F.col("base.anchor"), F.col("base.anchor") + F.col("_n") - 1)).alias("at"))
    diffs = judged.filter("base is not null or at is not null").filter("not snapshot").drop(RECV, "seq", "epoch", "snapshot", "valid", "used", "base", "diffs")
    again = bases.join(diffs, [*KEY, "at"]).withColumns({"sub": F.col("at") - F.col("_from") + 1, "snapshot": F.lit(False)}).withColumn("final", F.col("sub") == F.col("_n"))
    keep = [c for c in steps.columns if c not in ("_n", "valid", "used", "diffs", "at", "base")]
    return steps.select(keep).unionByName(again.select(keep))


def last_of_book(chained: DataFrame) -> DataFrame:
    """The description of each diff-stream book after its last row: verdict, counters, last id, best prices and sizes."""
    last = F.max_by(F.struct("valid", "rows_applied", "held", "passed", "update_id"), ord_())
    best = tops(chained).groupBy(*KEY).agg(F.max_by(F.struct("best_bid", "best_ask", "bid_size", "ask_size"), ord_()).alias("t"))
    out = chained.groupBy(*KEY).agg(last.alias("x")).join(best, list(KEY), "left")
    shown = (F.when(F.col("x.valid"), F.col(f"t.{c}")).alias(c) for c in ("best_bid", "best_ask", "bid_size", "ask_size"))
    return out.select(*KEY, "x.valid", "x.rows_applied", "x.held", "x.passed", F.col("x.update_id").alias("last_id"), *shown)
