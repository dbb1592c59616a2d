"""Files in order: tapes over hours and segments, day files, audits of damaged files, landed frames, diff books as files hold them."""

import gzip
import json
import random
import tarfile
from collections import deque

import pytest
from pyspark.sql import functions as F

from ticklake.operators import audit, book, coverage, coverage_log, export, spans
from ticklake.schema import widened
from ticklake.sources import file_audit, frame_stream, line_files, normalize, tape_files, testbed
from ticklake.streaming import state

NS = 10**9
HOUR = 3600 * NS
START = 1_704_067_200 * NS
SF = "/root/testdata/sf0.001"


def land(root, hour, segment, rows, symbol="AAA"):
    folder = root / "2024-01-01" / f"{hour:02d}" / symbol
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"segment-{segment:06d}.jsonl").write_text("".join(json.dumps({"venue": "v", "symbol": symbol} | r) + "\n" for r in rows))


def top(at, u, bid, ask, snapshot=True):
    return {"kind": "orderbook_snapshot" if snapshot else "orderbook_delta", "local_receive_ts_ns": at, "depth": 1, "update_id": u, "bids": [[bid, "1"]], "asks": [[ask, "2"]]}


def test_tops_and_trades_over_two_hours(spark, tmp_path):
    root = tmp_path / "v-x"
    for hour in (0, 1):
        land(root, hour, 0, [top(START + hour * HOUR + i * NS, 10 * hour + i, str(100 * hour + i + 1), str(100 * hour + i + 2)) for i in range(3)])
        land(root, hour, 1, [{"kind": "public_trade", "local_receive_ts_ns": START + hour * HOUR + i * NS, "trade_id": f"{hour}{i}", "price": 1.0, "qty": 1.0, "side": "Buy"} for i in range(4)])
    tape = tape_files.read_tape(spark, str(root))
    shown = export.book_ticker(tape).orderBy("local_receive_ts_ns").collect()
    assert [(r.bid_price, r.ask_price) for r in shown] == [(str(100 * h + i + 1), str(100 * h + i + 2)) for h in (0, 1) for i in range(3)]
    for name, rows in (("trades", export.trades(tape)), ("book_ticker", export.book_ticker(tape)), ("incremental_book_L2", export.incremental_book(tape, 1))):
        export.write_days(rows, "vendor", name, str(tmp_path / "out"))
        lines = gzip.open(tmp_path / "out" / "vendor" / name / "2024-01-01" / "AAA.csv.gz", "rt").read().splitlines()
        stamps = [int(x.split(",")[3]) for x in lines[1:]]
        assert lines[0] == export.COLUMNS[name] and stamps == sorted(stamps) and len(stamps) == {"trades": 8, "book_ticker": 6, "incremental_book_L2": 12}[name]
    book_lines = gzip.open(tmp_path / "out" / "vendor" / "incremental_book_L2" / "2024-01-01" / "AAA.csv.gz", "rt").read().splitlines()[1:]
    assert [x.split(",")[5] for x in book_lines] == ["bid", "ask"] * 6
    done = {(r.type, r.symbol, r.rows) for r in export.exported(spark, str(tmp_path / "out")).collect()}
    assert done == {("trades", "AAA", 8), ("book_ticker", "AAA", 6), ("incremental_book_L2", "AAA", 12)}
    assert not list((tmp_path / "out").glob("_parts*"))


def test_ties_over_segments_keep_their_order(spark, tmp_path):
    root, want = tmp_path / "v-x", []
    for hour, segment, n in ((0, 0, 3), (0, 1, 2), (0, 12, 2), (1, 0, 2)):
        ids = [f"{hour}-{segment:02d}-{i}" for i in range(n)]
        land(root, hour, segment, [{"kind": "public_trade", "local_receive_ts_ns": START + hour * HOUR, "trade_id": x, "price": 1.0, "qty": 1.0, "side": "Buy"} for x in ids])
        want += ids
    (tmp_path / "tars").mkdir()
    with tarfile.open(tmp_path / "tars" / "x.tar", "w") as tar:
        tar.add(root / "2024-01-01", "2024-01-01")
    tape = tape_files.read_tape(spark, str(root)).persist()
    tape_files.write_segments(tape, str(tmp_path / "again"), 2)
    for path in (root, tmp_path / "tars", tmp_path / "again"):
        rows = tape_files.read_tape(spark, str(path), venue="v")
        assert [r.trade_id for r in rows.orderBy("seq").collect()] == want, path
    with pytest.raises(Exception, match="segment over"):
        land(root, 0, 2**14, [{"kind": "ticker", "local_receive_ts_ns": START}])
        tape_files.read_tape(spark, str(root)).select("kind", "seq").collect()


def test_sink_leaves_nothing_of_a_failed_job(spark, tmp_path):
    out = tmp_path / "out"
    lines = spark.range(8).select(F.concat(F.lit("f"), (F.col("id") % 2).cast("string")).alias("path"), F.when(F.col("id") < 6, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("broken"))).alias("line"))
    with pytest.raises(Exception, match="broken"):
        line_files.write_lines(lines.repartition(2, "path"), str(out))
    assert [p for p in out.rglob("*") if p.is_file()] == []
    with pytest.raises(Exception, match="one partition"):
        line_files.write_lines(lines.filter("id < 4").repartition(4, "id"), str(out))
    assert [p for p in out.rglob("*") if p.is_file()] == []
    line_files.write_lines(lines.filter("id < 4").repartition(2, "path").sortWithinPartitions("path", "line"), str(out), "head", "told")
    assert gzip.open(out / "f1", "rt").read() == "head\n1\n3\n"
    told = line_files.read_receipts(spark, str(out), "told").collect()
    assert {(r.path, r.rows, r.bytes) for r in told} == {(n, 2, (out / n).stat().st_size) for n in ("f0", "f1")}


def test_damaged_files_give_rows(spark, tmp_path):
    text = "".join(json.dumps({"local_receive_ts_ns": i}) + "\n" for i in (5, 7, 6)) + "x\n\n"
    packed = gzip.compress(text.encode())
    for name, data in (("a.jsonl", text.encode()), ("b.jsonl.gz", packed), ("c.jsonl.gz", packed[:-9]), ("d.jsonl.zst", b"\x00" * 40), ("e.jsonl", b"")):
        (tmp_path / name).write_bytes(data)
    got = {r.file.rsplit("/", 1)[1]: r for r in file_audit.walked_files(spark, str(tmp_path)).collect()}
    for name in ("a.jsonl", "b.jsonl.gz"):
        r = got[name]
        assert (r.seen, r.bad_lines, r.first_bad, r.first_ns, r.last_ns, r.late_line, r.error) == (3, 1, 4, 5, 7, 3, None)
    assert all(got[n].error and got[n].seen is None and got[n].sha256 for n in ("c.jsonl.gz", "d.jsonl.zst"))
    assert (got["e.jsonl"].bytes, got["e.jsonl"].seen, got["e.jsonl"].error) == (0, 0, None)
    assert file_audit.walk_file(f"file://{tmp_path}/none", True)[1:3] == (None, None)
    files = spark.createDataFrame([("h", "p", "s", "cut short"), ("h", "q", None, "gone")], "hour string, path string, sha256 string, error string")
    receipts = spark.createDataFrame([("h", "p", "s", 1, 0, 0), ("h", "q", "s", 1, 0, 0)], "hour string, path string, sha256 string, records long, first_receive_ns long, last_receive_ns long")
    content = spark.createDataFrame([], "hour string, path string, seen long, bad_lines long, first_ns long, last_ns long, late_line long")
    found = {(r.path, r.finding) for r in audit.findings(files, receipts, content, files.select("hour")).collect()}
    assert found == {("p", "unreadable"), ("q", "unreadable")}
    total = {r.finding: r.n for r in audit.summary(audit.audit(files, receipts, content, files.select("hour")), audit.findings(files, receipts, content, files.select("hour"))).collect()}
    assert total == {"all": 1, "unreadable": 2}


def test_frames_replayed_after_a_restart(spark, tmp_path):
    frames = testbed.frames(spark, SF).filter("venue = 'bybit'").persist()
    n = frames.agg(F.max("arrival_seq")).first()[0] // 4 + 1
    for half in (f"arrival_seq < {2 * n}", f"arrival_seq >= {2 * n}"):
        frame_stream.land_frames(frames.filter(half), str(tmp_path / "landed"), n)
        stream = normalize.normalized(frame_stream.read_frames(spark, str(tmp_path / "landed"), "bybit", stream=True))
        query = state.sink_tape(stream.withColumn("symbol", F.upper("symbol")), str(tmp_path / "tape"), str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "tape"))
    want = normalize.normalized(frames)
    names = ["symbol", "kind", "local_receive_ts_ns", "price", "qty", "trade_id"]
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))
    assert got.select("kind", "seq", "symbol").distinct().count() == got.count()
    (tmp_path / "landed" / "frames-9.jsonl").write_text("{}\n")
    with pytest.raises(Exception, match="line 1: not a frame"):
        frame_stream.read_frames(spark, str(tmp_path / "landed"), "bybit").collect()


def test_streams_of_bytes_clocks_and_history(spark, tmp_path):
    """What closed windows of a stream hold, against the same sums over the table."""
    e = testbed.events(spark, SF)
    rows = e.select(F.lit("t").alias("tier"), F.col("event_type").alias("feed"), "recv_ns", F.col("k").alias("bytes"), (F.col("k") * 1.5).alias("ms"), (F.col("k") % 3).cast("string").alias("kind"), "symbol", F.expr("recv_ns div 1000000000000").alias("day_ms"))
    rows.orderBy("recv_ns").coalesce(1).write.parquet(str(tmp_path / "in"))

    def run(stream, name):
        query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)
        return spark.table(name)

    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    minutes = {(r.feed, r.minute): r.bytes for r in run(state.stream_bytes(source), "minutes").collect()}
    want = {(r.feed, r.minute): r.bytes for r in rows.groupBy("feed", F.expr("recv_ns div 60000000000").alias("minute")).agg(F.sum("bytes").alias("bytes")).collect()}
    assert len(minutes) > len(want) * 0.9 and all(want[k] == v for k, v in minutes.items())
    days = {r.start_ns: (r.n, round(r["mean"], 6), r.least, r.most) for r in run(state.stream_clock(source, "1 day"), "clocks").collect()}
    told = rows.groupBy(F.expr("recv_ns div 86400000000000 * 86400000000000").alias("d")).agg(F.count("*").alias("n"), F.avg("ms").alias("m"), F.min("ms").alias("a"), F.max("ms").alias("b"))
    want = {r.d: (r.n, round(r.m, 6), r.a, r.b) for r in told.collect()}
    assert len(days) >= len(want) - 1 and all(want[k] == v for k, v in days.items())
    seen = run(state.stream_history(source, "day_ms", "60 days"), "history").select("kind", "symbol", "day_ms")
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, rows.select("kind", "symbol", "day_ms").distinct().collect()))


# ------------------------------------------------------------------ diff books
def diff_rows(rng, n):
    """(snapshot, id, first, named, flagged) with holes, flags, wrong links, and snapshots late, stale or ahead."""
    u, rows = 100, []
    for _ in range(n):
        if rng.random() < 0.25:
            rows.append((True, u + rng.randint(-14, 6) if rng.random() < 0.8 else rng.randint(90, u + 3), 0, 0, False))
            continue
        first = u + 1 + (rng.randint(1, 4) if rng.random() < 0.08 else 0)
        u = first + rng.randint(0, 3)
        rows.append((False, u, first, first - 1 - (rng.random() < 0.04), rng.random() < 0.06))
    return rows


def whole_books(rows):
    """Whether the book is the venue's after each row, row by row."""
    whole, waiting, held, recent, last, base, out = False, False, [], [], 0, 0, []

    def follow(d):
        nonlocal whole, waiting, last
        if d[1] < base:
            return True
        good = d[2] <= base <= d[1] if waiting else not d[4] and d[3] == last
        if not good:
            whole = False
            recent.clear()
            return False
        waiting, last = False, d[1]
        recent.append(d)
        return True

    for r in rows:
        if not r[0]:
            if not whole or not follow(r):
                held.append(r)
        elif not whole:
            base = last = r[1]
            whole = waiting = True
            recent.clear()
            todo, held = held, []
            while todo and follow(todo[0]):
                todo.pop(0)
            held = todo
        else:
            kept = [d for d in recent if d[1] >= r[1]]
            if kept and kept[0][2] <= r[1]:
                base, last, waiting, recent = r[1], kept[-1][1], False, kept
            elif not kept and r[1] >= last:
                base = last = r[1]
                waiting, recent = True, []
        out.append(whole)
    return out


def written_messages(rows):
    """(place, step, row) of each message of a file, rows without one, and stale snapshots."""
    based, last, waiting, held, recent, out = False, 0, 0, deque(), deque(), []
    missed = stale = 0

    def drop(d):
        nonlocal based, waiting, missed
        based, waiting, missed = False, 0, missed + 1
        held.clear()
        recent.clear()
        held.append(d)

    def message(d, place, step):
        nonlocal last, waiting, missed
        i, (_, u, first, named, flagged) = d
        if not based:
            if flagged:
                held.clear()
            held.append(d)
            missed += 1
        elif waiting and u < waiting:
            return True
        elif (first > waiting) if waiting else (flagged or named != last):
            drop(d)
        else:
            waiting, last = 0, u
            out.append((place, step, i))
            recent.append(d)
            return True
        return False

    for i, r in enumerate(rows):
        if not r[0]:
            message((i, r), i, 0)
            continue
        later = [d for d in (recent if based else held) if d[1][1] >= r[1]]
        if later and later[0][1][2] > r[1]:
            stale += 1
            continue
        out.append((i, 0, i))
        based, last, waiting = True, r[1], r[1]
        held.clear()
        recent.clear()
        for k, d in enumerate(later):
            if not message(d, i, k + 1):
                held.extend(later[k + 1 :])
                break
    return out, missed, stale


def test_diff_books_by_both_rules(spark):
    rng = random.Random(20)
    streams = {f"S{k}": diff_rows(rng, rng.randint(5, 70)) for k in range(150)}
    made = [("orderbook_snapshot" if r[0] else "orderbook_delta", "binance", k, 1000, START + (i + 1) * NS, START + (i + 1) * NS, i, r[1], r[2], r[3], [[str(i + 1), "1"]], [["9999", "1"]], bool(r[4])) for k, rows in streams.items() for i, r in enumerate(rows)]
    schema = "kind string, venue string, symbol string, depth int, local_receive_ts_ns long, exchange_system_ts_ns long, seq long, update_id long, first_update_id long, previous_update_id long, bids array<array<string>>, asks array<array<string>>, sequence_gap boolean"
    tape = widened(spark.createDataFrame(made, schema), "seq").persist()
    valid, lines = {}, {}
    for r in book.verdicts(book.book_rows(tape)).select("symbol", "seq", "valid").collect():
        valid.setdefault(r.symbol, {})[r.seq] = r.valid
    for r in export.incremental_book(tape, 1000).filter("side = 'bid'").collect():
        lines.setdefault(r.symbol, []).append((r.seq, r.pos // 100_000, int(r.price) - 1, r.local_timestamp))
    notes = {r.symbol: (r.unbased_rows, r.stale_snapshots) for r in export.unchained(tape, 1000).collect()}
    for k, rows in streams.items():
        assert [valid[k][i] for i in range(len(rows))] == whole_books(rows), k
        want, missed, stale = written_messages(rows)
        got = sorted(lines.get(k, []))
        assert [x[:3] for x in got] == want and notes.get(k, (0, 0)) == (missed, stale), k
        assert all(x[3] == (START + (x[0] + 1) * NS) // 1000 for x in got)  # a replayed diff has its snapshot's time


# ------------------------------------------------------------------ spans and documents
def test_sweep_of_a_hot_key(spark):
    n = 100_000
    a = spark.range(n).select(F.lit("k").alias("key"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 6).alias("end"))
    b = spark.range(n).select(F.lit("k").alias("key"), (F.col("id") * 10 + 4).alias("start"), (F.col("id") * 10 + 9).alias("end"))
    both, left = spans.intersect(a, b, "key"), spans.subtract(a, b, "key")
    assert both.agg(F.count("*"), F.sum(F.col("end") - F.col("start"))).first() == (n, 2 * n)
    assert left.agg(F.count("*"), F.sum(F.col("end") - F.col("start"))).first() == (n, 4 * n)
    assert "Join" not in both._jdf.queryExecution().executedPlan().toString()


def test_sweep_against_sets(spark):
    rng = random.Random(6)
    rows = [(side, rng.choice("xy"), s := rng.randint(0, 60), s + rng.randint(-1, 9)) for side in "ab" for _ in range(40)]
    a, b = (spark.createDataFrame([r[1:] for r in rows if r[0] == side], "key string, start long, end long") for side in "ab")
    cover = {(side, k): {t for s, key, x, y in rows if s == side and key == k for t in range(x, y)} for side in "ab" for k in "xy"}
    for op, want in ((spans.intersect, set.__and__), (spans.subtract, set.__sub__)):
        got = op(a, b, "key").collect()
        for k in "xy":
            own = sorted((r.start, r.end) for r in got if r.key == k)
            assert {t for s, e in own for t in range(s, e)} == want(cover["a", k], cover["b", k])
            assert all(x[1] < y[0] for x, y in zip(own, own[1:], strict=False))
    assert spans.subtract(a, b.limit(0), "key").count() == spans.merge(a, "key").count()


def event(ns, what, on=True, pid=1, **more):
    names = [c.split()[0] for c in coverage_log.EVENT.split(", ")]
    row = {"venue": "bybit", "market": "linear", "pid": pid, "ns": ns, "what": what, "on": on} | more
    return tuple(row.get(n) for n in names)


def test_hour_documents(spark):
    h = HOUR
    log = [
        event(5, "up"), event(h + 50, "up", False), event(10, "member", tier="all", symbol="BTC"), event(20, "member", tier="all", symbol="ETH"), event(30, "member", False, tier="all", symbol="ETH"),
        event(11, "shard", shard=3, tier="all", topics=["publicTrade.BTC"]), event(h - 5, "shard", False, shard=3, tier="all", topics=["publicTrade.BTC"]), event(h + 7, "shard", True, shard=3, tier="all", topics=["publicTrade.BTC", "tickers.BTC"]),
        event(40, "gap", topic="orderbook.50.BTC", symbol="BTC", depth=50), event(41, "gap", topic="orderbook.50.BTC", symbol="BTC", depth=50), event(h + 9, "gap", False, topic="orderbook.50.BTC", symbol="BTC", depth=50),
        event(60, "shed", tier="all", feed="ticker"), event(70, "shed", False, tier="all", feed="ticker"), event(h + 20, "disk"), event(h + 25, "overrun", shard=3), event(h + 60, "overrun", shard=3),
        event(3 * h + 1, "up", pid=2), event(3 * h + 9, "member", pid=2, tier="all", symbol="BTC"),
    ]
    feeds = spark.createDataFrame([("bybit", "linear", "all", ["trades", "ticker"]), ("bybit", "linear", "none", ["trades"])], "venue string, market string, tier string, feeds array<string>")
    docs = {(r.pid, r.hour): r for r in coverage_log.hour_documents(spark.createDataFrame(log, coverage_log.EVENT), feeds).collect()}
    assert set(docs) == {(1, "00"), (1, "01"), (2, "03")}
    a, b, c = (docs[k] for k in sorted(docs))
    assert (a.window.from_ns, a.window.to_ns, b.window.from_ns, b.window.to_ns) == (5, h, h, h + 50) and a.hour_span.to_ns == h
    assert {t.name: t.members for t in a.tiers} == {"all": {"BTC": [[10, h]], "ETH": [[20, 30]]}, "none": {}}
    assert {t.name: t.members for t in b.tiers}["all"] == {"BTC": [[h, h + 50]]}
    assert [(d.shard, d.topics, d.from_ns, d.to_ns) for d in (*a.disconnects, *b.disconnects)] == [(3, ["publicTrade.BTC"], h - 5, h), (3, ["publicTrade.BTC"], h, h + 7)]
    assert [(g.from_ns, g.to_ns) for g in (*a.book_gaps, *b.book_gaps)] == [(40, None), (h, h + 9)]
    assert [(s.feed, s.from_ns, s.to_ns) for s in a.shed] == [("ticker", 60, 70)] and not b.shed and b.disk_blocked == [[h + 20, h + 50]]
    assert [(s["index"], s.topics) for s in b.shards] == [(3, ["publicTrade.BTC", "tickers.BTC"])] and [o.ns for o in b.overruns] == [h + 25]
    assert c.window.to_ns == 3 * h + 9 and not c.shards and coverage_log.hour_documents(spark.createDataFrame([], coverage_log.EVENT), feeds).count() == 0
    cells = coverage.ledger(coverage.exploded(coverage_log.hour_documents(spark.createDataFrame(log, coverage_log.EVENT), feeds)))
    assert {r.status for r in cells.collect()} == {"excluded"}


def test_index_of_a_columnar_tape(spark, tmp_path):
    from ticklake.sources import columnar_index

    rows = testbed.tape(spark, SF)
    tape_files.write_columnar(rows, str(tmp_path / "c"), by=("venue", "day"))
    groups = columnar_index.index(spark, str(tmp_path / "c")).persist()
    found = columnar_index.content(groups)
    assert groups.agg(F.sum("rows")).first()[0] == rows.count() and columnar_index.verified(groups, found).count() == 0
    kinds = {r.kind: r.n for r in rows.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    told = columnar_index.described(groups, found).collect()
    assert {k: sum(r.rows_by_kind.get(k, 0) for r in told) for k in kinds} == kinds and sum(r.rows for r in told) == rows.count()
    day = columnar_index.groups_of(groups, START, START + 24 * HOUR)
    assert 0 < day.count() < groups.count() and columnar_index.groups_of(groups, symbol="none").count() == 0
    first, second, *_ = sorted(r.file for r in groups.select("file").distinct().collect())
    for file, spoil in ((first, lambda x: x[:-6]), (second, lambda x: x[:40] + bytes(b ^ 255 for b in x[40:60]) + x[60:])):
        path = file.removeprefix("file://")
        data = open(path, "rb").read()
        open(path, "wb").write(spoil(data))
    again = columnar_index.index(spark, str(tmp_path / "c")).persist()
    wrong = {r.file for r in columnar_index.verified(again, columnar_index.content(again)).collect()}
    assert first in wrong
    moved = groups.withColumn("rows", F.when(F.col("file") == told[0].file, F.col("rows") + 1).otherwise(F.col("rows")))
    assert [r.why for r in columnar_index.verified(moved, found).filter(F.col("file") == told[0].file).collect()][:1] in (["other number of rows"], []) or told[0].file in (first, second)
