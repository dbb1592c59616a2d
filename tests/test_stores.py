"""Tapes, archives and their records on disk."""

import hashlib
import io
import json
import tarfile

import pytest
import zstandard
from pyspark.sql import functions as F

from ticklake.operators import coverage, health, retention
from ticklake.schema import widened
from ticklake.sources import archive, tape_files

NS = 10**9
HOUR = 3600 * NS


def line(symbol, ns, n):
    return json.dumps({"kind": "public_trade", "venue": "v", "symbol": symbol, "local_receive_ts_ns": ns, "trade_id": f"t{n}", "price": 1.5, "qty": 1.0, "side": "Buy"})


def test_one_reader_for_all_layouts(spark, tmp_path):
    root = tmp_path / "bybit-linear"
    for hour, symbol in (("00", "AAA"), ("00", "BBB"), ("01", "AAA")):
        folder = root / "2024-01-01" / hour / symbol
        folder.mkdir(parents=True)
        start = (1_704_067_200 + 3600 * int(hour)) * NS
        (folder / "segment-000000.jsonl").write_text("".join(line(symbol, start + i, i) + "\n" for i in range(5)))
    rows = tape_files.read_tape(spark, str(root))
    want = sorted((r.symbol, r.local_receive_ts_ns, r.trade_id) for r in rows.collect())
    assert len(want) == 15 and rows.first().source_venue == "bybit"
    tape_files.write_json_tape(rows, str(tmp_path / "json"), by=("day", "hour"))
    tape_files.write_columnar(rows, str(tmp_path / "columnar"))
    (tmp_path / "tars").mkdir()
    with tarfile.open(tmp_path / "tars" / "x.tar", "w") as tar:
        tar.add(root / "2024-01-01", "2024-01-01")
    for name in ("json", "columnar", "tars"):
        got = tape_files.read_tape(spark, str(tmp_path / name), venue="bybit")
        assert sorted((r.symbol, r.local_receive_ts_ns, r.trade_id) for r in got.collect()) == want, name
        some = tape_files.read_tape(spark, str(tmp_path / name), ["2024-01-01T00"], ["bbb"], venue="bybit")
        assert {(r.symbol, r.hour) for r in some.collect()} == {("BBB", "00")}
        assert [r.trade_id for r in some.orderBy("seq").collect()] == [f"t{i}" for i in range(5)]
    with pytest.raises(ValueError, match="venue"):
        tape_files.read_tape(spark, str(tmp_path / "json"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no tape"):
        tape_files.read_tape(spark, str(tmp_path / "empty"), venue="v")
    (root / "status.json").write_text('{\n"venue": "other"}')
    assert tape_files.read_tape(spark, str(root)).first().source_venue == "other"


def test_index_and_ranges(spark, tmp_path):
    texts = {"AAA/segment-0.jsonl": b"1\n2\n", "BBB/segment-0.jsonl.zst": zstandard.compress(b"3\n4\n5\n")}
    with tarfile.open(tmp_path / "h.tar", "w") as tar:
        for name, data in texts.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    with tarfile.open(tmp_path / "h.tar") as tar:
        members = [{"path": m.name, "offset": m.offset_data, "bytes": m.size, "sha256": hashlib.sha256(texts[m.name]).hexdigest(), "symbol": m.name[:3]} for m in tar]
    size = (tmp_path / "h.tar").stat().st_size
    good = {"kind": "tape_hour_index", "schema": 1, "name": "h", "tape": "t", "tar_bytes": size, "members": members}
    bad = {"a": good | {"kind": "x"}, "b": good | {"name": "other"}, "c": good | {"tar_bytes": None}, "d": good | {"members": [members[0] | {"offset": size}, members[1] | {"sha256": "short"}, members[0]]}, "e": good | {"tape": None}}
    (tmp_path / "index").mkdir()
    for name, doc in {"good": good, **bad}.items():
        (tmp_path / "index" / f"{name}.index.json").write_text(json.dumps(doc))
    docs = archive.read_index(spark, str(tmp_path / "index")).persist()
    planned = docs.select("file").withColumns({"tape": F.lit("t"), "name": F.lit("h")})
    found, wrong = archive.index_members(docs, planned)
    assert found.count() == 2 + 1 + 2
    assert sorted((r.file.rsplit("/", 1)[1][0], r.why[:6]) for r in wrong.collect()) == [("a", "not an"), ("b", "anothe"), ("c", "no siz"), ("d", "not a "), ("d", "not a ")]
    own = found.distinct().withColumn("archive", F.lit(str(tmp_path / "h.tar")))
    assert sorted((r.member, r.line, r.value) for r in archive.read_ranges(own).collect()) == [("AAA/segment-0.jsonl", i, str(i + 1)) for i in range(2)] + [("BBB/segment-0.jsonl.zst", i, str(i + 3)) for i in range(3)]
    assert archive.read_ranges(own.filter("symbol = 'AAA'")).count() == 2


def test_frames_and_coverage_documents(spark, tmp_path):
    frame = spark.createDataFrame([("a", ["x", "y"], 1.5)], "name string, codes array<string>, value double")
    for form in ("parquet", "csv", "json"):
        tape_files.write_frame(frame, str(tmp_path / form), form)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().codes == "x,y"
    assert spark.read.parquet(str(tmp_path / "parquet")).first().codes == ["x", "y"] and spark.read.json(str(tmp_path / "json")).first().value == 1.5
    with pytest.raises(ValueError):
        tape_files.write_frame(frame, str(tmp_path / "other"), "other")
    doc = {"venue": "bybit", "market": "linear", "day": "2024-01-01", "hour": "00", "pid": 1, "window": {"from_ns": 0, "to_ns": HOUR}, "hour_span": {"from_ns": 0, "to_ns": HOUR}, "tiers": [{"name": "all", "feeds": ["trades", "book:50"], "members": {"btc": [[0, HOUR]]}}],
           "shards": [{"index": 0, "tier": "all", "topics": ["publicTrade.BTC"]}], "disconnects": [{"shard": 0, "tier": "all", "topics": ["publicTrade.BTC"], "from_ns": 5, "to_ns": 9}], "overruns": [{"shard": 0, "ns": 7}],
           "book_gaps": [{"topic": "orderbook.50.BTC", "symbol": "btc", "depth": 50, "from_ns": 3, "to_ns": None}], "shed": [], "disk_blocked": []}
    records = spark.createDataFrame([(json.dumps(doc),)], "value string").select(F.from_json("value", coverage.RECORD).alias("r")).select("r.*")
    tape_files.write_coverage(records, str(tmp_path / "coverage"))
    back = tape_files.read_stored_coverage(spark, str(tmp_path / "coverage"))
    assert back.collect() == records.collect()
    cells = {(r.symbol, r.feed): (r.status, list(r.reason_codes)) for r in coverage.ledger(coverage.exploded(back)).collect()}
    assert cells == {("BTC", "trades"): ("excluded", ["shard_disconnected", "queue_overrun"]), ("BTC", "book:50"): ("excluded", ["book_gap"])}


def test_topics(spark):
    asked = {("bybit", "BTC", "book:50"): "orderbook.50.BTC", ("bybit", "BTC", "trades"): "publicTrade.BTC", ("bybit", "BTC", "ticker"): "tickers.BTC", ("bybit", "BTC", "liquidations"): "allLiquidation.BTC", ("bybit", "BTC", "kline:1h"): "kline.60.BTC",
             ("binance", "BTC", "book:1"): "btc@bookTicker", ("binance", "BTC", "book:1000"): "btc@depth@100ms", ("binance", "BTC", "book:20"): "btc@depth20@100ms", ("binance", "BTC", "trades"): "btc@trade", ("binance", "BTC", "ticker"): "btc@markPrice@1s",
             ("binance", "BTC", "liquidations"): "!forceOrder@arr", ("binance", "BTC", "kline:1h"): "btc@kline_1h", ("other", "BTC", "trades"): "", ("bybit", "BTC", "funding"): ""}
    rows = spark.createDataFrame(list(asked), "venue string, symbol string, feed string").withColumn("topic", coverage.topic())
    assert {(r.venue, r.symbol, r.feed): r.topic for r in rows.collect()} == asked


def test_rolled_spans(spark):
    windows = spark.createDataFrame([(h, h * HOUR, (h + 1) * HOUR) for h in range(3)], "hour long, from_ns long, to_ns long")
    spans = spark.createDataFrame([("a", 5, HOUR + 7), ("b", HOUR + 1, None), ("c", 3, 4), ("d", 2 * HOUR, 2 * HOUR)], "key string, start long, end long")
    cut = sorted((r.key, r.hour, r.from_ns, r.to_ns) for r in coverage.rolled(spans, windows, "key").collect())
    assert cut == [("a", 0, 5, HOUR), ("a", 1, HOUR, HOUR + 7), ("b", 1, HOUR + 1, 2 * HOUR), ("b", 2, 2 * HOUR, 3 * HOUR), ("c", 0, 3, 4)]
    left = {(r.key, r.hour): r.to_ns for r in coverage.rolled(spans, windows, "key", keep_open=True).collect()}
    assert left == {("a", 0): None, ("a", 1): HOUR + 7, ("b", 1): None, ("b", 2): None, ("c", 0): 4}
    assert not coverage.rolled(spans, windows.limit(0), "key").collect()


def test_uploads_and_samples(spark, tmp_path):
    stamps = spark.createDataFrame([("bytes=5\n file_count = 2\nother=1\nbytes=7\nnoise\npruned_hours=x", 1_000, 3_500), ("", 9, 5)], "stamp string, modified_ms long, now_ms long")
    a, b = health.upload_fields(stamps).orderBy("modified_ms", ascending=False).collect()
    assert (a.upload_age_ms, a.upload_bytes, a.upload_files, a.upload_pruned_hours, a.archive_free_bytes) == (2500.0, 7.0, 2.0, None, None) and (b.upload_age_ms, b.upload_bytes) == (0.0, None)
    samples = spark.createDataFrame([("tape", "x", 1_704_067_200_000, 1.0), ("tape", "x", 1_706_745_600_000, 2.0)], "kind string, realm string, ts_ms long, fill double")
    health.write_samples(samples, str(tmp_path / "s"))
    health.write_samples(samples.limit(1), str(tmp_path / "s"))
    back = spark.read.json(str(tmp_path / "s"))
    assert sorted((r.month.strftime("%Y-%m") if hasattr(r.month, "strftime") else str(r.month), r.fill) for r in back.collect())[0][1] == 1.0 and back.count() == 3


def test_space_and_retention(spark):
    assert retention.cap_for_space(100, 10, 30) == 80 and retention.cap_for_space(100, 50, 30) == 100 and retention.cap_for_space(10, 0, 30) == 0
    files = [("a", 10, False, 1), ("b", 10, False, 90_000), ("c", 10, True, 90_000), ("d", 10, False, 90_000), ("e", 10, False, 90_001), ("f", 10, False, 200_000)]
    df = spark.createDataFrame(files, "path string, size long, meta boolean, written_s long")

    def plan(cap):
        return {r.path: r.why for r in retention.retention_plan(df, 10, cap).collect()}

    assert plan(50) == {"a": "age"} and plan(49) == {"a": "age", "b": "space"} and plan(25) == {"a": "age", "b": "space", "d": "space", "e": "space"}
    assert plan(0) == {"a": "age"} | dict.fromkeys("bdef", "space")
    assert not retention.retention_plan(df.limit(0), 10, 5).collect()


def test_counters_and_empty_cells(spark):
    running = spark.createDataFrame([("p", 1, 5), ("p", 2, 9)], "pid string, to_ns long, frames long")
    assert [r.frames for r in coverage.counter_deltas(running, ["frames"], "pid").orderBy("to_ns").collect()] == [5, 4]
    tape = widened(spark.createDataFrame([("ticker", "a", 0, 1), ("ticker", "A", 9, 2), ("other", "a", 9, 3)], "kind string, symbol string, local_receive_ts_ns long, seq long"), "seq")
    rows = [tuple(r) for r in coverage.observed_by_feed(tape).collect()]
    assert rows == [("1970-01-01T00", "A", "ticker", 2, 9, 9)]


def test_plan_documents(spark):
    good = {"schema": 1, "tapes": {"bybit-linear": [{"day": "2024-01-01", "hour": "03", "symbols": ["BTC", "ETH"]}, {"day": "2024-01-01", "hour": "03", "symbols": ["BTC", "XRP"]}]}}
    spoiled = {
        "schema": good | {"schema": 2}, "tapes": {"schema": 1}, "tape": {"schema": 1, "tapes": {"a/b": []}}, "list": {"schema": 1, "tapes": {"a": {"day": 1}}}, "hour": {"schema": 1, "tapes": {"a": [{"day": "2024-01-01", "hour": "24", "symbols": []}]}},
        "date": {"schema": 1, "tapes": {"a": [{"day": "2024-02-31", "hour": "01", "symbols": ["A"]}]}}, "name": {"schema": 1, "tapes": {"a": good["tapes"]["bybit-linear"] + [{"day": "2024-01-01", "hour": "01", "symbols": ["a b"]}]}},
        "none": {"schema": 1, "tapes": {"a": [{"day": "2024-01-01", "hour": "01"}]}},
    }
    docs = spark.createDataFrame([("good", json.dumps(good)), ("torn", "{"), *((k, json.dumps(v)) for k, v in spoiled.items())], "file string, raw string")
    asked, bad = retention.plan_requests(docs)
    assert {r.file for r in bad.collect()} == {"torn", *spoiled} and {r.file for r in asked.collect()} == {"good"}
    assert [(r.tape, r.day, r.hour, r.symbols) for r in retention.fetch_plan(asked).collect()] == [("bybit-linear", "2024-01-01", "03", ["BTC", "ETH", "XRP"])]


def test_manifests_of_archives(spark, tmp_path):
    def pack(name, members):
        with tarfile.open(tmp_path / name, "w") as tar:
            for member, data in members.items():
                info = tarfile.TarInfo(member)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))

    receipt = {"kind": "segment", "path": "AAA/segment-0.jsonl", "records": 3, "first_receive_ns": 5, "sha256": "ab"}
    pack("a.tar", {"AAA/segment-0.jsonl": b"1\n", "MANIFEST.json": json.dumps({"files": [receipt, {"kind": "x"}]}).encode()})
    pack("b.tar", {"AAA/segment-0.jsonl": b"1\n"})
    pack("c.tar", {"MANIFEST.json": b"{}"})
    (tmp_path / "d.tar").write_bytes(b"no tar" * 200)
    rows = {r.archive.rsplit("/", 1)[1]: r for r in archive.read_manifests(spark, *(str(p) for p in sorted(tmp_path.glob("*.tar")))).collect()}
    assert (rows["a.tar"].path, rows["a.tar"].records, rows["a.tar"].sha256, rows["a.tar"].error) == ("AAA/segment-0.jsonl", 3, "ab", None)
    assert rows["b.tar"].error == "no MANIFEST.json" and "lists no files" in rows["c.tar"].error and rows["d.tar"].error and len(rows) == 4


def test_strict_reading_names_the_line(spark, tmp_path):
    folder = tmp_path / "2024-01-01" / "00" / "AAA"
    folder.mkdir(parents=True)
    (folder / "segment-000000.jsonl").write_text("".join(line("AAA", i, i) + "\n" for i in range(4)) + "torn\n" + line("AAA", 9, 9) + "\n")
    _, bad = tape_files.read_json_tape(spark, str(tmp_path))
    with pytest.raises(ValueError, match=r"AAA/segment-000000.jsonl, line 5: not a row: torn"):
        tape_files.refuse(bad, str(tmp_path))
    tape_files.refuse(bad.limit(0), str(tmp_path))


def test_meta_documents_and_coverage_files(spark, tmp_path):
    rows = [("tickers_snapshot", "v", "m", 1_704_067_200 * NS + 5, {"symbol": "A", "price": "1"}), ("tickers_snapshot", "v", "m", 1_704_067_200 * NS + 5, {"symbol": "B"}), ("instruments_snapshot", "v", "m", 1_704_067_200 * NS + HOUR, {"symbol": "A"}), ("other", "v", "m", 1_704_067_200 * NS, {"x": "1"})]
    frame = spark.createDataFrame(rows, "kind string, venue string, market string, recorded_at_ns long, row map<string,string>")
    tape_files.write_meta(frame, str(tmp_path))
    back = sorted(((r.kind, r.recorded_at_ns, r.row) for r in tape_files.read_meta(spark, str(tmp_path)).collect()), key=str)
    assert back == sorted(((k, n, m) for k, _, _, n, m in rows if k != "other"), key=str)
    assert tape_files.read_meta(spark, str(tmp_path), ["2024-01-01T01"]).count() == 1
    (tmp_path / "2024-01-01" / "00" / "_meta" / "coverage-1.jsonl").write_text(json.dumps({"venue": "v", "pid": 1, "day": "2024-01-01", "hour": "00"}) + "\n")
    assert [r.pid for r in tape_files.read_coverage(spark, str(tmp_path)).collect()] == [1]
    assert tape_files.day_range("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29"] and tape_files.day_range("2024-01-01", "2024-01-01") == ["2024-01-01"]


def test_hours_are_converted_once(spark, tmp_path):
    rows = [("public_trade" if i % 3 else "ticker", "v", "A", 1_704_067_200 * NS + i * HOUR // 2, i) for i in range(8)]
    tape = widened(spark.createDataFrame(rows, "kind string, venue string, symbol string, local_receive_ts_ns long, seq long"), "seq")
    first = tape_files.convert_hours(tape.filter("seq < 4"), str(tmp_path / "c")).collect()
    assert {(r.hour, r.rows) for r in first} == {("00", 2), ("01", 2)} and {r.hour: r.rows_by_kind for r in first}["00"] == {"public_trade": 1, "ticker": 1}
    again = tape_files.convert_hours(tape, str(tmp_path / "c")).collect()
    assert {(r.hour, r.rows) for r in again} == {("02", 2), ("03", 2)}
    assert tape_files.convert_hours(tape, str(tmp_path / "c")).count() == 0
    assert sorted(r.seq for r in tape_files.read_tape(spark, str(tmp_path / "c"), venue="v").collect()) == list(range(8))


def test_small_expressions(spark):
    from ticklake.functions import scalars
    from ticklake.operators import universe
    from ticklake.schema import kind_view
    from ticklake.sources import normalize

    row = spark.createDataFrame([("12", -1_500_000, 3_600_000_000_001, "book:50", 3.0, 0.0)], "ms string, d long, ns long, feed string, part double, whole double")
    got = row.select(scalars.ms_to_ns("ms"), scalars.floor_ms("d"), *scalars.hour_bounds("ns"), *scalars.feed_parts("feed"), scalars.safe_ratio("part", "whole"), scalars.safe_ratio("part", "part")).first()
    assert list(got) == [12_000_000, -2, 3_600_000_000_000, 7_200_000_000_000, "book", "50", None, 1.0]
    plan = spark.createDataFrame([("A", "trades"), ("A", "book:50"), ("A", "trades"), ("B", "ticker")], "symbol string, feed string")
    assert {r.symbol: r.feeds for r in universe.feeds_of(plan).collect()} == {"A": ["book:50", "trades"], "B": ["ticker"]}
    asked = spark.createDataFrame([(0, 1000, 100, 2, 5), (0, 250, 100, 2, 5), (900, 1000, 100, 2, 5)], "seen long, now long, step long, least long, most long")
    assert [r.n for r in asked.select(normalize.catch_up("seen", "now", "step", "least", "most").alias("n")).collect()] == [5, 3, 2]
    answer = spark.createDataFrame([("binance", "BTC", 7, '{"E":1,"T":2,"lastUpdateId":99,"bids":[["1","2"]],"asks":[]}')], "venue string, symbol string, recv_ns long, payload string")
    r = normalize.depth_answers(answer).first()
    assert (r.update_id, r.depth, r.bids, r.asks, r.exchange_system_ts_ns) == (99, 1000, [["1", "2"]], [], 1_000_000)
    diffs = spark.createDataFrame([(i, i, i - 1 if i != 3 else 0) for i in range(1, 6)], "seq long, update_id long, previous_update_id long").withColumns({"venue": F.lit("v"), "symbol": F.lit("X"), "local_receive_ts_ns": F.col("seq") * 10})
    assert [x.sequence_gap for x in normalize.mark_diffs(diffs).orderBy("seq").collect()] == [True, False, True, False, False]
    resets = spark.createDataFrame([("v", "X", 45)], "venue string, symbol string, local_receive_ts_ns long")
    assert [x.sequence_gap for x in normalize.mark_diffs(diffs, resets).orderBy("seq").collect()] == [True, False, True, False, True]
    tape = widened(spark.createDataFrame([("ticker", 1), ("kline", 2)], "kind string, seq long"), "seq")
    assert [x.seq for x in kind_view(tape, "kline", "other").collect()] == [2]


def test_grid_of_cells(spark):
    hours = spark.createDataFrame([("1970-01-01T00", 0, HOUR)], "hour string, start long, end long")
    grants = spark.createDataFrame([("1970-01-01T00", 1, "v", "m", "all", "A", "trades", 0, HOUR, "")], "hour string, rec long, venue string, market string, tier string, symbol string, feed string, start long, end long, topic string")
    topics = spark.createDataFrame([], "hour string, rec long, topic string, start long, end long, ns long")
    tables = {"hours": hours, "windows": hours, "grants": grants, "disconnects": topics.drop("ns"), "overruns": topics.drop("start", "end"), "shed": spark.createDataFrame([], "hour string, rec long, tier string, feed string, start long, end long"),
              "book_gaps": spark.createDataFrame([], "hour string, symbol string, feed string, start long, end long"), "disk_blocked": hours.limit(0)}
    seen = spark.createDataFrame([("1970-01-01T00", "A", 3, 1, 2), ("1970-01-01T02", "B", 4, 1, 2)], "hour string, symbol string, records long, first_receive_ns long, last_receive_ns long")

    def cells(*args):
        return sorted((r.hour[-2:], r.symbol, r.feed, r.status, r.records) for r in coverage.symbol_ledger(tables, seen, *args).collect())

    assert cells() == [("00", "A", "trades", "complete", 3), ("02", "B", "*", "observed", 4)]
    asked = spark.createDataFrame([("a",), ("C",)], "symbol string")
    assert cells(asked) == [("00", "A", "trades", "complete", 3), ("00", "C", "*", "absent", 0), ("02", "A", "*", "absent", 0), ("02", "C", "*", "absent", 0)]
    assert cells(None, ["trades", "ticker"]) == [("00", "A", "ticker", "absent", 3), ("00", "A", "trades", "complete", 3), ("02", "B", "ticker", "observed", 4), ("02", "B", "trades", "observed", 4)]
