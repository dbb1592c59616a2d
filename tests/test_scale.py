"""What larger tables bring: values of zero, ties, copies, and many rows of one hour."""

import gzip
import json

import duckdb
import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from ticklake.operators import book, carry, coverage, order, universe
from ticklake.plans import file_queries, registry, stream_queries
from ticklake.sources import file_audit, line_files, scratch, tape_files, testbed
from ticklake.streaming import state

START = 1_704_067_200_000_000
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def against_sql(spark, folder, name, events=None, **tables):
    """Rows of a query over small tables, and of its SQL."""
    frames = dict(tables)
    if events is not None:
        rows = spark.createDataFrame(events, "event_id bigint, us bigint, user_id bigint, event_type string, value double, k bigint")
        frames["events"] = rows.select("event_id", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", F.format_string('{"k": %d}', "k").alias("props"))
    db = duckdb.connect()
    for table, frame in frames.items():
        frame.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = registry.QUERIES[name](spark, str(folder))
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = db.execute(f"SELECT {columns} FROM ({registry.SQL[name]})").fetchall()
    return sorted(map(repr, (tuple(r) for r in got.collect()))), sorted(map(repr, want))


def test_days_that_begin_at_zero(spark, tmp_path):
    hour = 3_600_000_000
    values = [(1, 0.0), (1, 5.0), (2, 0.0), (3, 4.0), (3, 9.0), (4, 4.0), (4, 5.0), (5, 0.0), (5, 0.0)]
    events = [(i, START + i * hour, user, "click", value, 1) for i, (user, value) in enumerate(values)]
    got, want = against_sql(spark, tmp_path, "universe_sticky", events)
    assert got == want and len(got) == 4


def test_lookback_at_zero_and_at_ties(spark, tmp_path):
    day = 86_400_000_000
    # two rows of one stamp, the later one first in the file; a price of zero; a row that has only just an earlier one
    rows = [(4, 0, 8.0, 40), (2, 0, 2.0, 20), (5, 3 * day, 6.0, 50), (7, 1, 0.0, 10), (8, 3 * day + 1, 9.0, 10)]
    events = [(seq, START + us, 7, "signup", value, k) for seq, us, value, k in rows]
    got, want = against_sql(spark, tmp_path, "universe_lookback", events)
    assert got == want == [repr(("U7", 5, 0.25, 0.25)), repr(("U7", 8, None, 0.0))]


def test_a_member_listed_twice_is_fetched_once(spark, tmp_path):
    lines = "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_partkey bigint, l_quantity double, l_shipdate timestamp_ntz, l_returnflag string"
    same = [(9, 7, 1, 80, 41.0, "N"), (9, 7, 2, 40, 41.0, "R"), (9, 7, 2, 40, 43.0, "R"), (10, 1, 1, 80, 39.0, "N"), (11, 2, 1, 43, 5.0, "N"), (12, 7, 1, 43, 5.0, "N")]
    rows = spark.createDataFrame(same, "a bigint, b int, c bigint, d bigint, e double, g string").selectExpr("a", "b", "c", "d", "e", "timestamp_ntz '1996-04-15 00:00:00'", "g").toDF(*(c.split()[0] for c in lines.split(", ")))
    got, want = against_sql(spark, tmp_path, "members_to_fetch", lineitem=rows)
    assert got == want and sum("segment-9-7" in r for r in got) == 2  # one for each size


def test_the_driver_gets_a_folder_of_each_task_and_no_list_of_files(spark, tmp_path):
    writer = line_files.LineWriter(f"file://{tmp_path}", "", "job")
    many = pa.RecordBatch.from_arrays([pa.array([f"d/{i // 2:05d}" for i in range(4000)]), pa.array([str(i) for i in range(4000)])], names=["path", "line"])
    told = writer.write(iter([many]))
    assert len(repr(told)) < 1000 and sum(1 for _ in line_files.read_manifest(*fs.FileSystem.from_uri(f"file://{told.folder}"))) == 2000
    writer.abort([told])
    lines = spark.range(4000).select(F.format_string("d%02d/f%04d.gz", F.col("id") % 7, F.expr("id div 2")).alias("path"), F.col("id").cast("string").alias("line"))
    line_files.write_lines(lines.repartition(3, "path").sortWithinPartitions("path", "line"), f"file://{tmp_path}/out", "head", "told")
    told = line_files.read_receipts(spark, f"file://{tmp_path}/out", "told")
    back = file_audit.lines_below(spark, f"file://{tmp_path}/out/*", "f*")
    assert told.count() == back.filter("n = 0 and line = 'head'").count() == lines.select("path").distinct().count()
    assert back.filter("n > 0").count() == 4000 and len(list((tmp_path / "out").glob("told-*.jsonl"))) == 3


def test_moving_a_tasks_files_may_be_repeated(tmp_path):
    folder = tmp_path / "_parts-j" / "0"
    folder.mkdir(parents=True)
    (folder / "manifest.jsonl").write_text("".join(json.dumps({"path": f"a/{n}", "rows": 1, "bytes": 1, "sha256": ""}) + "\n" for n in "xy"))
    for i, n in enumerate("xy"):
        (folder / str(i)).write_text(n)
    line_files.publish(f"file://{tmp_path}", str(folder), "told", "j")
    (tmp_path / "a" / "y").rename(folder / "1")  # as if the first attempt had ended before its last file
    line_files.publish(f"file://{tmp_path}", str(folder), "told", "j")
    assert [(tmp_path / "a" / n).read_text() for n in "xy"] == ["x", "y"]
    assert len((tmp_path / "told-j-0.jsonl").read_text().splitlines()) == 2


def test_a_tape_of_many_segments_is_listed_by_folders(spark, tmp_path):
    for i in range(40):
        folder = tmp_path / "2024-01-01" / f"{i % 2:02d}" / f"S{i // 2}"
        folder.mkdir(parents=True)
        (folder / "segment-000000.jsonl").write_text(json.dumps({"kind": "ticker", "local_receive_ts_ns": i}) + "\n")
    (tmp_path / "segments-x.jsonl").write_text('{"path": "x"}\n')
    rows, bad = tape_files.read_json_tape(spark, f"file://{tmp_path}")
    assert {r.symbol for r in rows.select("symbol", "kind").collect()} == {f"S{i}" for i in range(20)} and bad.collect() == []
    roots = rows._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths()
    assert roots.size() == 2 and len(rows.inputFiles()) == 40  # two hours, and not 40 paths


def test_symbols_of_a_stream_share_states(spark, tmp_path):
    rows = spark.range(6000).selectExpr("'v' AS venue", "concat('S', id % 3000) AS symbol", "id AS seq", "10 * (id div 3000) + id % 7 - 50 * (id div 5000) AS local_receive_ts_ns", "id % 2 AS local_receive_mono_ns")
    rows.write.parquet(f"{tmp_path}/in")
    stream = state.stream_clamped(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start()
    query.awaitTermination()
    columns = ["symbol", "seq", "local_receive_ts_ns", "local_receive_mono_ns"]
    got, want = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").select(columns), order.clamp_late(rows).select(columns)
    assert sorted(got.collect()) == sorted(want.collect()) and got.join(rows, columns, "left_anti").count() > 900
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= state.LANES < 3000


def test_a_run_of_a_stream_lands_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "scratch", lambda spark, name: f"file://{tmp_path}/{name}")
    rows = spark.range(900).selectExpr("'v' AS venue", "concat('S', id % 9) AS symbol", "id AS seq", "id AS local_receive_ts_ns", "id AS local_receive_mono_ns").repartition(8)
    assert stream_queries.replayed(rows, "late", state.stream_clamped).count() == 900
    assert len(list((tmp_path / "late").glob("*.parquet"))) > 3 and len(list((tmp_path / "late_stream" / "checkpoint" / "commits").glob("[0-9]*"))) == 3


def test_only_long_keys_are_cut_by_hours(spark, monkeypatch):
    rows = testbed.tape(spark, "/root/testdata/sf0.001").select("venue", "symbol", "local_receive_ts_ns", "seq", "price")

    def found():
        return carry.carried(rows, ("symbol",), before={"last": F.col("price")}, counts={"n": F.col("price").isNotNull()})

    def samples():
        return sorted(universe.spaced(rows.select("symbol", "local_receive_ts_ns", "seq"), 6 * 3_600_000_000_000).collect())

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    whole, kept = found(), samples()
    assert "Join" not in plan(whole) and plan(whole).count("Window") == 1  # no table with a row for each hour
    sizes = [r["count"] for r in rows.groupBy("symbol").count().collect()]
    most = sorted(sizes)[len(sizes) // 2]
    for module in (carry, universe):
        monkeypatch.setattr(module, "LONG", most)  # half of the symbols are long now
    assert 0 < sum(n > most for n in sizes) < len(sizes)
    assert "Join" in plan(found()) and sorted(map(str, found().select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert samples() == kept and len(kept) > 100


def test_tops_of_short_books_have_no_stretches(spark, monkeypatch):
    judged = book.verdicts(book.book_rows(testbed.book(spark, "/root/testdata/sf0.001")))
    asked = []
    monkeypatch.setattr(book, "stretches", lambda steps: asked.append(steps) or steps)
    assert book.tops(judged).count() > 200 and not asked


def test_cells_meet_their_hour_without_a_sweep(spark, tmp_path, monkeypatch):
    asked, sweep = [], coverage.intersect
    monkeypatch.setattr(coverage, "intersect", lambda a, b, *key: asked.append(key) or sweep(a, b, *key))
    kinds = ("click", "error", "signup", "purchase")
    events = [(i, START + i * 271_000_000, i % 12, kinds[i % 4], 1.0, 9 * (i % 5) + 7 * (i % 2)) for i in range(400)]
    got, want = against_sql(spark, tmp_path, "coverage_ledger", events)
    assert got == want and len(got) > 300 and asked == [("hour",)]
    hours = spark.createDataFrame([("h", 0, 10), ("h", 20, 30), ("g", 0, 10)], "hour string, start bigint, end bigint")
    grants = spark.createDataFrame([("h", "S", "f", 5, 8), ("h", "S", "f", 8, 22), ("h", None, "f", 0, 9), ("h", "T", "f", 10, 20)], "hour string, symbol string, feed string, start bigint, end bigint")
    assert sorted(map(tuple, coverage.granted_spans(grants, hours).collect())) == [("h", "S", "f", 5, 10), ("h", "S", "f", 20, 22)]


def test_landed_files_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "PER_FILE", 7)
    monkeypatch.setattr(stream_queries, "scratch", lambda spark, name: f"file://{tmp_path}/{name}")
    events = [(i, START + i * 1_000_000, i % 5, "click", 2.0, i % 6) for i in range(100)]
    got, want = against_sql(spark, tmp_path, "stream_frames", events)
    assert got == want and len(got) > 80
    assert len(list((tmp_path / "landed_bybit").glob("frames-*"))) == 15  # and not 8
    assert len(list((tmp_path / "stream_bybit" / "checkpoint" / "commits").glob("[0-9]*"))) == 2


def test_segments_are_damaged_by_their_receipts(spark, tmp_path, monkeypatch):
    form, damage, asked = DataFrameReader.format, file_queries.damaged, []
    monkeypatch.setattr(DataFrameReader, "format", lambda self, name: asked.append(name) or form(self, name))
    monkeypatch.setattr(file_queries, "damaged", lambda *a: (damage(*a), damage(*a)))  # a task may run again
    events = [(i, START + i * 7_200_000_000 - i % 4 * 3_600_000_000, i % 23, "click", 2.0, i % 6) for i in range(400)]
    got, want = against_sql(spark, tmp_path, "audit_stored", events)
    assert got == want and len(got) > 80
    assert "binaryFile" not in asked  # a listing of each file by the driver


def test_a_folder_of_many_folders_is_dealt_out(spark, tmp_path):
    names = ["x", "a/x", "a/b/x", "a/b/y", *(f"a/c/s{i}/x" for i in range(30)), "a/c/s1/d/e/x", "a/.h/x", "a/_parts-1/x", "a/c/.x", "_temporary/x"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    found = file_audit.files_below(spark, f"file://{tmp_path}/*", "x*")
    assert sorted(r.file for r in found.collect()) == sorted(f"file://{tmp_path}/{n}" for n in names[:3] + names[4:35])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 3  # the 30 folders of one are listed by several tasks
    assert sorted(file_audit.entries(f"file://{tmp_path}/a/b")) == [(f"file://{tmp_path}/a/b/{n}", False) for n in "xy"]


def scratch_below(folder, made=None):
    """A stand-in for ``scratch`` that makes its paths below ``folder`` and notes them."""

    def path(spark, name):
        made.append(folder / f"ticklake-{len(made):012x}" / name)
        return f"file://{made[-1]}"

    made = [] if made is None else made
    return path


def test_segments_of_a_part_are_all_that_lies_on_disk(spark, tmp_path, monkeypatch):
    made, held, read = [], [], tape_files.read_tape
    for module in (scratch, file_queries):
        monkeypatch.setattr(module, "scratch", scratch_below(tmp_path, made))
    monkeypatch.setattr(tape_files, "read_tape", lambda *a, **k: held.append(len(list(tmp_path.rglob("segment-0*")))) or read(*a, **k))
    monkeypatch.setattr(file_queries, "SEGMENT_ROWS", 90)
    events = [(i, START + i * 1_500_000_000 - i % 4 * 3_600_000_000, i % 7, "click", 2.0, i % 6) for i in range(400)]
    got, want = against_sql(spark, tmp_path, "tape_layouts", events)
    assert got == want and len(got) == 1200
    assert 2 < sum(n > 0 for n in held) <= 7 and max(held) < 200  # several parts, none with most of the files
    assert [p.exists() for p in made if p.name == "segments"] == [*[False] * 4, True]  # the last part's stay


def test_only_scratch_folders_are_cleared(spark, tmp_path):
    path = tmp_path / "ticklake-0123456789ab" / "x"
    for folder in (tmp_path / "tape", path):
        (folder / "a" / "b" / "c").mkdir(parents=True)
        for name in ("top", "a/one", "a/b/two", "a/b/c/three"):
            (folder / name).write_text("")
    with pytest.raises(ValueError, match="no path of scratch"):
        scratch.clear(spark, f"file://{tmp_path}/tape", "*/*")
    scratch.clear(spark, f"file://{path}", "*/*")
    assert not path.exists() and (tmp_path / "tape" / "a" / "b" / "c" / "three").exists()
    scratch.clear(spark, f"file://{path}", "*/*")  # a task may run again


def test_gzipped_segments_are_read_alike_by_tasks(spark, tmp_path):
    rows = [json.dumps({"kind": "ticker", "symbol": "aa" if i % 2 else None, "local_receive_ts_ns": i, "values": {"mark_price": 1.5}, "bids": [["1", "2"]]}) for i in range(5)]
    bad = [b"", b"no row", b"  ", b'{"kind": 3, "local_receive_ts_ns": "x"}', b'{"kind": "\xff"}']
    for day, hour, dir, member in (("2024-01-01", "00", "Aa", "segment-000000"), ("2024-01-01", "01", "Aa", "segment-000012"), ("2024-01-02", "00", "B", "segment-000000"), ("2024-01-02", "00", "_meta", "segment-000000")):
        folder = tmp_path / "t" / day / hour / dir
        folder.mkdir(parents=True)
        (folder / f"{member}.jsonl.gz").write_bytes(gzip.compress(b"\n".join([*(r.encode() for r in rows), *bad])))
    (tmp_path / "t" / "2024-01-01" / "00" / "_odd").mkdir()
    (tmp_path / "t" / "2024-01-01" / "00" / "_odd" / "segment-000000.jsonl.gz").write_bytes(gzip.compress(b"{}\n"))
    root = f"file://{tmp_path}/t"
    got, want = tape_files.read_gzipped_tape(spark, root), tape_files.read_json_tape(spark, root)[0]
    assert got.columns == want.columns and got.dtypes == want.dtypes
    names = [c for c in got.columns if c != "seq"]
    assert sorted(map(repr, got.select(names).collect())) == sorted(map(repr, want.select(names).collect())) and got.count() == 15
    w = F.row_number().over(tape_files.Window.partitionBy("symbol").orderBy("seq"))
    order = [sorted(map(tuple, x.select("symbol", "day", "hour", "local_receive_ts_ns", w).collect())) for x in (got, want)]
    assert order[0] == order[1]
    plan = tape_files.read_tape(spark, root, venue="v")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Relation" not in plan
    (tmp_path / "t" / "2024-01-02" / "00" / "B" / "segment-000001.jsonl").write_text(rows[0] + "\n")
    assert tape_files.read_gzipped_tape(spark, root) is None and len(tape_files.read_tape(spark, root, venue="v").collect()) == 16


def test_lines_of_small_and_large_files(tmp_path, monkeypatch):
    for name, pack in (("a.gz", gzip.compress), ("b.txt", bytes)):
        (tmp_path / name).write_bytes(pack(b"x\ny\r\n\nz"))
        for size in (1 << 16, 4):
            monkeypatch.setattr(file_audit, "SMALL", size)
            assert list(file_audit.lines_in(f"file://{tmp_path}/{name}")) == [b"x\n", b"y\r\n", b"\n", b"z"]
    (tmp_path / "c.gz").write_bytes(gzip.compress(b"x" * 100)[:-9])
    for size in (1 << 16, 4):
        monkeypatch.setattr(file_audit, "SMALL", size)
        with pytest.raises(EOFError):
            list(file_audit.lines_in(f"file://{tmp_path}/c.gz"))


def test_day_files_of_a_part_are_all_that_lies_on_disk(spark, tmp_path, monkeypatch):
    made, held, read = [], [], file_queries.day_files
    for module in (scratch, file_queries):
        monkeypatch.setattr(module, "scratch", scratch_below(tmp_path, made))
    monkeypatch.setattr(file_queries, "day_files", lambda *a: held.append(len(list(tmp_path.rglob("*.csv.gz")))) or read(*a))
    monkeypatch.setattr(file_queries, "DAY_ROWS", 150)
    kinds = ("click", "error", "signup", "purchase")
    events = [(i, START + i * 1_500_000_000, i % 7, kinds[i % 4], 1.5, i % 6) for i in range(400)]
    got, want = against_sql(spark, tmp_path, "export_day_files", events)
    assert got == want and len(got) > 600
    assert len(held) == 3 and max(held) < sum(held) == 189  # files of different symbols, never all of them at a time
    assert [p.exists() for p in made if p.name == "day_files"] == [False, False, True]
