"""The tape on disk: JSON lines by day, hour and symbol, Parquet, receipts and meta documents."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticklake.operators.coverage import RECORD
from ticklake.operators.order import RECV, utc_day_hour
from ticklake.schema import TAPE, tape_columns
from ticklake.sources.file_audit import files_below, lines_below, walked_files
from ticklake.sources.line_files import read_receipts, write_lines
from ticklake.sources.scratch import stored

META = "_meta"
RECEIPT = (
    "kind string, recorded_at_ns bigint, path string, symbol string, day string, hour string, records bigint, first_receive_ns bigint, "
    "last_receive_ns bigint, compressed_bytes bigint, sha256 string"
)
PATH = r"(\d{4}-\d{2}-\d{2})/(\d{2})/([^/]+)/([^/]+)$"


def hour_range(start: str, end: str) -> list[str]:
    """Hours ``YYYY-MM-DDTHH`` from start to end, end excluded; the same hour twice means that hour."""
    a, b = (datetime.strptime(x, "%Y-%m-%dT%H").replace(tzinfo=timezone.utc) for x in (start, end))
    if b < a:
        raise ValueError(f"{end} is before {start}")
    n = max(1, int((b - a).total_seconds() // 3600))
    return [(a + timedelta(hours=i)).strftime("%Y-%m-%dT%H") for i in range(n)]


def day_range(start: str, end: str) -> list[str]:
    """Days from start to end, end excluded; the same day twice means that day."""
    return sorted({h[:10] for h in hour_range(f"{start}T00", f"{end}T00")})


def globs(root: str, hours: list[str] | None, symbols: list[str] | None, name: str) -> list[str]:
    """Path patterns of some hours and symbols, so that only their files are listed."""
    days = [f"{h[:10]}/{h[11:13]}" for h in hours] if hours else ["*/*"]
    letters = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in x) for x in symbols] if symbols else ["*"]
    return [f"{root}/{d}/{s}/{name}" for d in days for s in letters]


#: Bits of a row's place in its symbol's tape: hours since 2010, segment, MB at which the split starts, row.
HOUR_BITS, SEGMENT_BITS, START_BITS, ROW_BITS = 18, 14, 7, 24


def tape_place(day: Column, hour: Column, segment: Column, start_mb: Column, row: Column) -> Column:
    """A row's place among all rows of its symbol's tape, as one number that grows over hours, segments and lines; raises where a part is too large for its bits."""

    def part(value: Column, bits: int, name: str) -> Column:
        value = F.coalesce(value.cast("bigint"), F.lit(0))
        return F.when(value < 2**bits, value).otherwise(F.raise_error(F.concat(F.lit(f"{name} over {2**bits - 1}: "), value.cast("string"))).cast("bigint"))

    hours = F.datediff(day.try_cast("date"), F.lit("2010-01-01").cast("date")) * 24 + hour.try_cast("int")
    out = part(hours, HOUR_BITS, "hours since 2010")
    for value, bits, name in ((segment, SEGMENT_BITS, "segment"), (start_mb, START_BITS, "megabytes before a split of a segment"), (row, ROW_BITS, "rows of a read task (lower spark.sql.files.maxPartitionBytes)")):
        out = F.shiftleft(out, bits) + part(value, bits, name)
    return out


def segment_number(path: Column) -> Column:
    return F.regexp_extract(path, r"segment-0*([0-9]+)[^/]*$", 1).try_cast("bigint")


def row_of_task() -> Column:
    """The row's number in its task, which grows within a split."""
    return F.monotonically_increasing_id().bitwiseAND(2**33 - 1)


def located(rows: DataFrame) -> DataFrame:
    """Adds day, hour, symbol of the file, its member path and the line's place in the tape of its folder's symbol."""
    path = F.col("_metadata.file_path")
    part = {n: F.regexp_extract(path, PATH, i) for n, i in (("day", 1), ("hour", 2), ("dir", 3), ("member", 4))}
    return rows.withColumns(part | {"line": tape_place(part["day"], part["hour"], segment_number(path), F.shiftright("_metadata.file_block_start", 20), row_of_task())})


def read_json_tape(spark: SparkSession, root: str, hours: list[str] | None = None, symbols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the segments (any compression that Spark reads) and the lines that don't parse.

    Rows: the wide columns, day, hour, member and ``seq``, the line's place in the symbol's whole tape. Bad
    lines: day, hour, dir, member, line and text; none is lost.
    """
    reader = spark.read.schema(f"{TAPE}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    if hours or symbols:
        rows = located(reader.json(globs(root, hours, symbols, "segment-*")))
    else:  # tasks list the hours, not each file as a path of its own; a listing of its own sees files that came after an earlier read was persisted
        whole = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "segment-*").option("listing", uuid.uuid4().hex)
        rows = located(whole.json(f"{root}/*/*")).filter("day <> ''")
    rows = rows.filter(F.col("dir") != META)
    good = rows.filter("_bad is null").drop("_bad").withColumn("symbol", F.upper(F.coalesce("symbol", "dir"))).withColumnRenamed("line", "seq").drop("dir")
    # Spark refuses to read the corrupt column alone, so another one goes with it
    text = F.concat("_bad", F.coalesce(F.substring("kind", 1, 0), F.lit("")))
    return good, rows.filter("_bad is not null").select("day", "hour", "dir", "member", "line", text.alias("_bad"))


def read_gzipped_tape(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of ``read_json_tape``, where all segments end in ``.gz`` (none otherwise): no reader splits such files, and tasks that list and read many small ones open each at a tenth of what it costs Spark's reader."""
    if not files_below(spark, f"{root}/*", "segment-*").filter(~F.col("file").endswith(".gz")).isEmpty():
        return None
    lines = lines_below(spark, f"{root}/*", "segment-*")
    part = {n: F.regexp_extract("file", PATH, i) for n, i in (("day", 1), ("hour", 2), ("dir", 3), ("member", 4))}
    lines = lines.withColumns(part).filter("day <> '' and not startswith(dir, '_')")
    place = tape_place(F.col("day"), F.col("hour"), segment_number(F.col("file")), F.lit(0), F.col("n"))
    row = F.from_json("line", f"{TAPE}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.select(row.alias("row"), "day", "hour", "member", place.alias("seq"), "dir").filter("row is not null and row._bad is null")
    return rows.select(*(F.col(f"row.{c}").alias(c) for c, _ in tape_columns()), "day", "hour", "member", "seq", "dir").withColumn("symbol", F.upper(F.coalesce("symbol", "dir"))).drop("dir")


def skipped(bad: DataFrame) -> DataFrame:
    """Bad lines of each file and the first of them."""
    return bad.groupBy("day", "hour", "dir", "member").agg(F.count("*").alias("skipped_rows"), F.min_by("_bad", "line").alias("first_cause"))


def refuse(bad: DataFrame, root: str | None = None) -> None:
    """Strict reading: raises on the first bad line, naming its file and, below ``root``, the line's number in it."""
    first = bad.orderBy("day", "hour", "dir", "member", "line").first()
    if not first:
        return
    where = f"{first.day}/{first.hour}/{first.dir}/{first.member}"
    if root is not None:
        lines = located(bad.sparkSession.read.text(f"{root}/{where}"))
        place = lines.filter(F.col("value") == first["_bad"]).agg(F.min("line")).first()[0]
        where += f", line {lines.filter(F.col('line') <= place).count()}"
    raise ValueError(f"{where}: not a row: {first['_bad'][:200]}")


def filed(tape: DataFrame) -> DataFrame:
    """Rows with the day and hour they are filed under; rows without a stamp or symbol are left out."""
    day, hour = utc_day_hour()
    return tape.filter(f"{RECV} is not null and coalesce(symbol, '') <> ''").withColumns({"day": day, "hour": hour})


def write_json_tape(tape: DataFrame, root: str, rows_per_file: int = 1_000_000, by: tuple[str, ...] = ("day", "hour", "dir")) -> None:
    """Segments by day, hour and symbol (key=value folders), rows of a file in order; ``by`` may name fewer of them for a thin tape."""
    n = int(tape.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = filed(tape).withColumn("dir", F.upper("symbol"))
    rows = rows.repartition(n, *by).sortWithinPartitions(*by, RECV, "seq")
    rows.select(*(c for c, _ in tape_columns()), "day", "hour", "dir").write.partitionBy(*by).option("maxRecordsPerFile", rows_per_file).option("compression", "gzip").json(root)


def write_segments(tape: DataFrame, root: str, rows_per_segment: int = 500_000) -> DataFrame:
    """Segments ``day/hour/SYMBOL/segment-NNNNNN.jsonl.gz`` with rows in order; returns their receipts: hour, path (below the hour), records, stamps, compressed bytes and SHA-256.

    A symbol's hour is numbered in one sorted group, which also puts its segments
    in one task. What the sink saw of each file stays in ``segments-*.jsonl``.
    """
    w = Window.partitionBy("day", "hour", "dir").orderBy(RECV, "seq")
    n = int(tape.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = filed(tape).withColumn("dir", F.upper("symbol")).repartition(n, "day", "hour", "dir").withColumn("_n", F.row_number().over(w))  # by files, of which few bytes may hold many
    name = F.concat(F.lit("segment-"), F.lpad(F.expr(f"(_n - 1) div {rows_per_segment}").cast("string"), 6, "0"), F.lit(".jsonl.gz"))
    rows = rows.withColumn("path", F.concat_ws("/", "day", "hour", "dir", name))
    lines = rows.select("day", "hour", "dir", "_n", "path", F.to_json(F.struct(*(c for c, _ in tape_columns()))).alias("line"))
    write_lines(lines.sortWithinPartitions("day", "hour", "dir", "_n"), root, receipts="segments")
    told = rows.groupBy("day", "hour", "dir", "path").agg(F.count("*").alias("records"), F.min(RECV).alias("first_receive_ns"), F.max(RECV).alias("last_receive_ns")).drop("day", "hour", "dir")
    seen = read_receipts(tape.sparkSession, root, "segments").select("path", F.col("bytes").alias("compressed_bytes"), "sha256")
    hour = F.concat_ws("T", F.split("path", "/")[0], F.split("path", "/")[1])
    return told.join(seen, "path").withColumn("hour", hour).withColumn("path", F.substring_index("path", "/", -2))


def read_partitioned_json(spark: SparkSession, root: str) -> DataFrame:
    """Segments that ``write_json_tape`` wrote; day and hour prune folders."""
    return spark.read.schema(f"{TAPE}, day string, hour string, dir string").json(root)


def write_columnar(tape: DataFrame, path: str, by: tuple[str, ...] = ("venue", "day", "hour")) -> None:
    """Parquet by venue, day and hour (or less), sorted by symbol, kind and order, so that row-group statistics prune; ``seq`` keeps the order of kinds."""
    n = int(tape.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = filed(tape).repartition(n, *by, "symbol").sortWithinPartitions(*by, "symbol", "kind", RECV, "seq")
    rows.write.partitionBy(*by).mode("ignore").option("compression", "zstd").parquet(path)


def convert_hours(tape: DataFrame, path: str) -> DataFrame:
    """Add the hours of ``tape`` that the columnar tape at ``path`` doesn't hold yet; returns them: venue, day, hour, rows and rows by kind.

    Hours that are there are left alone, so a conversion that was cut off goes on
    with what is missing.
    """
    spark = tape.sparkSession
    held = [re.search(r"venue=([^/]*)/day=([^/]*)/hour=([^/]*)$", x).groups() for x in folders(spark, f"{path}/venue=*/day=*/hour=*")]
    rows = filed(tape)
    if held:
        rows = rows.join(spark.createDataFrame(held, "venue string, day string, hour string"), ["venue", "day", "hour"], "left_anti")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = rows.groupBy("venue", "day", "hour", "kind").agg(F.count("*").alias("n"))
    told = kinds.groupBy("venue", "day", "hour").agg(F.sum("n").alias("rows"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "n")))).alias("rows_by_kind"))
    told = stored(told, "converted")  # before the hours are there
    dealt = rows.repartition(n, "venue", "day", "hour", "symbol").sortWithinPartitions("venue", "day", "hour", "symbol", "kind", RECV, "seq")
    dealt.write.partitionBy("venue", "day", "hour").mode("append").option("compression", "zstd").parquet(path)
    return told


def index_summary(files: DataFrame) -> DataFrame:
    """Rows and stamps by file and kind of a columnar tape."""
    return files.groupBy(F.col("_metadata.file_name").alias("file"), "kind").agg(F.count("*").alias("n"), F.min(RECV).alias("first_ns"), F.max(RECV).alias("last_ns"))


def rows_as_json(tape: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows in total order as compact JSON with sorted keys, those of ``values`` too, nulls left out."""
    ordered = tape.orderBy(RECV, "symbol", "seq")
    ordered = ordered.limit(limit) if limit is not None else ordered
    ordered = ordered.withColumn("values", F.map_from_entries(F.array_sort(F.map_entries("values"))))
    return ordered.select(F.to_json(F.struct(*sorted(c for c, _ in tape_columns()))).alias("value"))


def file_name(path: Column) -> Column:
    """A file's path in one spelling; local ones come with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def segment_receipts(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Records, stamps, bytes and SHA-256 of each file that ``rows`` were read from."""
    count = rows.groupBy(file_name(F.col("_metadata.file_path")).alias("file")).agg(F.count("*").alias("records"), F.min(RECV).alias("first_receive_ns"), F.max(RECV).alias("last_receive_ns"))
    stored = file_digests(spark, root)
    return count.join(stored, "file").withColumnRenamed("bytes", "compressed_bytes")


def file_digests(spark: SparkSession, root: str) -> DataFrame:
    """Bytes and SHA-256 of every file below ``root``, hashed in blocks; both null where a file can't be read."""
    return walked_files(spark, root, rows=False).select(file_name(F.col("file")).alias("file"), "bytes", "sha256")


def read_meta(spark: SparkSession, root: str, hours: list[str] | None = None) -> DataFrame:
    """Instrument and ticker snapshots, a row for each table row as a map."""
    schema = "kind string, venue string, market string, recorded_at_ns bigint, rows array<map<string,string>>"
    docs = spark.read.schema(schema).json(globs(root, hours, [META], "*"))
    return docs.filter(F.col("kind").isin("instruments_snapshot", "tickers_snapshot")).select("kind", "venue", "market", "recorded_at_ns", F.explode("rows").alias("row"))


def write_meta(snapshots: DataFrame, root: str) -> None:
    """Snapshots (kind, venue, market, recorded_at_ns, row: a map for each table row) as one document each, ``day/hour/_meta/KIND-VENUE-MARKET-STAMP.json.gz``; ``read_meta`` reads them."""
    docs = snapshots.groupBy("kind", "venue", "market", "recorded_at_ns").agg(F.collect_list("row").alias("rows"))
    day, hour = utc_day_hour("recorded_at_ns")
    name = F.concat(F.concat_ws("-", "kind", "venue", "market", F.col("recorded_at_ns").cast("string")), F.lit(".json.gz"))
    lines = docs.select(F.concat_ws("/", day, hour, F.lit(META), name).alias("path"), F.to_json(F.struct("kind", "venue", "market", "recorded_at_ns", "rows")).alias("line"))
    write_lines(lines.repartition("path"), root)


def read_coverage(spark: SparkSession, root: str, hours: list[str] | None = None) -> DataFrame:
    return spark.read.schema(RECORD).json(globs(root, hours, [META], "coverage-*"))


def fold_receipts(receipts: DataFrame, order: str = "line") -> DataFrame:
    """The last receipt of each path; a path whose last one is a deletion goes."""
    w = Window.partitionBy("path").orderBy(F.desc(order))
    last = receipts.filter("path is not null").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return last.filter(~F.col("kind").endswith("_deleted"))


def first_of_cadence(snapshots: DataFrame, cadence: str = "day") -> DataFrame:
    """One snapshot of each kind for each day or hour: the first."""
    slot = F.date_format(F.timestamp_seconds(F.expr("recorded_at_ns div 1000000000")), "yyyy-MM-dd" if cadence == "day" else "yyyy-MM-dd'T'HH")
    w = Window.partitionBy("venue", "kind", "slot").orderBy("recorded_at_ns")
    return snapshots.withColumn("slot", slot).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def write_coverage(records: DataFrame, root: str) -> None:
    """Coverage documents (columns of ``RECORD``) filed under their hour (key=value folders), a line for each process; ``read_stored_coverage`` reads them."""
    names = [f.name for f in StructType.fromDDL(RECORD).fields]
    rows = records.select(F.col("day").alias("on_day"), F.col("hour").alias("in_hour"), F.to_json(F.struct(*names)).alias("value"))
    rows.repartition("on_day", "in_hour").write.partitionBy("on_day", "in_hour").mode("append").option("compression", "gzip").text(root)


def read_stored_coverage(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{RECORD}, on_day string, in_hour string").json(root).drop("on_day", "in_hour")


def write_frame(frame: DataFrame, path: str, form: str = "parquet") -> None:
    """Bars, quality, ledgers or summaries as ``parquet``, ``csv`` with a header or ``json`` lines; lists become comma-separated text in CSV."""
    if form == "csv":
        frame = frame.select(*(F.array_join(f"`{f.name}`", ",").alias(f.name) if f.dataType.typeName() == "array" else F.col(f"`{f.name}`") for f in frame.schema.fields))
        frame.write.mode("overwrite").option("header", True).csv(path)
    elif form in ("parquet", "json"):
        frame.write.mode("overwrite").format(form).save(path)
    else:
        raise ValueError(f"no such form: {form}")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found) if found else []


def read_tape(spark: SparkSession, root: str, hours: list[str] | None = None, symbols: list[str] | None = None, venue: str | None = None) -> DataFrame:
    """Rows of a tape in whatever layout ``root`` holds it, with ``source_venue``; bad lines are left out (``read_json_tape`` returns them).

    Layouts: segments by day, hour and symbol; what ``write_json_tape`` and
    ``write_columnar`` wrote; tars of hours. Raises where there is none, more
    than one, or no venue: that of status.json, of the folder's name, or the given one.
    """
    status = folders(spark, f"{root}/status.json")
    told = spark.read.schema("venue string").option("multiLine", True).json(status[0]).first() if status else None
    source = venue_of(root.rstrip("/").rsplit("/", 1)[-1].rsplit(":", 1)[-1], venue, told.venue if told else None)
    shapes = {"segments": "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]", "json": "day=*", "columnar": "venue=*", "archives": "*.tar"}
    held = {name: folders(spark, f"{root}/{shape}") for name, shape in shapes.items()}
    kinds = [name for name, paths in held.items() if paths]
    if len(kinds) != 1:
        raise ValueError(f"{root} holds {' and '.join(kinds) or 'no tape'}")
    if kinds == ["segments"]:
        rows = None if hours or symbols else read_gzipped_tape(spark, root)
        if rows is None:
            rows, _ = read_json_tape(spark, root, hours, symbols)
    elif kinds == ["json"]:
        rows = located_stored(spark.read.schema(f"{TAPE}, day string, hour string, dir string").json(root))
    elif kinds == ["columnar"]:
        rows = spark.read.option("basePath", root).schema(f"{TAPE}, seq bigint, day string, hour string").parquet(root)
    else:
        from ticklake.sources.archive import archive_lines, list_members

        members = list_members(spark, *held["archives"])
        if hours is not None:
            members = members.filter(F.concat_ws("T", "day", "hour").isin(hours))
        if symbols is not None:
            members = members.filter(F.col("symbol").isin([s.upper() for s in symbols]))
        lines = archive_lines(members)
        place = tape_place(F.col("day"), F.col("hour"), segment_number(F.col("member")), F.lit(0), F.col("line"))
        rows = lines.select("day", "hour", "member", F.col("symbol").alias("_dir"), place.alias("seq"), F.inline(F.array(F.from_json("value", TAPE))))
        rows = rows.filter("kind is not null").withColumn("symbol", F.upper(F.coalesce("symbol", "_dir"))).drop("_dir")
    if hours is not None:
        rows = rows.filter(F.concat_ws("T", "day", "hour").isin(hours))
    if symbols is not None:
        rows = rows.filter(F.col("symbol").isin([s.upper() for s in symbols]))
    return rows.withColumn("source_venue", F.lit(source))


def located_stored(rows: DataFrame) -> DataFrame:
    """Rows of stored JSON segments with ``seq``, their place in the symbol's tape; a task that wrote several files numbered them."""
    number = F.regexp_extract("_metadata.file_name", r"\.c([0-9]+)\.", 1).try_cast("bigint")
    place = tape_place(F.col("day"), F.col("hour"), number, F.shiftright("_metadata.file_block_start", 20), row_of_task())
    return rows.withColumn("seq", place).drop("dir")


def venue_of(name: str, given: str | None = None, status: str | None = None) -> str:
    """The venue of a source: the given one, else its status document's, else the letters before a dash in its name."""
    head, dash, _ = name.partition("-")
    for found in (given, status, head if dash and head.isalpha() else None):
        if found:
            return found.lower()
    raise ValueError(f"no venue for {name}; name one")
