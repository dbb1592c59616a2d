"""The index of a columnar tape: what the footers say of each row group, and whether its rows bear it out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.order import RECV
from ticklake.sources.file_audit import listed
from ticklake.sources.tape_files import folders

GROUPS = "file string, row_group int, rows bigint, bytes bigint, first_ns bigint, last_ns bigint, symbol_low string, symbol_high string, error string"
CONTENT = "file string, row_group int, kind string, rows bigint, first_ns bigint, last_ns bigint, error string"


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def opened(file: str) -> pq.ParquetFile:
    store, path = fs.FileSystem.from_uri(file)
    return pq.ParquetFile(store.open_input_file(path), page_checksum_verification=True)


def footer_rows(file: str) -> list[tuple]:
    """A row of GROUPS for each row group, from the footer alone; one with ``error`` if there is no footer."""
    try:
        meta = opened(file).metadata
    except (OSError, pa.ArrowException) as why:
        return [(file, None, *(None,) * 6, f"{type(why).__name__}: {why}"[:200])]
    at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    rows = []
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        bounds = []
        for name in (RECV, "symbol"):
            stats = group.column(at[name]).statistics if name in at else None
            bounds += [stats.min, stats.max] if stats is not None and stats.has_min_max else [None, None]
        rows.append((file, g, group.num_rows, group.total_byte_size, *bounds, None))
    return rows


def content_rows(file: str, groups: list[int]) -> Iterator[pa.RecordBatch]:
    """A row of CONTENT for each kind in each of the row groups; one with ``error`` for a group that can't be read."""
    for g in groups:
        try:
            table = opened(file).read_row_group(g, columns=[RECV, "kind"])
            found = table.group_by("kind").aggregate([(RECV, "count"), (RECV, "min"), (RECV, "max")]).to_pydict()
            rows = [(file, g, *r, None) for r in zip(found["kind"], found[f"{RECV}_count"], found[f"{RECV}_min"], found[f"{RECV}_max"], strict=True)]
        except (OSError, pa.ArrowException) as why:
            rows = [(file, g, None, None, None, None, f"{type(why).__name__}: {why}"[:200])]
        yield batch_of(rows, CONTENT)


def index(spark: SparkSession, root: str) -> DataFrame:
    """GROUPS of all Parquet files below ``root``: folders are listed and footers read by tasks."""
    tops = [re.sub("^file:/+", "file:///", x) for x in folders(spark, f"{root}/*")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for top in batch.column(0).to_pylist():
                yield batch_of([(x,) for x in listed(top, "*.parquet")], "file string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                yield batch_of(footer_rows(file), GROUPS)

    tree = spark.createDataFrame([(x,) for x in tops], "top string").repartition(min(n, max(1, len(tops))))
    return tree.mapInArrow(find, "file string").repartition(n, F.xxhash64("file")).mapInArrow(read, GROUPS)


def content(groups: DataFrame) -> DataFrame:
    """CONTENT of the row groups that ``index`` names: two columns of each group are read and its pages checked, a group at a time, dealt over all tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from content_rows(file, [g])

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = groups.filter("row_group is not null").select("file", "row_group")
    return asked.repartition(n, "file", "row_group").mapInArrow(read, CONTENT)


def groups_of(groups: DataFrame, start_ns: int | None = None, end_ns: int | None = None, symbol: str | None = None) -> DataFrame:
    """The row groups that a read of [start_ns, end_ns) and a symbol touches, by the index alone."""
    tests: list[Column] = []
    if start_ns is not None:
        tests.append(F.col("last_ns").isNull() | (F.col("last_ns") >= start_ns))
    if end_ns is not None:
        tests.append(F.col("first_ns").isNull() | (F.col("first_ns") < end_ns))
    if symbol is not None:
        tests.append(F.col("symbol_low").isNull() | F.lit(symbol).between(F.col("symbol_low"), F.col("symbol_high")))
    for test in tests:
        groups = groups.filter(test)
    return groups


def verified(groups: DataFrame, found: DataFrame) -> DataFrame:
    """What is wrong with an index: file, row_group, why. ``found``: ``content`` of the groups."""
    seen = found.groupBy("file", "row_group").agg(F.sum("rows").alias("_rows"), F.min("first_ns").alias("_first"), F.max("last_ns").alias("_last"), F.min("error").alias("_error"))
    both = groups.join(seen, ["file", "row_group"], "left")
    outside = F.coalesce((F.col("_first") < F.col("first_ns")) | (F.col("_last") > F.col("last_ns")), F.lit(False))
    why = F.coalesce("error", "_error", F.when(~F.col("rows").eqNullSafe(F.coalesce("_rows", F.lit(0))), "other number of rows"), F.when(outside, "rows outside the bounds"))
    return both.select("file", "row_group", why.alias("why")).filter("why is not null")


def described(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Each file: groups, rows, bytes, first and last stamp, and rows by kind."""
    kinds = found.filter("kind is not null").groupBy("file", "kind").agg(F.sum("rows").alias("n"))
    by_kind = kinds.groupBy("file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "n")))).alias("rows_by_kind"))
    told = groups.groupBy("file").agg(F.count("row_group").alias("groups"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("first_ns").alias("first_ns"), F.max("last_ns").alias("last_ns"))
    return told.join(by_kind, "file", "left")
