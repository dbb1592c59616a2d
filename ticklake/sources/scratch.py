"""A folder for tables between jobs."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); where that is unset and the driver is the only machine, in a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-ticklake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/ticklake-{uuid.uuid4().hex[:12]}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in the shared folder and read it again: a plan that uses it several times computes it once, and a lost executor costs a read."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of(rows: DataFrame, key: list[Column], most: int) -> list[DataFrame]:
    """``rows`` in parts of ``most`` rows on average, those of one ``key`` in one part; none is empty unless all are."""
    n = -(-rows.count() // most)
    if n < 2:
        return [rows]
    part = F.pmod(F.xxhash64(*key), F.lit(n))
    return [rows.filter(part == i) for i in sorted(r[0] for r in rows.select(part).distinct().collect())]


def in_parts(rows: DataFrame, key: list[Column], most: int, name: str, inner: str, through: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What ``through(part, root)`` reads of the files that it wrote under ``root``, of all ``parts_of`` the rows.

    Before the next part's files are written, a part's result is stored and its
    files go (``clear``), so the files on disk don't grow with the table. Those of
    the last part stay and are read when they are asked for.
    """
    spark, parts = rows.sparkSession, parts_of(rows, key, most)
    home, found = scratch(spark, f"{name}_parts"), []
    for i, part in enumerate(parts):
        root = scratch(spark, name)
        read = through(part, root)
        if i + 1 < len(parts):
            read.write.option("compression", "zstd").parquet(f"{home}/{i}")
            found.append(f"{home}/{i}")
            clear(spark, root, inner)
    return spark.read.schema(read.schema).parquet(*found).unionByName(read) if found else read


def clear(spark: SparkSession, root: str, inner: str) -> None:
    """Delete a path of ``scratch`` with all that it holds: folders below it that match ``inner`` by tasks, which may run again, then the rest."""
    from ticklake.sources.tape_files import folders

    if not re.search("/ticklake-[0-9a-f]{12}/[^/]+$", root):
        raise ValueError(f"no path of scratch: {root}")

    def drop(path: str) -> None:
        store, base = fs.FileSystem.from_uri(path)
        if store.get_file_info(base).type == fs.FileType.Directory:
            store.delete_dir(base)

    def dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                drop(path)
            yield batch

    if found := [(re.sub("^file:/+", "file:///", x),) for x in folders(spark, f"{root}/{inner}")]:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.createDataFrame(found, "path string").repartition(n, F.xxhash64("path")).mapInArrow(dropped, "path string").write.format("noop").mode("overwrite").save()
    drop(root)
