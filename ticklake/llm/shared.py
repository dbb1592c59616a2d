"""Helpers that several operators share: scratch tables and row keys."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset and
    the driver is the only machine (tests) is a folder of this process used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-ticklake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ticklake-{uuid.uuid4().hex[:12]}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and the plan above may split the partitions anew.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def removed(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete scratch tables that are no longer needed."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ordered_key(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(d, doc_id, text)`` where ``d`` is unique and ordered as ``doc_id``.

    With unique, non-null ids ``d`` is the id itself. Else the rows are put in
    order of (doc_id, text), nulls last, and numbered; rows that share an id
    then count as separate documents in that order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.groupBy("doc_id").count().filter((F.col("count") > 1) | F.col("doc_id").isNull())
    if ids.isEmpty():
        return rows.select(F.col("doc_id").alias("d"), "doc_id", "text")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text"]
    ranged = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return written(ranged.select(F.monotonically_increasing_id().alias("d"), "doc_id", "text"), "keyed")
