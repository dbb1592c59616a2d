"""Exact deduplication against a persistent digest index."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.shared import read_table, scratch_path, written


class DigestIndex:
    """SHA-256 digests of all texts seen, bucketed and sorted by digest.

    The index is an external Parquet table. A new batch is reduced to one row
    per digest, deduplicated against the index by a sort-merge anti-join (the
    index side needs no shuffle: it is read by bucket) and appended under the
    batch's name. A batch that is added again, say after its job died, finds what
    it had appended and neither appends it twice nor takes it for known.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        """Open the index at ``path``, or make one there. ``buckets`` must stay the same for a path."""
        self.spark = spark
        self.path = path or scratch_path(spark, "digest_index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"ticklake_digests_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def close(self) -> None:
        """Forget the table's name in the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def compacted(self, path: str) -> DigestIndex:
        """The same index with one sorted file for each bucket, at another path; the old one stays until its owner deletes it."""
        new = DigestIndex(self.spark, path, self.buckets)
        new._append(self.rows())
        return new

    def _append(self, rows: DataFrame) -> None:
        rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)

    def add(self, docs: DataFrame, normalise=None, batch: str | None = None) -> DataFrame:
        """Judge every row of ``docs`` and append the new digests.

        Returns per row: doc_id, keep_id, group_size (rows of the batch with
        this text), kept, text_sha256. Of equal texts new to the index the row
        with the largest doc_id stays (nulls smallest; of rows that repeat an id
        exactly one stays). A text that an earlier batch had is kept by its row
        there, whose id is the keep_id. ``batch`` names the batch, so that it can
        be added again; without a name each call is a batch of its own. A null
        text counts as empty. Other columns of ``docs`` are ignored; an empty
        batch gives no rows.
        """
        batch = batch or uuid.uuid4().hex
        text = F.coalesce(F.col("text"), F.lit(""))
        text = normalise(text) if normalise else text
        seen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
        seen = written(seen.withColumn("row", F.monotonically_increasing_id()), "digests")
        last = F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), F.col("doc_id"), F.col("row")))
        groups = seen.groupBy("digest").agg(last.alias("last"), F.count("*").alias("group_size"))
        old = self.rows().filter(F.col("batch") != batch).select("digest", F.col("keep_id").alias("old_id"), F.lit(True).alias("known"))
        judged = written(groups.join(old.hint("merge"), "digest", "left"), "judged")
        fresh = judged.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        self._append(fresh.select("digest", F.col("last.doc_id").alias("keep_id"), F.lit(batch).alias("batch")))
        # Both sides are plain scans, so a digest with very many rows can be split by adaptive execution.
        known = F.coalesce("known", F.lit(False))
        return seen.join(judged, "digest").select(
            "doc_id",
            F.when(known, F.col("old_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
            F.col("group_size").cast("long").alias("group_size"),
            (~known & (F.col("row") == F.col("last.row"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def judged_once(docs: DataFrame) -> DataFrame:
    """Verdicts of ``DigestIndex.add`` on an index of its own."""
    index = DigestIndex(docs.sparkSession)
    found = index.add(docs)
    index.close()
    return found


def exact_dedup_rows(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text a row of larger doc_id repeats; same columns and order of columns.

    Of repeated rows with one id and one text a single one stays.
    """
    judged = written(judged_once(docs), "kept")
    keep = judged.filter("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("row_id"), sha.alias("row_sha"))
    hit = rows.join(keep, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_sha") == F.col("sha")), "left_semi")
    repeated = judged.groupBy("doc_id", "text_sha256").count().filter("count > 1")
    if not repeated.isEmpty():
        hit = hit.dropDuplicates(["row_id", "row_sha"])
    return hit.select("row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_once(read_table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
