"""Audit of stored files against their receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.order import RECV

WARNINGS = ("no_coverage",)


def walked(rows: DataFrame) -> DataFrame:
    """What a file's rows say: records, stamps, bad lines, and the first line behind an earlier one. ``rows``: hour, path, line, the stamp and ``bad``."""
    w = Window.partitionBy("hour", "path").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    behind = F.col(RECV) < F.max(RECV).over(w)
    rows = rows.withColumn("_late", F.when(behind, F.col("line")))
    return rows.groupBy("hour", "path").agg(
        F.count_if(~F.col("bad")).alias("seen"), F.min_by(RECV, "line").alias("first_ns"), F.max_by(RECV, "line").alias("last_ns"), F.min("_late").alias("late_line"), F.count_if("bad").alias("bad_lines")
    )


def findings(files: DataFrame, receipts: DataFrame, content: DataFrame, coverage_hours: DataFrame) -> DataFrame:
    """One row for each finding: hour, path, finding.

    ``files``: hour, path, sha256 (null: unreadable) and, if a walk met one, ``error``; ``receipts``: hour, path,
    sha256, records, first_receive_ns, last_receive_ns; ``content``: from
    ``walked``; ``coverage_hours``: hours with a coverage file. One full outer
    join on the path serves digest, missing and unreceipted; stamps are compared
    only in ordered files. An hour with neither file nor receipt isn't found.
    """
    r = receipts.select("hour", "path", F.col("sha256").alias("told"), "records", "first_receive_ns", "last_receive_ns", F.lit(True).alias("receipted"))
    failed = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    f = files.select("hour", "path", "sha256", failed.alias("error"), F.lit(True).alias("held"))
    said = content.select("hour", "path", "seen", "bad_lines", "first_ns", "last_ns", "late_line")
    both = f.join(r, ["hour", "path"], "full").join(said, ["hour", "path"], "left")
    held, receipted = F.col("held").isNotNull(), F.col("receipted").isNotNull()
    stamps = F.col("late_line").isNull() & ~(F.col("first_ns").eqNullSafe(F.col("first_receive_ns")) & F.col("last_ns").eqNullSafe(F.col("last_receive_ns")))
    tests = {
        "missing": ~held & receipted,
        "unreceipted": held & ~receipted,
        "unreadable": held & (F.col("sha256").isNull() | F.col("error").isNotNull()),
        "digest": held & receipted & (F.col("sha256") != F.col("told")),
        "rows": held & F.col("seen").isNotNull() & ((F.col("bad_lines") > 0) | receipted & ((F.col("seen") != F.col("records")) | stamps)),
        "order": held & F.col("late_line").isNotNull(),
    }
    found = F.filter(F.array(*(F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items())), lambda x: x.isNotNull())
    rows = both.select("hour", "path", F.explode(found).alias("finding"))
    dark = both.select("hour").distinct().join(coverage_hours, "hour", "left_anti").select("hour", F.lit("").alias("path"), F.lit("no_coverage").alias("finding"))
    return rows.unionByName(dark)


def audit(files: DataFrame, receipts: DataFrame, content: DataFrame, coverage_hours: DataFrame) -> DataFrame:
    """Each hour: files, receipts, findings; ``ok`` without any, ``sound`` with warnings only."""
    found = findings(files, receipts, content, coverage_hours)
    hours = files.select("hour").unionByName(receipts.select("hour")).distinct()
    counted = found.groupBy("hour").agg(F.count("*").alias("findings"), F.count_if(~F.col("finding").isin(*WARNINGS)).alias("faults"))
    sizes = files.groupBy("hour").agg(F.count("*").alias("files")).join(receipts.groupBy("hour").agg(F.count("*").alias("receipts")), "hour", "full")
    out = hours.join(sizes, "hour", "left").join(counted, "hour", "left").na.fill(0, ["files", "receipts", "findings", "faults"])
    return out.withColumns({"ok": F.col("findings") == 0, "sound": F.col("faults") == 0})


def summary(hours: DataFrame, found: DataFrame) -> DataFrame:
    """Totals, and findings by kind."""
    total = hours.agg(F.count("*").alias("hours"), F.count_if("ok").alias("ok"), F.count_if("sound").alias("sound")).select(F.lit("all").alias("finding"), F.col("hours").alias("n"), "ok", "sound")
    return total.unionByName(found.groupBy("finding").agg(F.count("*").alias("n")), allowMissingColumns=True)
