"""Plans over a file inventory: packing, retention and fetching. Plans are DataFrames; nothing is moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finished_hours(files: DataFrame, now_s: int, grace_s: int) -> DataFrame:
    """Hours (number ``h``) that ended ``grace_s`` ago, hold no raw file and at least one archived one."""
    rows = files.groupBy("h").agg(F.bool_or("raw").alias("raw"), F.count_if(~F.col("raw")).alias("archived"))
    return rows.filter(((F.col("h") + 1) * 3600 + grace_s <= now_s) & ~F.col("raw") & (F.col("archived") > 0)).select("h")


def last_of_ledger(ledger: DataFrame, stores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The last row of each remote path, if one of the current stores confirms it; and the last rows that none confirms."""
    last = ledger.groupBy("path").agg(F.max_by(F.struct(*ledger.columns), "line").alias("r")).select("r.*")
    return last.join(stores, "store", "left_semi"), last.join(stores, "store", "left_anti")


def bytes_since(ledger: DataFrame, since_ns: int) -> DataFrame:
    return ledger.filter(F.col("uploaded_ns") >= since_ns).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def prunable(files: DataFrame, shipped: DataFrame, now_s: int, keep_hours: int) -> DataFrame:
    """Hours in the ledger that ended ``keep_hours`` ago and still hold files."""
    old = files.filter((F.col("h") + 1 + keep_hours) * 3600 <= now_s).select("h").distinct()
    return old.join(shipped.select("h"), "h", "left_semi")


def retention_plan(files: DataFrame, expired_before: int, cap: int) -> DataFrame:
    """Files (path, size, meta, written_s) to delete: what is expired, then the oldest until the rest fits ``cap``.

    Meta files go by age only and count towards the total. A file goes if what is
    left before it is above the cap, files being ordered by (written_s, path).
    What is freed before a file is the sum of the days before, of the day's
    seconds before and of the second's paths before, so only a table with a row
    for each day is summed in one task.
    """
    rows = files.withColumn("expired", F.col("written_s") < expired_before)
    freed = F.when(~F.col("expired") & ~F.col("meta"), F.col("size")).otherwise(0)
    rest = rows.agg(F.coalesce(F.sum(F.when(~F.col("expired"), F.col("size"))), F.lit(0))).first()[0]
    earlier = (Window.unboundedPreceding, -1)

    def before(c: str, w) -> Column:
        return F.coalesce(F.sum(c).over(w.rowsBetween(*earlier)), F.lit(0))

    rows = rows.withColumns({"_freed": freed, "_day": F.expr("written_s div 86400")})
    seconds = rows.groupBy("_day", "written_s").agg(F.sum("_freed").alias("_sum"))
    days = seconds.groupBy("_day").agg(F.sum("_sum").alias("_sum"))
    days = days.select("_day", before("_sum", Window.partitionBy(F.lit(0)).orderBy("_day")).alias("_days"))
    seconds = seconds.withColumn("_seconds", before("_sum", Window.partitionBy("_day").orderBy("written_s"))).drop("_sum")
    rows = rows.join(seconds.join(days, "_day").drop("_day"), "written_s").withColumn("_paths", before("_freed", Window.partitionBy("written_s").orderBy("path")))
    left = F.lit(rest) - F.col("_days") - F.col("_seconds") - F.col("_paths")
    return rows.filter(F.col("expired") | ~F.col("meta") & (left > cap)).select("path", "size", "written_s", F.when(F.col("expired"), "age").otherwise("space").alias("why"))


def cap_for_space(total: int, free: int, target_free: int) -> int:
    """The size that files may keep so that ``target_free`` bytes of the disk are free."""
    return max(0, total - max(0, target_free - free))


#: The version of a plan document and what its names look like.
PLAN_SCHEMA = 1
PLAN_NAMES = {"tape": "^[A-Za-z0-9_-]+$", "day": r"^\d{4}-\d{2}-\d{2}$", "hour": r"^([01]\d|2[0-3])$", "symbol": "^[A-Z0-9]+$"}
PLAN = "schema bigint, tapes map<string,string>"
PLANNED = "array<struct<day:string,hour:string,symbols:array<string>>>"


def plan_requests(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What plan documents (file, raw) ask for: (file, tape, day, hour, symbol), and why others are no plans: (file, why), one row each.

    A document with anything wrong asks for nothing.
    """
    rows = documents.withColumn("p", F.from_json("raw", PLAN))
    sound = (F.col("p.schema") == PLAN_SCHEMA) & F.col("p.tapes").isNotNull()
    tapes = rows.filter(sound).select("file", F.explode("p.tapes").alias("tape", "_hours")).withColumn("h", F.from_json("_hours", PLANNED))
    listed = F.col("tape").rlike(PLAN_NAMES["tape"]) & F.col("_hours").startswith("[") & F.col("h").isNotNull()
    hours = tapes.filter(listed).select("file", "tape", F.explode("h").alias("h")).select("file", "tape", "h.*")
    dated = F.coalesce(F.col("day").rlike(PLAN_NAMES["day"]) & F.col("hour").rlike(PLAN_NAMES["hour"]) & F.col("day").try_cast("date").isNotNull(), F.lit(False))
    named = F.coalesce(F.forall("symbols", lambda s: F.coalesce(s.rlike(PLAN_NAMES["symbol"]), F.lit(False))), F.lit(False))
    why = [
        rows.filter(~F.coalesce(sound, F.lit(False))).select("file", F.lit(f"not a plan of schema {PLAN_SCHEMA} with tapes").alias("why")),
        tapes.filter(~F.coalesce(listed, F.lit(False))).select("file", F.concat(F.lit("not a tape with a list of hours: "), "tape").alias("why")),
        hours.filter(~dated).select("file", F.concat_ws(" ", F.lit("not a day and hour of"), "tape", F.coalesce("day", F.lit("null")), F.coalesce("hour", F.lit("null"))).alias("why")),
        hours.filter(dated & ~named).select("file", F.concat_ws(" ", F.lit("not a list of symbols of"), "tape", "day", "hour").alias("why")),
    ]
    bad = why[0].unionByName(why[1]).unionByName(why[2]).unionByName(why[3]).groupBy("file").agg(F.min("why").alias("why"))
    asked = hours.join(bad, "file", "left_anti").select("file", "tape", "day", "hour", F.explode("symbols").alias("symbol"))
    return asked, bad


def fetch_plan(requests: DataFrame) -> DataFrame:
    """Requested symbols of each (tape, day, hour), merged, newest first."""
    return requests.groupBy("tape", "day", "hour").agg(F.sort_array(F.collect_set(F.upper("symbol"))).alias("symbols")).orderBy(F.desc("day"), F.desc("hour"), "tape")


def wanted_members(plan: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members that a plan needs (its symbols' segments and all coverage files), and requested symbols without any."""
    asked = plan.select("tape", "day", "hour", F.explode("symbols").alias("symbol"))
    own = members.join(asked, ["tape", "day", "hour", "symbol"], "left_semi")
    meta = members.filter(F.col("member").startswith("coverage-")).join(plan.select("tape", "day", "hour"), ["tape", "day", "hour"], "left_semi")
    return own.unionByName(meta).distinct(), asked.join(members, ["tape", "day", "hour", "symbol"], "left_anti")


def still_to_fetch(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Wanted members that aren't held at the same size and digest."""
    return wanted.join(held, ["tape", "path", "size", "sha256"], "left_anti")


def coalesced_ranges(members: DataFrame, gap: int = 256 * 1024) -> DataFrame:
    """One read for neighbours at most ``gap`` bytes apart: (archive, offset, size, members)."""
    w = Window.partitionBy("archive").orderBy("offset")
    before = F.max(F.col("offset") + F.col("size")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = members.withColumn("_new", F.coalesce(F.col("offset") - before > gap, F.lit(True)).cast("int"))
    rows = rows.withColumn("_read", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = rows.groupBy("archive", "_read").agg(F.min("offset").alias("offset"), F.max(F.col("offset") + F.col("size")).alias("_end"), F.count("*").alias("members"))
    return out.select("archive", "offset", (F.col("_end") - F.col("offset")).alias("size"), "members")


def past_window(hours: DataFrame, keep: DataFrame, default_hours: int, now_h: int) -> DataFrame:
    """Hours (tape, h) older than their tape's keep window or the default."""
    return hours.join(keep, "tape", "left").filter(F.col("h") < now_h - F.coalesce("keep_hours", F.lit(default_hours))).select("tape", "h")


def hour_manifest(files: DataFrame, receipts: DataFrame) -> DataFrame:
    """Each hour's files with receipts: count, bytes, records and sorted symbols."""
    rows = files.join(receipts.select("path", "records"), "path", "left")
    return rows.groupBy("h").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.sort_array(F.collect_set("symbol")).alias("symbols"))
