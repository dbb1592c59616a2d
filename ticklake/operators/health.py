"""Health samples from a table of recorder status documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: A status older than this is stale.
FRESH_MS = 120_000
CLASSES = ("book", "trades", "ticker", "liquidations", "kline", "control")
COUNTERS = ("received_frames", "written_rows", "queued_frames", "dropped_frames", "disk_dropped_frames", "malformed_frames", "snapshot_failures", "free_disk_bytes", "queue_capacity")
SHARDS = (
    "array<struct<connected:boolean,reconnects:double,resyncs:double,reanchors:double,"
    "link:struct<tcp:struct<min_rtt_us:double,rtt_us:double,data_segs_in:double,rcv_ooopack:double>,ping_rtt_ms:double,reads:double,frames:double,dwell_max_ms:double>>>"
)
STATUS = (
    "venue string, recorded_at_ns string, last_receive_ns bigint, started_at_ns bigint, budget struct<projected_month_gb:double,monthly_gb:double,over:boolean,shed:array<string>>, "
    + ", ".join(f"{c} double" for c in COUNTERS)
    + ", queued_bytes double, queue_byte_capacity double, disk_blocked boolean, "
    f"shards {SHARDS}, "
    "bytes struct<received_24h:double,received_total:double,by_feed_24h:map<string,double>>, tiers array<struct<symbols:double,topics:double>>, lanes double, last_snapshot_ns bigint, "
    "compressor struct<pending:double,pending_bytes:double,compressed:double,failed:double,deferred:double,deferred_total:double,alive:boolean>, "
    "clock struct<samples:double,skew_mean_ms:double,skew_min_ms:double,skew_max_ms:double,feeds:map<string,struct<skew_p50_ms:double,skew_p99_ms:double,venue_p50_ms:double,venue_p99_ms:double>>>, "
    "queue_wait struct<samples:double,wait_mean_ms:double,wait_max_ms:double>, fast_json boolean"
)


@F.pandas_udf(DoubleType())
def fixed(value: pd.Series, digits: pd.Series) -> pd.Series:
    """Rounded as fixed formatting does: on the binary value, ties to even. No built-in rounds so."""
    return pd.Series([None if pd.isna(v) else float(f"{v:.{int(d)}f}") for v, d in zip(value, digits, strict=True)], dtype="float64")


#: Parts of a status that stay nested in a sample, for ``tape_fields``, ``bytes_by_class`` and ``link_fields``.
NESTED = ("shards", "bytes", "tiers", "lanes", "last_snapshot_ns", "compressor", "clock", "queue_wait", "fast_json")
#: Feeds whose clocks are told apart.
CLOCK_FEEDS = ("book", "trades")


def ratio(part: str, whole: str) -> Column:
    return fixed(F.when(F.col(whole) > 0, F.col(part) / F.col(whole)), F.lit(6))


def age_ms(now: str, stamp: str) -> Column:
    return F.when(F.coalesce(F.col(stamp).cast("bigint"), F.lit(0)) != 0, F.bround(F.col(now) - F.col(stamp).cast("bigint") / 1e6).cast("bigint"))


def samples(documents: DataFrame) -> DataFrame:
    """Status documents ``(realm, now_ms, raw)`` with state and fields.

    State: absent (no text), unreadable (no object, or a stamp that is missing,
    not a positive number or in the future), stale, or live; only live ones have fields.
    """
    rows = documents.withColumn("s", F.from_json("raw", STATUS, {"mode": "PERMISSIVE"})).select("realm", "now_ms", "raw", "s.*")
    stamp = F.col("recorded_at_ns").try_cast("double")
    millis = F.when((stamp > 0) & ~F.isnan(stamp), F.floor(stamp / 1e6))
    parsed = F.ltrim("raw").startswith("{") & F.try_parse_json("raw").isNotNull()
    state = (
        F.when(F.col("raw").isNull(), "absent").when(~F.coalesce(parsed, F.lit(False)) | millis.isNull() | (millis > F.col("now_ms")), "unreadable")
        .when(F.col("now_ms") - millis > FRESH_MS, "stale").otherwise("live")
    )
    rows = rows.withColumn("state", state)
    live = F.col("state") == "live"
    shards = F.coalesce("shards", F.array().cast(SHARDS))

    def summed(name: str) -> Column:
        return F.aggregate(F.transform(shards, lambda x: F.floor(F.coalesce(x[name], F.lit(0.0)))), F.lit(0).cast("bigint"), lambda a, b: a + b)

    fields = {
        "status_age_ms": age_ms("now_ms", "recorded_at_ns"), "receive_age_ms": age_ms("now_ms", "last_receive_ns"), "projected_month_gb": F.col("budget.projected_month_gb"), "monthly_gb": F.col("budget.monthly_gb"),
        "budget_over": F.col("budget.over").cast("double"), "shed_feeds": F.coalesce(F.size("budget.shed"), F.lit(0)), "blocked": F.when(F.col("disk_blocked"), 1.0).otherwise(0.0),
        "queue_fill": F.greatest(ratio("queued_frames", "queue_capacity"), ratio("queued_bytes", "queue_byte_capacity")), "shard_count": F.size(shards),
        "shards_connected": F.size(F.filter(shards, lambda x: F.coalesce(x["connected"], F.lit(False)))), "reconnects": summed("reconnects"), "resyncs": summed("resyncs"), "reanchors": summed("reanchors"),
        "bytes_24h": F.col("bytes.received_24h"), "uptime_s": F.when(F.col("started_at_ns") > 0, F.floor((F.col("now_ms") - F.col("started_at_ns") / 1e6) / 1000)),
    }
    keep = ["realm", "now_ms", "state", "venue", *COUNTERS, *NESTED]
    out = rows.select(*keep, *(F.when(live, v).alias(n) for n, v in fields.items()))
    return out.withColumns({c: F.when(live, F.col(c)) for c in ("venue", *COUNTERS)})


def bytes_by_class(live: DataFrame) -> DataFrame:
    """Bytes of a day by feed class, the part of ``tier:feed`` keys before a colon; unknown classes are ``other``."""
    rows = live.select("realm", "now_ms", F.explode("bytes.by_feed_24h").alias("key", "value"))
    name = F.split(F.element_at(F.split("key", ":", 2), -1), ":")[0]
    name = F.when(name.isin(*CLASSES), name).otherwise("other")
    return rows.withColumn("class", name).groupBy("realm", "now_ms").pivot("class", [*CLASSES, "other"]).agg(F.sum("value"))


def tape_fields(live: DataFrame) -> DataFrame:
    """A live sample's totals of tiers, its compressor, clocks and queue wait, a column for each."""

    def total(name: str) -> Column:
        return F.aggregate(F.coalesce("tiers", F.array().cast("array<struct<symbols:double,topics:double>>")), F.lit(0).cast("bigint"), lambda a, t: a + F.floor(F.coalesce(t[name], F.lit(0.0))))

    fields = {"symbols": total("symbols"), "topics": total("topics"), "lanes": F.col("lanes"), "snapshot_age_ms": age_ms("now_ms", "last_snapshot_ns"), "received_total_bytes": F.col("bytes.received_total")}
    fields |= {f"compressor_{n}": F.col(f"compressor.{n}") for n in ("pending", "pending_bytes", "compressed", "failed", "deferred", "deferred_total")}
    fields["compressor_alive"] = F.when(F.col("compressor").isNotNull(), F.coalesce(F.col("compressor.alive"), F.lit(False)).cast("double"))
    fields |= {"skew_samples": F.col("clock.samples")} | {n: F.col(f"clock.{n}") for n in ("skew_mean_ms", "skew_min_ms", "skew_max_ms")}
    reading = {f: F.try_element_at("clock.feeds", F.lit(f)) for f in CLOCK_FEEDS}
    fields |= {f"{n}_{f}_{q}_ms": reading[f][f"{n}_{q}_ms"] for f in CLOCK_FEEDS for n in ("skew", "venue") for q in ("p50", "p99")}
    fields |= {"queue_wait_samples": F.col("queue_wait.samples"), "queue_wait_mean_ms": F.col("queue_wait.wait_mean_ms"), "queue_wait_max_ms": F.col("queue_wait.wait_max_ms"), "fast_json": F.col("fast_json").cast("double")}
    return live.select("realm", "now_ms", *(v.alias(n) for n, v in fields.items()))


def link_fields(live: DataFrame) -> DataFrame:
    """Over the connected shards: least and slowest round trip, slowest ping, share of segments out of order, frames a read and the longest wait."""
    rows = live.select("realm", "now_ms", F.explode("shards").alias("x")).filter("x.connected and x.link is not null").select("realm", "now_ms", "x.link.*")

    def share(part: str, whole: str, digits: int) -> Column:
        return fixed(F.when(F.col(whole) > 0, F.coalesce(part, F.lit(0.0)) / F.col(whole)), F.lit(digits))

    agg = rows.groupBy("realm", "now_ms").agg(
        (F.min("tcp.min_rtt_us") / 1000).alias("link_min_rtt_ms"), (F.max("tcp.rtt_us") / 1000).alias("link_rtt_ms"), F.max("ping_rtt_ms").alias("link_ping_rtt_ms"), F.sum("tcp.rcv_ooopack").alias("_late"),
        F.sum("tcp.data_segs_in").alias("_in"), F.sum("frames").alias("_frames"), F.sum("reads").alias("_reads"), F.max("dwell_max_ms").alias("reader_dwell_max_ms"),
    )
    return agg.withColumns({"link_out_of_order": share("_late", "_in", 6), "reader_frames_per_read": share("_frames", "_reads", 3)}).drop("_late", "_in", "_frames", "_reads")


#: What a sample calls the numbers of an upload's stamp.
UPLOAD = {
    "bytes": "upload_bytes", "bytes_30d": "upload_bytes_30d", "file_count": "upload_files", "pruned_hours": "upload_pruned_hours", "pruned_bytes": "upload_pruned_bytes",
    "recovered_segments": "upload_recovered_segments", "remote_free_bytes": "archive_free_bytes",
}


def upload_fields(stamps: DataFrame) -> DataFrame:
    """What the last upload counted, from ``stamp`` (``key=value`` lines, the last of a key counts) written at ``modified_ms``, and its age at ``now_ms``."""
    lines = F.transform(F.split("stamp", "\\R"), lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("key"), F.when(F.contains(x, F.lit("=")), F.trim(F.substring(x, F.instr(x, "=") + 1, F.length(x))).try_cast("double")).alias("value")))
    out = stamps.withColumn("_lines", F.filter(lines, lambda p: p["value"].isNotNull()))

    def last(key: str) -> Column:
        return F.try_element_at(F.filter("_lines", lambda p: p["key"] == key), F.lit(-1))["value"]

    age = F.bround(F.greatest(F.lit(0.0), F.col("now_ms") - F.col("modified_ms").cast("double")))
    return out.withColumns({"upload_age_ms": age} | {n: last(k) for k, n in UPLOAD.items()}).drop("_lines")


def write_samples(samples: DataFrame, root: str) -> None:
    """Samples (kind, realm, ts_ms and fields) as JSON lines with sorted keys in a folder for each kind, realm and month."""
    line = F.to_json(F.struct(*sorted(samples.columns)))
    rows = samples.select("kind", "realm", F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM").alias("month"), "ts_ms", line.alias("value"))
    rows = rows.repartition("kind", "realm", "month").sortWithinPartitions("kind", "realm", "month", "ts_ms").drop("ts_ms")
    rows.write.partitionBy("kind", "realm", "month").mode("append").text(root)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([,= ])", r"\\$1")


def line_protocol(rows: DataFrame, measurement: str, tags: list[str], fields: list[str], stamp_ms: str = "now_ms") -> DataFrame:
    """Influx line text of each row: tags escaped, fields sorted, nulls left out."""
    named = F.array(*(F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{f}="), F.col(f).cast("double").cast("string"))) for f in sorted(fields)))
    body = F.array_join(F.filter(named, lambda x: x.isNotNull()), ",")
    head = F.concat_ws(",", F.lit(measurement), *(F.concat(F.lit(f"{t}="), escaped(F.col(t).cast("string"))) for t in tags))
    return rows.withColumn("line", F.concat(head, F.lit(" "), body, F.lit(" "), (F.col(stamp_ms) * 1_000_000).cast("string")))
