"""Coverage documents of each hour from the log of a recorder's events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticklake.functions.scalars import hour_key
from ticklake.operators.coverage import RECORD, rolled
from ticklake.operators.spans import by_hour, fold_transitions
from ticklake.schema import NS_PER_HOUR
from ticklake.sources.scratch import stored

#: An event: ``what`` is up (the process runs), member (tier, symbol), shard (off: disconnected; with tier and topics),
#: overrun (shard), gap (topic, symbol, depth), shed (tier, feed) or disk (blocked); ``on`` says whether it begins or ends.
EVENT = (
    "venue string, market string, pid bigint, ns bigint, what string, on boolean, tier string, symbol string, feed string, shard bigint, "
    "topics array<string>, topic string, depth bigint"
)
PROCESS = ("venue", "market", "pid")
DOC = (*PROCESS, "hour", "window")


def windows(log: DataFrame) -> DataFrame:
    """Each process's time up, cut at whole hours: process, hour (``YYYY-MM-DDTHH``), from_ns, to_ns. A process still up at its last event is up until then."""
    last = log.groupBy(*PROCESS).agg(F.max("ns").alias("_last"))
    up = fold_transitions(log.filter("what = 'up'"), *PROCESS).join(last, list(PROCESS)).withColumn("end", F.coalesce("end", "_last"))
    cut = by_hour(up, NS_PER_HOUR, *PROCESS)
    return cut.select(*PROCESS, hour_key("start").alias("hour"), F.col("start").alias("from_ns"), F.col("end").alias("to_ns"))


def outages(log: DataFrame) -> DataFrame:
    """Spans without connection by shard, with the tier and topics that its disconnect named."""
    shard = (*PROCESS, "shard")
    turns = log.filter("what = 'shard'").select(*shard, "ns", (~F.col("on")).alias("on"), "tier", "topics")
    named = turns.filter("on").groupBy(*shard, F.col("ns").alias("start")).agg(F.min("tier").alias("tier"), F.first("topics").alias("topics"))
    return fold_transitions(turns, *shard).join(named, [*shard, "start"])


def topology(log: DataFrame) -> DataFrame:
    """Spans of a shard's tier and topics: from the event that told them to the next."""
    w = Window.partitionBy(*PROCESS, "shard").orderBy("ns", "on")
    return log.filter("what = 'shard'").select(*PROCESS, "shard", "tier", "topics", F.col("ns").alias("start"), F.lead("ns").over(w).alias("end"))


def hour_documents(log: DataFrame, feeds: DataFrame) -> DataFrame:
    """One document (columns of RECORD) for each process and hour in which it was up.

    ``feeds``: venue, market, tier and the list of its feeds. Spans of members,
    sheds, outages, gaps and full disks are folded from their events, carried over
    hours and cut to the time the process was up; a gap that the hour leaves open
    has no end. Pieces of all kinds meet once, grouped by their document, whose
    size is bounded by what one process says of an hour.
    """
    log = log.select(*(f.name for f in StructType.fromDDL(EVENT).fields))
    up = stored(windows(log), "windows")

    def folded(what: str, *key: str) -> DataFrame:
        return fold_transitions(log.filter(F.col("what") == what), *PROCESS, *key)

    def inside(spans: DataFrame, *key: str, keep_open: bool = False) -> DataFrame:
        return rolled(spans, up, *key, keep_open=keep_open, of=PROCESS)

    names = ("tier", "symbol", "feed", "shard", "topics", "topic", "depth", "from_ns", "to_ns", "spans")
    kinds = dict(f.split() for f in "tier string, symbol string, feed string, shard bigint, topics array<string>, topic string, depth bigint, from_ns bigint, to_ns bigint, spans array<array<bigint>>".split(", "))

    def pieces(what: str, rows: DataFrame) -> DataFrame:
        have = set(rows.columns)
        return rows.select(*PROCESS, "hour", F.lit(what).alias("what"), *(F.col(n).cast(kinds[n]).alias(n) if n in have else F.lit(None).cast(kinds[n]).alias(n) for n in names))

    heard = log.filter("what = 'overrun'").select(*PROCESS, "shard", "ns").join(up, list(PROCESS)).filter("from_ns <= ns and ns < to_ns")
    members = inside(folded("member", "tier", "symbol"), "tier", "symbol").groupBy(*PROCESS, "hour", "tier", "symbol")
    parts = [
        pieces("member", members.agg(F.sort_array(F.collect_list(F.array("from_ns", "to_ns"))).alias("spans"))),  # so that a document's members need no search
        pieces("shard", inside(topology(log), "shard", "tier", "topics")),
        pieces("disconnect", inside(outages(log), "shard", "tier", "topics")),
        pieces("gap", inside(folded("gap", "topic", "symbol", "depth"), "topic", "symbol", "depth", keep_open=True)),
        pieces("shed", inside(folded("shed", "tier", "feed"), "tier", "feed")),
        pieces("disk", inside(folded("disk"))),
        pieces("overrun", heard.select(*PROCESS, "hour", "shard", F.col("ns").alias("from_ns"))),
    ]
    all_ = parts[0]
    for part in parts[1:]:
        all_ = all_.unionByName(part)
    window = F.struct("from_ns", "to_ns")
    docs = up.groupBy(*PROCESS, "hour").agg(F.min("from_ns").alias("from_ns"), F.max("to_ns").alias("to_ns")).withColumn("window", window)
    gathered = all_.groupBy(*PROCESS, "hour").agg(*(gather(what, fields) for what, fields in GATHERED.items()))
    tiers = feeds.groupBy("venue", "market").agg(F.sort_array(F.collect_list(F.struct("tier", "feeds"))).alias("_tiers"))
    rows = docs.join(gathered, [*PROCESS, "hour"], "left").join(tiers, ["venue", "market"], "left")
    start = F.expr(f"from_ns div {NS_PER_HOUR} * {NS_PER_HOUR}")
    columns = {
        "day": F.split("hour", "T")[0], "hour": F.split("hour", "T")[1], "window": F.col("window"), "hour_span": F.struct(start.alias("from_ns"), (start + NS_PER_HOUR).alias("to_ns")),
        "tiers": F.transform(F.coalesce("_tiers", F.array().cast("array<struct<tier:string,feeds:array<string>>>")), lambda t: F.struct(t["tier"].alias("name"), t["feeds"].alias("feeds"), members_of(t["tier"]).alias("members"))),
        "shards": latest_shards(), "disconnects": told("disconnect", "shard", "tier", "topics", "from_ns", "to_ns"), "overruns": F.transform(told("overrun", "shard", "from_ns"), lambda x: F.struct(x["shard"], x["from_ns"].alias("ns"))),
        "book_gaps": told("gap", "topic", "symbol", "depth", "from_ns", "to_ns"), "shed": told("shed", "tier", "feed", "from_ns", "to_ns"), "disk_blocked": F.transform(told("disk", "from_ns", "to_ns"), lambda x: F.array(x["from_ns"], x["to_ns"])),
    }
    made = rows.select("venue", "market", "pid", *(c.alias(n) for n, c in columns.items()))
    return made.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(RECORD).fields))


#: What a document gathers of each kind, in the order of its lists.
GATHERED = {
    "member": ("tier", "symbol", "spans"), "shard": ("shard", "from_ns", "tier", "topics"), "disconnect": ("from_ns", "shard", "to_ns", "tier", "topics"), "overrun": ("from_ns", "shard"),
    "gap": ("from_ns", "topic", "to_ns", "symbol", "depth"), "shed": ("tier", "feed", "from_ns", "to_ns"), "disk": ("from_ns", "to_ns"),
}


def gather(what: str, fields: tuple[str, ...]) -> Column:
    return F.sort_array(F.collect_list(F.when(F.col("what") == what, F.struct(*fields)))).alias(f"_{what}")


def told(what: str, *fields: str) -> Column:
    """The gathered list of a kind with its fields in the document's order; empty where there is none."""
    return F.coalesce(F.transform(f"_{what}", lambda x: F.struct(*(x[f].alias(f) for f in fields))), F.array())


def members_of(tier: Column) -> Column:
    """Spans by symbol of one tier."""
    own = F.transform(F.filter("_member", lambda m: m["tier"] == tier), lambda m: F.struct(m["symbol"], m["spans"]))
    return F.coalesce(F.map_from_entries(own), F.create_map().cast("map<string,array<array<bigint>>>"))


def latest_shards() -> Column:
    """Each shard once, as the last event of the hour told it."""
    last = F.filter("_shard", lambda x, i: (i == F.size("_shard") - 1) | (F.get(F.col("_shard"), i + 1)["shard"] != x["shard"]))
    return F.coalesce(F.transform(last, lambda x: F.struct(x["shard"].alias("index"), x["tier"].alias("tier"), x["topics"].alias("topics"))), F.array())
