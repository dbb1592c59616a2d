"""Mixing sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.llm.shared import WORD, read_table, written

#: Marginal cost of a token's first, second and third use: convex, so no text repeats before all are used once.
REPEAT_COSTS = (1, 4, 9)
#: Distinct sets of sources that the driver will take; more raise ValueError.
MAX_PATTERNS = 50_000
#: Hash ranges of a pattern's documents; only one range of each pattern is ordered row by row.
RANGES = 1 << 14
#: Rows that fill up what a pattern's rest lacks at its end.
FILL = 3


def share_out(sizes: dict, weights: dict, most: int = len(REPEAT_COSTS)) -> dict:
    """Targets in proportion to ``weights`` that add up to all sizes, none above ``most`` times its source's size.

    What a capped source can't take is shared again by weight among the others
    until none is above its cap.
    """
    total, left = float(sum(sizes.values())), dict(weights)
    targets: dict = {}
    while left:
        unit = (total - sum(targets.values())) / sum(left.values())
        over = [s for s in left if left[s] * unit > most * sizes[s]]
        if not over:
            return targets | {s: w * unit for s, w in left.items()}
        for s in over:
            targets[s] = float(most * sizes[s])
            del left[s]
    return targets


def blocking_flows(graph: list[list[int]], to: list[int], room: list[int], source: int, sink: int) -> None:
    """Augment along shortest paths of the residual graph until none is left; arc i ^ 1 is the reverse of arc i."""
    while True:
        level, queue = {source: 0}, [source]
        for x in queue:
            for i in graph[x]:
                if room[i] and to[i] not in level:
                    level[to[i]] = level[x] + 1
                    queue.append(to[i])
        if sink not in level:
            return
        next_arc, path, x = [0] * len(graph), [], source
        while True:
            while x != sink and next_arc[x] < len(graph[x]) and not (room[i := graph[x][next_arc[x]]] and level.get(to[i]) == level[x] + 1):
                next_arc[x] += 1
            if x == sink:
                flow = min(room[i] for i in path)
                for i in path:
                    room[i] -= flow
                    room[i ^ 1] += flow
                full = next(k for k, i in enumerate(path) if not room[i])
                x = to[path[full] ^ 1]
                del path[full:]
            elif next_arc[x] < len(graph[x]):
                path.append(i)
                x = to[i]
            elif path:
                x = to[path.pop() ^ 1]
                next_arc[x] += 1
            else:
                break


def route(patterns: dict[tuple, int], quotas: dict, costs=REPEAT_COSTS) -> dict[tuple, int]:
    """Tokens to take of each pattern: a min-cost flow from patterns to the sources they belong to.

    ``patterns``: tokens by tuple of sources; ``quotas``: tokens by source. Each
    pattern offers its tokens once per entry of ``costs`` at that marginal cost.
    Only the arcs into the patterns cost anything, and an augmentation never
    takes flow back from them; so the shortest paths are those over the cheapest
    uses left, and the flow is completed for one marginal cost after the other.
    """
    names, sources = sorted(patterns, key=str), sorted(quotas, key=str)
    node = {s: i + 2 for i, s in enumerate(sources)}
    graph: list[list[int]] = [[] for _ in range(len(sources) + len(names) + 2)]
    to: list[int] = []
    room: list[int] = []

    def arc(a: int, b: int, capacity: int) -> int:
        for x, y, c in ((a, b, capacity), (b, a, 0)):
            graph[x].append(len(to))
            to.append(y)
            room.append(c)
        return len(to) - 2

    offer = [arc(0, len(sources) + 2 + k, 0) for k in range(len(names))]
    for k, p in enumerate(names):
        for s in dict.fromkeys(p):
            if s in quotas:
                arc(len(sources) + 2 + k, node[s], patterns[p] * len(costs))
    for s in sources:
        arc(node[s], 1, quotas[s])
    for _ in sorted(costs):
        for k, p in enumerate(names):
            room[offer[k]] += patterns[p]
        blocking_flows(graph, to, room, 0, 1)
    return {p: room[offer[k] ^ 1] for k, p in enumerate(names)}


def measured(docs: DataFrame, sources: str, seed: int) -> DataFrame:
    """Adds ``_pattern`` (JSON list of the sources), ``_members``, ``_size`` (words of the whole text, null: 0) and ``_h``, the seeded order (0 to 2^63 - 1)."""
    many = docs.schema[sources].dataType.typeName() == "array"
    none = F.array(F.lit(None).cast("string"))
    member = F.sort_array(F.array_distinct(sources)) if many else F.array(sources)
    member = F.when(F.col(sources).isNull() | (F.size(member) == 0), none).otherwise(member)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")), 1)
    return docs.withColumns({"_members": member, "_pattern": F.to_json(member, {"ignoreNullFields": "false"}), "_size": size, "_h": order})


def cut_off(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """``(pattern, full, last, more)``: rows of the pattern with ``_h <= last`` or ``_h`` in ``more`` are used once more than ``full`` times.

    ``taken``: pattern, full, rest, one row for each pattern (at most
    MAX_PATTERNS, broadcast). The order's hash ranges are summed first; a window
    then orders only the one range in which a pattern's rest ends. What the rest
    still lacks there is filled by FILL later rows, each time the largest that
    fits, and at last by the smallest row if that comes nearer.
    """
    spark = rows.sparkSession
    bits = 63 - (RANGES.bit_length() - 1)
    rows = rows.select(F.col("_pattern").alias("pattern"), F.col("_size").alias("size"), "_h", F.shiftright("_h", bits).alias("_range"))
    upto = Window.partitionBy("pattern").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("pattern", "_range").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
    edge = sums.join(F.broadcast(taken), "pattern").filter("rest > 0 and upto > rest and upto - words <= rest")
    edge = edge.select("pattern", F.col("_range").alias("edge"), (F.col("upto") - F.col("words")).alias("before"), "rest")
    order = Window.partitionBy("pattern").orderBy("_h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.join(F.broadcast(edge), "pattern").filter("_range = edge").withColumn("at", F.sum("size").over(order))
    last = inside.filter("before + at <= rest").groupBy("pattern").agg(F.max("_h").alias("last"), F.max("at").alias("at"))
    ends = edge.join(last, "pattern", "left").select("pattern", F.coalesce("last", F.shiftleft("edge", bits) - 1).alias("last"), (F.col("rest") - F.col("before") - F.coalesce("at", F.lit(0))).alias("gap"))
    lack = {r.pattern: [r["last"], r.gap, []] for r in ends.collect()}
    for largest in [True] * FILL + [False]:
        short = [(p, end, gap, more) for p, (end, gap, more) in lack.items() if gap > 0]
        if not short:
            break
        open_ = spark.createDataFrame(short, "pattern string, last long, gap long, more array<long>")
        later = rows.join(F.broadcast(open_), "pattern").filter("size > 0 and _h > last and not array_contains(more, _h)")
        if largest:
            pick = F.max(F.when(F.col("size") <= F.col("gap"), F.struct("size", (-F.col("_h")).alias("h"))))
        else:
            pick = F.min(F.when((F.col("size") > F.col("gap")) & (F.col("size") < 2 * F.col("gap")), F.struct("size", F.col("_h").alias("h"))))
        for r in later.groupBy("pattern").agg(pick.alias("pick")).filter("pick is not null").collect():
            lack[r.pattern][1] -= r.pick.size
            lack[r.pattern][2].append(abs(r.pick.h))
    told = spark.createDataFrame([(p, end, more) for p, (end, _, more) in lack.items()], "pattern string, last long, more array<long>")
    out = taken.join(F.broadcast(told), "pattern", "left").withColumn("last", F.coalesce("last", F.when(F.col("rest") > 0, F.lit(2**63 - 1)).otherwise(F.lit(-1))))
    return out.select("pattern", "full", "last", F.coalesce("more", F.array().cast("array<long>")).alias("more"))


def share_out_of(patterns: dict, sizes: dict, weights: dict) -> dict:
    """Targets of overlapping sources: shares of all words, each text counted once."""
    total, scale = sum(patterns.values()), sum(sizes.values()) or 1
    return {s: t * total / scale for s, t in share_out(sizes, weights).items()}


def plan_mix(rows: DataFrame, weights) -> DataFrame:
    """``(pattern, full, last, more, source_size, target)``, a row for each membership pattern of ``measured`` rows.

    Only sums for each pattern reach the driver, where the flow is solved.
    """
    spark = rows.sparkSession
    found = rows.groupBy("_pattern").agg(F.first("_members").alias("members"), F.sum("_size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sets of sources")
    patterns = {tuple(r.members): r.size for r in found}
    names = sorted({s for p in patterns for s in p}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    sizes = dict.fromkeys(names, 0)
    for p, n in patterns.items():
        for s in p:
            sizes[s] += n
    targets = share_out_of(patterns, sizes, weight)
    flow = route(patterns, {s: round(t) for s, t in targets.items()})
    plan, told = [], []
    for r in sorted(found, key=lambda r: r["_pattern"]):
        p = tuple(r.members)
        full, rest = divmod(flow[p], r.size) if r.size else (0, 0)
        plan.append((r["_pattern"], full, rest))
        told.append((r["_pattern"], sum(sizes[s] for s in p), float(sum(targets[s] for s in p))))
    ends = cut_off(rows, spark.createDataFrame(plan, "pattern string, full long, rest long")).collect()
    more = {p: (size, target) for p, size, target in told}
    schema = "pattern string, full long, last long, more array<long>, source_size long, target double"
    return spark.createDataFrame([(r.pattern, r.full, r["last"], r.more, *more[r.pattern]) for r in ends], schema)


def mixed(docs: DataFrame, weights, seed: int, sources: str) -> DataFrame:
    """``docs`` with _size, source_size, target and _copies, the times that the mix uses the row. Nothing is shuffled: each row meets its pattern's cut-off."""
    rows = measured(docs, sources, seed)
    sums = written(rows.select("_pattern", "_members", "_size", "_h"), "sizes")
    plan = plan_mix(sums, weights).withColumnRenamed("pattern", "_pattern").withColumnsRenamed({"source_size": "_source_size", "target": "_target", "full": "_full", "last": "_last", "more": "_more"})
    return rows.join(F.broadcast(plan), "_pattern").withColumn("_copies", F.col("_full") + ((F.col("_h") <= F.col("_last")) | F.array_contains("_more", F.col("_h"))).cast("long"))


def mix(docs: DataFrame, weights=(1, 2, 3), seed: int = 0, sources: str = "source") -> DataFrame:
    """Mix documents so that their sources come near their target shares of all words.

    ``sources``: a string column (one source for each document) or an array column
    (overlapping sources). Sources by code point, null last, weigh ``weights``,
    repeating. Returns doc_id, size, source_size, target, taken and copies; with
    overlapping sources source_size and target are sums over the document's
    sources. A null or empty text has size 0 and takes 0 words. A null source or
    an empty array counts as the null source. Rows that repeat id and text are
    used alike (and may so miss a target by their number); all other ties are ordered by the seeded hash of id and text, so
    reruns agree. Other columns are ignored; an empty table gives no rows.
    """
    rows = mixed(docs.select("doc_id", "text", sources), weights, seed, sources)
    return rows.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"), F.col("_copies").alias("copies"),
    )


def mixed_rows(docs: DataFrame, weights=(1, 2, 3), seed: int = 0, sources: str = "source") -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as the mix uses it, columns unchanged."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", F.col(sources).alias("source"))
    used = mixed(rows, weights, seed, "source").filter("_copies > 0")
    return used.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("row.*")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
