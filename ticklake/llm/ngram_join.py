"""N-gram Jaccard join with Bayesian candidate pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import kernels as K
from ticklake.llm.components import components
from ticklake.llm.repeats import batch_of
from ticklake.llm.shared import ordered_key, read_table, written

SHINGLE, THRESHOLD = 5, 0.8
#: MinHash values of a signature: BANDS * BAND. A pair at the threshold shares a band but for one in two million cases.
BAND, BANDS = 6, 48
#: MinHash values compared at a time, and the posterior probability of reaching the threshold under which a pair is dropped.
STEP, TOLERANCE = 32, 1e-8
#: Documents and shingles of a block of a large group of candidates.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1_000_000
#: Pairs compared at once; shingles looked up at once while they are verified are GATHER.
TILE = 1 << 17
GATHER = 1 << 20

_FACTORS = np.random.default_rng(7).integers(1, 2**63, BAND * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SIGNED = "d long, g1 long, g2 long, shingles long, signature binary"


def shingle_sets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row of joined texts, and where each row's begin.

    A text of fewer words than a shingle has one shingle of all its words.
    """
    values, bounds = K.word_values(data, starts)
    counts = np.diff(bounds)
    row = np.repeat(np.arange(len(counts)), counts)
    if len(values) >= SHINGLE:
        names = K.doubled(values, SHINGLE)
        whole = row[: len(names)] == row[SHINGLE - 1 :]
        names, rows = names[whole], row[: len(names)][whole]
    else:
        names, rows = values[:0], row[:0]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        one = np.array([K.mix(np.add.reduce(K.mix(values[bounds[i] : bounds[i + 1]] + np.arange(counts[i], dtype=np.uint64) * K._U(K._BASE)), keepdims=True))[0] for i in short], np.uint64)
        names, rows = np.concatenate((names, one)), np.concatenate((rows, short))
    order = np.lexsort((names, rows))
    names, rows = names[order], rows[order]
    new = np.concatenate(([True], (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])))[: len(names)]
    names, rows = names[new], rows[new]
    return names, np.searchsorted(rows, np.arange(len(counts) + 1))


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature, number of shingles and set digest (128 bits) of each text with words."""
    for batch in batches:
        d = batch.column("d").to_numpy(zero_copy_only=False)
        text = K.text_column(batch.column("text"))
        for at, to in K.chunks(text):
            names, bounds = shingle_sets(*K.joined(text, at, to))
            some = np.flatnonzero(np.diff(bounds))
            if not len(some):
                continue
            first = bounds[some]
            signature = np.empty((len(some), len(_FACTORS)), np.uint16)
            for i, factor in enumerate(_FACTORS):
                signature[:, i] = K.mix(np.minimum.reduceat(names * factor, first)) & K._U(0xFFFF)
            yield batch_of({
                "d": d[at:to][some],
                "g1": np.add.reduceat(K.mix(names), first).view(np.int64),
                "g2": np.add.reduceat(K.mix(names ^ K._U(0xA5A5A5A5A5A5A5A5)), first).view(np.int64),
                "shingles": np.diff(bounds)[some],
            }).append_column("signature", pa.array([s.tobytes() for s in signature], pa.binary()))


def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = batch.column("d").to_numpy(zero_copy_only=False)
        signature = signatures(batch.column("signature")).astype(np.uint64)
        for b in range(BANDS):
            key = np.full(len(d), b + 1, np.uint64)
            for i in range(b * BAND, (b + 1) * BAND):
                key = K.mix(key * K._U(K._BASE) + signature[:, i])
            yield batch_of({"key": key.view(np.int64), "d": d})


def signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches needed): with fewer the posterior of a similarity of ``threshold`` or more is under ``tolerance``.

    Prior: uniform. After m matches of n the similarity is Beta(m + 1, n - m + 1).
    """
    needed = []
    for n in range(STEP, BAND * BANDS + 1, STEP):
        tail = 0.0
        for m in range(n + 1):  # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                needed.append((n, m))
                break
    return needed


_NEEDED = least_matches()


def similar(block: Block, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (left, right) those with a similarity of THRESHOLD or more."""
    a, b = block.count[left], block.count[right]
    near = np.minimum(a, b) >= THRESHOLD * np.maximum(a, b)
    left, right = left[near], right[near]
    matches, done = np.zeros(len(left), np.int32), 0
    for n, needed in _NEEDED:
        matches += (block.signature[left, done:n] == block.signature[right, done:n]).sum(1, dtype=np.int32)
        done, stay = n, matches >= needed
        left, right, matches = left[stay], right[stay], matches[stay]
        if not len(left):
            break
    exact = block.shared(left, right)
    a, b = block.count[left], block.count[right]
    hit = exact >= THRESHOLD * (a + b - exact) - 1e-9
    return left[hit], right[hit]


class Block:
    """Candidates that meet: signatures and sorted shingle numbers."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.d, self.weight, self.side = (table.column(c).to_numpy() for c in ("d", "weight", "side"))
        self.signature = signatures(table.column("signature").combine_chunks())
        sets = [np.frombuffer(x, np.uint64) for x in table.column("names").to_pylist()]
        self.count = np.array([len(x) for x in sets])
        self.number = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
        self.bounds = np.concatenate(([0], np.cumsum(self.count)))
        self.seen = np.zeros(int(self.number.max()) + 1, bool)

    def shared(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Exact sizes of the intersections; ``left`` comes in runs."""
        out = np.zeros(len(left), np.int64)
        edges = np.flatnonzero(np.concatenate(([True], left[1:] != left[:-1], [True]))) if len(left) else [0]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            own = self.number[self.bounds[left[x]] : self.bounds[left[x] + 1]]
            self.seen[own] = True
            upto = np.cumsum(self.count[right[x:y]])
            a = x
            while a < y:
                done = upto[a - x - 1] if a > x else 0
                b = max(a + 1, x + int(np.searchsorted(upto, done + GATHER, side="right")))
                size = self.count[right[a:b]]
                first = np.cumsum(size) - size
                at = np.arange(size.sum()) + np.repeat(self.bounds[right[a:b]] - first, size)
                out[a:b] = np.add.reduceat(self.seen[self.number[at]], first, dtype=np.int64)
                a = b
            self.seen[own] = False
        return out


def linked(table: pa.Table) -> pa.RecordBatch:
    """Links of a block: for each of its documents the number of similar ones, their copies, and the least document reached."""
    block = Block(table)
    n = len(block.d)
    across = bool(table.column("across")[0].as_py())
    if across and block.side.all() == block.side.any():  # one of the two blocks has no documents
        return batch_of({k: block.d[:0] for k in ("d", "root", "links", "docs")})
    root = np.arange(n)
    links, docs = np.zeros(n, np.int64), np.zeros(n, np.int64)
    rows = max(1, TILE // n)
    for x in range(0, n, rows):
        left, right = np.meshgrid(np.arange(x, min(n, x + rows)), np.arange(n), indexing="ij")
        left, right = left.ravel(), right.ravel()
        pick = (block.side[left] == 0) & (block.side[right] == 1) if across else left < right
        left, right = similar(block, left[pick], right[pick])
        for a, b in ((left, right), (right, left)):
            links += np.bincount(a, minlength=n)
            docs += np.bincount(a, weights=block.weight[b], minlength=n).astype(np.int64)
        while True:  # hook and jump until the tile's links agree
            low = np.minimum(root[left], root[right])
            before = root.copy()
            np.minimum.at(root, root[left], low)
            np.minimum.at(root, root[right], low)
            root = root[root]
            if (before == root).all():
                break
    while (root != root[root]).any():
        root = root[root]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, root, block.d)
    return batch_of({"d": block.d, "root": least[root], "links": links, "docs": docs})


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (cluster, pair), which come sorted."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cluster, pair = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "pair"))
        edges = [0, *(np.flatnonzero((cluster[1:] != cluster[:-1]) | (pair[1:] != pair[:-1])) + 1).tolist(), len(cluster)]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if held and key != (cluster[x], pair[x]):
                yield pa.Table.from_batches(held)
                held = []
            key = (cluster[x], pair[x])
            held.append(batch.slice(x, y - x))
    if held:
        yield pa.Table.from_batches(held)


def link_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in by_group(batches):
        yield linked(table)


def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the text by its shingle hashes."""
    for batch in batches:
        text = K.text_column(batch.column("text"))
        made = []
        for at, to in K.chunks(text):
            names, bounds = shingle_sets(*K.joined(text, at, to))
            made += [names[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        yield batch.drop_columns(["text"]).append_column("names", pa.array(made, pa.binary()))


def ngram_join(docs: DataFrame) -> DataFrame:
    """Near-duplicate classes and links by the Jaccard similarity of word 5-gram sets (0.8 or more).

    Texts with the same set of shingles form one candidate, the one of least id,
    with their number as weight. Banded signatures bring candidates together;
    their buckets' connected components are the groups in which pairs are
    compared. There a pair is dropped as soon as its matching MinHash values make
    a similarity of 0.8 improbable (posterior under TOLERANCE), and the rest is
    verified on the shingle sets. A large group is cut into blocks, and each pair
    of blocks is one unit of work; only sums for each document leave it, never
    pairs. Returns per row doc_id, class_id (least doc_id of all that are linked
    directly or through others), n_links (other documents of similarity 0.8 or
    more, copies counted), n_linked_texts (other shingle sets among them).
    Texts without words (null, empty) are alone in their class; fewer than five
    words make one shingle of all of them. Rows that share an id (or have none)
    count separately; a class without any id has a null class_id. Other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = ordered_key(docs)
    signed_rows = written(rows.select("d", "text").mapInArrow(signed, SIGNED), "signatures")
    alike = signed_rows.groupBy("g1", "g2").agg(F.min("d").alias("d"), F.count("*").alias("weight"), F.first("shingles").alias("shingles"), F.first("signature").alias("signature"))
    alike = written(alike, "candidates")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = alike.select("d", "signature").mapInArrow(banded, "key long, d long")
    heads = buckets.groupBy("key").agg(F.min("d").alias("a"), F.count("*").alias("n")).filter("n > 1").select("key", "a")
    groups = components(buckets.join(heads, "key").filter("d > a").select("a", F.col("d").alias("b")))
    member = alike.join(groups.withColumnRenamed("v", "d"), "d").withColumnRenamed("root", "cluster")
    member = written(member.select("cluster", "d", "weight", "shingles", "signature"), "members")
    sizes = member.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("shingles") / BLOCK_SHINGLES)).alias("blocks"))
    texts = member.join(sizes, "cluster").join(rows.select("d", "text").hint("merge"), "d")
    sets = texts.select("cluster", "d", "weight", "signature", "blocks", "text")
    sets = sets.mapInArrow(named, "cluster long, d long, weight long, signature binary, blocks long, names binary")
    own = F.pmod(F.xxhash64("d"), F.col("blocks"))
    sets = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sets = sets.withColumn("pair", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).withColumn("side", (F.col("own") > F.col("other")).cast("int")).withColumn("across", F.col("own") != F.col("other"))
    units = sets.select("cluster", "pair", "side", "across", "d", "weight", "signature", "names").repartition(parts, "cluster", "pair").sortWithinPartitions("cluster", "pair")
    links = written(units.mapInArrow(link_groups, "d long, root long, links long, docs long"), "links")
    sums = links.groupBy("d").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    roots = components(links.select(F.col("d").alias("a"), F.col("root").alias("b"))).withColumnRenamed("v", "d")
    found = sums.join(roots, "d", "left")
    classes = alike.select("g1", "g2", "d", "weight").join(found, "d", "left")
    least = classes.select("g1", "g2", F.coalesce("root", "d").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), (F.coalesce("docs", F.lit(0)) + F.col("weight") - 1).alias("docs"))
    least = written(least, "classes")
    keyed = signed_rows.select("d", "g1", "g2").join(least, ["g1", "g2"]).drop("g1", "g2")
    out = rows.select("d", "doc_id").join(keyed, "d", "left").withColumn("root", F.coalesce("root", "d"))
    if not same_keys(rows):
        ids = rows.select(F.col("d").alias("root"), F.col("doc_id").alias("class_id"))
        out = out.join(ids, "root", "left")
    else:
        out = out.withColumn("class_id", F.col("root"))
    return out.select("doc_id", "class_id", F.coalesce("docs", F.lit(0)).cast("long").alias("n_links"), F.coalesce("links", F.lit(0)).cast("long").alias("n_linked_texts"))


def same_keys(rows: DataFrame) -> bool:
    return rows.filter(~F.col("d").eqNullSafe(F.col("doc_id"))).isEmpty()


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the document of least id stays; columns unchanged.

    Rows that repeat an id, or have none, are first numbered in order of id and
    text; the least number stays.
    """
    ids = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("d"), "text")
    if not ids.isEmpty():
        order = [F.col("d").asc_nulls_last(), F.xxhash64("text")]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
        rows = written(rows.withColumn("d", F.monotonically_increasing_id()), "numbered")
    judged = written(ngram_join(rows.select(F.col("d").alias("doc_id"), "text")), "classes")
    keep = judged.filter("class_id = doc_id").select(F.col("doc_id").alias("d"))
    return rows.join(keep, "d", "left_semi").select("row.*")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
      UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4),
c AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS same FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y, a.same AS sx, b.same AS sy FROM p JOIN c a ON a.doc_id = x JOIN c b ON b.doc_id = y WHERE i >= 0.8 * (a.n + b.n - i) - 1e-9),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other),
k AS (SELECT doc_id, min(other) AS class_id FROM r GROUP BY doc_id),
t AS (SELECT x AS doc_id, count(*) AS n_links, count(DISTINCT sy) FILTER (sy <> sx) AS n_linked_texts FROM l GROUP BY x)
SELECT k.doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_linked_texts, 0) AS n_linked_texts FROM k LEFT JOIN t ON t.doc_id = k.doc_id
"""
