"""SimHash near-duplicates: fingerprints linked through vantage-point trees."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.components import components
from ticklake.llm.shared import read_table, written

#: Words of a shingle, seed of its hash, and the differing bits up to which two fingerprints link.
WIDTH, SEED, RADIUS = 3, 42, 3
#: The upper levels of the tree, one for each run of 64 / LEVELS bits; 17 branches a level at 16 bits.
LEVELS = 4
#: The vantage point of the upper levels; any value gives the same links.
VANTAGE = 0x9E3779B97F4A7C15
#: Fingerprints that one shard indexes; a fuller leaf of the upper levels is dealt to several.
SHARD = 16384
#: Fingerprints of a leaf in a shard's own tree, and cells of one comparison of points with a leaf.
LEAF, CELLS = 64, 1 << 20
#: Hashes whose bits are counted at a time.
COUNTED = 1 << 16


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """Bit i is set if it is in over half of the XXH64 hashes of the shingles, repeats included; zero without words."""
    words = text.lower().split()  # on bytes: A-Z alone are lowered, ASCII white space alone splits
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - width + 1)
    spans = zip(starts[:last].tolist(), ends[min(width, len(words)) - 1 :].tolist(), strict=True)
    counts, n = np.zeros(64, np.int64), 0
    while part := list(itertools.islice(spans, COUNTED)):
        hashes = np.fromiter((xxhash.xxh64_intdigest(line[a:b], seed) for a, b in part), "<u8", len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(x.as_py() or b"", width, seed) for x in batch.column(1)]
        fp = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class VantageTree:
    """A vantage-point tree over distinct 64-bit fingerprints under Hamming distance.

    A node holds a vantage point and the median distance to it: points up to the
    median lie inside, the others outside. For all queries of a batch at once a
    branch is entered only by those that the triangle inequality lets in.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.root = self._node(np.arange(len(points)))

    def _node(self, rows: np.ndarray) -> tuple:
        if len(rows) > LEAF:
            vantage = self.points[rows[len(rows) // 2]]
            far = distance(self.points[rows], vantage)
            median = np.partition(far, (len(rows) - 1) // 2)[(len(rows) - 1) // 2]
            if median == far.max():
                median -= 1
            inside = far <= median
            if inside.any():
                return vantage, int(median), self._node(rows[inside]), self._node(rows[~inside])
        return (rows,)

    def near(self, asked: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place in ``asked``, place in the points) within ``radius``, in pieces."""
        todo = [(self.root, np.arange(len(asked)))]
        while todo:
            node, who = todo.pop()
            if not len(who):
                continue
            if len(node) == 1:
                step = max(1, CELLS // len(node[0]))
                for at in range(0, len(who), step):
                    part = who[at : at + step]
                    i, j = np.nonzero(distance(asked[part][:, None], self.points[node[0]][None, :]) <= radius)
                    yield part[i], node[0][j]
                continue
            vantage, median, inside, outside = node
            far = distance(asked[who], vantage).astype(np.int64)
            todo.append((inside, who[far <= median + radius]))
            todo.append((outside, who[far > median - radius]))


class Forest:
    """Joins what is linked and keeps only the links that joined something, so that links stay fewer than points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.parent = np.arange(len(points))

    def _root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def roots(self) -> np.ndarray:
        at = self.parent
        while not np.array_equal(at, at[at]):
            at = at[at]
        return at

    def links(self, tree: VantageTree, asked: np.ndarray, guests: bool, radius: int) -> tuple[list[int], list[int]]:
        """Links of ``asked`` (the points themselves, or guests that are forgotten afterwards) that join components."""
        own = len(self.points)
        if guests:
            self.parent = np.concatenate((self.parent[:own], own + np.arange(len(asked))))
        a, b = [], []
        for who, which in tree.near(asked, radius):
            if not len(who):
                continue
            roots = self.roots()
            node = who + own if guests else who
            _, first = np.unique(roots[node] * own + roots[which], return_index=True)
            for i, left, right in zip(who[first].tolist(), node[first].tolist(), which[first].tolist(), strict=True):
                x, y = self._root(left), self._root(right)
                if x != y:
                    self.parent[max(x, y)] = min(x, y)
                    a.append(int(asked[i]))
                    b.append(int(self.points[right]))
        return a, b


def shard_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of each shard; rows (place, guest, fp) come sorted, a shard's own points before its guests.

    Only the own points of one shard (at most about SHARD) and one batch of guests are in memory.
    """
    place, own, tree, forest = None, [], None, None

    def out(a: list[int], b: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64), pa.int64()) for x in (a, b)], ["a", "b"])

    def indexed() -> pa.RecordBatch:
        nonlocal tree, forest
        points = np.concatenate(own)
        tree, forest = VantageTree(points), Forest(points)
        return out(*forest.links(tree, points, False, radius))

    for batch in batches:
        places, guest = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        fps = batch.column(2).to_numpy().view(np.uint64)
        edges = np.flatnonzero((places[1:] != places[:-1]) | (guest[1:] != guest[:-1])) + 1
        for at, to in itertools.pairwise([0, *edges.tolist(), len(places)]):
            if at == to:
                continue
            if places[at] != place:
                if own and tree is None:
                    yield indexed()
                place, own, tree, forest = places[at], [], None, None
            if not guest[at]:
                own.append(fps[at:to])
            elif own:
                if tree is None:
                    yield indexed()
                yield out(*forest.links(tree, fps[at:to], True, radius))
    if own and tree is None:
        yield indexed()


def branch_steps(radius: int, levels: int) -> list[int]:
    """Codes of the steps from a leaf of the upper levels to each later one that the triangle bounds leave.

    On each level's bits the distances of two points to the vantage point differ
    by at most their own distance there, and these add up to at most ``radius``.
    """
    reach = itertools.product(range(-radius, radius + 1), repeat=levels)
    codes = (sum(s << (6 + radius.bit_length()) * i for i, s in enumerate(step)) for step in reach if sum(map(abs, step)) <= radius)
    return sorted(c for c in codes if c > 0)


def fingerprint_links(points: DataFrame, radius: int = RADIUS, levels: int = LEVELS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that join all of the distinct fingerprints ``fp`` within ``radius`` bits into their components.

    The upper levels of the tree split the fingerprints by their Hamming distance
    to the vantage point, each level on bits of its own. A fingerprint is indexed
    in one leaf and asked of the leaves that the triangle bounds leave, each pair
    of leaves one way only. A leaf of more than ``shard`` points is dealt to
    several shards by hash, and the same goes for its guests. In a shard the lower
    levels are a tree of vantage points taken from its own points.
    """
    bits, width = 64 // levels, 6 + radius.bit_length()
    apart = F.col("fp").bitwiseXOR(F.lit(VANTAGE - (1 << 64)))
    ones = (1 << bits) - 1
    code = sum((F.bit_count(F.shiftrightunsigned(apart, bits * i).bitwiseAND(F.lit(ones))).cast("long") + radius) * (1 << width * i) for i in range(levels))
    at = points.select("fp", code.alias("leaf"))
    # At most (64 / levels + 1) ** levels rows, 83,521 by default, however many the points are.
    leaves = F.broadcast(at.groupBy("leaf").agg(F.ceil(F.count("*") / shard).cast("long").alias("shards")))
    home = at.join(leaves, "leaf").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("shards")))

    def placed(rows: DataFrame, shard_no: F.Column, guest: bool) -> DataFrame:
        return rows.select((F.shiftleft("leaf", 24) + shard_no).alias("place"), F.lit(guest).alias("guest"), "fp")

    steps = F.explode(F.array(*(F.lit(c) for c in branch_steps(radius, levels)))).alias("step")
    beyond = at.select("fp", "leaf", steps).select("fp", (F.col("leaf") + F.col("step")).alias("leaf")).join(leaves, "leaf")
    asked = home.filter("own > 0").select("fp", "leaf", F.col("own").alias("upto")).unionByName(beyond.select("fp", "leaf", F.col("shards").alias("upto")))
    guests = asked.select("fp", "leaf", F.explode(F.sequence(F.lit(0), F.col("upto").cast("int") - 1)).alias("to"))
    dealt = placed(home, F.col("own"), False).unionByName(placed(guests, F.col("to"), True))
    dealt = dealt.repartition("place").sortWithinPartitions("place", "guest")
    return dealt.mapInArrow(lambda it: shard_links(it, radius), "a long, b long")


def simhash_components(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, seed: int = SEED, shard: int = SHARD) -> DataFrame:
    """doc_id, fp (signed), n_same (rows of that fingerprint) and component_id of every row of ``docs``.

    Fingerprints of at most ``radius`` differing bits link; component_id is the
    smallest id that a row reaches over links, its own included, and null where
    none of its component has an id. Rows of one fingerprint are reduced to one
    point before anything is compared, so copies cost a row each. A null text is
    an empty one; texts without words have fingerprint zero and link like any
    other; repeated rows and ids give rows of their own; other columns are
    ignored, whatever their names; an empty table gives no rows. Links leave a
    shard as a spanning forest, fewer than its points and guests.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    seen = written(rows.mapInArrow(lambda it: fingerprints(it, width, seed), "doc_id long, fp long"), "fingerprints")
    points = written(seen.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_same")), "points")
    labels = components(written(fingerprint_links(points, radius, shard=shard), "links"))
    rooted = points.join(labels.select(F.col("v").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(rooted.join(smallest, "root").select("fp", "n_same", "component_id"), "classes")
    return seen.join(classes, "fp").select("doc_id", "fp", "n_same", "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_same")
