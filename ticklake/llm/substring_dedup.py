"""Removes word windows that earlier documents hold, found in FM-indexes of shards."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import kernels as K
from ticklake.llm import repeats as R
from ticklake.llm.fm_index import FMIndex
from ticklake.llm.shared import ordered_key, read_table, written
from ticklake.llm.suffix_dedup import listed, merged

#: Words of a window.
WINDOW = 13
#: Words of an anchor.
ANCHOR = 4
#: Words of a shard's index, on average; a name with more than a HOT part of them is dealt by its windows.
SHARD, HOT = 1_000_000, 4

FIELDS = (*R.FIELDS, "kind", "text")
ROUTED = R.GROUP + ", kind int, text binary"


def grouped(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = batch.column("d").to_numpy(zero_copy_only=False)
        text = K.text_column(batch.column("text"))
        for at, to in K.chunks(text):
            values, bounds = K.word_values(*K.joined(text, at, to))
            yield R.group_batch(d[at:to], K.groups(values, bounds, window, ANCHOR))


def with_text(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words under each open group."""
    for batch in batches:
        out: list[list] = [[] for _ in FIELDS]
        for d, text, spans in zip(batch.column("d").to_pylist(), K.text_column(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            raw = text.as_py()
            first, last = K.words(np.frombuffer(raw, np.uint8))
            for s in spans:
                cut = raw[first[s["start"]] : last[s["start"] + s["n"] + window - 2]]
                for c, x in zip(out, (s["name"], s["digest"], d, s["start"], s["n"], R.OPEN, cut), strict=True):
                    c.append(x)
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=list(FIELDS))


def spans_of(d: np.ndarray, start: np.ndarray, n: np.ndarray, least: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """Runs of windows whose least document lies before ``d``; ``first``: where each group's windows start in ``least``."""
    group = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    hit = np.flatnonzero(least[first[group] + within] < d[group])
    if not len(hit):
        return R.batch_of({"d": d[:0], "start": start[:0], "n": n[:0]})
    new = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (group[hit[1:]] != group[hit[:-1]])))
    edge = np.flatnonzero(new)
    count = np.diff(np.concatenate((edge, [len(hit)])))
    g = group[hit[edge]]
    return R.batch_of({"d": d[g], "start": start[g] + within[hit[edge]], "n": count})


def search_shard(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Index a shard's open groups, then stream its groups through the index.

    Groups with the same words share one backward search for each window.
    """
    held: list[pa.RecordBatch] = []
    index = None
    for batch in batches:
        is_open = batch.column("kind").to_numpy(zero_copy_only=False) == R.OPEN
        if index is None and is_open.any():
            held.append(batch.filter(pa.array(is_open)))
        if is_open.all():
            continue
        index = index or Shard(held, window)
        yield from index.judge(batch.filter(pa.array(~is_open)))
    if held:
        index = index or Shard(held, window)
        yield from index.judge(index.groups)


def exact_values(data: np.ndarray, starts: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """A value for each word that differs for words of different bytes: its hash, unless ``known`` (bytes by hash) has that for another word."""
    first, last = K.words(data)
    values = K.word_hashes(data, first, last)
    _, at, number = np.unique(values, return_index=True, return_inverse=True)
    length = last - first
    same = length == length[at][number]
    size = np.where(same, length, 0)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    wrong = data[place + np.repeat(first, size)] != data[place + np.repeat(first[at][number], size)]
    clash = ~same
    clash[np.repeat(np.arange(len(size)), size)[wrong]] = True
    raw = data.tobytes()

    def settled(i: int) -> int:
        word, value = raw[first[i] : last[i]], int(values[i])
        while known.setdefault(value, word) != word:
            value = (value + 1) % 2**64
        return value

    own = {int(i): settled(int(i)) for i in np.flatnonzero(clash)}
    values = np.array([settled(i) for i in at.tolist()], np.uint64)[number]
    for i, value in own.items():
        values[i] = value
    return values, np.searchsorted(first, starts)


class Shard:
    def __init__(self, batches: list[pa.RecordBatch], window: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        text = K.text_column(table.column("text").chunk(0))
        values, counts = [], []
        known: dict = {}
        for at, to in K.chunks(text):
            v, bounds = exact_values(*K.joined(text, at, to), known)
            values.append(v)
            counts.append(np.diff(bounds))
        values, counts = np.concatenate(values), np.concatenate(counts)
        bounds = np.concatenate(([0], np.cumsum(counts)))
        d, n, name, digest = (table.column(c).to_numpy() for c in ("d", "n", "name", "digest"))
        index = FMIndex(values, bounds, d, window)
        group = np.repeat(np.arange(len(n)), n)
        self.first = np.cumsum(n) - n
        self.least = index.smallest_label(bounds[group] + np.arange(len(group)) - self.first[group], window)
        self.key = (name, digest)
        self.groups = table.drop_columns(["text"]).to_batches()[0]
        self.at = {k: i for i, k in enumerate(zip(name.tolist(), digest.tolist(), strict=True))}

    def judge(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        name, digest, d, start, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in R.FIELDS)
        which = np.array([self.at[k] for k in zip(name.tolist(), digest.tolist(), strict=True)], np.int64)
        for a in range(0, len(d), 65536):
            part = slice(a, a + 65536)
            yield spans_of(d[part], start[part], n[part], self.least, self.first[which[part]])


def hot_windows(batches: Iterator[pa.RecordBatch], window: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows whose anchor is one of ``hot``, each with two independent 64-bit names of its words."""
    for batch in batches:
        d = batch.column("d").to_numpy(zero_copy_only=False)
        text = K.text_column(batch.column("text"))
        for at, to in K.chunks(text):
            values, bounds = K.word_values(*K.joined(text, at, to))
            row, start, n, name, _ = K.groups(values, bounds, window, ANCHOR)
            pick = np.isin(name.view(np.int64), hot)
            row, start, n = row[pick], start[pick], n[pick]
            if not len(row):
                continue
            group = np.repeat(np.arange(len(n)), n)
            begin = start[group] + np.arange(len(group)) - (np.cumsum(n) - n)[group]
            unit = bounds[row[group]] + begin
            other, _ = K.word_values(*K.joined(text, at, to), salt=1)
            w, v = (K.doubled(x, window)[unit].view(np.int64) for x in (values, other))
            yield R.batch_of({"w": w, "v": v, "d": d[at:to][row[group]], "start": begin.astype(np.int64)})


def hot_spans(texts_of: DataFrame, window: int, hot: list[int]) -> DataFrame:
    """Windows under the names ``hot`` that an earlier document holds; they meet by their own words, not by their anchor."""
    names = np.array(hot, np.int64)
    windows = written(texts_of.mapInArrow(lambda it: hot_windows(it, window, names), "w long, v long, d long, start long"), "windows")
    first = written(windows.groupBy("w", "v").agg(F.min("d").alias("first"), F.max("d").alias("last")).filter("first < last").drop("last"), "first")
    return windows.join(first, ["w", "v"]).filter("first < d").select("d", "start", F.lit(1).cast("long").alias("n"))


def cut_words(batches: Iterator[pa.RecordBatch], window: int, texts: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * texts]
    kinds = [pa.int64()] * 3 + [pa.string()] * (1 + texts)
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc, text, spans in zip(batch.column("doc_id").to_pylist(), K.text_column(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            words = text.as_py().split()
            kept = words
            if spans:
                start, n = np.array([s["start"] for s in spans]), np.array([s["n"] for s in spans])
                a, b = merged(start, start + n + window - 1)
                edges = [0, *np.stack((a, b), 1).ravel().tolist(), len(words)]
                kept = [w for x, y in zip(edges[::2], edges[1::2], strict=True) for w in words[x:y]]
            joined = b" ".join(kept)
            for c, x in zip(out, (doc, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()), strict=False):
                c.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)


def substring_dedup(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """Remove each word covered by a window whose words also start in an earlier document.

    Words are runs of bytes other than ASCII white space, unchanged. Windows are
    grouped by anchor; groups whose anchor comes once hold no repeat. The distinct
    other groups are dealt by anchor to shards, so that equal windows meet in one
    shard; each shard is a compressed FM-index over its groups' words, and the
    windows of all documents' groups are searched backwards in it. A name whose
    groups would fill a large part of an index is not indexed: its windows are
    dealt singly, by two 64-bit names of their own words. Returns per
    row doc_id, n_words, n_removed, kept_sha256 and with ``texts`` the kept words.
    A null or empty text has no words; texts shorter than ``window`` are kept
    whole; rows that share an id (or have none) are separate documents in the
    order of their texts, nulls last. Other columns are ignored; an empty table
    gives no rows. In an index words are compared by their bytes; whole groups,
    and the windows of hot names, by two 64-bit names, which two of 10^14 different
    strings share with a probability under 10^-10.
    """
    spark = docs.sparkSession
    rows = ordered_key(docs)
    texts_of = rows.select("d", "text")
    named = lambda it: grouped(it, window)
    often = R.hot_names(texts_of, named)
    sorted_groups = R.by_name(texts_of.mapInArrow(named, R.GROUP), often)
    found = written(sorted_groups.mapInArrow(lambda it: R.sorted_out(it, all_firsts=True, hot=often), R.FOUND), "groups")
    firsts = found.filter(F.col("kind") == R.OPEN)
    held = firsts.groupBy("name").agg(F.sum(F.col("n") + window - 1).alias("words"))
    large = held.filter(F.col("words") > SHARD // HOT).select("name").collect()  # fewer than HOT for each shard
    hot = sorted({*often, *(r["name"] for r in large)})
    if hot:
        found = found.join(F.broadcast(spark.createDataFrame([(x,) for x in hot], "name long")), "name", "left_anti")
        firsts = found.filter(F.col("kind") == R.OPEN)
    total = firsts.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / SHARD))
    lists = firsts.groupBy("d").agg(F.collect_list(F.struct("name", "digest", "start", "n")).alias("spans"))
    indexed = texts_of.join(lists.hint("merge"), "d").mapInArrow(lambda it: with_text(it, window), ROUTED)
    copies = found.filter(F.col("kind") == R.COPY).select(*R.FIELDS, "kind", F.lit(None).cast("binary").alias("text"))
    routed = indexed.unionByName(copies).repartition(shards, "name").sortWithinPartitions(F.col("kind").desc())
    spans = written(routed.mapInArrow(lambda it: search_shard(it, window), "d long, start long, n long"), "spans")
    if hot:
        spans = spans.unionByName(hot_spans(texts_of, window, hot))
    joined = rows.join(listed(spans).hint("merge"), "d", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    return joined.mapInArrow(lambda it: cut_words(it, window, texts), schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
n AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS key FROM n),
m AS (SELECT key, min(doc_id) AS first FROM k GROUP BY key),
hit AS (SELECT DISTINCT k.doc_id, unnest(range(k.i, k.i + 13)) AS pos FROM k JOIN m ON k.key = m.key WHERE m.first < k.doc_id),
a AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
o AS (SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.pos) FILTER (hit.pos IS NULL) AS kept, count(hit.pos) AS gone
      FROM a LEFT JOIN hit ON a.doc_id = hit.doc_id AND a.pos = hit.pos GROUP BY a.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN o ON w.doc_id = o.doc_id
"""
