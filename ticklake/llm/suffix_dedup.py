"""Removes long repeated byte strings by distributed prefix doubling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import kernels as K
from ticklake.llm import repeats as R
from ticklake.llm.shared import ordered_key, read_table, removed, written

#: Bytes of a repeated string.
THRESHOLD = 100
#: Prefix lengths at which anchors alone are ranked, before every position that is left.
ROUNDS = (24, 48, 96)

SPANS = "array<struct<start:bigint,n:bigint>>"
PIECE = "d long, base long, text binary"


def ranked(batches: Iterator[pa.RecordBatch], threshold: int, length: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a position and its name (rank) at prefix length ``length``, one for each group of windows that shares them."""
    for batch in batches:
        d, base = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("d", "base"))
        text = K.text_column(batch.column("text"))
        for at, to in K.chunks(text):
            data, bounds = K.joined(text, at, to, b"")
            found = K.groups(K._LETTER[data], bounds, threshold, length)
            yield R.group_batch(d[at:to], found, base[at:to])


def steps_of(threshold: int, start: int) -> list[int]:
    """Offsets of the rounds that double prefixes from ``start`` to ``threshold`` bytes."""
    steps, have = [], start
    while have < threshold:
        steps.append(min(have, threshold - have))
        have += steps[-1]
    return steps


def places_of(threshold: int, start: int) -> list[int]:
    """Places of a window whose prefixes of ``start`` bytes the rounds need."""
    out = {0}
    for step in reversed(steps_of(threshold, start)):
        out |= {x + step for x in out}
    return sorted(out)


def prefixes(batches: Iterator[pa.RecordBatch], threshold: int, length: int) -> Iterator[pa.RecordBatch]:
    """``(name, other, d, piece, at)``: two independent names of the ``length`` bytes at the places of which whole windows are put together."""
    for batch in batches:
        d, base = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("d", "base"))
        text = K.text_column(batch.column("text"))
        for at, to in K.chunks(text):
            data, bounds = K.joined(text, at, to, b"")
            size = np.diff(bounds)
            row = np.repeat(np.arange(to - at), size)
            place = np.arange(len(data)) - bounds[row]
            whole = size[row] - place >= threshold  # a window starts here
            use = whole.copy()
            for step in places_of(threshold, length):  # and these are the places at which it is put together
                if 0 < step < len(data):
                    use[step:] |= whole[:-step] & (row[step:] == row[:-step])
            pick = np.flatnonzero(use & (size[row] - place >= length))
            if not len(pick):
                continue
            names = [K.doubled(x, length)[pick].view(np.int64) for x in (K._LETTER[data], K.mix(K._LETTER[data] + K._U(K._BASE)))]
            owner = row[pick]
            yield R.batch_of({"name": names[0], "other": names[1], "d": d[at:to][owner], "piece": base[at:to][owner], "at": (place[pick] + base[at:to][owner]).astype(np.int64)})


def doubled_ranks(rows: DataFrame, threshold: int, start: int) -> DataFrame:
    """Repeats ``(d, start, n)`` of rows (d, base, text) by prefix doubling over positions.

    Names of prefixes of ``start`` bytes that come more than once get a rank. Then
    each position meets the rank at a growing offset; Spark groups the pairs of
    ranks, those that come once are unique and leave, the others get a new rank.
    A position whose partner has left is unique too. At the threshold all but the
    first position of a pair repeat it. Sums precede every shuffle of a rank, and
    the joins are plain ones, so that adaptive execution can split a hot rank.
    """
    names = rows.mapInArrow(lambda it: prefixes(it, threshold, start), "name long, other long, d long, piece long, at long")
    ranks = names.groupBy("name", "other").agg(F.count("*").alias("n")).filter("n > 1")
    ranks = written(ranks.select("name", "other", F.monotonically_increasing_id().alias("rank")), "ranks")
    places = written(names.join(ranks, ["name", "other"]).select("d", "piece", "at", "rank"), "places")
    steps = steps_of(threshold, start)
    for i, step in enumerate(steps):
        ahead = places.select("d", "piece", (F.col("at") - step).alias("at"), F.col("rank").alias("next"))
        pairs = written(places.join(ahead, ["d", "piece", "at"]), "pairs")
        removed(rows.sparkSession, ranks, places)
        ranks = pairs.groupBy("rank", "next").agg(F.count("*").alias("n"), F.min(F.struct("d", "at")).alias("first")).filter("n > 1")
        if i < len(steps) - 1:
            ranks = written(ranks.select("rank", "next", F.monotonically_increasing_id().alias("new")), "ranks")
            places = written(pairs.join(ranks, ["rank", "next"]).select("d", "piece", "at", F.col("new").alias("rank")), "places")
            removed(rows.sparkSession, pairs)
    repeats = pairs.join(ranks, ["rank", "next"]).filter(F.struct("d", "at") > F.col("first"))
    out = written(repeats.select("d", F.col("at").alias("start"), F.lit(1).cast("long").alias("n")), "last")
    removed(rows.sparkSession, pairs)
    return out


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]


def intervals(batch: pa.RecordBatch, column: str) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Start and count arrays of each row's list of spans."""
    lists = batch.column(column)
    flat = lists.flatten()
    start, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    bounds = np.concatenate(([0], np.cumsum([len(x) if x.is_valid else 0 for x in lists])))
    return [(start[a:b], n[a:b]) if b > a else None for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def pieces(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """The text under the windows that are still open."""
    for batch in batches:
        out: list[list] = [[], [], []]
        texts = K.text_column(batch.column("text"))
        for d, base, text, spans in zip(batch.column("d").to_pylist(), batch.column("base").to_pylist(), texts, intervals(batch, "spans"), strict=True):
            if spans is None:
                continue
            raw, (start, n) = text.as_py(), spans
            start = start - base
            inside = (start >= 0) & (start + n + threshold - 1 <= len(raw))
            if not inside.any():
                continue
            a, b = merged(start[inside], start[inside] + n[inside])
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                for column, v in zip(out, (d, base + x, raw[x : y + threshold - 1]), strict=True):
                    column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["d", "base", "text"])


def listed(rows: DataFrame) -> DataFrame:
    """The spans of each document in a list (as many as the document has groups at most)."""
    return rows.groupBy("d").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def repeated_windows(rows: DataFrame, threshold: int = THRESHOLD, rounds=ROUNDS, start: int | None = None) -> list[DataFrame]:
    """Spans ``(d, start, n)``: n window starts from ``start`` whose ``threshold`` bytes also start earlier.

    ``rows``: d (the order of documents), base, text. Two windows are equal only
    if the prefixes at their anchors are; so the first rounds rank one anchor for
    a group of neighbouring windows: Spark sorts the (name, position) pairs, and
    positions with a name of their own are unique and leave, as do groups that
    repeat an earlier group whole. Every position that is left goes through
    ``doubled_ranks``, from prefixes of ``start`` bytes (half of the threshold).
    """
    spark, spans = rows.sparkSession, []
    for length in rounds:
        named = lambda it, n=length: ranked(it, threshold, n)
        pieces_of = rows.select("d", "base", "text")
        hot = R.hot_names(pieces_of, named)
        pairs = R.by_name(pieces_of.mapInArrow(named, R.GROUP), hot)
        found = written(pairs.mapInArrow(lambda it, hot=hot: R.sorted_out(it, hot=hot), R.FOUND), f"round{length}")
        spans.append(found.filter(F.col("kind") == R.COPY).select("d", "start", "n"))
        still = listed(found.filter(F.col("kind") == R.OPEN))
        before, rows = rows, written(rows.join(still.hint("merge"), "d").mapInArrow(lambda it: pieces(it, threshold), PIECE), "pieces")
        if length != rounds[0]:
            removed(spark, before)
    spans.append(doubled_ranks(rows, threshold, start or (threshold + 1) // 2))
    removed(spark, rows)
    return spans


def cut_out(batches: Iterator[pa.RecordBatch], threshold: int, texts: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * texts]
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * texts
    for batch in batches:
        out: list[list] = [[] for _ in names]
        column = K.text_column(batch.column("text"))
        for doc, text, spans in zip(batch.column("doc_id").to_pylist(), column, intervals(batch, "spans"), strict=True):
            raw = text.as_py()
            kept, gone, n = raw, 0, 0
            if spans:
                a, b = merged(spans[0], spans[0] + spans[1] + threshold - 1)
                edges = [0, *np.stack((a, b), 1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                gone, n = len(raw) - len(kept), len(a)
            for c, x in zip(out, (doc, len(raw), gone, n, hashlib.sha256(kept).hexdigest(), kept), strict=False):
                c.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)


def suffix_dedup(docs: DataFrame, threshold: int = THRESHOLD, texts: bool = False) -> DataFrame:
    """Remove each byte under a ``threshold``-byte string that also starts earlier.

    Earlier: in a document of smaller doc_id, or before it in the same one;
    strings are judged on the input. Returns per row doc_id, n_bytes, n_removed,
    n_spans, kept_sha256, and with ``texts`` the kept bytes. A null text is empty;
    texts shorter than ``threshold`` are kept whole; rows that share an id (or
    have none) are separate documents in the order of their texts, nulls last.
    Other columns are ignored; an empty table gives no rows. Strings are compared
    by two names of 64 bits each, made of nonlinear steps: among 10^14 strings two
    different ones have the same pair with a probability under 10^-10.
    """
    rows = ordered_key(docs)
    windows = repeated_windows(rows.select("d", F.lit(0).cast("long").alias("base"), "text"), threshold)
    spans = windows[0]
    for more in windows[1:]:
        spans = spans.unionByName(more)
    joined = rows.join(listed(spans).hint("merge"), "d", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return joined.mapInArrow(lambda it: cut_out(it, threshold, texts), schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"))
