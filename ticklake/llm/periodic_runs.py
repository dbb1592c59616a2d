"""Runs of repeated words: internal pattern matching over dyadic blocks of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.fm_index import Bits
from ticklake.llm.kernels import chunks, text_column
from ticklake.llm.shared import WORD, read_table

#: A run has at least LENGTH words and TIMES periods.
LENGTH, TIMES = 6, 4
#: Words of the shortest blocks; they serve all periods up to their length.
BLOCK = 4

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, n_dropped long, collapsed string"


class RangeSuccessor:
    """A wavelet tree over a sequence of numbers that answers: the least number above x between two places."""

    def __init__(self, values: np.ndarray):
        self.shifts = list(range(len(values).bit_length() - 1, -1, -1))
        self.levels: list[Bits] = []
        for shift in self.shifts:
            bit = (values >> shift & 1).astype(bool)
            self.levels.append(Bits(bit))
            values = np.concatenate((values[~bit], values[bit]))

    def after(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """For each query the least of values[lo:hi] above x, or -1."""
        skip = self._upto(lo, hi, x + 1)
        have = np.flatnonzero(skip < hi - lo)
        found = np.full(len(lo), -1)
        found[have] = self._ranked(lo[have], hi[have], skip[have])
        return found

    def _upto(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of values[lo:hi] are under x."""
        under = np.zeros(len(lo), np.int64)
        for shift, level in zip(self.shifts, self.levels, strict=True):
            one_lo, one_hi = level.ones(lo), level.ones(hi)
            high = (x >> shift & 1).astype(bool)
            under += np.where(high, (hi - one_hi) - (lo - one_lo), 0)
            lo, hi = np.where(high, level.zeros + one_lo, lo - one_lo), np.where(high, level.zeros + one_hi, hi - one_hi)
        return under

    def _ranked(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number of rank k in values[lo:hi]."""
        value = np.zeros(len(lo), np.int64)
        for shift, level in zip(self.shifts, self.levels, strict=True):
            one_lo, one_hi = level.ones(lo), level.ones(hi)
            low = (hi - one_hi) - (lo - one_lo)
            high = k >= low
            k = np.where(high, k - low, k)
            value |= high.astype(np.int64) << shift
            lo, hi = np.where(high, level.zeros + one_lo, lo - one_lo), np.where(high, level.zeros + one_hi, hi - one_hi)
        return value


def refined(rank: np.ndarray, shared: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by twice as many symbols, and the positions that still share theirs with another.

    A rank is the place of the first suffix that has it in suffix order, so it
    bounds an interval of the suffix array. Only ``shared`` positions can change.
    """
    follow = np.where(shared + half < len(rank), rank[np.minimum(shared + half, len(rank) - 1)], -1)
    key = rank[shared] * (len(rank) + 1) + follow + 1
    order = np.argsort(key, kind="stable")
    key, at = key[order], shared[order]
    old, place = rank[at], np.arange(len(at))
    fresh = np.ones(len(at), bool)
    fresh[1:] = key[1:] != key[:-1]
    first = np.ones(len(at), bool)
    first[1:] = old[1:] != old[:-1]
    rank[at] = old + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
    size = np.diff(np.append(np.flatnonzero(fresh), len(at)))
    return rank, np.sort(at[np.repeat(size > 1, size)])


def candidates(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks and the periods that their next occurrences suggest.

    A run of period q in (B/2, B] holds some block of B symbols that starts at a
    multiple of B/2 together with the copy of it q later, and no nearer copy. So
    each block asks the suffix array for its successor in the window of B
    starts after it. (Blocks of BLOCK symbols serve all periods up to BLOCK, since a
    run has at least LENGTH symbols.) Blocks in arithmetic progression that
    suggest one period lie in one run; the first of them is returned.
    """
    _, inverse, counts = np.unique(symbols, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]
    shared = np.flatnonzero(counts[inverse] > 1)
    asked, have = [], 1
    while len(shared) and (have <= BLOCK or (have // 2 + 1) * TIMES <= longest):
        if have >= BLOCK:
            at = shared[shared % (have // 2) == 0]
            size = np.bincount(rank[shared], minlength=len(rank))
            asked.append((at, rank[at], rank[at] + size[rank[at]], np.full(len(at), have)))
        rank, shared = refined(rank, shared, have)
        have *= 2
    if not asked:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, lo, hi, block = (np.concatenate(x) for x in zip(*asked, strict=True))
    period = RangeSuccessor(np.argsort(rank, kind="stable")).after(lo, hi, at) - at
    good = (period > 0) & (period <= block) & ((period > block // 2) | (block == BLOCK))
    at, period, block = at[good], period[good], block[good]
    same = (block[1:] == block[:-1]) & (period[1:] == period[:-1]) & (at[1:] - at[:-1] == block[1:] // 2)
    head = np.concatenate(([True], ~same))[: len(at)]
    return at[head], period[head]


def agreement(symbols: np.ndarray, at: int, period: int, step: int) -> int:
    """How many symbols from ``at`` on, in the direction of ``step``, equal the one a period later."""
    n, width = 0, 64
    while True:
        x = at + n if step > 0 else at - n
        if step > 0:
            same = symbols[x : max(x, min(x + width, len(symbols) - period))]
            same = same == symbols[x + period : x + period + len(same)]
        else:
            low = max(0, x - width + 1)
            same = (symbols[low : x + 1] == symbols[low + period : x + 1 + period])[::-1]
        if not len(same):
            return n
        if not same.all():
            return n + int(np.argmin(same))
        n, width = n + len(same), width * 2


def runs_of(texts: list[list[bytes]], length: int = LENGTH, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """All runs of some texts, given as words: (text, start, length, period), sorted.

    The texts lie behind one another with a symbol of its own after each, so one
    suffix array serves them all and no block or run crosses an end.
    """
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for words in texts for w in words), np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(len(ids) + len(texts), np.int64)
    symbols[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), sizes)] = ids
    symbols[starts + sizes] = len(known) + np.arange(len(texts))
    longest = int(sizes.max(initial=0))
    found = set()
    if longest >= length:
        for at, period in zip(*(x.tolist() for x in candidates(symbols, longest)), strict=True):
            before = agreement(symbols, at - 1, period, -1) if at else 0
            n = before + agreement(symbols, at, period, 1) + period
            if n >= max(length, times * period):
                found.add((at - before, n, period))
    start, n, period = (np.array(x, np.int64) for x in (zip(*sorted(found, key=lambda r: (r[0], r[2])), strict=True) if found else ((),) * 3))
    text = np.searchsorted(starts, start, side="right") - 1
    return text, start - starts[text] if len(start) else start, n, period


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple[list[bytes], int]:
    """Words left when each run keeps its first period, and how many went."""
    if not runs:
        return words, 0
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k], int(len(words) - keep.sum())


def found_runs(batches: Iterator[pa.RecordBatch], length: int, times: int) -> Iterator[pa.RecordBatch]:
    """Runs of each document; about a megabyte of texts, or one longer text, is worked on at a time."""
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        texts = text_column(batch.column(1))
        for at, to in chunks(texts):
            words = [x.split() for x in texts.slice(at, to - at).to_pylist()]  # on bytes: ASCII white space alone
            text, *runs = runs_of(words, length, times)
            bounds = np.searchsorted(text, np.arange(len(words) + 1))
            rows = list(zip(*(x.tolist() for x in runs), strict=True))
            left = [collapsed(w, rows[bounds[i] : bounds[i + 1]]) for i, w in enumerate(words)]
            made = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in runs], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, to - at), pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), made),
                    pa.array([n for _, n in left], pa.int64()), pa.array([b" ".join(w) for w, _ in left], pa.large_binary()).cast(pa.large_string()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "n_dropped", "collapsed"],
            )


def periodic_runs(docs: DataFrame, length: int = LENGTH, times: int = TIMES) -> DataFrame:
    """All maximal runs of repeated words of every document, and its text with each run cut to its first period.

    A run is a stretch of consecutive words with smallest period q (words q apart
    are identical) and at least max(length, times * q) words, that no word beside
    it extends. ``runs`` come by start, then period; places count words from 0.
    ``collapsed`` joins by one space the words that no run holds after its first
    period. A null or empty text has no words and an empty ``collapsed``; repeated
    rows and null ids give rows of their own; other columns are ignored, whatever
    their names; an empty table gives no rows. Nothing is shuffled; a task holds
    about 200 bytes for each word of its longest text.
    """
    if length < LENGTH or times < TIMES:
        raise ValueError(f"blocks find runs of at least {LENGTH} words and {TIMES} periods")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda it: found_runs(it, length, times), RUNS)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, the first of equals; null without runs."""
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    return F.reduce(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by crc32 of its id repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, g = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.call_function("div", h, F.lit(10))
    n = F.size("words").cast("long")
    cut = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    cut = cut.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("rest", F.col("n") - F.col("a")).withColumn("p", 1 + F.call_function("div", F.col("rest"), 3 + F.col("g") % 8))
    unit = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    copies = F.flatten(F.array_repeat(unit, F.ceil(F.col("rest") / F.col("p")).cast("int")))
    made = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice(copies, F.lit(1), F.col("rest").cast("int")))
    return cut.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(read_table(spark, sf_dir, "documents"))).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words", "n_dropped",
    )
