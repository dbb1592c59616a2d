"""Chroma audio fingerprints of a media column, and their alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import kernels as K
from ticklake.llm.repeats import batch_of
from ticklake.llm.shared import read_table, written

#: Samples a second, of a frame and between frames.
RATE, FRAME, HOP = 4000, 512, 256
#: Frequencies that count towards pitch classes.
LOW, HIGH = 110.0, 1760.0
#: Frames that a fingerprint number looks at.
CONTEXT = 8
#: Quarter tones of a note: samples that one value of a derived recording sounds.
NOTE = 512
#: An alignment counts with a bit error rate up to ERRORS over at least OVERLAP numbers.
ERRORS, OVERLAP = 0.15, 32
PRINTS = "id long, prints array<int>"
#: Landmarks: the bits of each tuple's masks in the numbers at these distances. One that two recordings share is a vote for its offset.
CLEAN = (0, 8, 16), [(m,) * 3 for m in (0x0000FFFF, 0x00FFFF00, 0xFFFF0000)]
#: Sixteen landmarks of 32 bits, a byte of each of four numbers: one or more survive error rates up to ERRORS, for many more offsets to compare.
NOISY = (0, 4, 8, 12), [tuple(0xFF << 8 * ((start + turn * i) % 4) for i in range(4)) for turn in range(4) for start in range(4)]
#: Links that one row of ``links_of`` lists.
LISTED = 1024

#: The bank: each filter is (frames, first pitch class, pitch classes, how its rectangle is halved).
FILTERS = [(w, c, h, kind) for kind in ("whole", "time", "pitch", "cross") for w, c, h in ((2, 0, 12), (4, 0, 6), (4, 6, 6), (8, 3, 6))]
#: Limits of the log ratio between the halves that give the two bits 0, 1, 3, 2 (Gray code).
LEVELS = (-0.3, 0.0, 0.3)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Energy of the twelve pitch classes in each frame, scaled to length 1."""
    if len(samples) < FRAME:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float64), FRAME)[::HOP] * np.hanning(FRAME)
    power = np.abs(np.fft.rfft(frames)) ** 2
    hertz = np.fft.rfftfreq(FRAME, 1 / RATE)
    used = (hertz >= LOW) & (hertz <= HIGH)
    pitch = np.round(12 * np.log2(hertz[used] / 440.0)).astype(int) % 12
    classes = np.zeros((len(frames), 12))
    for k in range(12):
        classes[:, k] = power[:, used][:, pitch == k].sum(1)
    return classes / np.maximum(np.linalg.norm(classes, axis=1, keepdims=True), 1e-9)


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """A packed 32-bit number for each run of CONTEXT frames: two bits for each filter of the bank over the integral image."""
    image = chroma(samples)
    n = len(image) - CONTEXT + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(image) + 1, 13))
    total[1:, 1:] = image.cumsum(0).cumsum(1)
    at = np.arange(n)

    def area(t: int, c: int, w: int, h: int) -> np.ndarray:
        return total[at + t + w, c + h] - total[at + t, c + h] - total[at + t + w, c] + total[at + t, c]

    out = np.zeros(n, np.uint32)
    for i, (w, c, h, kind) in enumerate(FILTERS):
        a, b = w // 2, h // 2
        if kind == "whole":
            up, down = area(0, c, w, h), area(0, 0, w, 12) / 2
        elif kind == "time":
            up, down = area(0, c, a, h), area(a, c, w - a, h)
        elif kind == "pitch":
            up, down = area(0, c, w, b), area(0, c + b, w, h - b)
        else:
            up, down = area(0, c, a, b) + area(a, c + b, w - a, h - b), area(0, c + b, a, h - b) + area(a, c, w - a, b)
        level = np.searchsorted(LEVELS, np.log((up + 0.01) / (down + 0.01)), side="right").astype(np.uint32)
        out |= (level ^ (level >> np.uint32(1))) << np.uint32(2 * i)
    return out


def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [fingerprint(np.frombuffer(x[: len(x) & ~1], "<i2")).view(np.int32).tolist() if x else [] for x in batch.column("media").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(made, pa.list_(pa.int32()))], names=["id", "prints"])


def fingerprints(media: DataFrame) -> DataFrame:
    """``(id, prints)`` from (id, media): media holds 16-bit mono samples at RATE; prints are the packed numbers.

    A null, empty or too short recording has none. A batch of Spark's Arrow
    transfer is in memory at a time: for long recordings set
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` accordingly.
    """
    return media.select("id", "media").mapInArrow(fingerprinted, PRINTS)


def errors(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[int, int]:
    """Differing bits and compared numbers where number i + offset of ``a`` meets number i of ``b``."""
    i, j = max(0, offset), max(0, -offset)
    n = min(len(a) - i, len(b) - j)
    return int(np.bitwise_count(a[i : i + n] ^ b[j : j + n]).sum()), n


def landmarks(batches: Iterator[pa.RecordBatch], marks: tuple) -> Iterator[pa.RecordBatch]:
    """``(key, r, at, n)``: each run of n equal landmarks of each recording and where it starts (a held tone is one row)."""
    span, masks = marks
    for batch in batches:
        lists = batch.column("prints")
        size = np.array([len(x) for x in lists])
        numbers = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint32)
        ends = np.cumsum(size)
        place = np.arange(len(numbers)) - np.repeat(ends - size, size)
        whole = np.flatnonzero(np.repeat(size, size) - place > span[-1])
        if not len(whole):
            continue
        r, at = np.repeat(batch.column("r").to_numpy(zero_copy_only=False), size)[whole], place[whole]
        for k, mask in enumerate(masks):
            key = np.full(len(whole), k + 1, np.uint64)
            for step, bits in zip(span, mask, strict=True):
                key = K.mix(key * K._U(K._BASE) + (numbers[whole + step] & np.uint32(bits)).astype(np.uint64))
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (at[1:] == 0))))
            n = np.diff(np.append(first, len(key)))
            yield batch_of({"key": key[first].view(np.int64), "r": r[first], "at": at[first].astype(np.int32), "n": n.astype(np.int32)})


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bit errors of candidates (q, r, shift, asked, known); those within the limits stay."""
    for batch in batches:
        q, r, shift = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("q", "r", "shift"))
        out = []
        for i, (a, b) in enumerate(zip(batch.column("asked"), batch.column("known"), strict=True)):
            a, b = (x.values.to_numpy(zero_copy_only=False).view(np.uint32) for x in (a, b))
            bits, n = errors(b, a, int(shift[i]))
            if n >= OVERLAP and bits <= ERRORS * 32 * n:
                x, y = max(0, -int(shift[i])), max(0, int(shift[i]))
                out.append((q[i], r[i], shift[i], int((a[x : x + n] == b[y : y + n]).sum()), n, bits / (32 * n)))
        columns = [np.array(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5 + [np.zeros(0)]
        yield batch_of(dict(zip(("q", "r", "shift", "votes", "overlap", "ber"), [*(c.astype(np.int64) for c in columns[:5]), columns[5]], strict=True)))


def classes_of(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recordings with equal fingerprints: ``(id, r)`` for each, and ``(r, prints)`` for each class, r its least id."""
    key = [F.xxhash64("prints").alias("h"), F.hash("prints").alias("g")]
    rows = written(prints.filter("id is not null and size(prints) > 0").select("id", *key, "prints"), "prints")
    reps = written(rows.groupBy("h", "g").agg(F.min("id").alias("r"), F.first("prints").alias("prints")), "classes")
    return written(rows.select("id", "h", "g").join(reps.select("h", "g", "r"), ["h", "g"]).select("id", "r"), "members"), reps.select("r", "prints")


def aligned_classes(prints: DataFrame, queries: DataFrame, marks: tuple = CLEAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(pairs, member, wanted)``: aligned classes (q, r, x: the best alignment), the recordings' classes and the queries' (both: id, r)."""
    member, reps = classes_of(prints)
    wanted, asked = classes_of(queries)
    columns = "key long, r long, at int, n int"
    known = reps.mapInArrow(lambda it: landmarks(it, marks), columns)
    searched = asked.mapInArrow(lambda it: landmarks(it, marks), columns).withColumnsRenamed({"r": "q", "at": "asked_at", "n": "asked_n"})
    shifts = F.sequence(F.expr("bigint(at - asked_at - asked_n + 1)"), F.expr("bigint(at - asked_at + n - 1)"))
    offsets = searched.join(known, "key").select("q", "r", F.explode(shifts).alias("shift"))
    offsets = written(offsets.distinct(), "offsets")
    both = offsets.join(asked.select(F.col("r").alias("q"), F.col("prints").alias("asked")), "q").join(reps.select("r", F.col("prints").alias("known")), "r")
    good = both.select("q", "r", "shift", "asked", "known").mapInArrow(compared, "q long, r long, shift long, votes long, overlap long, ber double")
    best = F.min(F.struct("ber", (-F.col("overlap")).alias("less"), "shift", "votes")).alias("x")
    return written(good.groupBy("q", "r").agg(best), "aligned"), member, wanted


def align(prints: DataFrame, queries: DataFrame, marks: tuple = CLEAN) -> DataFrame:
    """Recordings of ``prints`` that align with a recording of ``queries`` (both: id, prints).

    Equal fingerprints (whole lists) form a class, searched once. ``marks`` says
    which bits of which numbers make a landmark; every recording is indexed by
    all of its landmarks, a run of equal ones by one row, and each that it shares
    with a query votes for an offset, two runs for each that brings them together.
    Every offset with a vote is then compared bit by bit. Returns query_id, id, shift, votes (equal numbers),
    overlap and ber for alignments with a rate up to ERRORS over OVERLAP numbers
    or more, for each pair the one of the least rate (ties: longest overlap, then
    least shift), each recording of a class by itself. An alignment without a
    common landmark is missed: CLEAN finds nearly all up to 5 % of bit errors
    and about nine of ten at 8 %, NOISY those up to ERRORS (the README has both against comparing all offsets of all
    pairs). Ids that repeat with other fingerprints, and rows that repeat, are
    recordings of their own; rows without an id or numbers align with nothing;
    other columns are ignored; empty tables give no rows.
    """
    pairs, member, wanted = aligned_classes(prints, queries, marks)
    out = pairs.join(member, "r").join(wanted.select(F.col("r").alias("q"), F.col("id").alias("query_id")), "q")
    return out.select("query_id", "id", F.col("x.shift").alias("shift"), F.col("x.votes").alias("votes"), (-F.col("x.less")).alias("overlap"), F.col("x.ber").alias("ber"))


def synthesised(batches: Iterator[pa.RecordBatch], first: int, last: int | None, noise: int) -> Iterator[pa.RecordBatch]:
    time = np.arange(NOTE) / RATE
    tones = (np.sin(2 * np.pi * 220.0 * 2 ** (np.arange(24) / 12)[:, None] * time) * 12000).astype("<i2")
    for whole in batches:
        for at in range(0, whole.num_rows, 128):  # a recording is large against its vector
            batch = whole.slice(at, 128)
            made = []
            for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                x = np.nan_to_num(np.array([v or 0.0 for v in vector or []], float))
                note = np.clip(np.round((x / max(x.std(), 1e-9) + 2.5) * 24 / 5), 0, 23).astype(int)[first:last] if len(x) else []
                samples = tones[note].ravel() if len(note) else np.zeros(0, "<i2")
                if noise:
                    samples = (samples + np.random.default_rng(abs(key or 0)).integers(-noise, noise, len(samples))).astype("<i2")
                made.append(samples.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").cast(pa.int64()), pa.array(made, pa.binary())], names=["id", "media"])


def recordings(embeddings: DataFrame, first: int = 0, last: int | None = None, noise: int = 0) -> DataFrame:
    """``(id, media)``: a recording derived from each vector, a tone of NOTE samples for each value.

    The value's standing among the vector's values picks one of 24 semitones from
    220 Hz. ``first`` and ``last`` cut an excerpt of values; ``noise`` is the range
    of the noise added to it, seeded by the id.
    """
    return embeddings.select("vec_id", "embedding").mapInArrow(lambda it: synthesised(it, first, last, noise), "id long, media binary")


def derived_prints(embeddings: DataFrame, first: int = 0, last: int | None = None, noise: int = 0) -> DataFrame:
    """Fingerprints of ``recordings`` without their samples leaving the task."""
    return embeddings.select("vec_id", "embedding").mapInArrow(lambda it: fingerprinted(synthesised(it, first, last, noise)), PRINTS)


def links_of(pairs: DataFrame, member: DataFrame, wanted: DataFrame) -> DataFrame:
    """The links of ``aligned_classes`` and the members of its classes, with none lost and no copies expanded.

    Rows of kind ``query``, one for each query that aligns: query_class, class_id
    (the least recording it aligns with), n_links (with how many), the alignment
    of the least rate, and in ``linked`` all classes it aligns with, each with its
    alignment. The list stands at the query that names its class; one of over
    LISTED entries is dealt to further rows of that query (``part``). Rows of kind
    ``recording``, one for each recording with numbers: id and class_id, the least
    id of equal fingerprints. Rows grow with the recordings, not with pairs.
    """
    sizes = member.groupBy("r").agg(F.count("*").alias("size"))
    found = written(pairs.join(sizes, "r"), "links")
    best = F.min(F.struct("x.ber", "x.less", F.col("r").alias("id"), "x.shift", "x.votes")).alias("best")
    total = found.groupBy("q").agg(F.min("r").alias("class_id"), F.sum("size").alias("n_links"), F.count("*").alias("classes"), best)
    link = F.struct(F.col("r").alias("class_id"), "size", "x.shift", "x.votes", (-F.col("x.less")).alias("overlap"), "x.ber")
    part = F.pmod(F.xxhash64("r"), F.ceil(F.col("classes") / LISTED)).cast("int").alias("part")
    lists = found.join(total.select("q", "classes"), "q").groupBy("q", part).agg(F.sort_array(F.collect_list(link)).alias("linked"))
    asked = wanted.groupBy("id", "r").agg(F.count("*").alias("rows")).select(F.col("id").alias("query_id"), F.col("r").alias("q"))
    named = lists.withColumn("query_id", F.col("q"))
    rows = asked.join(total, "q").join(named, ["q", "query_id"], "left")
    rows = rows.select(
        F.lit("query").alias("kind"), "query_id", F.col("q").alias("query_class"), "class_id", "n_links", F.col("best.id").alias("id"), F.col("best.shift").alias("shift"),
        F.col("best.votes").alias("votes"), (-F.col("best.less")).alias("overlap"), F.col("best.ber").alias("ber"), "part", "linked",
    )
    return rows.unionByName(member.select(F.lit("recording").alias("kind"), "id", F.col("r").alias("class_id")), allowMissingColumns=True)


def op6_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With which recordings, of all, the noisy excerpts of those whose id is divisible by 50 align: a row for each excerpt, and the recordings' classes."""
    vectors = read_table(spark, sf_dir, "embeddings")
    asked = derived_prints(vectors.filter("vec_id % 50 = 0"), first=16, last=56, noise=600)
    return links_of(*aligned_classes(derived_prints(vectors), asked))
