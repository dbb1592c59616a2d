"""Quality classifier: supervised subword embeddings averaged over a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import kernels as K
from ticklake.llm.shared import read_table, written

#: Hash buckets of words, as many of word bigrams, and as many of character n-grams.
BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
TABLE = 3 * BUCKETS
DIM = 8
#: Documents that the training reads at most, taken in seeded order from all labelled ones, and distinct features of them in all.
SAMPLE, FEATURES = 2000, 20_000_000
EPOCHS = 12
RATE = 10.0


def features(data: np.ndarray, rows: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(positions, buckets)`` of the words, of the word bigrams (any word twice is one bigram), and of each n-gram size; n-grams stay inside words and count bytes. ``rows``: where each joined text starts; bigrams stay inside a text."""
    starts, ends = K.words(data)
    hashes = K.word_hashes(data, starts, ends)
    yield starts, (hashes % K._U(BUCKETS)).astype(np.int32)
    inner = np.ones(len(starts), bool)  # words with a word before them
    inner[:1] = False
    if rows is not None:
        first = np.searchsorted(starts, rows)
        inner[first[first < len(starts)]] = False
    second = np.flatnonzero(inner)
    pairs = (K.doubled(hashes, 2)[second - 1] >> K._U(20) & K._U(BUCKETS - 1)).astype(np.int32)
    pairs[hashes[second] == hashes[second - 1]] = 0
    yield starts[second], pairs + 2 * BUCKETS
    names, have = K._LETTER[data], 1
    sizes = np.zeros(len(data), np.int32)
    if len(starts):
        length = ends - starts
        inside = np.repeat(ends, length) - (np.arange(length.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(length)[:-1])), length))
        sizes[np.flatnonzero(~K._SEPARATOR[data])] = inside  # bytes from here to the word's end
    for n in GRAMS:
        if len(names) <= n - have:
            return
        names, have = K.doubled(names, n, have), n
        at = np.flatnonzero(sizes[: len(names)] >= n)
        yield at, (names[at] >> K._U(20) & K._U(BUCKETS - 1)).astype(np.int32) + BUCKETS


def doc_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a whole text and their shares."""
    found = np.concatenate([b for _, b in features(np.frombuffer(text, np.uint8))] or [np.zeros(0, np.int32)])
    buckets, counts = np.unique(found, return_counts=True)
    return buckets.astype("<i4"), (counts / max(1, len(found))).astype("<f4")


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = K.text_column(batch.column("text"))
        made = [doc_features(t.as_py()) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("place").cast(pa.int64()), batch.column("y").cast(pa.int64()), pa.array([b.tobytes() for b, _ in made], pa.binary()), pa.array([s.tobytes() for _, s in made], pa.binary())], names=["place", "y", "buckets", "shares"])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 0) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent on the cross entropy; returns what each bucket adds to the log odds, and the bias.

    A document's vector is the mean of its features' vectors, the output a
    softmax over the two labels. The step falls linearly from RATE to 0; the
    output layer, which sees means and no shares, takes a tenth of it and the bias
    a thousandth.
    """
    rng = np.random.default_rng(seed)
    table = ((rng.random((TABLE, DIM)) - 0.5) / DIM).astype(np.float32)
    out = np.zeros((DIM, 2), np.float32)
    good = sum(y for y, _, _ in examples)
    bias = np.log(np.array([len(examples) - good + 1.0, good + 1.0], np.float32))
    steps, step = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            y, buckets, shares = examples[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            hidden = shares @ table[buckets]
            odds = hidden @ out + bias
            odds = np.exp(odds - odds.max())
            slip = odds / odds.sum()
            slip[y] -= 1
            back = out @ slip
            out -= rate / 10 * np.outer(hidden, slip)
            bias -= rate / 1000 * slip
            table[buckets] -= rate * np.outer(shares, back)
    gap = out[:, 1] - out[:, 0]
    return (table @ gap).astype(np.float32), float(bias[1] - bias[0])


class QualityModel:
    """Learned weight of each hash bucket; scores are 1 / (1 + exp(-(mean weight + bias)))."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, seed: int = 0) -> QualityModel:
        """Train on at most ``sample`` labelled documents, chosen in seeded order of their ids, as long as they have no more than FEATURES distinct features together.

        The sample is drawn from the label table alone, so only its ids are
        broadcast (a bounded number); the documents are scanned once for their
        texts. Rows whose label or id is null are left out; of an id with several
        labels the largest counts, with several texts the least. Without examples
        of both labels every text scores the smoothed share of label 1.
        """
        known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("y")).filter("_id is not null and y in (0, 1)")
        chosen = known.groupBy("_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(sample).collect()
        spark = docs.sparkSession
        ids = spark.createDataFrame([(i, r["_id"], r.y) for i, r in enumerate(chosen)], "place int, _id long, y int")
        texts = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).groupBy("place", "y").agg(F.min("text").alias("text"))
        rows = written(texts.mapInArrow(_examples, "place long, y long, buckets binary, shares binary"), "examples").orderBy("place")
        examples, held = [], 0
        for r in rows.toLocalIterator():
            held += len(r.buckets) // 4
            if held > FEATURES:
                break
            if len(r.buckets):
                examples.append((r.y, np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.shares, "<f4")))
        if len({y for y, _, _ in examples}) < 2:
            good = sum(y for y, _, _ in examples)
            return cls(np.zeros(TABLE, np.float32), float(np.log((good + 1) / (len(examples) - good + 1))))
        return cls(*train(examples, seed))

    def scores(self, column: pa.Array) -> np.ndarray:
        """The score of each whole text of an Arrow column."""
        column = K.text_column(column)
        out = np.zeros(len(column))
        for at, to in K.chunks(column):
            data, starts = K.joined(column, at, to)
            sums, counts = np.zeros(to - at), np.zeros(to - at)
            for position, buckets in features(data, starts):
                upto = np.concatenate(([0.0], np.cumsum(self.weights[buckets], dtype=np.float64)))
                bound = K.per_doc(position, starts)
                sums += upto[bound[1:]] - upto[bound[:-1]]
                counts += bound[1:] - bound[:-1]
            out[at:to] = sums / np.maximum(counts, 1)
        return 1 / (1 + np.exp(-(out + self.bias)))

    def score(self, docs: DataFrame, threshold: float = 0.3) -> DataFrame:
        """doc_id, score and predicted (score >= threshold) of every row; a null or empty text scores the bias alone. Repeated rows score alike."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = model.scores(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

        return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")

    def keep(self, docs: DataFrame, threshold: float = 0.3) -> DataFrame:
        """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
        model, names = self, docs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(model.scores(batch.column(names.index("text"))) >= threshold))

        return docs.mapInArrow(run, docs.schema)


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_on_table(docs: DataFrame, spark: SparkSession, sf_dir: str) -> QualityModel:
    return QualityModel.fit(docs, read_table(spark, sf_dir, "labels").filter(~is_held_out("doc_id")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = fit_on_table(docs, spark, sf_dir).score(docs)
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", "predicted")
