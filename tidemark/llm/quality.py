"""Quality classifier (operator 1).

Word vectors by random indexing: every word slot (a hash of the word) has a
fixed sparse index vector of a few +1 and -1, and its context vector is the
sum, over all its occurrences in the corpus, of the index vectors of the words
up to ``REACH`` places away.  No vocabulary has to be kept: the table has
``SLOTS`` rows of ``DIM`` numbers whatever the corpus holds.

A document is pooled from the vectors of its words (weighted against very
frequent slots): their mean, their spread, and the mean step from a word to
the next, which vanishes in text that repeats itself.  A network with one
hidden layer, in NumPy, gives the logit; a temperature fitted on labelled rows
kept out of its training makes the logit a calibrated probability.

Spark counts contexts over all documents (sums by slot, with partial sums),
and scores all documents in tasks.  The driver gets the slot table (bounded by
``SLOTS`` x ``DIM``) and the pooled vectors of at most ``SAMPLE`` labelled
rows, the documented bound of the fitting sample; more labelled rows than that
are sampled by a hash of their key.

Defined cases: a null or empty text is pooled to zeros and scored like any
other; without labels every score is 0.5, with labels of one value only it is
a constant near that value; of several labels of one key the smallest counts;
labels without a document and null labels teach nothing; a null key counts as
the empty text for its fold; repeated rows are scored each; other columns are
left out; whole texts are read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ROWS, fold, map_columns, read, slices, small_batches

#: Word slots, length of a vector, non-zero entries of an index vector, and
#: how many places away a word still counts as context.
SLOTS, DIM, NONZERO, REACH = 1 << 15, 32, 2, 2
#: Labelled rows that the network is fitted on at most.
SAMPLE = 20_000
#: Slots whose share of all words is well above this weigh less.
COMMON = 1e-2
#: Score from which a document is predicted to be of quality.
THRESHOLD = 0.7
#: Words pooled at a time, and words whose slots a task remembers.
BLOCK, WORD_MEMORY = 1 << 16, 100_000

WORD = re.compile(r"\w+|[^\w\s]+")


class _Slots(dict):
    """Slot by word; emptied when it is full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        slot = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % SLOTS
        return slot


def _words(texts: list[str | None], slots: _Slots) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all words, and where each text begins (and the last ends)."""
    rows = [np.array([*map(slots.__getitem__, WORD.findall(t))] if t else [], np.int64) for t in texts]
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.cumsum([0, *map(len, rows)])


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every slot's index vector."""
    rng = np.random.RandomState(7)
    return rng.randint(0, DIM, (SLOTS, NONZERO)), rng.choice([-1.0, 1.0], (SLOTS, NONZERO))


def context_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(slot, n, d0 ... d31): occurrences and context sums over all texts."""
    schema = T.StructType(
        [T.StructField("slot", T.IntegerType()), T.StructField("n", T.LongType())]
        + [T.StructField(f"d{i}", T.LongType()) for i in range(DIM)]
    )

    def make():
        slots, (place, sign) = _Slots(), index_vectors()
        total, seen = np.zeros(SLOTS * DIM), np.zeros(SLOTS, np.int64)

        def step(columns):
            nonlocal total, seen
            if columns is None:
                used = np.flatnonzero(seen)
                sums = total.reshape(SLOTS, DIM)[used].astype(np.int64)
                for at in range(0, len(used), 4096):
                    yield [used[at : at + 4096].tolist(), seen[used[at : at + 4096]].tolist()] + [
                        c.tolist() for c in sums[at : at + 4096].T
                    ]
                return
            for part in slices(columns[0]):
                words, begins = _words(columns[0][part], slots)
                seen += np.bincount(words, minlength=SLOTS)
                doc = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
                for off in range(1, REACH + 1):
                    same = doc[off:] == doc[:-off]
                    a, b = words[:-off][same], words[off:][same]
                    for x, y in ((a, b), (b, a)):
                        for k in range(NONZERO):
                            total += np.bincount(x * DIM + place[y, k], sign[y, k], SLOTS * DIM)

        return step

    return (
        map_columns(docs.select(text), schema, make)
        .groupBy("slot")
        .agg(*[F.sum(c).alias(c) for c in schema.names[1:]])
    )


def word_vectors(counts: DataFrame) -> np.ndarray:
    """The slot table (SLOTS x DIM): context sums at unit length, less what
    all words share, weighted against very frequent slots."""
    sums, n = np.zeros((SLOTS, DIM)), np.zeros(SLOTS)
    for row in counts.collect():
        n[row[0]], sums[row[0]] = row[1], row[2:]
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = np.divide(sums, size, out=np.zeros_like(sums), where=size > 0)
    share = n / max(n.sum(), 1)
    unit[n > 0] -= (unit * share[:, None]).sum(axis=0)
    return (unit * (COMMON / (COMMON + share))[:, None]).astype(np.float32)


FEATURES = 3 * DIM + 2


def pool(texts: list[str | None], vectors: np.ndarray, slots: _Slots) -> np.ndarray:
    """One row of FEATURES numbers for each text."""
    parts = [_pool(texts[part], vectors, slots) for part in slices(texts)]
    return np.vstack([np.zeros((0, FEATURES)), *parts])


def _pool(texts: list[str | None], vectors: np.ndarray, slots: _Slots) -> np.ndarray:
    words, begins = _words(texts, slots)
    n = np.diff(begins)
    sums, ones = np.zeros((len(texts), 3 * DIM)), np.ones(BLOCK, np.float32)
    for i, (first, end) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)):
        for at in range(first, end, BLOCK):
            v = vectors[words[at : min(end, at + BLOCK + 1)]]
            step = np.abs(v[1:] - v[:-1])
            sums[i, 2 * DIM :] += ones[: len(step)] @ step
            v = v[:BLOCK]
            sums[i, :DIM] += ones[: len(v)] @ v
            sums[i, DIM : 2 * DIM] += ones[: len(v)] @ (v * v)
    mean = sums / np.maximum(n, 1)[:, None]
    spread = np.sqrt(np.maximum(mean[:, DIM : 2 * DIM] - mean[:, :DIM] ** 2, 0))
    return np.hstack(
        [mean[:, :DIM], spread, mean[:, 2 * DIM :], np.log1p(n)[:, None], np.linalg.norm(mean[:, :DIM], axis=1)[:, None]]
    )


class Network:
    """Two layers and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60) -> None:
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            # a constant near the only label seen, by the rule of succession
            self.constant = (y.sum() + 1) / (len(y) + 2)
            return
        rng = np.random.RandomState(11)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(y))
        # every fifth row is kept for the temperature, where there are enough
        kept = order[::5] if len(y) >= 50 else order
        used = np.setdiff1d(order, kept) if len(y) >= 50 else order
        if y[used].min() == y[used].max() or y[kept].min() == y[kept].max():
            kept = used = order
        p = self.p = [
            rng.randn(x.shape[1], hidden) / np.sqrt(x.shape[1]),
            np.zeros(hidden),
            rng.randn(hidden) / np.sqrt(hidden),
            np.array([np.log(y.mean() / (1 - y.mean()))]),
        ]
        m, v, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs)
            for at in np.array_split(rng.permutation(used), max(1, len(used) // 64)):
                xs, t = x[at], t + 1
                h = np.tanh(xs @ p[0] + p[1])
                miss = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - y[at]) / len(at)
                back = np.outer(miss, p[2]) * (1 - h * h)
                for i, g in enumerate(
                    [xs.T @ back + 1e-3 * p[0], back.sum(axis=0), h.T @ miss + 1e-3 * p[2], miss.sum(keepdims=True)]
                ):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        logit = self._logit(x[kept])
        # targets a little inside 0 and 1: without them rows that are told
        # apart without error would ask for ever larger logits
        one = (y[kept].sum() + 1) / (y[kept].sum() + 2)
        target = np.where(y[kept] > 0, one, 1 / ((1 - y[kept]).sum() + 2))
        loss = lambda temp: (np.logaddexp(0, logit / temp) - target * logit / temp).mean()
        self.temperature = min(np.geomspace(0.25, 16, 161), key=loss)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logit = self._logit((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


class Model:
    def __init__(self, vectors: np.ndarray, network: Network) -> None:
        self.vectors, self.network = vectors, network


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE) -> Model:
    """Word vectors from all of ``docs``, the network from at most ``sample``
    rows of ``labels``."""
    vectors = word_vectors(context_counts(docs, text))
    few = (
        labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("label", T.IntegerType()),
            T.StructField("x", T.ArrayType(T.DoubleType())),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def make():
        slots = _Slots()

        def step(columns):
            if columns is not None:
                yield [columns[0], columns[1], pool(columns[2], shared.value, slots).tolist()]

        return step

    # the sample has a fixed bound, so it is sent to the texts, not they to it
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(few), "_id")
    rows = rows.select(F.col("_id").cast("string"), "_label", "_text")
    learned = sorted((tuple(r) for r in map_columns(rows, schema, make).collect()), key=lambda r: (r[0], r[2]))
    x = np.array([r[2] for r in learned]).reshape(len(learned), FEATURES)
    return Model(vectors, Network(x, np.array([float(r[1] > 0) for r in learned])))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): the calibrated probability that a text is of quality."""
    schema = T.StructType([docs.select(key).schema[0], T.StructField("score", T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        slots = _Slots()

        def step(columns):
            if columns is not None:
                x = pool(columns[1], shared.value.vectors, slots)
                yield [columns[0], shared.value.network.probability(x).tolist()]

        return step

    return map_columns(docs.select(key, text), schema, make)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted to be of quality, all columns
    as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    small_batches(docs.sparkSession)

    def run(batches):
        slots = _Slots()
        for batch in batches:
            good = []
            for first in range(0, batch.num_rows, ROWS):
                x = pool(batch.column(at).slice(first, ROWS).to_pylist(), shared.value.vectors, slots)
                good.append(shared.value.network.probability(x) >= threshold)
            yield batch.filter(pa.array(np.concatenate([np.zeros(0, bool), *good])))
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)


def held_out(key: Column) -> Column:
    return fold(key, 4) == 2


def q_op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op1_quality": q_op1_quality}
