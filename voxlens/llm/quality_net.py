"""Operator 9, quality classifier: random-indexing word vectors pooled per
document, a two-layer numpy network, temperature-calibrated probabilities.

Words are runs of letters and digits or runs of other visible characters,
lower-cased, hashed to ``BUCKETS`` buckets. Each bucket has a sparse ternary index
vector of ``DIM`` places; a bucket's context vector is the sum of the index
vectors of the words within ``REACH`` places, over the whole corpus. Each word
also carries a marker (its shape, whether the text had it before, whether it
repeats its predecessor) with an index vector of its own. A document is the mean
of its words' normalised context vectors, the mean of its markers' index vectors,
and the logarithm of its length.

Learning: labels are read for training rows only; a sample of at most about
``MAX_PER_CLASS`` rows of each class (chosen by the id's hash, at the rate that
the class's count asks for) fits the network. A fifth of it sets the temperature.

Scale: two passes over the texts (corpus vectors, scores) and one over the sample.
A task sends one partial table of BUCKETS x DIM sums in ``CHUNKS`` pieces, which
are summed in two levels; there are TASKS_PER_CORE tasks a core, so their number
follows the cluster and not the data; driver and broadcast hold the table (bounded by the
parameters) and the sample's features (bounded by MAX_PER_CLASS).

Defined cases: NULL and empty texts have the features of no word and still get
a score; a NULL label does not train; labels of only one class, or none, give
the share of that class (0.5 where there is none) to all; of a training row's
texts (a repeated doc_id) the smallest teaches; repeated documents are scored row by row; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.llm import textops as X
from voxlens.llm.common import crc_mod, fresh

BUCKETS, DIM, ONES, REACH = 1 << 13, 64, 4, 2
MARKER_DIM = 32
#: Training rows of a class, about.
MAX_PER_CLASS = 4000
#: Pieces of the table that are summed separately, and tasks whose pieces are summed first.
CHUNKS, FIRST_LEVEL = 64, 64
#: Tasks a core that make partial tables; each reads the input partitions that lie together.
TASKS_PER_CORE = 4
HIDDEN, ROUNDS, RATE, DECAY, SEED = 32, 400, 0.01, 1e-3, 7

_SHAPES = 6  # lower, capitalised, upper, mixed, digits, other characters
_HASH = X._splitmix(BUCKETS * ONES, 5).reshape(BUCKETS, ONES)
_PLACE = (_HASH % np.uint64(DIM)).astype(np.int64)
_SIGN = np.where(_HASH >> np.uint64(63), 1.0, -1.0)
_MARKERS = np.where(X._splitmix(_SHAPES * 4 * MARKER_DIM, 11).reshape(-1, MARKER_DIM) >> np.uint64(63), 1.0, -1.0)


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and marker of each word of a text."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cp = X.code_points(text)
    lower = X.lower_ascii(cp)
    alnum = X.alnum_mask(lower)
    kind = np.where(alnum, 1, 2 * X.spaced_mask(cp)).astype(np.int8)
    edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    ends = np.append(edge[1:], len(cp))
    word = kind[edge] > 0
    starts, ends = edge[word], ends[word]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = X.word_hashes(lower, starts, ends)
    upper = lower != cp
    n_upper = np.add.reduceat(upper, starts) if len(starts) else upper  # up to the next start: spaces have none
    n_digit = np.add.reduceat(cp - 48 < 10, starts)
    size = ends - starts
    shape = np.where(kind[starts] == 2, 5, np.where(n_digit == size, 4, np.where(
        n_upper == 0, 0, np.where((n_upper == 1) & upper[starts] & (size > 1), 1, np.where(n_upper == size, 2, 3)))))
    before = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    order = np.argsort(hashes, kind="stable")
    again = np.zeros(len(hashes), bool)
    again[order[1:]] = hashes[order][1:] == hashes[order][:-1]
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), shape * 4 + again * 2 + before


def context_sums(texts: DataFrame) -> np.ndarray:
    """The context vectors of all buckets over all texts of the single column."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        total = np.zeros(BUCKETS * DIM)
        for batch in batches:
            rows = [tokens(t)[0] for t in batch.column(0).to_pylist() if t]
            if not rows:
                continue
            word = np.concatenate(rows)
            row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            for step in range(1, REACH + 1):
                same = row[step:] == row[:-step]
                a, b = word[:-step][same], word[step:][same]
                for k in range(ONES):
                    total += np.bincount(a * DIM + _PLACE[b, k], _SIGN[b, k], BUCKETS * DIM)
                    total += np.bincount(b * DIM + _PLACE[a, k], _SIGN[a, k], BUCKETS * DIM)
        if total.any():
            pieces = [c.astype("<f4").tobytes() for c in np.split(total, CHUNKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(CHUNKS), pa.int32()), pa.array([task % FIRST_LEVEL] * CHUNKS, pa.int32()),
                 pa.array(pieces, pa.binary())], ["chunk", "level", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s, "<f4").astype(np.float64) for s in pdf["sums"])
        return pd.DataFrame({"chunk": pdf["chunk"][:1], "level": pdf["level"][:1],
                             "sums": [total.astype("<f4").tobytes()]})

    schema = "chunk int, level int, sums binary"
    tasks = TASKS_PER_CORE * texts.sparkSession.sparkContext.defaultParallelism
    summed = texts.coalesce(tasks).mapInArrow(partial, schema).groupBy("chunk", "level").applyInPandas(add, schema) \
        .groupBy("chunk").applyInPandas(add, schema)
    out = np.zeros((CHUNKS, BUCKETS * DIM // CHUNKS))
    for r in summed.collect():  # CHUNKS rows
        out[r.chunk] = np.frombuffer(r.sums, "<f4")
    return out.reshape(BUCKETS, DIM)


def normalised(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors, with the common direction taken out."""
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
    met = norm[:, 0] > 0
    if met.any():
        unit[met] -= unit[met].mean(axis=0)
    return unit.astype(np.float32)


def features(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """A document's pooled vector."""
    word, marker = tokens(text)
    out = np.zeros(DIM + MARKER_DIM + 2)
    if len(word):
        out[:DIM] = vectors[word].mean(axis=0)
        share = np.bincount(marker, minlength=len(_MARKERS)) / len(word)
        out[DIM:-2] = share @ _MARKERS
        out[-2] = np.log1p(len(word))
    out[-1] = len(word) == 0
    return out


class Net:
    """Standardised inputs, tanh layer, logistic output, temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature = \
            mean, scale, w1, b1, w2, b2, temperature

    def probability(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-np.clip((hidden @ self.w2 + self.b2) / self.temperature, -30, 30)))


class Constant:
    """What is left where the labels have one class or none."""

    def __init__(self, share: float):
        self.share = share

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Net | Constant:
    """A network trained by Adam on four fifths of the rows; the rest sets the temperature."""
    if len(set(y.tolist())) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(SEED)
    weight = np.ones(len(y)) if weight is None else weight
    held = np.zeros(len(y), bool)
    held[rng.permutation(len(y))[:len(y) // 5]] = True
    mean, scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-3
    z, t, v = (x[~held] - mean) / scale, y[~held], weight[~held] / weight[~held].sum()
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, ROUNDS + 1):
        hidden = np.tanh(z @ p[0] + p[1])
        out = 1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30)))
        d = (out - t) * v
        back = np.outer(d, p[2]) * (1 - hidden ** 2)
        grads = [z.T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ d + DECAY * p[2], d.sum(keepdims=True)]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            s[i] = 0.999 * s[i] + 0.001 * g * g
            p[i] = p[i] - RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(s[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Net(mean, scale, *p, 1.0)
    if held.sum() >= 20 and len(set(y[held].tolist())) == 2:
        logit = np.tanh((x[held] - mean) / scale @ p[0] + p[1]) @ p[2] + p[3]

        def loss(temperature: float) -> float:
            q = logit / temperature
            return float(((np.logaddexp(0, q) - y[held] * q) * weight[held]).sum())

        net.temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    return net


class Classifier:
    def __init__(self, vectors: np.ndarray, net: Net | Constant):
        self.vectors, self.net = vectors, net

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        return self.net.probability(np.stack([features(t, self.vectors) for t in texts]))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality",
          training=None, max_per_class: int = MAX_PER_CLASS) -> Classifier:
    """A classifier of ``label``. ``training`` is a predicate on doc_id that label rows must meet."""
    spark = docs.sparkSession
    vectors = normalised(context_sums(docs.select(text)))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")) \
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
    if training is not None:
        known = known.where(training)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(0.0)
    for y, n in sizes.items():
        rate = F.when(F.col("y") == y, F.lit(min(1.0, max_per_class / n))).otherwise(rate)
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < rate * (1 << 20))
    shared = spark.sparkContext.broadcast(vectors)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def pooled(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([features(t, shared.value).astype(np.float32) for t in batch])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    one = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    sample = one.select("doc_id", "y", pooled("text").alias("x")).toPandas().sort_values("doc_id")  # bounded by the sample
    if not len(sample):
        return Classifier(vectors, Constant(0.5))
    x, y = np.stack(sample["x"].to_numpy()).astype(np.float64), sample["y"].to_numpy()
    weight = np.where(y == 1, *(max(1.0, sizes.get(c, 0) / max_per_class) for c in (1.0, 0.0)))
    return Classifier(vectors, fit(x, y, weight))


def score_udf(classifier):
    """Scalar pandas UDF text -> probability; ``classifier`` is broadcast."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(classifier.value.score(list(batch)), dtype="float64")

    return score


def with_score(docs: DataFrame, labels: DataFrame, text: str = "text", name: str = "score", **options) -> DataFrame:
    """All columns of ``docs`` and the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, text, **options))
    return docs.select("*", score_udf(shared)(F.col(text)).alias(name))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; learnt from rows that are not held out."""
    scored = with_score(docs.select("doc_id", "text"), labels, training=crc_mod(F.col("doc_id"), 3) != 1)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def filter_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The documents that score at least ``threshold``, all columns kept."""
    name = fresh("score")
    return with_score(docs, labels, name=name, **options).where(F.col(name) >= threshold).drop(name)
