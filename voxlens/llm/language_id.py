"""Operator 1, language identification by a string kernel.

Kernel: the blended spectrum of character n-grams (1 to ``LONGEST``) by presence;
an n-gram is hashed to one of ``PLACES`` places, two windows of text have the
kernel |both| / sqrt(|one| |other|). Nyström: ``LANDMARKS`` windows stand for the
sample, k(x, landmarks) K^(-1/2) is a window's feature vector; one ridge
regression per language against the rest is fitted on these (in kernel terms, a
kernel ridge regression in the landmarks' span). Scoring is a product of a batch
of presence rows with the landmarks and one with the folded coefficients.

A whole text is cut into windows of ``WINDOW`` characters; its scores are the mean
of its windows' (weighted by length), turned into probabilities by a softmax.

Learning: at most about ``MAX_PER_LANG`` rows of a language, fewer where there are
more than MAX_ROWS / MAX_PER_LANG languages, chosen by the id's hash; up to
``SAMPLE_WINDOWS`` windows of each, spread over its text.

Scale: one pass over the texts, no shuffle; the driver sees the sample's presence
bits (PLACES / 8 bytes a window), the broadcast holds the landmarks. Both are
bounded by the parameters.

Defined cases: NULL texts and texts without a letter (category L) give ``und`` and score 0; no
training row gives ``und`` to all; equal scores go to the language that sorts
first; repeated documents are scored row by row; lang, source and doc_id are never
looked at in a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.llm import textops as X
from voxlens.llm.common import crc_mod

LONGEST, PLACES, WINDOW = 3, 1 << 13, 1000
LANDMARKS, RIDGE, SHARPNESS = 128, 1e-2, 6.0
MAX_PER_LANG, MAX_ROWS, SAMPLE_WINDOWS, SEED = 500, 8000, 3, 3
UNKNOWN = "und"
_BATCH = 256  # presence rows of one product

_MULTIPLIERS = (X._splitmix(LONGEST, 41) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def has_letter(text: str) -> bool:
    """Whether a character is of category L; number signs such as ² or Ⅷ are not."""
    return any(map(str.isalpha, text))


def places(text: str) -> list[np.ndarray]:
    """For each n, the place of the n-gram that starts at each character."""
    cp = X.code_points(text.lower())
    out = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(cp), np.uint32)
        for n in range(1, LONGEST + 1):
            if n > len(cp):
                break
            h = (h[:len(cp) - n + 1] ^ (cp[n - 1:] + np.uint32(n))) * _MULTIPLIERS[n - 1]
            h ^= h >> np.uint32(15)
            out.append((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - PLACES.bit_length() + 1))
    return out


def presence(text: str, into: np.ndarray) -> int:
    """Mark the n-grams of a text's windows in rows of ``into``; the number of windows."""
    at = places(text)
    n = max(1, -(-len(at[0]) // WINDOW))
    for p in at:
        into[np.arange(len(p)) // WINDOW, p] = 1
    return n


def n_windows(text: str) -> int:
    return max(1, -(-len(text.lower()) // WINDOW))


class Languages:
    """Landmarks, folded coefficients and the languages in order."""

    def __init__(self, langs: list[str], landmarks: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.langs, self.bias, self.weights = langs, bias, weights.astype(np.float32)
        rows = landmarks.astype(np.float32)
        self.landmarks = (rows / np.sqrt(np.maximum(1, rows.sum(axis=1, keepdims=True)))).T.copy()

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.landmarks / np.sqrt(np.maximum(1, rows.sum(axis=1, keepdims=True)))

    def scores(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [i for i, t in enumerate(texts) if self.langs and t and has_letter(t)]
        total = np.zeros((len(texts), max(1, len(self.langs))))
        rows = np.zeros((_BATCH, PLACES), np.float32)
        owner, weight = np.zeros(_BATCH, np.int64), np.zeros(_BATCH)
        used = 0

        def flush() -> None:
            nonlocal used
            if used:
                out = self.kernel(rows[:used]) @ self.weights + self.bias
                np.add.at(total, owner[:used], out * weight[:used, None])
                rows[:used] = 0
                used = 0

        for i in known:
            text = texts[i]
            size = _BATCH * WINDOW
            for a in range(0, len(text), size):  # at most one product's windows at a time
                part = text[a:a + size]
                if used and used + n_windows(part) > _BATCH:
                    flush()
                if n_windows(part) > _BATCH:  # lower-casing has lengthened it
                    part, rest = part[:size // 2], part[size // 2:]
                    used += self._mark(rows, owner, weight, used, part, i)
                    flush()
                    part = rest
                used += self._mark(rows, owner, weight, used, part, i)
        flush()
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for i in known:
            z = SHARPNESS * total[i] / max(1, len(texts[i]))
            p = np.exp(z - z.max())
            best = int(np.argmax(z))
            langs[i], scores[i] = self.langs[best], float(p[best] / p.sum())
        return langs, scores

    @staticmethod
    def _mark(rows, owner, weight, used, part, i) -> int:
        n = presence(part, rows[used:])
        owner[used:used + n] = i
        weight[used:used + n] = WINDOW
        weight[used + n - 1] = len(part) - (n - 1) * WINDOW
        return n


def fit(langs: list[str], rows: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Languages:
    """``rows``: presence rows of the sample, ``langs``: the language of each."""
    names = sorted(set(langs))
    if not names:
        return Languages([], np.zeros((1, PLACES)), np.zeros((1, 1)), np.zeros(1))
    y = np.array([names.index(v) for v in langs])
    rng = np.random.default_rng(SEED)
    share = max(1, landmarks // len(names))
    chosen = np.concatenate([rng.permutation(np.flatnonzero(y == k))[:share] for k in range(len(names))])
    model = Languages(names, rows[chosen], np.zeros((len(chosen), len(names))), np.zeros(len(names)))
    k_all = np.concatenate([model.kernel(rows[a:a + _BATCH].astype(np.float32))  # a batch as floats at a time
                            for a in range(0, len(rows), _BATCH)]).astype(np.float64)
    value, vector = np.linalg.eigh(k_all[chosen])
    root = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T
    phi = k_all @ root
    weight = 1 / np.bincount(y)[y]  # languages count alike
    weight *= len(y) / weight.sum()
    middle = np.average(phi, axis=0, weights=weight)
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    level = np.average(target, axis=0, weights=weight)
    centred = phi - middle
    gram = centred.T @ (centred * weight[:, None]) + ridge * len(y) / len(chosen) * np.eye(phi.shape[1])
    w = np.linalg.solve(gram, centred.T @ ((target - level) * weight[:, None]))
    return Languages(names, rows[chosen], root @ w, level - middle @ w)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", training: Column | None = None) -> Languages:
    """Fit on a sample of the rows with a language; ``training`` is a predicate that they must meet."""
    known = docs.select(F.col("doc_id").cast("string").alias("id"), F.col(lang).alias("lang"),
                        F.col(text).alias("text"), *([] if training is None else [training.alias("ok")]))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL" + ("" if training is None else " AND ok"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_ROWS).collect()
    if not sizes:
        return fit([], np.zeros((0, PLACES)))
    each = max(1, min(MAX_PER_LANG, MAX_ROWS // len(sizes)))
    spark = docs.sparkSession
    rates = spark.createDataFrame([(r.lang, float(min(1.0, each / r.n))) for r in sizes], "lang string, rate double")
    place = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 20))
    chosen = known.join(F.broadcast(rates), "lang").where(place < F.col("rate") * (1 << 20))

    @F.pandas_udf(T.ArrayType(T.BinaryType()))
    def bits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            out = []
            for t in batch:
                if not has_letter(t):
                    out.append([])
                    continue
                rows = np.zeros((n_windows(t), PLACES), np.uint8)
                presence(t, rows)
                spread = np.unique(np.linspace(0, len(rows) - 1, SAMPLE_WINDOWS).astype(int))
                out.append([np.packbits(rows[i]).tobytes() for i in spread])
            yield pd.Series(out)

    sample = chosen.select("id", "lang", F.posexplode(bits("text")).alias("w", "bits")).toPandas()
    sample = sample.sort_values(["id", "w", "bits"])
    rows = np.unpackbits(np.frombuffer(b"".join(sample["bits"]), np.uint8)).reshape(-1, PLACES)
    return fit(sample["lang"].tolist(), rows)


def language_udf(model):
    """Scalar pandas UDF text -> (lang_pred, score); ``model`` is broadcast."""

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def identify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            langs, scores = model.value.scores(list(batch))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return identify


def with_language(docs: DataFrame, model: Languages, text: str = "text", name: str = "language") -> DataFrame:
    """All columns of ``docs`` and a struct of lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("*", language_udf(shared)(F.col(text)).alias(name))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learnt from rows that are not held out."""
    part = crc_mod(F.col("doc_id"), 4)
    model = train(docs, training=part != 2)
    scored = with_language(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"),
                         "language.lang_pred", "language.score")
