"""Operator 2, quality rules: n-gram perplexity of a modified Kneser-Ney model,
with a lower and an upper band per language, after a few base rules.

Model: n-grams of ``ORDER`` characters over all documents (a text starts after
ORDER - 1 boundary marks). A character is its code point where that is below
4095, else a value hashed to that range, so that an n-gram is one 60-bit key.
Tasks count keys in numpy and send each distinct key once; Spark sums them,
takes the continuation counts of the lower orders from the distinct n-grams of
the next higher order, the discounts from counts of counts, and joins the
interpolated probabilities upwards. The result is, per order, one row per n-gram
(log2 probability, raw count) and per context (log2 of the mass left to shorter
contexts), kept as sorted arrays and searched with sorted queries. The arrays are
broadcast while they have at most ``MAX_ENTRIES`` rows; beyond, the texts' n-grams
are joined with the rows instead, to the same figures.

A text is scored without its own help: an n-gram that occurs nowhere else counts
as unseen, and the next shorter one is taken with the left mass of the contexts
passed over (one place in 2 ** 12 where even the character is the text's own).

Bands: the cross-entropy (bits a character) of the distinct texts of a language
that pass the base rules has a median; deviations from it times the root of the
text's length have a scale on each side (quartile / 0.6745, at least
``MIN_SCALE``), since an average over n characters scatters as 1 / sqrt(n). A document is
rejected above its language's median by more than HIGH_WIDTH * scale / sqrt(n) +
ODD_BITS / n (numbers and keys in a good text cost a number of bits, whatever its
length), or below it by more than LOW_WIDTH * scale / sqrt(n), at least ``FLOOR`` each;
below, the bands of all languages with a hundredth of the texts spare it, since
the label may be wrong. Model and bands take each distinct text once, and the model
one of the near copies only (texts of 4-word shingles with a common key of
MinHash values); the others are scored without their help likewise, as its count of
an n-gram is then the text's own.

Scale: four passes over the texts, of which only those that repeat another (and the few whose hash
begins like that of one) are shuffled; the model is what grows and it is summed with
partial aggregates. Base rules and entropy are made in one pass per document.

Defined cases: NULL and empty texts have no word, fail the base rules and have
no entropy; a NULL language has its own band; repeated documents are judged row
by row; other input columns are kept by ``filter_documents`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.llm import near_dup
from voxlens.llm import textops as X
from voxlens.llm.common import fresh, materialize, n_rows

#: Characters of an n-gram.
ORDER = 5
_BITS = 12
#: Rows of a model that is broadcast (24 bytes each); larger ones are joined.
MAX_ENTRIES = 8_000_000
#: A band's parts: scales of at least MIN_SCALE bits a root character, bits of odd strings, least bits a character.
LOW_WIDTH, HIGH_WIDTH, MIN_SCALE, ODD_BITS, FLOOR = 4.0, 4.0, 1.2, 200.0, 0.1
#: MinHash keys by which near copies are found, values of a key, and values in which a copy agrees.
KEYS, KEY_VALUES, COPY = 6, 2, 34
#: Leading bits of a text's hash by which the texts without copies are told apart from the rest.
PREFIX_BITS = 22
#: Base rules.
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 10, 20, 5

# fixed values: characters that count as symbols
SYMBOLS = "#*$%&|<>"


def keys_of(text: str, order: int = ORDER) -> np.ndarray:
    """The n-gram key that ends at each character of a text."""
    cp = X.code_points(text).astype(np.int64)
    top = (1 << _BITS) - 1
    symbols = np.where(cp < top, cp + 1, 1 + (cp * 2654435761 >> 7) % top)
    padded = np.zeros(len(cp) + order - 1, np.int64)
    padded[order - 1:] = symbols
    out = np.zeros(len(cp), np.int64)
    for k in range(order):
        out = (out << _BITS) | padded[k:k + len(cp)]
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count, first)


def ngram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n) over the texts of the single column of ``texts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            rows = [keys_of(t, order) for t in batch.column(0).to_pylist() if t]
            if not rows:
                continue
            key, n = np.unique(np.concatenate(rows), return_counts=True)
            keys.append(key)
            counts.append(n)
            held += len(key)
            if held > 2_000_000:  # merged now and then: a task holds its distinct keys
                key, n = _summed(keys, counts)
                if len(key) > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["gram", "n"])
                    keys, counts, held = [], [], 0
                else:
                    keys, counts, held = [key], [n], 0
        if keys:
            key, n = _summed(keys, counts)
            for at in range(0, len(key), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[at:at + 200_000]), pa.array(n[at:at + 200_000])],
                                                 ["gram", "n"])

    return texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """One row of each text (column ``text``), and of texts that have about half of their shingles in common
    only one: they would teach each other. A text leaves if it agrees with the text of smallest hash under one of
    its ``KEYS`` keys in ``COPY`` of ``near_dup.COORDINATES`` MinHash values; of texts alike by a quarter (a common
    footer, say) fewer than one in a million does, on average over footers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [near_dup.signature(s) if len(s) else None for s in map(near_dup.shingles, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([None if s is None else s[:KEYS * KEY_VALUES] for s in sigs], pa.list_(pa.int32())),
                pa.array([None if s is None else near_dup.as_bytes(s) for s in sigs], pa.list_(pa.int64()))],
                ["id", "h", "first_values", "sig"])

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col(text).alias("text")) \
        .where("text IS NOT NULL AND text <> ''").withColumn("h", F.xxhash64("text"))
    sketched = rows.select("id", "h", "text").mapInArrow(sketch, "id string, h long, first_values array<int>, sig array<long>")
    known = materialize(sketched.groupBy("h").agg(
        F.count("*").alias("n"), F.min("id").alias("first"), F.first("first_values").alias("first_values"),
        F.first("sig").alias("sig")), "sketches")
    keys = [F.xxhash64(F.lit(k), F.slice("first_values", 1 + k * KEY_VALUES, KEY_VALUES)) for k in range(KEYS)]
    keyed = known.where("sig IS NOT NULL").select("h", F.explode(F.array(*keys)).alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("h").alias("top"), F.count("*").alias("n")).where("n > 1").select("key", "top")
    pairs = keyed.join(firsts, "key").where("h <> top").select("h", "top").distinct()
    tops = known.select(F.col("h").alias("top"), F.col("sig").alias("top_sig"))
    copies = pairs.join(known.select("h", "sig"), "h").join(tops, "top") \
        .where(near_dup.agree("sig", "top_sig", near_dup.COORDINATES, COPY)).select("h").distinct().withColumn("copy", F.lit(True))
    again = materialize(known.select("h", "n", "first").join(copies, "h", "left").where("n > 1 OR copy")
                        .select("h", "first", "copy"), "again")
    # only texts whose hash begins like that of a repeated text travel; what is sent has 2 ** PREFIX_BITS rows at most
    prefix = F.shiftrightunsigned("h", 64 - PREFIX_BITS).cast("int").alias("prefix")
    begins = F.broadcast(again.select(prefix).distinct())
    rows = rows.select("*", prefix)
    lone = rows.join(begins, "prefix", "left_anti").select("text")
    # the same plan at every size: the planner would send a short list and deal a long one out
    rest = rows.join(begins, "prefix", "left_semi").join(again.hint("merge"), "h", "left").where(
        "copy IS NULL AND (first IS NULL OR id IS NULL OR id = first)").select("text")
    return lone.unionByName(rest)


def kneser_ney(counts: DataFrame, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (gram, lp, n) with log2 of the interpolated probability
    and the raw count, and (context, left) with log2 of the mass left to the next lower order."""
    return _kneser_ney(counts, order)[0]


def _kneser_ney(counts: DataFrame, order: int = ORDER) -> tuple[list[tuple[DataFrame, DataFrame]], int]:
    """The model and the number of its rows."""
    seen = {k: Observation() for k in range(1, order + 1)}  # how many n-grams have the counts 1 to 4

    def written(grams: DataFrame, k: int) -> DataFrame:
        numbers = [F.count_if(F.col("c") == j).alias(f"n{j}") for j in (1, 2, 3, 4)]
        return materialize(grams.observe(seen[k], *numbers), f"grams{k}")

    orders = {order: written(counts.select("gram", "n", F.col("n").alias("c")), order)}
    for k in range(order - 1, 0, -1):  # c: continuation counts, distinct characters before an n-gram
        mask = (1 << (_BITS * k)) - 1
        lower = orders[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(
            F.sum("n").alias("n"), F.count("*").alias("c"))
        orders[k] = written(lower, k)
    out, below, entries = [], None, 0
    for k in range(1, order + 1):
        grams = orders[k]
        row = seen[k].get
        n1, n2, n3, n4 = (max(1, row[f"n{j}"]) for j in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(j - (j + 1) * y * b / a, 0.05), j - 0.05) for j, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        grams = grams.withColumn("context", F.shiftright("gram", _BITS)).withColumn("d", discount)
        context = materialize(grams.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("held")),
                              f"contexts{k}")
        left = F.col("held") / F.col("total")
        own = (F.col("c") - F.col("d")) / F.col("total")
        joined = grams.join(context, "context")
        if below is None:  # the last order leans on all characters being alike
            joined = joined.withColumn("q", F.lit(1.0 / (1 << _BITS)))
        else:
            mask = (1 << (_BITS * (k - 1))) - 1
            joined = joined.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(mask))).join(
                below.select(F.col("gram").alias("suffix"), F.col("p").alias("q")), "suffix")
        below = materialize(joined.select("gram", "n", (own + left * F.col("q")).alias("p")), f"model{k}")
        out.append((below.select("gram", F.log2("p").alias("lp"), "n"), context.select("context", F.log2(left).alias("left"))))
        entries += n_rows(below) + n_rows(context)
    return out, entries


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    cp = X.code_points(text)
    starts, ends = X.runs(X.spaced_mask(cp))
    n = len(starts)
    symbols = sum(map(text.count, SYMBOLS))
    if not n:
        return 0, 0, symbols, 0, 0
    lines, dup = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in lines:
                dup += 1
            elif line.strip(" \t\n\v\f\r"):
                lines.add(line)
    windows = X.window_hashes(X.word_hashes(cp, starts, ends), WINDOW)
    repeated = 0
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        if same.any():
            hit = np.zeros(len(windows), bool)
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            repeated = int(X.covered(hit, WINDOW).sum())
    return n, int((ends - starts).sum()), symbols, dup, repeated


STATS = T.StructType([T.StructField(c, T.LongType()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")] + [
    T.StructField("bits", T.DoubleType())])


class Model:
    """Sorted arrays of all orders."""

    def __init__(self, orders: list[tuple[DataFrame, DataFrame]]):
        def arrays(df: DataFrame, names: str) -> list[np.ndarray]:
            found = df.select(*names.split()).toArrow()
            columns = [c.to_numpy() for c in found.columns]
            order = np.argsort(columns[0])
            return [c[order] for c in columns]

        self.grams = [arrays(g, "gram lp n") for g, _ in orders]
        self.contexts = [arrays(c, "context left") for _, c in orders]

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def bits(self, text: str) -> float:
        """Cross-entropy in bits a character."""
        order = len(self.grams)
        keys, n = np.unique(keys_of(text, order), return_counts=True)
        passed, total, size = np.zeros(len(keys)), 0.0, int(n.sum())
        for k in range(order, 0, -1):
            table, lp, count = self.grams[k - 1]
            at, known = self._find(table, keys)
            seen = known & (count[at] > n)
            total += float((passed + n * np.where(seen, lp[at], 0.0))[seen].sum())
            keys, n, passed = keys[~seen], n[~seen], passed[~seen]
            if not len(keys):
                break
            contexts, left = self.contexts[k - 1]
            at, known = self._find(contexts, keys >> _BITS)
            passed = passed + n * np.where(known, left[at], 0.0)
            keys, own = np.unique(keys & ((1 << (_BITS * (k - 1))) - 1), return_inverse=True)
            n, passed = np.bincount(own, n).astype(np.int64), np.bincount(own, passed)
        total += float((passed - n * _BITS).sum())
        return -total / size


def stats_udf(model):
    """Scalar pandas UDF text -> STATS; ``model`` is a broadcast Model, or None to leave ``bits`` out."""

    @F.pandas_udf(STATS)
    def stats(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = None if model is None else model.value
        names = [f.name for f in STATS]
        for batch in texts:
            rows = [(*base_counts(t), len(t or ""), own.bits(t) if own is not None and t else None) for t in batch]
            out = pd.DataFrame(rows, columns=names)
            out["bits"] = out["bits"].astype("float64")
            yield out

    return stats


def _bits_by_join(docs: DataFrame, key: str, text: str, orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(key, bits) where the model is too large to send: the texts' n-grams meet the model's rows."""
    longest = len(orders)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t:
                    grams, n = np.unique(keys_of(t, longest), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(grams), row)), pa.array(grams), pa.array(n)], ["row", "gram", "own"])

    open_ = docs.select(key, text).mapInArrow(explode, "row long, gram long, own long").withColumn("passed", F.lit(0.0))
    done = None
    for k in range(len(orders), 0, -1):
        grams, contexts = orders[k - 1]
        met = materialize(open_.join(grams, "gram", "left"), f"met{k}")
        seen = F.coalesce(F.col("n") > F.col("own"), F.lit(False))
        part = met.where(seen).groupBy("row").agg(F.sum(F.col("passed") + F.col("own") * F.col("lp")).alias("lp"),
                                                  F.sum("own").alias("n"))
        done = part if done is None else done.unionByName(part)
        mask = (1 << (_BITS * (k - 1))) - 1
        left = met.where(~seen).withColumn("context", F.shiftright("gram", _BITS)).join(contexts, "context", "left")
        open_ = left.groupBy("row", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(
            F.sum(F.col("passed") + F.col("own") * F.coalesce("left", F.lit(0.0))).alias("passed"),
            F.sum("own").alias("own"))
    rest = open_.select("row", (F.col("passed") - F.col("own") * _BITS).alias("lp"), F.col("own").alias("n"))
    return done.unionByName(rest).groupBy(F.col("row").alias(key)).agg((-F.sum("lp") / F.sum("n")).alias("bits"))


def with_stats(docs: DataFrame, text: str = "text", name: str = "stats", max_entries: int = MAX_ENTRIES,
               keep_text: bool = True, lazy: bool = False) -> DataFrame:
    """All columns of ``docs`` (but the text if it isn't to be kept) and a struct
    ``name`` of STATS, written once; ``lazy``: not written, if the model is sent."""
    gone = [] if keep_text else [text]
    spark = docs.sparkSession
    model, entries = _kneser_ney(ngram_counts(distinct_texts(docs, text)))
    if entries <= max_entries:
        held = Model(model) if entries else None
        shared = spark.sparkContext.broadcast(held)
        scored = docs.select("*", stats_udf(shared)(F.col(text)).alias(name))
        return scored if lazy else materialize(scored.drop(*gone), "stats")
    key = fresh("row")
    kept = materialize(docs.select("*", F.monotonically_increasing_id().alias(key),
                                   stats_udf(None)(F.col(text)).alias(name)), "stats")
    bits = _bits_by_join(kept, key, text, model)
    return kept.join(bits, key, "left").withColumn(name, F.col(name).withField("bits", F.col("bits"))) \
        .drop(key, "bits", *gone)


def base_failed(name: str) -> F.Column:
    n, repeated = F.col(f"{name}.n_words"), F.col(f"{name}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)


def bands(scored: DataFrame, name: str, lang: str, text_hash: str) -> DataFrame:
    """(band_lang, middle, low, high, n): median of bits a character, the scales of deviations
    below and above it times the root of the length, and the texts they are taken from."""
    distinct = scored.where(~base_failed(name)).groupBy(F.col(lang).alias("l"), F.col(text_hash).alias("h")).agg(
        F.min(f"{name}.bits").alias("bits"), F.min(f"{name}.n_chars").alias("n"))
    middle = distinct.groupBy(F.col("l").alias("band_lang")).agg(
        F.percentile_approx("bits", 0.5, 10000).alias("middle"))
    off = (F.col("bits") - F.col("middle")) * F.sqrt("n")
    return distinct.join(middle, F.col("l").eqNullSafe(F.col("band_lang"))).groupBy("band_lang").agg(
        F.first("middle").alias("middle"), F.percentile_approx(off, [0.25, 0.75], 10000).alias("q"),
        F.count("*").alias("n")).select(
        "band_lang", "middle", F.greatest(F.lit(MIN_SCALE), -F.col("q")[0] / 0.6745).alias("low"),
        F.greatest(F.lit(MIN_SCALE), F.col("q")[1] / 0.6745).alias("high"), "n")


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", name: str = "stats", **options) -> DataFrame:
    """All columns of ``docs``, the struct ``name`` with STATS, lower, upper, base_failed and kept."""
    hashed, of, middle, low, high, n = (fresh(x) for x in ("hash", "lang", "middle", "low", "high", "n"))
    scored = with_stats(docs.withColumn(hashed, F.xxhash64(text)), text, name, **options)
    small = scored
    if options.get("lazy"):  # the texts are scored again rather than written a second time
        small = materialize(scored.select(F.col(lang), hashed, name), "stats")
    limits = materialize(bands(small, name, lang, hashed).toDF(of, middle, low, high, n), "bands")
    total = limits.agg(F.sum(n)).first()[0] or 0
    common = limits.where(F.col(n) * 100 >= total).collect()  # at most a hundred
    joined = scored.join(limits.drop(n), F.col(lang).eqNullSafe(F.col(of)), "left")
    size = F.greatest(F.col(f"{name}.n_chars"), F.lit(1))

    def below(median, scale):
        return median - F.greatest(F.lit(FLOOR), LOW_WIDTH * scale / F.sqrt(size))

    lowest = [below(F.lit(r[middle]), F.lit(r[low])) for r in common]
    own = below(F.col(middle), F.col(low))
    lower = F.when(F.col(middle).isNotNull(), F.least(own, *lowest) if lowest else own)
    upper = F.col(middle) + F.greatest(F.lit(FLOOR), HIGH_WIDTH * F.col(high) / F.sqrt(size) + ODD_BITS / size)
    inside = F.col(f"{name}.bits").between(lower, upper)
    out = F.col(name).withField("lower", lower).withField("upper", upper) \
        .withField("base_failed", base_failed(name)) \
        .withField("kept", ~base_failed(name) & F.coalesce(inside, F.lit(False)))
    return joined.withColumn(name, out).drop(hashed, of, middle, low, high)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, the base counts, base_failed, kept, and the bands' figures."""
    out = judged(docs.select("doc_id", "lang", "text"), keep_text=False)
    return out.select(
        "doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "stats.base_failed", "stats.kept", F.col("stats.bits").alias("bits_per_char"), "stats.lower", "stats.upper")


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, all columns kept."""
    name = fresh("stats")
    return judged(docs, text, lang, name, lazy=True).where(F.col(f"{name}.kept")).drop(name)
