"""Operator 8, benchmark decontamination: a broadcast hash set of the normalised
windows of the benchmark, a scan of each text's windows, verified hits.

A–Z is lower-cased and words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window
is ``size`` consecutive words of one item; an item of fewer words, but not
none, is one window. A word of a document inside any occurrence of a window is
hit. A window that the hash set reports is compared word by word with the item
before it counts.

Scale: the documents are scanned where they lie, with no shuffle. The benchmark
is read in blocks of about ``block_chars`` characters (dealt by the items'
hash, after one aggregate that gives its size; an item stays whole). With more
than one block they run one after the other: a block is broadcast, the rows that
it hits are written, and it is given back, so driver and workers hold one block
whatever the size of the benchmark. One aggregate on the row's own key merges
the hits.

Defined cases: NULL text has no words (n_words 0, not contaminated); an item
with NULL text has no window; an item with a NULL id marks words but is not
listed among the items; items with the same id count once; an empty benchmark
leaves every document clean; repeated documents are judged row by row; input
columns other than those named are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.llm import textops as X
from voxlens.llm.common import fresh, materialize

#: Words of a window.
WINDOW = 10
#: Characters of benchmark text that one broadcast block holds on average (about 50 MB in a worker).
BLOCK_CHARS = 1_000_000

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.IntegerType())),
    T.StructField("chars", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of a text's normalised words."""
    cp = X.lower_ascii(X.code_points(text))
    starts, ends = X.runs(X.alnum_mask(cp))
    return X.word_hashes(cp, starts, ends), starts, ends


_LOWER = {k: k + 32 for k in range(65, 91)}


class WindowSet:
    """The windows of some items: a bitmap, sorted hashes, and the words behind each hash."""

    BITS = 20

    def __init__(self, items: Iterable[tuple[str | None, str | None]], size: int = WINDOW):
        self.size = size
        self.by_length: dict[int, dict[int, list[tuple[str | None, tuple[str, ...]]]]] = {}
        for item_id, text in items:
            if not text:
                continue
            hashes, starts, ends = words_of(text)
            if not len(hashes):
                continue
            words = [text[a:b].translate(_LOWER) for a, b in zip(starts, ends)]
            k = min(size, len(words))
            table = self.by_length.setdefault(k, {})
            for i, h in enumerate(X.window_hashes(hashes, k).tolist()):
                entry = (item_id, tuple(words[i:i + k]))
                have = table.setdefault(h, [])
                if entry not in have:
                    have.append(entry)
        self.bitmaps = {}
        for k, table in self.by_length.items():
            bitmap = np.zeros(1 << self.BITS, dtype=bool)
            bitmap[np.fromiter(table, np.uint64, len(table)) >> np.uint64(64 - self.BITS)] = True
            self.bitmaps[k] = bitmap

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[str]]:
        """(number of words, merged word spans, the same spans in characters, item ids)."""
        if not text:
            return 0, [], [], []
        hashes, starts, ends = words_of(text)
        n = len(hashes)
        mark = np.zeros(n + 1, np.int32)
        items: set[str] = set()
        for k, table in self.by_length.items():
            windows = X.window_hashes(hashes, k)
            for i in np.flatnonzero(self.bitmaps[k][windows >> np.uint64(64 - self.BITS)]).tolist():
                found = table.get(int(windows[i]))
                if found is None:
                    continue
                here = tuple(text[a:b].translate(_LOWER) for a, b in zip(starts[i:i + k], ends[i:i + k]))
                for item_id, words in found:
                    if words == here:
                        mark[i] += 1
                        mark[i + k] -= 1
                        if item_id is not None:
                            items.add(item_id)
        if not mark.any() and not items:
            return n, [], [], []
        a, b = X.runs(np.cumsum(mark[:-1]) > 0)
        spans = np.stack([a, b], 1).ravel()
        chars = np.stack([starts[a], ends[b - 1]], 1).ravel()
        return n, spans.tolist(), chars.tolist(), sorted(items)


def hits_udf(windows):
    """Scalar pandas UDF text -> struct of hits; ``windows`` is a broadcast WindowSet."""

    @F.pandas_udf(HITS)
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = windows.value
        for batch in texts:
            rows = [own.scan(t) for t in batch]
            yield pd.DataFrame(rows, columns=["n_words", "spans", "chars", "items"])

    return hits


def blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int, block_chars: int) -> tuple[int, Iterator]:
    """The number of blocks, and broadcast WindowSets, made one at a time, that together hold the whole benchmark."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")) \
        .where(F.col("t").isNotNull())
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-total // block_chars))

    def make() -> Iterator:
        for b in range(n):
            part = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
            yield spark.sparkContext.broadcast(WindowSet(((r.i, r.t) for r in part.toLocalIterator()), size))

    return n, make()


def _merge(spans: pd.Series) -> pd.Series:
    """Union of several lists of (start, end) pairs, each flattened."""
    def one(lists):
        merged: list[int] = []
        for a, b in sorted((s[i], s[i + 1]) for s in lists for i in range(0, len(s), 2)):
            if merged and a <= merged[-1]:
                merged[-1] = max(merged[-1], b)
            else:
                merged += [a, b]
        return merged

    return spans.map(one)


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", size: int = WINDOW, block_chars: int = BLOCK_CHARS,
         name: str | None = None) -> DataFrame:
    """``docs`` with a struct column ``name`` (default ``hits``) of n_words,
    spans (flattened word positions [a, b)), chars (the same in characters)
    and items (sorted ids as strings)."""
    name = name or "hits"
    n, parts = blocks(benchmark, item_id, item_text, size, block_chars)
    if n == 1:
        return docs.select("*", hits_udf(next(parts))(F.col(text)).alias(name))
    # several blocks: rows get a key of their own (kept by writing them) and the hits of the first block
    key, more = fresh("row"), fresh("more")
    kept, others = None, None
    for part in parts:
        if kept is None:
            kept = materialize(docs.select("*", F.monotonically_increasing_id().alias(key),
                                           hits_udf(part)(F.col(text)).alias(name)), "decontaminate")
        else:
            hit = kept.select(key, hits_udf(part)(F.col(text)).alias("h")).where(F.size("h.spans") > 0)
            hit = materialize(hit, "decontaminate")
            others = hit if others is None else others.unionByName(hit)
        part.destroy()
    merged = others.groupBy(key).agg(F.collect_list("h").alias(more))
    every = F.concat(F.array(F.col(name)), F.coalesce(F.col(more), F.expr(f"CAST(array() AS ARRAY<{HITS.simpleString()}>)")))
    merge = F.pandas_udf(_merge, T.ArrayType(T.IntegerType()))
    joined = kept.join(merged, key, "left").withColumn(more, every)
    hits = F.struct(F.col(name)["n_words"].alias("n_words"), merge(F.col(more)["spans"]).alias("spans"),
                    merge(F.col(more)["chars"]).alias("chars"),
                    F.array_sort(F.array_distinct(F.flatten(F.col(more)["items"]))).alias("items"))
    return joined.select(*docs.columns, hits.alias(name))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark, name="hits", **options)
    signed = F.transform("hits.spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return found.select(
        "doc_id", F.col("hits.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit word, all columns kept."""
    name = fresh("hits")
    return scan(docs, benchmark, name=name, **options).where(F.size(F.col(f"{name}.spans")) == 0).drop(name)


def _cut(text: pd.Series, chars: pd.Series) -> pd.Series:
    def one(t, spans):
        if t is None or not len(spans):
            return t
        out, at = [], 0
        for i in range(0, len(spans), 2):
            out.append(t[at:spans[i]])
            at = spans[i + 1]
        return "".join(out) + t[at:]

    return pd.Series([one(t, s) for t, s in zip(text, chars)], dtype=object)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with every hit span cut out of ``text``, all columns kept."""
    name = fresh("hits")
    found = scan(docs, benchmark, text=text, name=name, **options)
    cut = F.pandas_udf(_cut, "string")
    columns = [cut(F.col(text), F.col(f"{name}.chars")).alias(c) if c == text else F.col(c) for c in docs.columns]
    return found.select(*columns)
