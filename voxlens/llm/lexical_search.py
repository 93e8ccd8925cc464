"""Operator 11, ranked lexical search over bit-sliced Bloom signatures.

Terms are the maximal runs of letters, digits and non-ASCII characters, A-Z lower-
cased. Every document with a term stands as one column in a block of up to
``COLUMNS`` documents of about as many entries; an entry is a (term, level j) with
2**j <= the term's occurrences, j < ``LEVELS``. A block's signature has
``BITS`` * (the entries of its class) slices; an entry sets its column's bit in
``HASHES`` slices. The AND of an entry's slices is a bitmap that holds every document
with the entry, and a few others: presence and occurrences are only overestimated.

Search: for each item the weighted sums of those bitmaps give every document an
upper bound of its score. The ``top`` documents of largest bound are scored from
their texts; the last of these scores is the item's threshold, and every document
whose bound reaches it is scored from its text (a task raises the threshold by what
it has scored itself). A document is left out only where its bound proves it.

Scale: building is one scan of the texts without a shuffle, and writes the blocks
(signature and texts, in columns of their own) as parquet. An item costs two scans
of the signatures, of the second's texts only those not excluded are split into terms.
The items are read in groups of at most ``ITEM_CHARS`` characters, which bounds all
that is broadcast; what is shuffled are counts of the items' terms and ``top`` rows an
item and task. A block holds at most ``BLOCK_BYTES`` of text plus one text.

Defined cases: NULL or empty texts, and texts without a term, count for nothing and
are never found; a NULL doc_id stands after all others of equal score; each row is a
document (repeated rows are found each) and each item row an item, also if ids
repeat; an item without a term, or of terms that no document holds, gives no row;
empty tables give none; other input columns are not looked at.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.llm import textops as X
from voxlens.llm.common import materialize

#: Documents found for an item.
TOP = 10
HASHES = 10
#: Slices of a block for each entry that its class may hold.
BITS = 20
LEVELS = 6
COLUMNS = 512
#: Cells (slices x columns) and bytes of text of one block; bytes that a task buffers.
BLOCK_CELLS = 1 << 23
BLOCK_BYTES = 2 << 20
BUFFER_BYTES = 64 << 20
ITEM_CHARS = 200_000

_SPLIT = X.byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz")

INDEX = ("block long, slices int, ids array<long>, lengths array<long>, bits binary, texts array<binary>")


def terms(raw: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_SPLIT).split() if raw else []


def _codes(names) -> np.ndarray:
    """A 32-bit code of each term; equal codes only widen a bitmap."""
    return np.fromiter(map(zlib.crc32, names), np.uint64)


def _entries(codes: np.ndarray, level: int) -> np.ndarray:
    """The entries of these codes at a level."""
    return codes + np.uint64(level + 1 << 32)


def _slices(entries: np.ndarray, slices: int) -> np.ndarray:
    """The HASHES slices of each entry, one column a hash."""
    h = X.finish(entries)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(slices)).astype(np.int64)


class _Blocks:
    """Gathers documents into blocks by the size class of their entries."""

    def __init__(self):
        self.open: dict[int, list[tuple]] = {}
        self.held: dict[int, int] = {}

    def add(self, doc_id: int | None, raw: bytes) -> Iterator[dict]:
        """Takes a document; gives the blocks that are full."""
        words = terms(raw)
        if not words:
            return
        counts = Counter(words)
        codes, often = _codes(counts), np.fromiter(counts.values(), np.int64)
        entries = np.concatenate([_entries(codes[often >= 1 << j], j) for j in range(LEVELS)])
        size = max(5, (len(entries) - 1).bit_length())
        self.open.setdefault(size, []).append((doc_id, len(words), raw, entries))
        self.held[size] = self.held.get(size, 0) + len(raw) + 8 * len(entries)
        if len(self.open[size]) >= min(COLUMNS, max(8, BLOCK_CELLS // (BITS << size))) or self.held[size] >= BLOCK_BYTES:
            yield self.close(size)
        elif sum(self.held.values()) >= BUFFER_BYTES:
            yield self.close(max(self.held, key=self.held.get))

    def close(self, size: int) -> dict:
        docs, slices = self.open.pop(size), BITS << size
        self.held.pop(size)
        packed = np.empty((slices, -(-len(docs) // 8)), np.uint8)
        for byte in range(packed.shape[1]):  # eight documents at a time bound the unpacked cells
            cells = np.zeros((slices, 8), bool)
            for at, (_, _, _, entries) in enumerate(docs[8 * byte:8 * byte + 8]):
                cells[_slices(entries, slices), at] = True
            packed[:, byte] = np.packbits(cells, axis=1)[:, 0]
        return {"block": uuid.uuid4().int >> 65, "slices": slices, "ids": [d[0] for d in docs],
                "lengths": [d[1] for d in docs], "bits": packed.tobytes(), "texts": [d[2] for d in docs]}


_INDEX_ARROW = pa.schema([("block", pa.int64()), ("slices", pa.int32()), ("ids", pa.list_(pa.int64())),
                          ("lengths", pa.list_(pa.int64())), ("bits", pa.binary()), ("texts", pa.list_(pa.binary()))])


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``: one row per block, written in the shared folder."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks()
        for batch in batches:
            for one, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                for full in blocks.add(one, raw.as_py()):
                    yield pa.RecordBatch.from_pylist([full], _INDEX_ARROW)
        for size in list(blocks.open):
            yield pa.RecordBatch.from_pylist([blocks.close(size)], _INDEX_ARROW)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return materialize(rows.mapInArrow(make, INDEX), "signatures")


class Items:
    """Some items: their distinct terms, and an entry per (item, distinct term)."""

    def __init__(self, texts: list[bytes | None]):
        own = [list(dict.fromkeys(terms(t))) for t in texts]
        self.vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for words in own for t in words))}
        self.of = [[self.vocabulary[t] for t in words] for words in own]
        self.codes = _codes(self.vocabulary)
        self.term = np.array([t for words in self.of for t in words], np.int64)
        self.item = np.repeat(np.arange(len(own)), [len(words) for words in self.of])
        self.weight = np.zeros(len(self.vocabulary), np.int64)
        self.n_docs = self.n_terms = 0
        self.least = np.ones(len(own), np.int64)  # a score of at least 1 is asked for

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        for t in range(len(self.weight)):
            self.weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))

    def spread(self, lengths: np.ndarray) -> np.ndarray:
        """m of documents of these lengths."""
        return 100 - 90 + (90 * lengths * self.n_docs) // self.n_terms

    def score(self, item: int, counts: dict[bytes, int], spread: int, names: list[bytes]) -> int:
        total = 0
        for t in self.of[item]:
            tf = counts.get(names[t], 0)
            if tf:
                total += int(self.weight[t]) * ((1_000_000_000 * tf) // (1000 * tf + 8 * spread))
        return total

    def bounds(self, bits: bytes, slices: int, lengths: np.ndarray) -> np.ndarray:
        """(items, documents): no document's score is above its bound."""
        n = len(lengths)
        table = np.frombuffer(bits, np.uint8).reshape(slices, -1)
        spread = self.spread(lengths)
        most = [np.zeros(n, np.int64)] + [np.minimum(lengths, (2 << j) - 1) for j in range(LEVELS - 1)] + [lengths]
        worth = [(1_000_000_000 * tf) // (1000 * tf + 8 * spread) for tf in most]
        out = np.zeros((len(self.of), n), np.int64)
        alive, before = np.arange(len(self.codes)), None
        for j in range(LEVELS):
            at = _slices(_entries(self.codes[alive], j), slices)
            here = table[at[:, 0]]
            for k in range(1, HASHES):
                here &= table[at[:, k]]
            if before is not None:
                here &= before
            some = here.any(axis=1)
            alive, before = alive[some], here[some]
            if not len(alive):
                break
            row = np.full(len(self.codes), -1, np.int64)
            row[alive] = np.arange(len(alive))
            entries = np.flatnonzero(row[self.term] >= 0)
            for first in range(0, len(entries), 4096):
                part = entries[first:first + 4096]
                on = np.unpackbits(before[row[self.term[part]]], axis=1, count=n)
                starts = np.flatnonzero(np.diff(self.item[part], prepend=-1))
                sums = np.add.reduceat(on * self.weight[self.term[part]][:, None], starts, axis=0)
                out[self.item[part[starts]]] += sums * (worth[j + 1] - worth[j])
        return out


def _df(docs: DataFrame, text: str, items) -> dict[int, int]:
    """The documents that hold each term of ``items`` (a broadcast Items)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = items.value.vocabulary
        known, df = vocabulary.keys(), Counter()
        for batch in batches:
            for raw in batch.column(0):
                df.update(set(terms(raw.as_py())) & known)
        yield pa.RecordBatch.from_arrays([pa.array([vocabulary[t] for t in df], pa.int64()),
                                          pa.array(list(df.values()), pa.int64())], ["term", "n"])

    found = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "term long, n long")
    return {r.term: r.n for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _leading(index: DataFrame, items, top: int) -> DataFrame:
    """(item, block, col) of the ``top`` documents of largest bound for each item."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Items = items.value
        best = np.zeros((len(own.of), top), np.int64)
        block, col = np.zeros_like(best), np.zeros_like(best)
        for batch in batches:
            for r in batch.to_pylist():
                bound = np.concatenate([best, own.bounds(r["bits"], r["slices"], np.array(r["lengths"]))], axis=1)
                keep = np.argpartition(-bound, top - 1, axis=1)[:, :top]
                n = bound.shape[1] - top
                old = np.concatenate([block, np.full((len(block), n), r["block"])], axis=1)
                place = np.concatenate([col, np.broadcast_to(np.arange(n), (len(col), n))], axis=1)
                best, block, col = (np.take_along_axis(x, keep, axis=1) for x in (bound, old, place))
        item, k = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (item, best[item, k], block[item, k], col[item, k])],
            ["item", "bound", "block", "col"])

    found = index.select("block", "slices", "lengths", "bits").mapInArrow(scan, "item long, bound long, block long, col long")
    first = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "block", "col"))
    return found.withColumn("k", first).where(F.col("k") <= top).select("item", "block", "col")


def _thresholds(index: DataFrame, leading: DataFrame, items, top: int) -> dict[int, int]:
    """Each item's last score among its ``top`` leading documents, if it has as many."""
    asked = leading.groupBy("block").agg(F.collect_list(F.struct("item", "col")).alias("asked"))
    rows = index.select("block", "lengths", "texts").join(F.broadcast(asked), "block").select("lengths", "texts", "asked")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Items = items.value
        names = list(own.vocabulary)
        for batch in batches:
            item, scores = [], []
            for r in batch.to_pylist():
                spread, seen = own.spread(np.array(r["lengths"])), {}
                for one in r["asked"]:
                    c = one["col"]
                    if c not in seen:
                        seen[c] = Counter(terms(r["texts"][c]))
                    item.append(one["item"])
                    scores.append(own.score(one["item"], seen[c], int(spread[c]), names))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(scores, pa.int64())], ["item", "score"])

    found = rows.mapInArrow(score, "item long, score long").groupBy("item").agg(
        F.count("*").alias("n"), F.min("score").alias("least"))
    return {r.item: r.least for r in found.collect() if r.n >= top}


def _found(index: DataFrame, items, top: int) -> DataFrame:
    """(item, doc_id, score) of every task's ``top`` documents for each item: all that no
    bound excludes are scored."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Items = items.value
        names, least = list(own.vocabulary), own.least.copy()
        best: list[list[tuple]] = [[] for _ in own.of]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("texts"))
            for at, r in enumerate(batch.drop_columns(["texts"]).to_pylist()):
                lengths = np.array(r["lengths"])
                spread, bound = own.spread(lengths), own.bounds(r["bits"], r["slices"], lengths)
                held = texts[at].values
                for c in np.argsort(-bound.max(axis=0)).tolist():
                    asked = np.flatnonzero(bound[:, c] >= least)
                    if not len(asked):
                        continue
                    counts = Counter(terms(held[c].as_py()))
                    one = r["ids"][c]
                    for item in asked.tolist():
                        score = own.score(item, counts, int(spread[c]), names)
                        if score < least[item]:
                            continue
                        mine = best[item]
                        mine.append((-score, one is None, one))
                        mine.sort()
                        if len(mine) >= top:
                            del mine[top:]
                            least[item] = max(least[item], -mine[-1][0])
        rows = [(item, one, -score) for item, mine in enumerate(best) for score, _, one in mine]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                                         ["item", "doc_id", "score"])

    return index.select("slices", "ids", "lengths", "bits", "texts").mapInArrow(scan, "item long, doc_id long, score long")


def _groups(rows: Iterator, limit: int) -> Iterator[list]:
    """Items in groups of at most ``limit`` characters (plus one item)."""
    group, size = [], 0
    for r in rows:
        group.append(r)
        size += len(r.t or "")
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, text: str = "text", item_id: str = "item_id",
           item_text: str = "text", item_chars: int = ITEM_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of highest score above 0."""
    spark = docs.sparkSession
    kind = benchmark.schema[item_id].dataType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)])
    index = build(docs, text=text)
    size = index.agg(F.sum(F.size("lengths")).alias("n"),
                     F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    asked = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t"))
    out = spark.createDataFrame([], T.StructType([
        T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for group in _groups(asked.toLocalIterator(), item_chars) if size.n else ():
        items = Items([r.t.encode("utf-8") if r.t else None for r in group])
        if not items.vocabulary:
            continue
        sent = spark.sparkContext.broadcast(items)
        items.weigh(size.n, size.l, _df(docs, text, sent))
        weighed = spark.sparkContext.broadcast(items)
        for item, score in _thresholds(index, _leading(index, weighed, top), weighed, top).items():
            items.least[item] = max(1, score)
        final = spark.sparkContext.broadcast(items)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = _found(index, final, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r.i) for k, r in enumerate(group)], schema)
        part = ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"),
                                                              "doc_id", "score")
        out = out.unionByName(materialize(part, "found"))
        sent.unpersist()
        weighed.unpersist()
    return out
