"""Operator 13, source divergence audit by single-pass in-memory indexing.

Terms are the maximal runs of letters and non-ASCII characters, A-Z lower-cased. A
language keeps the terms that at least ``MIN_DOCS`` of its documents hold. Each
(lang, source) group, and each language as a whole, gives a kept term the chance
p = 1 + floor(10**9 * (count + 2) / (N + 2 * V)). Two chances p and q differ by
f = floor((p - q)**2 / (p + q)). All of it is integer arithmetic.

* Index: a task counts its documents' terms by group and their documents by language
  in memory. When it holds ``BLOCK_ENTRIES`` counts it spills them as a run: per hash
  shard, pieces of at most ``PIECE`` terms in order.
* Merge: the runs' pieces are dealt by shard and sorted by their first term. A heap
  holds the pieces that have begun; a term is summed and leaves when the heap's
  smallest term lies below the next piece's first, as every run that holds it has
  begun then. What leaves are the frequencies: one row per kept term of a language.
* Corrections: a pair of sources would differ by V * f(p0, q0) if both lacked every
  term, p0 and q0 being the chances of a count of 0. Each distinct count of a source
  corrects this for all others by f(p, q0) - f(p0, q0), once for all its terms of that
  count; each term that both hold by f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0). A task
  sums the corrections of the terms that stream by, in tables of ``SUMS`` pairs at most.

Scale: a frequent term is one count per group of a run however often it occurs, so no
key is hot; pieces are shuffled once; the frequencies are written and read twice. The
sources' counts are sent to every task: a few numbers per source, where the result has
a row for each two sources of a language.

Defined cases: NULL text, lang and source are read as ''; repeated rows count each; a
group without a kept term still has its pairs (and 0 where V is 0), a language without
another source has none; empty tables give no row; other input columns, and doc_id,
are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlens.llm import textops as X
from voxlens.llm.common import materialize

#: Documents of a language that must hold a term.
MIN_DOCS = 10
#: Terms listed per group.
TOP = 10
#: Counts that a task holds before it spills a run; terms of one piece of a run.
BLOCK_ENTRIES = 1_000_000
PIECE = 4096
#: Pairs of sources, and pairs of postings, that a task holds at once.
SUMS = 1_000_000

#: Bytes of a text that are split into terms at once.
_STEP = 1 << 22

_SPLIT = X.byte_table(b"abcdefghijklmnopqrstuvwxyz")


def pieces_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded size."""
    spaced = raw.translate(_SPLIT)
    at = 0
    while at < len(spaced):
        end = spaced.find(b" ", at + _STEP) if at + _STEP < len(spaced) else -1
        end = len(spaced) if end < 0 else end
        yield spaced[at:end].split()
        at = end


def chance(count: np.ndarray, total, kept) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * kept)), by long division: no product
    leaves 64 bits while the divisor is below 9 * 10**15."""
    by = np.asarray(total, np.int64) + 2 * np.asarray(kept, np.int64)
    rest = np.asarray(count, np.int64) + 2
    out = np.zeros(np.broadcast(rest, by).shape, np.int64)
    for _ in range(3):
        whole, rest = np.divmod(rest, by)
        out, rest = (out + whole) * 1000, rest * 1000
    return out + rest // by + 1


def differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Block:
    """Term counts by group and document counts by language, of some documents."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = {}
        self.docs: dict[str, Counter] = {}
        self.entries = 0

    def add(self, lang: str, source: str, raw: bytes) -> None:
        own, df, seen = self.counts.setdefault((lang, source), Counter()), self.docs.setdefault(lang, Counter()), set()
        before = len(own) + len(df)
        for words in pieces_of(raw):
            own.update(words)
            seen.update(words)
        df.update(seen)
        self.entries += len(own) + len(df) - before

    def run(self, shards: int) -> Iterator[dict]:
        """The block as a run: pieces of sorted terms by language and shard."""
        for lang, df in self.docs.items():
            held = [(source, counts) for (one, source), counts in self.counts.items() if one == lang]
            parts: dict[int, list[bytes]] = {}
            for term in df:
                parts.setdefault(zlib.crc32(term) % shards, []).append(term)
            for shard, terms in parts.items():
                terms.sort()
                for at in range(0, len(terms), PIECE):
                    part = terms[at:at + PIECE]
                    postings = [[(k, counts[t]) for k, (_, counts) in enumerate(held) if t in counts] for t in part]
                    yield {"shard": shard, "lang": lang, "first": part[0], "terms": part, "df": [df[t] for t in part],
                           "sources": [source for source, _ in held], "held": [len(p) for p in postings],
                           "source": [k for p in postings for k, _ in p], "count": [n for p in postings for _, n in p]}


_RUNS = ("shard int, lang string, first binary, terms array<binary>, df array<long>, sources array<string>, "
         "held array<int>, source array<int>, count array<long>")
_RUNS_ARROW = pa.schema([
    ("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()), ("terms", pa.list_(pa.binary())),
    ("df", pa.list_(pa.int64())), ("sources", pa.list_(pa.string())), ("held", pa.list_(pa.int32())),
    ("source", pa.list_(pa.int32())), ("count", pa.list_(pa.int64()))])


def runs(docs: DataFrame, text: str, shards: int, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """The spilled runs of ``docs``, a row per piece."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, raw in zip(langs, sources, batch.column(2)):
                block.add(lang, source, raw.as_py())
                if block.entries >= block_entries:
                    for piece in block.run(shards):
                        yield pa.RecordBatch.from_pylist([piece], _RUNS_ARROW)
                    block = _Block()
        for piece in block.run(shards):
            yield pa.RecordBatch.from_pylist([piece], _RUNS_ARROW)

    return docs.select("lang", "source", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")) \
        .mapInArrow(index, _RUNS)


def _piece(batch: pa.RecordBatch, k: int) -> dict:
    """Row ``k`` of ``batch``, its numbers as arrays."""
    return {name: one[k].values.to_numpy() if name in ("df", "held", "source", "count") else one[k].as_py()
            for name, one in zip(batch.schema.names, batch.columns)}


def _postings(piece: dict) -> Iterator[tuple[bytes, int, list[tuple[str, int]]]]:
    at = 0
    for term, df, held in zip(piece["terms"], piece["df"].tolist(), piece["held"].tolist()):
        end = at + held
        yield term, df, [(piece["sources"][k], n) for k, n in zip(piece["source"][at:end].tolist(),
                                                                  piece["count"][at:end].tolist())]
        at = end


def _merged(pieces: Iterator[dict]) -> Iterator[tuple[str, bytes, int, dict[str, int]]]:
    """(lang, term, documents, counts by source) of pieces sorted by shard, lang and first term."""
    heap: list[tuple[bytes, int, int, list, Iterator]] = []
    n = 0
    now = None

    def take(limit: bytes | None):
        while heap and (limit is None or heap[0][0] < limit):
            term, df, counts = heap[0][0], 0, {}
            while heap and heap[0][0] == term:
                _, one, order, own, rest = heap[0]
                df += one
                for source, count in own:
                    counts[source] = counts.get(source, 0) + count
                nxt = next(rest, None)
                if nxt is None:
                    heapq.heappop(heap)
                else:
                    heapq.heapreplace(heap, (nxt[0], nxt[1], order, nxt[2], rest))
            yield now[1], term, df, counts

    for piece in pieces:
        if now != (piece["shard"], piece["lang"]):
            yield from take(None)
            now = piece["shard"], piece["lang"]
        yield from take(piece["first"])
        rest = _postings(piece)
        term, df, own = next(rest)
        heapq.heappush(heap, (term, df, n := n + 1, own, rest))
    yield from take(None)


def frequencies(found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, sources, counts) of the terms that ``min_docs`` documents of the language hold."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def give():
            out = pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                pa.array([list(r[3]) for r in rows], pa.list_(pa.string())),
                pa.array([list(r[3].values()) for r in rows], pa.list_(pa.int64()))], ["lang", "term", "sources", "counts"])
            rows.clear()
            return out

        for row in _merged(_piece(batch, k) for batch in batches for k in range(batch.num_rows)):
            if row[2] >= min_docs:
                rows.append(row)
                if len(rows) >= PIECE:
                    yield give()
        yield give()

    dealt = found.repartition("shard").sortWithinPartitions("shard", "lang", "first")
    return dealt.mapInArrow(merge, "lang string, term binary, sources array<string>, counts array<long>")


class Groups:
    """Per language: its sources in order, the counts over kept terms, and V."""

    def __init__(self, rows: list):
        self.sources: dict[str, list[str]] = {}
        self.totals: dict[str, np.ndarray] = {}
        self.kept: dict[str, int] = {}
        by: dict[str, list] = {}
        for r in rows:
            by.setdefault(r.lang, []).append((r.source, r.total))
            self.kept[r.lang] = r.kept
        for lang, own in by.items():
            own.sort()
            self.sources[lang] = [s for s, _ in own]
            self.totals[lang] = np.array([t for _, t in own], np.int64)

    def zero(self, lang: str) -> np.ndarray:
        """Each source's chance of a count of 0 (1 where the language keeps no term)."""
        return chance(0, self.totals[lang], self.kept[lang]) if self.kept[lang] else np.ones_like(self.totals[lang])


class _Sums:
    """Sums by 64-bit key, held sorted; the whole is given away when it grows large."""

    def __init__(self, limit: int):
        self.limit, self.keys, self.values = limit, [], []
        self.size = 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        if len(keys):
            keys, values = self._summed(keys, values)
            self.keys.append(keys)
            self.values.append(values)
            self.size += len(keys)
            if self.size > self.limit:
                self.compact()

    @staticmethod
    def _summed(keys, values):
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        return keys[starts], np.add.reduceat(values, starts)

    def compact(self) -> None:
        if self.keys:
            keys, values = self._summed(np.concatenate(self.keys), np.concatenate(self.values))
            self.keys, self.values, self.size = [keys], [values], len(keys)

    def full(self) -> bool:
        return 2 * self.size > self.limit

    def give(self) -> tuple[np.ndarray, np.ndarray]:
        self.compact()
        out = (self.keys[0], self.values[0]) if self.keys else (np.empty(0, np.int64),) * 2
        self.keys, self.values, self.size = [], [], 0
        return out


def _both(offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) within each run of ``offsets``, about ``limit`` at a time."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    first, n = 0, len(ends)
    left = ends - np.arange(n) - 1
    reach = np.cumsum(left)
    while first < n:
        base = reach[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(reach, base + limit, side="right")))
        times = left[first:last]
        i = np.repeat(np.arange(first, last), times)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
        yield i, j
        first = last


def corrections(found: DataFrame, groups, top: int = TOP, sums: int = SUMS) -> DataFrame:
    """Partial sums (lang, a, b, term NULL, value) of pairs a < b of a language's sources, and each task's
    ``top`` terms (lang, a, b NULL, term, value) of each source."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Groups = groups.value
        pairs = {lang: _Sums(sums) for lang in own.sources}
        often = {lang: _Sums(sums) for lang in own.sources}
        place = {lang: {s: k for k, s in enumerate(names)} for lang, names in own.sources.items()}
        best: dict[tuple[str, int], list[tuple[int, bytes]]] = {}

        def rows(lang, a, b, terms, values):
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(terms, pa.binary()), pa.array(values, pa.int64())], ["lang", "a", "b", "term", "value"])

        def given(lang):
            size = len(own.sources[lang])
            keys, values = pairs[lang].give()
            for at in range(0, len(keys), 100_000):
                k, v = keys[at:at + 100_000], values[at:at + 100_000]
                yield rows(lang, k // size, k % size, [None] * len(k), v)

        def single(lang):
            """Corrections of the distinct counts gathered, for all other sources."""
            size, zero = len(own.sources[lang]), own.zero(lang)
            keys, times = often[lang].give()  # none where no term is kept
            step = max(1, sums // size)
            for at in range(0, len(keys), step):
                s, count, n = keys[at:at + step] % size, keys[at:at + step] // size, times[at:at + step, None]
                p = chance(count, own.totals[lang][s], own.kept[lang])
                value = (differ(p[:, None], zero[None, :]) - differ(zero[s][:, None], zero[None, :])) * n
                other = np.broadcast_to(np.arange(size), value.shape)
                mine = np.broadcast_to(s[:, None], value.shape)
                apart = mine != other
                a, b = np.minimum(mine, other)[apart], np.maximum(mine, other)[apart]
                pairs[lang].add(a * size + b, value[apart])
                if pairs[lang].full():
                    yield from given(lang)

        for batch in batches:
            langs, terms = batch.column(0).to_pylist(), batch.column(1)
            names, counts = batch.column(2), batch.column(3)
            for lang in dict.fromkeys(langs):
                at = [k for k, one in enumerate(langs) if one == lang]
                size, kept, zero = len(own.sources[lang]), own.kept[lang], own.zero(lang)
                offsets = np.concatenate([[0], np.cumsum([len(names[k]) for k in at])]).astype(np.int64)
                s = np.array([place[lang][x] for k in at for x in names[k].as_py()], np.int64)
                count = np.array([x for k in at for x in counts[k].as_py()], np.int64)
                p = chance(count, own.totals[lang][s], kept)
                often[lang].add(count * size + s, np.ones(len(s), np.int64))
                if often[lang].full():
                    yield from single(lang)
                for i, j in _both(offsets, sums):
                    a, b, p_a, p_b = s[i], s[j], p[i], p[j]
                    value = differ(p_a, p_b) - differ(p_a, zero[b]) - differ(zero[a], p_b) + differ(zero[a], zero[b])
                    pairs[lang].add(np.minimum(a, b) * size + np.maximum(a, b), value)
                    if pairs[lang].full():
                        yield from given(lang)
                whole = np.add.reduceat(count, offsets[:-1])
                q = np.repeat(chance(whole, own.totals[lang].sum(), kept), np.diff(offsets))
                term = np.repeat(np.array(at), np.diff(offsets))
                value = np.where(p > q, differ(p, q), -1)
                for one in np.unique(s).tolist():
                    mine = np.flatnonzero((s == one) & (p > q))
                    if len(mine) > top:
                        least = np.partition(value[mine], len(mine) - top)[len(mine) - top]
                        mine = mine[value[mine] >= least]
                    if len(mine):
                        held = best.setdefault((lang, one), [])
                        held += [(-int(value[k]), terms[int(term[k])].as_py()) for k in mine]
                        held.sort()
                        del held[top:]
        for lang in own.sources:
            yield from single(lang)
            yield from given(lang)
        for (lang, one), held in best.items():
            yield rows(lang, [one] * len(held), [None] * len(held), [t for _, t in held], [-v for v, _ in held])

    return found.mapInArrow(stream, "lang string, a long, b long, term binary, value long")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
          top: int = TOP, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language by divergence
    (part `pair`), and the ``top`` terms that set a source apart (part `term`)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text"))
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = materialize(frequencies(runs(rows, "text", shards, block_entries), min_docs), "frequencies")
    held = found.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")) \
        .groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("total"))
    kept = found.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = materialize(
        rows.select("lang", "source").distinct().join(held, ["lang", "source"], "left").join(kept, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"),
                F.coalesce("kept", F.lit(0)).cast("long").alias("kept")), "groups")
    table = Groups(groups.collect())
    sent = spark.sparkContext.broadcast(table)
    parts = materialize(corrections(found, sent, top), "corrections")

    numbered = spark.createDataFrame(
        [(one, k, s, int(z), table.kept[one]) for one, names in table.sources.items()
         for k, (s, z) in enumerate(zip(names, table.zero(one)))],
        "lang string, k long, source string, zero long, kept long")
    left = numbered.select("lang", F.col("k").alias("a"), "source", F.col("zero").alias("p"), "kept")
    right = numbered.select("lang", F.col("k").alias("b"), F.col("source").alias("item"), F.col("zero").alias("q"))
    more = parts.where("b IS NOT NULL").groupBy("lang", F.col("a").alias("lo"), F.col("b").alias("hi")) \
        .agg(F.sum("value").alias("more"))
    apart = F.expr("((p - q) * (p - q)) div (p + q)")
    pairs = left.join(right, "lang").where("a <> b").withColumn("lo", F.least("a", "b")) \
        .withColumn("hi", F.greatest("a", "b")).join(more, ["lang", "lo", "hi"], "left") \
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                (F.col("kept") * apart + F.coalesce("more", F.lit(0))).alias("value"))
    own = parts.where("b IS NULL").join(left.select("lang", "a", "source"), ["lang", "a"]) \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(own).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top)).select(
        "lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
