"""Operator 12, approximate nearest neighbours by a hierarchical k-means tree that
each query walks best bin first.

The nearest are those of largest inner product. With one more component,
sqrt(M - |x|**2) for a vector x and 0 for a query (M is the largest squared norm),
they are the nearest by Euclidean distance, which the tree is made for.

* Tree: k-means of ``BRANCHES`` centres, again within each cluster, until a cluster stands
  for ``LEAF_ROWS`` rows or fewer, or has ``LEAST_ROWS`` of the fitted vectors or fewer. It is
  fitted on at most ``FIT_ROWS`` vectors (of smallest row hash); every row is put into a leaf.
* Walk: a priority queue gives the nearest node not yet opened; a leaf that comes up is
  the next one visited. A query visits as many leaves as calibrated, and more until
  these hold ``top`` candidates.
* Calibration: ``PROBES`` vectors are searched by brute force; leaf visits widen until
  they find ``RECALL`` of these neighbours.
* Scores: a leaf's rows lie in packs of about ``PACK`` rows, the queries that visit a leaf
  in packs of at most as many; each pack of queries meets each pack of rows of its leaf in one
  matrix product, and the best ``top`` are scored again from the original vectors, component by
  component in double precision.

Scale: the tree is all that is broadcast (below 2 * BRANCHES * FIT_ROWS / LEAST_ROWS centres, and a count a
leaf); rows are shuffled once into packs, a leaf of any size lies in packs of bounded
size, and a query sends its vector to the leaves it visits. What comes back are ``top`` rows for a
query and task (a task holds ``HELD`` at most, then gives them on), ranked per query.

Defined cases: vectors that are NULL, empty, zero, or hold a NULL or non-finite component,
and those of another length than most (the smaller of equally frequent lengths), take
no part; a row of NULL vec_id is no query, and a candidate that stands after all others of
equal score; each row is a candidate and, if asked for, a query of its own, also if
vec_ids repeat (a query never finds its own row, but finds a repeated one); fewer than ``top``
candidates are all returned; an empty table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlens.llm.common import materialize

TOP = 20
BRANCHES = 16
#: Vectors that the tree is fitted on; the most rows, and fitted vectors, that a cluster keeps undivided.
FIT_ROWS = 65_536
LEAF_ROWS = 1024
LEAST_ROWS = 64
ROUNDS = 12
#: Calibration: vectors searched by brute force, and the share of their neighbours to be found.
PROBES = 256
RECALL = 0.97
#: Rows, and queries, of one pack.
PACK = 1024
#: Rows found that a task holds before it gives them on.
HELD = 1_000_000


class Tree:
    """Nodes in arrays: centre, first child and number of children (0: a leaf)."""

    def __init__(self, vectors: np.ndarray, largest: float, branches: int = BRANCHES, leaf_rows: int = LEAST_ROWS):
        self.largest = largest
        rng = np.random.default_rng(12)
        centres, self.first, self.count = [vectors.mean(axis=0) if len(vectors) else np.zeros(vectors.shape[1])], [0], [0]
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, own = todo.pop()
            if len(own) <= leaf_rows:
                continue
            best, centre = _means(vectors[own], branches, rng)
            if len(centre) < 2:
                continue  # equal vectors
            self.first[node], self.count[node] = len(centres), len(centre)
            for k in range(len(centre)):
                todo.append((len(centres), own[best == k]))
                centres.append(centre[k])
                self.first.append(0)
                self.count.append(0)
        self.centres = np.array(centres, np.float32)
        leaves = [n for n, c in enumerate(self.count) if not c]
        self.leaf = {n: k for k, n in enumerate(leaves)}
        self.leaves = len(leaves)
        self.held = np.zeros(self.leaves, np.int64)

    def _nearest(self, node: int, x: np.ndarray) -> np.ndarray:
        """Squared distances to a node's children, without the part that all share."""
        c = self.centres[self.first[node]:self.first[node] + self.count[node]]
        return (c * c).sum(axis=1) - 2 * x @ c.T

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest child at each node."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if not self.count[node]:
                out[own] = self.leaf[node]
            elif len(own):
                best = self._nearest(node, x[own]).argmin(axis=1)
                todo += [(self.first[node] + k, own[best == k]) for k in range(self.count[node])]
        return out

    def walk(self, x: np.ndarray) -> Iterator[int]:
        """The leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.count[node]:
                yield self.leaf[node]
                continue
            for k, far in enumerate(self._nearest(node, x[None])[0].tolist()):
                heapq.heappush(queue, (far, self.first[node] + k))

    def visited(self, x: np.ndarray, visits: int, enough: int) -> list[int]:
        """The first ``visits`` leaves with rows, and more until they hold ``enough``."""
        out, held = [], 0
        for leaf in self.walk(x):
            if len(out) >= visits and held >= enough:
                break
            if self.held[leaf]:
                out.append(leaf)
                held += int(self.held[leaf])
        return out


def _means(x: np.ndarray, branches: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """k-means: the nearest centre of each row, and the centres that have rows."""
    centre = np.unique(x[rng.choice(len(x), min(branches, len(x)), replace=False)], axis=0)
    best = np.zeros(len(x), np.int64)
    for _ in range(ROUNDS):
        best = ((centre * centre).sum(axis=1) - 2 * x @ centre.T).argmin(axis=1)
        used, best = np.unique(best, return_inverse=True)
        own = (best[None, :] == np.arange(len(used))[:, None]).astype(x.dtype)
        centre = own @ x / own.sum(axis=1, keepdims=True)
    return best, centre


def _longer(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows with the component that gives all the same norm."""
    rest = np.sqrt(np.maximum(0.0, largest - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)


def _query(x: np.ndarray) -> np.ndarray:
    """A query; its length plays no part in the order of candidates, but does in that of nodes."""
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.concatenate([x / norm, np.zeros((len(x), 1))], axis=1).astype(np.float32)


def _matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


class Best:
    """The ``top`` rows of each query by (score descending, id with NULL last, row) of all that was
    added; ``carried`` more columns of the rows ride along."""

    def __init__(self, top: int):
        self.top, self.held = top, None
        self.new: list[list[np.ndarray]] = []
        self.size = self.fresh = 0
        self.q = np.empty(0, np.int64)  # queries that have ``top`` rows, and their last scores
        self.last = np.empty(0)

    def add(self, q_row: np.ndarray, queries: np.ndarray, row: np.ndarray, ids: np.ndarray, none: np.ndarray,
            rows: np.ndarray, carried: np.ndarray) -> None:
        """``ids`` are 0 where ``none``; a query never meets the row that it is."""
        rough = queries @ rows.T
        rough[q_row[:, None] == row[None, :]] = -np.inf
        n = len(row)
        least = np.partition(rough, n - self.top, axis=1)[:, n - self.top] if n > self.top else np.full(len(q_row), -np.inf)
        if len(self.q):
            at = np.minimum(np.searchsorted(self.q, q_row), len(self.q) - 1)
            least = np.maximum(least, np.where(self.q[at] == q_row, self.last[at], -np.inf))
        slack = 1e-9 * np.abs(queries).max(axis=1) * np.abs(rows).max() * (8 * rows.shape[1])
        q, k = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
        score = (rows[k] * queries[q]).sum(axis=1)  # the same sum wherever a vector stands
        self.new.append([q_row[q], score, none[k], ids[k], row[k], carried[k]])
        self.fresh += len(q)
        if self.fresh > max(self.size, 4096):
            self.trim()

    def trim(self) -> None:
        parts = ([self.held] if self.held else []) + self.new
        if not parts:
            return
        q, score, none, ids, row, carried = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((row, ids, none, -score, q))
        first = np.searchsorted(q[order], q[order])
        place = np.arange(len(order)) - first
        order, place = order[place < self.top], place[place < self.top]
        self.held = [x[order] for x in (q, score, none, ids, row, carried)]
        self.new, self.size, self.fresh = [], len(order), 0
        full = place == self.top - 1
        self.q, self.last = self.held[0][full], self.held[1][full]

    def give(self) -> list[np.ndarray]:
        """query row, score, none, id, row, carried; then it is empty."""
        self.trim()
        out = self.held or [np.empty(0, t) for t in (np.int64, float, bool, np.int64, np.int64, np.int64)]
        self.__init__(self.top)
        return out


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow column of ids as numbers (0 for NULL), and where it is NULL."""
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)


def _nullable(ids: np.ndarray, none: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=none)


def _usable(vectors: DataFrame, vector: str) -> DataFrame:
    """(vec_id, asked, v, row) of the vectors that take part; ``row`` is a number of their own."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False)))
    rows = materialize(rows.select("vec_id", "asked", F.col(vector).alias("v"),
                                   F.monotonically_increasing_id().alias("row")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("m")).orderBy(F.desc("m"), "n").first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, leaf_rows: int = LEAF_ROWS, least_rows: int = LEAST_ROWS) -> Tree | None:
    """The tree of (row, v) rows, from those of smallest row hash; None for no row."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = rows.agg(F.max(norm).alias("largest"), F.count("*").alias("n")).first()
    if not size.n:
        return None
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(fit_rows).select("v").toArrow()
    share = min(1.0, fit_rows / size.n)
    return Tree(_longer(_matrix(sample.column(0).combine_chunks()), size.largest), size.largest,
                leaf_rows=max(1, least_rows, round(leaf_rows * share)))


def place(rows: DataFrame, tree) -> DataFrame:
    """(row, vec_id, asked, v, leaf): every row with its leaf, written."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.place(_longer(_matrix(batch.column(3)), tree.value.largest)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], [*batch.schema.names, "leaf"])

    return materialize(rows.select("row", "vec_id", "asked", "v").mapInArrow(
        put, f"row long, vec_id long, asked boolean, v {rows.schema['v'].dataType.simpleString()}, leaf long"), "placed")


def calibrate(placed: DataFrame, tree: Tree, top: int, recall: float, probes: int = PROBES) -> int:
    """The leaf visits with which the probes find ``recall`` of their ``top`` neighbours."""
    asked = placed.orderBy(F.xxhash64("row", F.lit("probe")), "row").limit(probes).select("row", "v").toArrow()
    q_row, q = asked.column(0).to_numpy(), _matrix(asked.column(1).combine_chunks())
    sent = placed.sparkSession.sparkContext.broadcast((q_row, q))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_row, q = sent.value
        best = Best(top)
        for batch in batches:
            if batch.num_rows:
                best.add(q_row, q, batch.column(0).to_numpy(), *_ids(batch.column(1)), _matrix(batch.column(2)),
                         batch.column(3).to_numpy())
        probe, score, none, ids, row, leaf = best.give()
        yield pa.RecordBatch.from_arrays([pa.array(probe), pa.array(score), _nullable(ids, none), pa.array(row),
                                          pa.array(leaf)], ["probe", "score", "id", "row", "leaf"])

    order = Window.partitionBy("probe").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    true = placed.select("row", "vec_id", "v", "leaf") \
        .mapInArrow(brute, "probe long, score double, id long, row long, leaf long") \
        .withColumn("k", F.row_number().over(order)).where(F.col("k") <= top).select("probe", "leaf").collect()
    wanted: dict[int, list[int]] = {}
    for r in true:
        wanted.setdefault(r.probe, []).append(r.leaf)
    walks = {i: tree.walk(x) for i, x in zip(q_row.tolist(), _query(q))}
    seen: dict[int, set[int]] = {i: set() for i in walks}
    visits = 0
    while True:  # widen until enough is found; all leaves find everything
        visits += 1
        for i, walk in walks.items():
            for leaf in walk:
                if tree.held[leaf]:
                    seen[i].add(leaf)
                    break
        hit = sum(leaf in seen[i] for i, own in wanted.items() for leaf in own)
        if hit >= recall * len(true) or visits >= tree.leaves:
            return visits


def search(vectors: DataFrame, asked: Column, vector: str = "embedding", vec_id: str = "vec_id", top: int = TOP,
           recall: float = RECALL, fit_rows: int = FIT_ROWS, leaf_rows: int = LEAF_ROWS, least_rows: int = LEAST_ROWS,
           pack: int = PACK, held: int = HELD) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest of each row for which ``asked`` holds,
    among all other rows."""
    spark = vectors.sparkSession
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = _usable(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("vector"),
                                  F.coalesce(asked, F.lit(False)).alias("asked")), "vector")
    tree = fit(rows, fit_rows, leaf_rows, least_rows)
    if tree is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = spark.sparkContext.broadcast(tree)
    placed = place(rows, sent)
    for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        tree.held[r.leaf] = r.n
    visits = calibrate(placed, tree, top, recall)
    counted = spark.sparkContext.broadcast(tree)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Tree = counted.value
        for batch in batches:
            x = _matrix(batch.column(2))
            leaves = [own.visited(one, visits, top + 1) for one in _query(x)] if len(x) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int64()))],
                                             [*batch.schema.names, "leaves"])

    def packs(df: DataFrame, name: str) -> DataFrame:
        """The rows of a leaf in packs, dealt by the row's hash; a leaf's number of packs follows its rows."""
        n = df.groupBy("leaf").agg(F.ceil(F.count("*") / pack).cast("int").alias("n_packs"))
        part = F.pmod(F.xxhash64("row"), F.col("n_packs")).alias("part")
        return df.join(n, "leaf").select("leaf", part, F.struct("row", "vec_id", "v").alias("x")) \
            .groupBy("leaf", "part").agg(F.collect_list("x").alias(name)).drop("part")

    queries = materialize(placed.where("asked").select("row", "vec_id", "v").mapInArrow(
        visit, f"row long, vec_id long, v {kind}, leaves array<long>"), "visits")
    queries = packs(queries.select("row", "vec_id", "v", F.explode("leaves").alias("leaf")), "queries")
    stored = packs(placed, "stored")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, names = Best(top), {}

        def given():
            q, scores, none, ids, row, _ = best.give()
            asked = [names[k] for k in q.tolist()]
            names.clear()
            return pa.RecordBatch.from_arrays([pa.array(q), pa.array(asked, pa.int64()), pa.array(row), _nullable(ids, none),
                                               pa.array(scores)], ["q_row", "query_id", "row", "vec_id", "score"])

        for batch in batches:
            for k in range(batch.num_rows):
                q, x = batch.column(0)[k].values, batch.column(1)[k].values
                names.update(zip(q.field(0).to_pylist(), q.field(1).to_pylist()))
                row = x.field(0).to_numpy()
                best.add(q.field(0).to_numpy(), _matrix(q.field(2)), row, *_ids(x.field(1)), _matrix(x.field(2)), row)
                if best.size > held:
                    yield given()
        yield given()

    found = queries.join(stored, "leaf").select("queries", "stored").mapInArrow(
        score, "q_row long, query_id long, row long, vec_id long, score double")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
