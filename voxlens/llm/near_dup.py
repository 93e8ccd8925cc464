"""Operator 10, near-duplicates by an inverted join over signature coordinates.

A–Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, a document's set is its
distinct 4-word shingles (fewer words: the whole sequence as one). Equal sets
make one node. A node has ``COORDINATES`` MinHash values; it is posted under each
(coordinate, value). All thresholds follow from the similarity that links (``Limits``),
so that together they miss a link of just that similarity with a probability below ``MISS``.

* Skip: a node that shares no run of ``run`` coordinates with another has no partner and
  is not posted; nor has one with fewer than ``matches`` values that another node has.
* Prefix: two nodes with ``matches`` common values meet within the
  COORDINATES - matches + 1 rarest of either; its unshared values use up places
  of that prefix, so only the rarest (shared - matches + 1) are posted.
* Large groups: a node is first compared with one other, the central node (the one that shares
  most) of most of its postings, then with the central nodes of its other postings that are in another
  component by then (linear in the postings), which joins copies of one text into components. The inverted join
  pairs only nodes of different components, so a group of copies of any size never pairs with itself. Postings of
  at most ``FEW`` nodes go first (linear in the postings); the others pair what is still apart then.
* Nearest first: of the pairs made between components each component tests the one whose parities differ least; of
  the rest only pairs whose components are apart then are left (``_linked``). So a node that is alike to many
  members of a large group is mostly tested once, and links are followed between components, not between nodes.
* Once: a posting carries the node's rarer keys, and a pair is made only under the
  first key that both have.
* Sets: two sets of n and m members are alike only if they have at least
  a = (n + m) * S / (1 + S) in common, so of any common order of members the first
  n - a + 1 of the one and m - a + 1 of the other must meet. With the rarest first,
  members that no other set has use up places; a node with no place left leaves, and
  a pair is made under a common key only if its first members meet.
* Match threshold: of the pairs with a posting's central node only those go on that agree in enough
  of ``FINE`` more coordinates, a byte each (equal values have equal bytes); the others' first members have met.
* Parity: a set's members dealt to at least ``PARITY`` bits a member leave each bit's parity. Bits in which
  two sets differ are at most the members that one set has alone, so a pair that differs in more than an
  alike one may has no link (exact). It drops nearly all pairs below a similarity of 0.78 where 0.8 links, so of
  nodes at the rim of a large group few pairs with its members are made.
* Links are confirmed on the full sets.

Scale: the texts are read once where they lie, and shuffled once for the nodes that have any
partner candidate. Shuffled are the runs (8 bytes each), the values of nodes that share a run, and, of postings that
lie in several components, a few hundred bytes each; sets of shingles travel for pairs that agree only. Hot values are counted by partial aggregates and
joined by skew-splittable sort-merge joins; links and components stay in Spark.

Defined cases: NULL, empty or blank texts have no shingle and link with
nothing; repeated rows are equal sets; a NULL doc_id counts as larger than any
id and its component is NULL only if no member has an id; other columns of the
input are neither looked at nor clash; a similarity for which the coordinates do not
suffice is refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.llm import textops as X
from voxlens.llm.common import few, fresh, materialize, n_rows
from voxlens.llm.graph import components

SHINGLE = 4
#: Links need 100 * intersection >= 100 * SIMILARITY * union.
SIMILARITY = 0.8
COORDINATES = 64
#: Coordinates of the finer test, a byte each.
FINE = 128
#: Least bits of parity for a member of a set (a power of two in all).
PARITY = 4
#: Nodes of a posting that is paired in the first turn.
FEW = 256
#: Turns of nearest pairs go on while one of so many components links.
TURN = 8
#: Rows of one task where rows are few: of ids and labels, of nodes with their coordinates, of sets.
NARROW, NODES, SETS = 10_000, 4000, 500
#: The chance to miss a link of just the similarity asked for, all tests together.
MISS = 1e-6

_A = (X._splitmix(COORDINATES + FINE, 1001) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (X._splitmix(COORDINATES + FINE, 2003) >> np.uint64(32)).astype(np.uint32)


def _least_matches(n: int, similarity: float, miss: float) -> int:
    """The largest m such that fewer than m of n coordinates agree with a chance of ``miss`` at most."""
    tail, m = 0.0, 0
    while m <= n:
        tail += math.comb(n, m) * similarity ** m * (1 - similarity) ** (n - m)
        if tail > miss:
            break
        m += 1
    return min(m, n)


class Limits:
    """The thresholds for one similarity."""

    def __init__(self, similarity: float):
        self.similarity = similarity
        self.matches = _least_matches(COORDINATES, similarity, 0.4 * MISS)
        self.fine = _least_matches(FINE, similarity, 0.2 * MISS)
        if not 0 < similarity <= 1 or not self.matches:
            raise ValueError(f"{COORDINATES} coordinates do not find links of similarity {similarity}")
        self.run = max(r for r in range(1, 9) if r == 1 or (1 - similarity ** r) ** (COORDINATES // r) <= 0.4 * MISS)

SIGNED = "doc_id long, text_hash long, n_shingles long, node long, sig array<int>"


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    if not text:
        return np.empty(0, np.uint64)
    cp = X.lower_ascii(X.code_points(text))
    words = X.word_hashes(cp, *X.runs(X.spaced_mask(cp)))
    return np.unique(X.window_hashes(words, min(size, len(words)))) if len(words) else np.empty(0, np.uint64)


def node_of(own: np.ndarray) -> int:
    """A set's 64-bit identity."""
    with np.errstate(over="ignore"):
        mixed = X.finish(own ^ np.uint64(0x5851F42D4C957F2D))
        total = X.finish(np.array([mixed.sum(dtype=np.uint64) + np.uint64(len(own))]))
    return int(total.view(np.int64)[0])


def signature(own: np.ndarray, first: int = 0, last: int = COORDINATES) -> np.ndarray:
    """The smallest value over a set of each of the hash functions ``first`` to ``last``."""
    h = (own >> np.uint64(32)).astype(np.uint32)
    best = np.full(last - first, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 1024):
            np.minimum(best, (h[at:at + 1024, None] * _A[first:last] + _B[first:last]).min(axis=0), out=best)
    return best.view(np.int32)


def as_bytes(sig: np.ndarray) -> np.ndarray:
    """A byte of each value of a signature, eight to a number; equal values have equal bytes."""
    return (sig.view(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).view(np.int64)


def fine(own: np.ndarray) -> np.ndarray:
    """The ``FINE`` further coordinates as bytes."""
    return as_bytes(signature(own, COORDINATES, COORDINATES + FINE))


def parity(own: np.ndarray) -> np.ndarray:
    """The parities of the members that fall on each of a power of two of bits, 64 to a number."""
    bits = max(64, 1 << (PARITY * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def signed(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text, the set's size, its node (NULL if empty) and signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32()))],
                ["doc_id", "text_hash", "n_shingles", "node", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).alias("text")).mapInArrow(sign, SIGNED)


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, the members of its set, sorted as unsigned numbers, its fine coordinates and parities) of (node, text) rows."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([fine(s) for s in sets], pa.list_(pa.int64())),
                 pa.array([parity(s) for s in sets], pa.list_(pa.int64()))], ["node", "members", "fine", "parity"])

    return texts.select("node", "text").mapInArrow(
        make, "node long, members array<long>, fine array<long>, parity array<long>")


def agree(p: str, q: str, coordinates: int, least: int) -> F.Column:
    """Whether two signatures as bytes have at least ``least`` equal ones of ``coordinates``."""
    differ = F.lit(0)
    for k in range(coordinates // 8):
        x = F.col(p)[k].bitwiseXOR(F.col(q)[k])
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift)).bitwiseAND(F.lit(mask))
        differ = differ + F.bit_count(x)  # a bit for each byte that differs
    return differ <= coordinates - least


def _similar(similarity: float):
    percent = round(100 * similarity)

    @F.pandas_udf(T.BooleanType())
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            both = np.concatenate([a, b])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            out.append(100 * common >= percent * (len(both) - common))
        return pd.Series(out, dtype=bool)

    return similar


def _sizes_allow(p: str, q: str, limits: Limits) -> F.Column:
    percent = round(100 * limits.similarity)
    return 100 * F.least(p, q) >= percent * F.greatest(p, q)


def _least_common(p: str, q: str, limits: Limits) -> F.Column:
    """The members that alike sets of so many members have in common at least."""
    percent = round(100 * limits.similarity)
    return F.ceil((F.col(p) + F.col(q)) * percent / (100 + percent))


def _parities_differ(p: str, q: str) -> F.Column:
    """The number of parities that differ. Of two sizes the longer is folded in half; NULL for sets whose sizes lie
    further apart."""

    def folded(x: str, y: str) -> F.Column:
        half = (F.size(x) / 2).cast("int")
        fold = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(x) > F.size(y), fold).otherwise(F.col(x))

    return F.aggregate(F.zip_with(folded(p, q), folded(q, p), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0),
                       lambda total, n: total + n)


def _parities_allow(p: str, q: str, p_n: str, q_n: str, limits: Limits) -> F.Column:
    """Whether the parities differ in no more bits than alike sets may have members alone; sets whose sizes lie too
    far apart are let pass."""
    alone = F.col(p_n) + F.col(q_n) - 2 * _least_common(p_n, q_n, limits)
    return F.coalesce(_parities_differ(p, q) <= alone, F.lit(True))


def _distance(p: str, q: str, p_n: str, q_n: str) -> F.Column:
    """How far two sets are apart by their parities, for an order of tests only."""
    return F.coalesce(_parities_differ(p, q) / (F.col(p_n) + F.col(q_n)), F.lit(2.0))


def _confirmed(pairs: DataFrame, sets: DataFrame, limits: Limits) -> DataFrame:
    """The pairs (a, b, further columns) whose full sets are alike."""
    set_a = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
    set_b = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))
    alike = pairs.join(set_a, "a").join(set_b, "b").where(_similar(limits.similarity)("set_a", "set_b")).select(*pairs.columns)
    return materialize(few(alike, n_rows(pairs), NARROW, joined=True), "links")


def _near(pairs: DataFrame, rows: int, sets: DataFrame, limits: Limits) -> DataFrame:
    """The pairs (a, b, further columns; ``rows`` at most) that agree in their fine coordinates and parities, with
    their distance."""
    n = F.size("members")
    fine_a = sets.select(F.col("node").alias("a"), F.col("fine").alias("fine_a"),
                        F.col("parity").alias("parity_a"), n.alias("n_a"))
    fine_b = sets.select(F.col("node").alias("b"), F.col("fine").alias("fine_b"),
                        F.col("parity").alias("parity_b"), n.alias("n_b"))
    near = pairs.join(fine_a, "a").join(fine_b, "b").where(
        _sizes_allow("n_a", "n_b", limits) & agree("fine_a", "fine_b", FINE, limits.fine)
        & _parities_allow("parity_a", "parity_b", "n_a", "n_b", limits)).select(
        *pairs.columns, _distance("parity_a", "parity_b", "n_a", "n_b").alias("distance"))
    return materialize(few(near, rows, NARROW, joined=True), "pairs")


def _part(df: DataFrame, labels: DataFrame, node: str, part: str) -> DataFrame:
    """``df`` with the component of the node in column ``node``; a node without a link is its own."""
    own = labels.select(F.col("node").alias(node), F.col("label").alias("own"))
    return df.join(own, node, "left").withColumn(part, F.coalesce("own", node)).drop("own")


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) after components a and b of ``edges`` have become one."""
    parts = components(edges)
    into = parts.select(F.col("node").alias("label"), F.col("label").alias("into"))
    old = labels.join(into, "label", "left").select("node", F.coalesce("into", "label").alias("label"))
    return materialize(old.unionByName(parts.join(labels, "node", "left_anti").select("node", "label")), "labels")


def _linked(pairs: DataFrame, labels: DataFrame, sets: DataFrame, limits: Limits) -> DataFrame:
    """(node, label) after the written pairs (a, b, a_part, b_part, distance), all between components of ``labels``, are tested.

    In each turn every component tests its nearest pair, and the other pairs within the components made so leave.
    Once few components link, or if no more pairs are left than twice the components at first, all are tested that are left."""
    thorough, most = False, 0
    while rows := n_rows(pairs):
        pair = F.struct("distance", "a", "b", "a_part", "b_part").alias("pair")
        ends = [pairs.select(F.col(x).alias("part"), pair) for x in ("a_part", "b_part")]
        of_part = few(ends[0].unionByName(ends[1]).groupBy("part").agg(F.min("pair").alias("pair")), rows, NARROW)
        nearest = materialize(few(of_part.select("pair.*").distinct(), rows, NARROW), "nearest")
        n = n_rows(nearest)
        most = most or 2 * n
        last = thorough or rows <= most
        found = _confirmed(pairs if last else nearest, sets, limits)
        n_found = n_rows(found)
        if n_found:
            labels = _merged(labels, few(found.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")).distinct(),
                                         n_found, NARROW))
        if last:
            return labels
        thorough = n_found * TURN < n
        left = pairs.join(nearest.select("a", "b"), ["a", "b"], "left_anti")
        for x in ("a_part", "b_part"):  # a component's name is one of its nodes
            left = _part(left.withColumnRenamed(x, "was"), labels, "was", x).drop("was")
        pairs = materialize(few(left.where("a_part <> b_part"), rows, NARROW, joined=True), "pairs")
    return labels


def _sharing(reps: DataFrame, limits: Limits) -> DataFrame:
    """The (node, sig) rows that share a run of coordinates with another node."""
    runs = F.transform(F.sequence(F.lit(0), F.lit(COORDINATES // limits.run - 1)),
                       lambda k: F.xxhash64(k, F.slice("sig", k * limits.run + 1, F.lit(limits.run))))
    posted = reps.select("node", F.explode(runs).alias("run"))
    often = posted.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run")
    return reps.join(posted.join(often, "run").select("node").distinct(), "node").select("node", "sig")


def _postings(reps: DataFrame, limits: Limits) -> DataFrame:
    """(node, key, n, rank, shared): the shared values of nodes that have ``matches`` of them, rarest first."""
    postings = _sharing(reps, limits).select("node", F.posexplode("sig").alias("c", "v")).select(
        "node", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v").cast("long")).alias("key"))
    often = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    by_rarity = Window.partitionBy("node").orderBy("n", "key")
    shared = postings.join(often, "key").withColumn("rank", F.row_number().over(by_rarity)) \
        .withColumn("shared", F.count("*").over(Window.partitionBy("node"))).where(f"shared >= {limits.matches}")
    return materialize(few(shared, n_rows(reps), NODES), "postings")


def _grouped(shared: DataFrame, sets: DataFrame, limits: Limits) -> DataFrame:
    """(node, label) of the nodes that a star has linked: each posting's nodes against the one that
    shares most, which copies of one text have in common. A node meets the one of most of its postings
    first, and of the others those that are not in its component then."""

    def pairs(star: DataFrame, *more: F.Column) -> DataFrame:
        # a hub is more central than its nodes, so no pair comes in both directions
        return star.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"), *more)

    central = F.col("shared") * F.lit(1 << 48) + F.shiftrightunsigned(F.xxhash64("node"), 16)
    hubs = shared.groupBy("key").agg(F.max_by("node", central).alias("hub"))
    spokes = shared.select("key", "node").join(hubs, "key").where("node <> hub")
    star = materialize(few(spokes.groupBy("node", "hub").agg(F.count("*").alias("keys")), n_rows(shared), NARROW), "star")
    n = n_rows(star)
    nearest = few(star.groupBy("node").agg(F.max_by("hub", F.struct("keys", "hub")).alias("hub")), n, NARROW)
    first = components(_confirmed(_near(pairs(nearest), min(n, n_rows(sets)), sets, limits), sets, limits))
    apart = _part(_part(star, first, "node", "node_part"), first, "hub", "hub_part").where("node_part <> hub_part")
    ends = [F.when((F.col("node") < F.col("hub")) == least, F.col("node_part")).otherwise(F.col("hub_part")).alias(x)
            for x, least in (("a_part", True), ("b_part", False))]
    return _linked(_near(pairs(apart, *ends), n, sets, limits), first, sets, limits)


def _rarest(sets: DataFrame, limits: Limits) -> DataFrame:
    """(node, n, alone, first): size, members that no other set has, and the rarest of the
    others as far as any partner's size lets them count; nodes without any leave."""
    percent = round(100 * limits.similarity)
    members = sets.select("node", F.size("members").cast("long").alias("n"), F.explode("members").alias("member"))
    often = members.groupBy("member").agg(F.count("*").alias("times")).where("times > 1")
    by_rarity = Window.partitionBy("node").orderBy("times", "member")
    shared = members.join(often, "member").withColumn("place", F.row_number().over(by_rarity)) \
        .withColumn("alone", F.col("n") - F.count("*").over(Window.partitionBy("node")))
    places = F.floor(F.col("n") * (100 - percent) / 100) + 1 - F.col("alone")  # the smallest partner asks least
    return shared.where(F.col("place") <= places).groupBy("node").agg(
        F.first("n").alias("n"), F.first("alone").alias("alone"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "member"))), lambda x: x["member"]).alias("first"))


def _may_be_alike(limits: Limits) -> F.Column:
    """Whether the first members of p and q meet, as far as their sizes ask."""
    both = _least_common("p_n", "q_n", limits)
    cut = [F.slice(f"{x}_first", 1, F.greatest(F.lit(0), F.col(f"{x}_n") - both + 1 - F.col(f"{x}_alone")).cast("int"))
           for x in ("p", "q")]
    return F.arrays_overlap(*cut)


def _across(shared: DataFrame, labels: DataFrame, sets: DataFrame, limits: Limits) -> DataFrame:
    """(node, label) after links between nodes of different components, by the inverted join over the prefixes."""
    rarer = Window.partitionBy("node").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    prefix = materialize(few(shared.where(f"rank <= shared - {limits.matches} + 1").select(
        "node", "key", "n", F.collect_list("key").over(rarer).alias("rarer")), n_rows(shared), NARROW), "prefix")
    rarest = materialize(few(_rarest(sets, limits), n_rows(sets), SETS), "rarest").join(sets.select("node", "parity"), "node")
    for turn in (f"n <= {FEW}", f"n > {FEW}"):
        own = prefix.where(turn).drop("n")
        if not own.isEmpty():
            labels = _linked(_pairs(own, labels, rarest, limits), labels, sets, limits)
    return labels


def _pairs(prefix: DataFrame, labels: DataFrame, rarest: DataFrame, limits: Limits) -> DataFrame:
    """The pairs (a, b, a_part, b_part, distance), written, of nodes of different components that may be alike and have
    their first common key among the postings ``prefix``."""
    prefix = materialize(_part(prefix, labels, "node", "part"), "postings")
    n = n_rows(prefix)
    parts = few(prefix.groupBy("key", "part").agg(F.count("*").alias("n_nodes")), n, NARROW)
    mixed = few(parts.groupBy("key").agg(F.count("*").alias("n_parts")).where("n_parts > 1").select("key"), n, NARROW)
    parts = materialize(few(parts.join(mixed, "key"), n, NARROW, joined=True), "parts")
    posted = prefix.join(parts, ["key", "part"])
    posted = materialize(posted.join(rarest, "node"), "posted")

    def side(df: DataFrame, x: str) -> DataFrame:
        return df.select("key", *[F.col(c).alias(f"{x}_{c}") for c in (
            "node", "part", "rarer", "n", "alone", "first", "parity")])

    # a component with one node under a key meets all others there; two larger ones meet by component
    single, several = posted.where("n_nodes = 1"), posted.where("n_nodes > 1")
    groups = parts.where("n_nodes > 1")
    meet = groups.select("key", F.col("part").alias("p_part")).join(
        groups.select("key", F.col("part").alias("q_part")), "key").where("p_part < q_part")
    # in this order: a pair's first members and parities are compared once, under its first key
    can = _sizes_allow("p_n", "q_n", limits) & ~F.arrays_overlap("p_rarer", "q_rarer") & _may_be_alike(limits) \
        & _parities_allow("p_parity", "q_parity", "p_n", "q_n", limits)
    across = [
        side(single, "p").join(side(single, "q"), "key").where((F.col("p_node") < F.col("q_node")) & can),
        side(single, "p").join(side(several, "q"), "key").where(can),
        meet.join(side(several, "p"), ["key", "p_part"]).join(side(several, "q"), ["key", "q_part"]).where(can)]
    pairs = [df.select(F.col("p_node").alias("a"), F.col("q_node").alias("b"), F.col("p_part").alias("a_part"),
                       F.col("q_part").alias("b_part"), _distance("p_parity", "q_parity", "p_n", "q_n").alias("distance"))
             for df in across]
    return materialize(few(pairs[0].unionByName(pairs[1]).unionByName(pairs[2]), n, NARROW, joined=True), "pairs")


def near_duplicates(docs: DataFrame, text: str = "text", size: int = SHINGLE,
                    similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id
    (the smallest doc_id reachable), first (this row's doc_id and text stand for
    its component)."""
    limits = Limits(similarity)
    rows = materialize(signed(docs, text, size), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    n_all = n_rows(rows)
    reps = materialize(few(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(order).alias("best"), F.first("sig").alias("sig")), n_all, NODES), "nodes")
    shared = _postings(reps, limits)
    best = reps.select("node", "best").join(shared.where("rank = 1").select("node"), "node", "left_semi").select(
        "node", F.col("best.doc_id").alias("doc"), F.col("best.text_hash").alias("hash"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        F.col(text).alias("text"))
    texts = texts.join(best.hint("merge"), F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_hash") == F.col("hash")))
    posted = min(n_rows(reps), n_rows(shared) // limits.matches)  # nodes at most
    sets = materialize(few(_sets(texts, size).dropDuplicates(["node"]), posted, SETS), "sets")
    labels = _grouped(shared, sets, limits)
    final = _across(shared, labels, sets, limits)

    n, best = n_rows(sets), reps.select("node", "best")
    tops = few(final.join(best, "node").groupBy("label").agg(F.min("best").alias("top")), n, NARROW)
    place = materialize(few(final.join(tops, "label").select("node", "top"), n, NARROW, joined=True), "places")  # a node without a link is its own
    out = few(rows.select("doc_id", "text_hash", "n_shingles", "node").join(best, "node", "left").join(place, "node", "left")
              .withColumn("top", F.coalesce("top", "best")), n_all, NARROW, joined=True)
    alone = F.col("node").isNull()
    return out.select(
        "doc_id", "text_hash", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("component_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("text_hash") == F.col("top.text_hash"))))
        .alias("first"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(docs.select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """One document of each component, all columns kept; documents without a
    shingle stay."""
    doc, hashed, empty = fresh("doc"), fresh("hash"), fresh("empty")
    marked = near_duplicates(docs.select("doc_id", text), text, **options)
    first = marked.where("first").groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed)).agg(
        (F.max("n_shingles") == 0).alias(empty))
    joined = docs.join(first, F.col("doc_id").cast("long").eqNullSafe(F.col(doc))
                       & (F.xxhash64(text) == F.col(hashed)))
    one = joined.where(~F.col(empty)).dropDuplicates([doc, hashed])
    return one.unionByName(joined.where(F.col(empty))).drop(doc, hashed, empty)
