"""Operator 7, sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard by its
hash, which is balanced but cuts nearly all links. A group's label is the shard
that holds most of it. Groups move as a whole and all at once, so what leaves a
shard counts as room there: a shard admits groups, in the order of their hashes,
while the groups it has admitted stay below ``FILL`` of its quota (an equal share
of all bytes). A shard that refuses is full; who was refused asks
in the next round for the one of the others that holds most of it, until nobody is
refused or all shards are full (at most SHARDS rounds). Groups
above 1 / ``LARGE`` of a quota are placed before, largest first, on the shard that
holds most among those with room; one that no shard can hold fills the shard with
most room, then the next, and its rest is placed like a group. Documents without a
link, and what no shard admitted, one group after another, are laid along the
shards' free room by running sums, which leaves the shards equal to within a
document.

Law: ``bytes``. Scale: rows without texts; one aggregate makes a row per group, a
round is a narrow pass over the groups still open with one histogram of SHARDS x
``STEPS`` rows to the driver; at most SHARDS * LARGE groups are collected, and joined by
broadcast. Running sums and slots are made in hash buckets of about ``BUCKET_ROWS``
rows, whose totals are summed on the driver (rows / BUCKET_ROWS numbers).
DataFrame operations only.

Defined cases: NULL text has size 1, crc32 0 and the group of empty texts; NULL or
repeated ids are documents like others; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlens.llm.common import materialize

SHARDS = 16
#: Share of a shard's quota that groups of the rounds may fill.
FILL = 0.98
#: Steps of the order in which groups are admitted.
STEPS = 1024
#: A group larger than this part of a quota is placed by itself (at most SHARDS * LARGE of them).
LARGE = 64
BUCKET_ROWS = 50_000


def _step(column: Column | str, steps: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(steps))


def _running(rows: DataFrame, group: list[str], order: Column, value: Column, n_rows: int, name: str) -> DataFrame:
    """``rows`` with the running sum of ``value`` before each row, per group, in
    the order of a hash: totals of hash buckets, and a window inside each."""
    buckets = max(64, -(-n_rows // BUCKET_ROWS))
    keyed = rows.withColumn("_v", value).withColumn("_o", order).withColumn("_b", F.pmod(F.col("_o"), F.lit(buckets)))
    totals = keyed.groupBy(*group, "_b").agg(F.sum("_v").alias("s")).orderBy(*group, "_b").collect()
    before, at, last = [], 0, None
    for r in totals:
        own = tuple(r[g] for g in group)
        at, last = (0, own) if own != last else (at, last)
        before.append((*own, r["_b"], at))
        at += r["s"]
    fields = "".join(f"{g} {keyed.schema[g].dataType.simpleString()}, " for g in group)
    starts = rows.sparkSession.createDataFrame(before, f"{fields}_b bigint, _before bigint")
    inside = Window.partitionBy(*group, "_b").orderBy("_o", "row").rowsBetween(Window.unboundedPreceding, -1)
    summed = keyed.withColumn("_w", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return summed.join(starts, [*group, "_b"]).withColumn(name, F.col("_before") + F.col("_w")) \
        .drop("_v", "_o", "_b", "_w", "_before")


def _large(groups: list, shards: int, quota: float) -> tuple[list[float], dict[int, list[tuple[int, float]]]]:
    """The shards' loads, and for each of the large groups (gid, s, held) the shards
    that take it in turn and the running bytes up to which each does."""
    load, out = [0.0] * shards, {}
    for g in sorted(groups, key=lambda g: (-g.s, g.gid)):
        at, parts = 0.0, []
        while at < g.s:
            whole = [t for t in range(shards) if g.s - at <= quota - load[t]]
            if whole:
                t = max(whole, key=lambda t: (g.held[t], -load[t], -t))
            else:
                t = max(range(shards), key=lambda t: (quota - load[t], g.held[t], -t))
            part = g.s - at if whole else max(0.0, quota - load[t])
            if not part:
                break
            load[t] += part
            at += part
            parts.append((t, at))
        out[g.gid] = parts
    return load, out


def propagate(groups: DataFrame, shards: int, load: list[float], limit: float) -> list[DataFrame]:
    """Parts of (gid, shard): the labels of the groups (gid, s, held) that the shards
    admit, whole, up to ``limit`` bytes; ``load`` is kept up to date."""
    spark, out, k = groups.sparkSession, [], 0
    open_ = [t for t in range(shards) if load[t] < limit]
    while open_:
        best = F.array_max(F.array(*[F.struct(F.col("held")[t].alias("n"), F.xxhash64("gid", F.lit(t)).alias("o"),
                                              F.lit(t).alias("t")) for t in open_]))
        asks = materialize(groups.select("gid", "s", "held", best["t"].alias("target"),
                                         _step("gid", STEPS, 100 + k).alias("step")), "asks")
        edges = {}  # first step that a shard doesn't hold
        for r in asks.groupBy("target", "step").agg(F.sum("s").alias("s")).orderBy("target", "step").collect():
            if r.target in edges:
                continue
            if load[r.target] + r.s <= limit:
                load[r.target] += r.s
            else:
                edges[r.target] = r.step
        cuts = spark.createDataFrame([(t, edges.get(t, STEPS)) for t in open_], "target int, edge int")
        answered = asks.join(F.broadcast(cuts), "target")
        out.append(answered.where("step < edge").select("gid", F.col("target").alias("shard")))
        open_ = [t for t in open_ if t not in edges] if edges else []  # who is refused asks elsewhere
        groups = answered.where("step >= edge").select("gid", "s", "held")
        k += 1
    return out


def shard(docs: DataFrame, text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(filled) + 1).cast("long").alias("size"), F.crc32(filled.cast("binary")).alias("crc"),
        F.xxhash64(filled).alias("gid"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "rows")
    totals = rows.agg(F.count("*").alias("n"), F.sum("size").alias("s")).first()
    n_rows, quota = totals.n, (totals.s or 0) / shards
    again = rows.groupBy("gid").agg(F.count("*").alias("n_same")).where("n_same > 1").select("gid")
    linked = materialize(rows.join(again, "gid").select("row", "gid", "size"), "linked")
    start = _step("row", shards, 5)
    groups = materialize(linked.groupBy("gid").agg(
        F.sum("size").alias("s"), F.array(*[F.count_if(start == t) for t in range(shards)]).alias("held")), "groups")

    large = F.col("s") > quota / LARGE
    big = groups.where(large).collect()
    load, taken = _large(big, shards, quota)
    parts = spark.createDataFrame(
        [(g.gid, [t for t, _ in taken[g.gid]], [float(at) for _, at in taken[g.gid]],
          [at for _, at in taken[g.gid]] == [g.s]) for g in big],
        "gid bigint, shards array<int>, upto array<double>, whole boolean")
    of_large = linked.join(F.broadcast(parts), "gid")
    whole = of_large.where("whole")
    cut = _running(of_large.where("NOT whole"), ["gid"], F.xxhash64("row", F.lit(7)), F.col("size"), n_rows,
                   "before")
    passed = F.size(F.filter("upto", lambda x: x <= F.col("before") + F.col("size") / 2))
    cut = cut.withColumn("shard", F.get("shards", passed))
    placed = whole.select("row", F.col("shards")[0].alias("shard"), "size").unionByName(
        cut.where("shard IS NOT NULL").select("row", "shard", "size"))
    labels = propagate(groups.where(~large), shards, load, quota * FILL)
    if labels:
        placed = placed.unionByName(linked.join(reduce(DataFrame.unionByName, labels), "gid").select("row", "shard", "size"))
    placed = materialize(placed, "placed")

    # documents without a link, and groups that no shard had room for, one group after another
    loads = {r.shard: r.s for r in placed.groupBy("shard").agg(F.sum("size").alias("s")).collect()}
    free = [max(0.0, quota - loads.get(t, 0)) for t in range(shards)]
    pool = rows.join(placed.select("row"), "row", "left_anti")
    pool = _running(pool, [], F.xxhash64("gid", F.lit(11)), F.col("size"), n_rows, "before")
    scale = sum(free)
    edges, at = [], 0.0
    for s in range(shards):
        at += free[s]
        edges.append((s, at))
    middle = F.col("before") + F.col("size") / 2
    # the pool's bytes are the free room, but for what rounding leaves
    pool_bytes = (totals.s or 0) - sum(quota - f for f in free)
    stretch = scale / pool_bytes if pool_bytes else 1.0
    choice = F.lit(max((s for s in range(shards) if free[s] > 0), default=0))
    for s, edge in reversed(edges):
        if free[s] > 0:
            choice = F.when(middle * stretch < edge, s).otherwise(choice)
    chosen = pool.select("row", choice.cast("int").alias("shard"))
    both = rows.join(placed.select("row", "shard").unionByName(chosen), "row")
    slotted = _running(materialize(both.drop("gid"), "sharded"), ["shard"], F.xxhash64("row", F.lit(13)),
                       F.lit(1).cast("long"), n_rows // shards, "slot")
    return slotted.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                          "slot", F.lit(None).cast("int").alias("grown_shard"))
