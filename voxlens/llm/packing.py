"""Operator 6, best-fit packing by a plan over the histogram of lengths.

Every document is its token ids and an end id; only longer ones than the
sequence length are cut, into full pieces and a rest. The lengths of all pieces
give a histogram of at most ``capacity`` counts; best-fit decreasing runs over
these counts (a whole run of equal lengths at a time), not over documents, and
yields planned slots: for a length, ranks from–to lie in consecutive sequences,
``per`` to a sequence, from an offset. A piece takes the slot that its rank
among the pieces of its length has in the plan.

Scale: one pass of tokenisation that writes small rows (no ids travel); a
piece's rank is its count within its task plus the counts of the same length in
earlier tasks, one row per task and length, so no group of a length ever meets
in one task however hot it is. What reaches the driver is the histogram, what
is broadcast is the plan: both depend on ``capacity`` and not on the documents.

Defined cases: NULL and empty texts are one end id; repeated documents are
packed row by row; an empty table gives no rows; other columns are not looked
at and do not clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.llm.common import materialize
from voxlens.llm.word_ids import END, loaded

#: Tokens of a sequence.
CAPACITY = 4096
VOCABULARY = "word_bpe_49k.json"

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: where it lies in its document, the checksum of its ids,
    the task that made it and its rank among that task's pieces of its length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encoder, met = TaskContext.get().partitionId(), loaded(vocabulary), {}
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column(1).to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                wide = np.frombuffer(ids + end, "<u2").astype("<u4")
                for piece, start in enumerate(range(0, len(wide), capacity)):
                    own = wide[start:start + capacity]
                    n = len(own)
                    nth = met[n] = met.get(n, -1) + 1
                    rows.append((doc_id, piece, start, n, zlib.crc32(own), task, nth))
            if rows:
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = [x.split()[0] for x in PIECE.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE)


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, count, per sequence, first sequence, offset).

    ``space`` keeps, for each remaining room, the intervals of sequences that
    have it. A length goes to the tightest room that holds it, as many times
    as it fits (after one piece that sequence is the tightest), then to the
    next; what is left opens new sequences.
    """
    space: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []  # sorted keys of space
    plan, opened = [], 0

    def put(room: int, start: int, n: int) -> None:
        if n and room:
            if room not in space:
                space[room] = []
                insort(rooms, room)
            space[room].append((start, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                start, n = space[room].pop()
                if not space[room]:
                    del space[room]
                    del rooms[at]
            else:
                per = capacity // length
                room, start, n = capacity, opened, -(-left // per)
                opened += n
            per = room // length
            full, rest = divmod(left, per)
            used = min(n, full)
            if used:
                plan.append((length, rank, used * per, per, start, capacity - room))
                put(room - per * length, start, used)
                left, rank = left - used * per, rank + used * per
            if used < n and left:  # fewer than fill one more sequence
                plan.append((length, rank, rest, per, start + used, capacity - room))
                put(room - rest * length, start + used, 1)
                left, rank, used = 0, rank + rest, used + 1
            put(room, start + used, n - used)
    return plan


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = materialize(pieces(docs, capacity, vocabulary), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit_plan(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("before"))
    table = np.array(sorted(plan), dtype=np.int64).reshape(-1, 6)
    slots = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = slots.value
        key = (rows[:, 0] << 44) + rows[:, 1]  # ranks below 2 ** 44
        own = rows[np.searchsorted(key, (length.to_numpy() << 44) + rank.to_numpy(), "right") - 1]
        nth, place = np.divmod(rank.to_numpy() - own[:, 1], own[:, 3])
        return pd.DataFrame({"sequence_id": own[:, 4] + nth, "offset": own[:, 5] + place * own[:, 0]})

    return ranked.withColumn("slot", slot("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "slot.sequence_id", "slot.offset")
