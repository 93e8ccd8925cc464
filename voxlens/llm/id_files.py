"""Operator 5, token-id output: encoded blocks in ascending order of documents.

``write`` deals the documents into ranges of (doc_id, hash of the text), sorts
each range, encodes its texts with the tokenizers library, appends the end id
and cuts the stream of ids into blocks at document ends. The counts of all ids
of the corpus make the one shared frequency table; each block is then encoded
independently (``rans``). A file set is a folder with

* ``blocks``: part, block, place of the block's first id in its part, number of
  ids, the documents' ids and lengths, and the encoded block;
* ``table``: the frequency table, one row per id that occurs.

``read`` decodes the blocks, checks their checksums, and gives each document's
place among all ids: its place in its part plus the sizes of the parts before.

Scale: one shuffle of the texts (by range, no key is a group), one staged copy
of the ids, one encoded copy. A task holds one Arrow batch and one block, which
ends with the document that fills it. The driver sees the table (at most the
vocabulary's size) and one number per part.

Defined cases: NULL and empty texts are one end id; a NULL doc_id sorts first;
documents of the same id follow by their text's hash, and their order among
equal texts does not show; an empty table writes no block.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.llm import rans
from voxlens.llm.common import materialize
from voxlens.llm.word_ids import END, loaded
from voxlens.session import stage_root

VOCABULARY = "word_bpe_49k.json"
IDS = 1 << 16
#: Ids at which a block ends (with the document that reaches it).
BLOCK_IDS = 1 << 17

RAW = "part int, block long, place long, n long, docs array<long>, lengths array<long>, ids binary"
ENCODED = RAW.replace("ids binary", "payload binary")
ROW = "doc_id long, part int, place long, n_tokens long, ids_crc32 long"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_RAW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("place", pa.int64()), ("n", pa.int64()),
                  ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary())])
_ENCODED = pa.schema([f if f.name != "ids" else pa.field("payload", pa.binary()) for f in _RAW])


def id_blocks(docs: DataFrame, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of plain ids, in order within their part; parts are ranges of doc_id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), loaded(vocabulary)
        end = np.array([END], "<u2").tobytes()
        block = place = size = 0
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        held: list[bytes] = []
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                doc_ids.append(doc_id)
                held.append(ids + end)
                lengths.append(len(held[-1]) // 2)
                size += lengths[-1]
                if size >= block_ids:
                    yield _batch([(part, block, place, size, doc_ids, lengths, b"".join(held))], _RAW)
                    block, place, size, doc_ids, lengths, held = block + 1, place + size, 0, [], [], []
        if size:
            yield _batch([(part, block, place, size, doc_ids, lengths, b"".join(held))], _RAW)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(cut, RAW)


def id_counts(blocks: DataFrame) -> DataFrame:
    """Occurrences of each id over all blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=IDS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    return blocks.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> None:
    """Write the file set of ``docs`` under ``path``."""
    spark = docs.sparkSession
    raw = materialize(id_blocks(docs, vocabulary, block_ids), "ids")
    counts = np.zeros(IDS, np.int64)
    for row in id_counts(raw).toLocalIterator():
        counts[row.id] = row.n
    freq = rans.scaled(counts)
    at = np.flatnonzero(freq)
    spark.createDataFrame([(int(i), int(freq[i])) for i in at], "id int, freq int").coalesce(1) \
        .write.parquet(f"{path}/table")
    table = spark.sparkContext.broadcast(freq)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = rans.Tables(table.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column(6)[0].as_buffer(), "<u2")
                payload = pa.array([rans.encode(ids, tables)], pa.binary())
                yield pa.RecordBatch.from_arrays([*row.columns[:6], payload], schema=_ENCODED)

    raw.mapInArrow(encode, ENCODED).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files under ``path``: doc_id, start, n_tokens, ids_crc32."""
    freq = np.zeros(IDS, np.uint32)
    for row in spark.read.parquet(f"{path}/table").toLocalIterator():
        freq[row.id] = row.freq
    table = spark.sparkContext.broadcast(freq)
    blocks = spark.read.schema(ENCODED).parquet(f"{path}/blocks")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = rans.Tables(table.value)
        for batch in batches:
            for i in range(batch.num_rows):
                part, _, place, n, doc_ids, lengths, _ = (c[i].as_py() if k < 6 else None
                                                          for k, c in enumerate(batch.columns))
                ids = rans.decode(batch.column(6)[i].as_py(), tables).astype("<u4")
                if len(ids) != n:
                    raise ValueError(f"block of part {part} has {len(ids)} ids, its row says {n}")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array([part] * len(crcs), pa.int32()),
                     pa.array(starts + place), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "part", "place", "n_tokens", "ids_crc32"])

    before, at = [], 0  # one row per part
    for row in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        before.append((row.part, at))
        at += row.n
    starts = spark.createDataFrame(before, "part int, before long")
    return blocks.mapInArrow(decode, ROW).join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a new folder of the shared folder and read it back."""
    spark = docs.sparkSession
    path = f"{stage_root(spark)}/id-files-{uuid.uuid4().hex}"
    write(docs, path)
    return read(spark, path)
