"""Streaming ingest: duplicates across and within files are inserted once,
and a replayed micro-batch is idempotent."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL
from voxlens.sources.tables import Tables
from voxlens.streaming.ingest import feedback_stream, insert_batch, start_feedback_ingest


def test_ingest_inserts_each_id_once(spark):
    work = tempfile.mkdtemp(prefix="voxlens-stream-")
    src, table, ckpt = (os.path.join(work, d) for d in ("src", "table", "ckpt"))
    fb = Tables(spark, SMALL).feedback
    n = fb.count()
    # Two overlapping drops: the first half, then everything (first half again).
    fb.where(F.col("created_at") < "2023-12-15").write.parquet(os.path.join(src, "drop1"))
    fb.write.parquet(os.path.join(src, "drop2"))
    stream = feedback_stream(spark, os.path.join(src, "*"), max_files_per_trigger=1)
    q = start_feedback_ingest(stream, table, ckpt)
    q.awaitTermination(300)
    stored = spark.read.parquet(table)
    assert stored.count() == n
    assert stored.select("id").distinct().count() == n


def test_replayed_batch_is_idempotent(spark):
    work = tempfile.mkdtemp(prefix="voxlens-replay-")
    table = os.path.join(work, "table")
    fb = Tables(spark, SMALL).feedback.orderBy("id").limit(50)
    insert_batch(fb, 0, table)
    insert_batch(fb, 0, table)  # replay of the same batch id
    insert_batch(fb, 1, table)  # same rows in a later batch: nothing new
    stored = spark.read.parquet(table)
    assert stored.count() == 50
    assert stored.where("batch_id = 1").count() == 0
