"""Continuous feedback ingestion (S4 as a Structured Streaming job).

New feedback files land in a source folder; each micro-batch is inserted into
the stored feedback table with ``ON CONFLICT (id) DO NOTHING`` semantics
(``voxlens.operators.sinks.insert_if_absent``).

Cost per micro-batch: the stored ids are not read. Their index
(``voxlens.operators.id_index``: 8 bytes an id, of the buckets that the batch's ids
fall into) names the data files that may hold one of the batch's ids; only those are
opened and compared in full.

Exactly-once: every micro-batch writes only its own ``batch_id=<n>`` directory and the
index of it, in overwrite mode, and compares against the table *without* that
directory. A batch replayed after a failure therefore recomputes the same
rows and replaces its own partial output; the streaming checkpoint (in the
shared folder) records which batches committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from voxlens.operators import id_index

FEEDBACK_SCHEMA = ("id string, created_at timestamp_ntz, source string, product_area string, sentiment string, "
                   "priority int, topic string, region string, customer_tier string, summary string, user_id bigint")


DEFAULT_MAX_FILES_PER_TRIGGER = 64


def feedback_stream(spark: SparkSession, source_dir: str, schema: str = FEEDBACK_SCHEMA,
                    max_files_per_trigger: int = DEFAULT_MAX_FILES_PER_TRIGGER) -> DataFrame:
    """File stream of feedback drops; the per-trigger file cap bounds the micro-batch."""
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(source_dir))


def insert_batch(batch: DataFrame, batch_id: int, table_path: str) -> None:
    """foreachBatch body: insert-if-absent into ``table_path/batch_id=<n>``."""
    batch = batch.persist()  # read twice (ids, rows); bounded by the trigger size
    try:
        id_index.insert(batch, table_path, batch_id, "id", order_col="created_at")
    finally:
        batch.unpersist()


def start_feedback_ingest(stream: DataFrame, table_path: str, checkpoint_location: str,
                          trigger: dict | None = None) -> StreamingQuery:
    """Start the ingest query. ``checkpoint_location`` must be a shared,
    durable folder (e.g. under ``spark.checkpoint.dir``)."""
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: insert_batch(df, bid, table_path))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
