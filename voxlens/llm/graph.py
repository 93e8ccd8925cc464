"""Connected components by Spark joins: smallest neighbouring label, then a jump
to the label's own label, until nothing changes. Labels and links stay
distributed; the driver sees the number of links and one number per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voxlens.llm.common import few, materialize, n_rows

#: Links of one task.
LINKS = 5000


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b): label is the
    smallest node of its component. Loops, repeated and reversed edges do no harm."""
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("end")
    both = materialize(edges.where("a <> b").select(ends).select("end.a", "end.b"), "edges")
    n = n_rows(both)
    labels = materialize(few(both.groupBy("a").agg(F.min("b").alias("m"))
                             .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), n, LINKS), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").select(
            F.col("a").alias("node"), "label", F.lit(None).alias("old"))
        spread = few(near.unionByName(labels.withColumn("old", F.col("label")))
                     .groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old")), n, LINKS)
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = Observation()
        new = materialize(spread.join(jump, "label", "left").select(
            "node", F.least("label", F.coalesce("far", "label")).alias("label"), "old")
            .observe(moved, F.count_if(F.col("label") != F.col("old")).alias("n")), "labels")
        if not moved.get["n"]:
            return new.select("node", "label")
        labels = new.select("node", "label")
