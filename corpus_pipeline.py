"""Training-corpus pipeline (counted as part of ``voxlens.llm``).

``documents`` go through the quality classifier, the quality rules, near-
deduplication and benchmark decontamination, then are packed into sequences.
Each stage takes (spark, docs, sf_dir), works on every row that its predecessor
kept and returns the columns of ``docs`` (the last one: the packed pieces); ``run``
writes each result as parquet in the shared folder and reads it again.

Rows with NULL or empty texts are judged as the operators define: the classifier
scores them like any text of no word; the quality rules drop what is left of them.
"""

from voxlens.llm import decontaminate, near_dup, packing, perplexity, quality_net
from voxlens.llm.common import crc_mod, materialize, ready, table


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier scores below 0.5 go."""
    ready(spark)
    labels = table(spark, sf_dir, "labels")
    return quality_net.filter_documents(docs, labels, training=crc_mod(labels["doc_id"], 3) != 1)


def quality_rules(spark, docs, sf_dir):
    """Documents that fail a base rule or leave their language's band go."""
    ready(spark)
    return perplexity.filter_documents(docs)


def near_deduplication(spark, docs, sf_dir):
    """One document of each component of near-duplicates stays."""
    ready(spark)
    return near_dup.deduplicate(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents with a word inside an occurrence of a benchmark window go."""
    ready(spark)
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark, docs, sf_dir):
    """The pieces of the remaining documents, packed into sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_deduplication", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The stages fit models and solve a packing: not expressible in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed pieces of ``documents`` after all stages."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
