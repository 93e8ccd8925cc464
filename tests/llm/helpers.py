"""Small tables with the cases that every operator must stand."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "stats string, score double, kept boolean, hits int, node long, size int, shard string"


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = "".join(rng.choice("etaoinsr") for _ in range(1 + rng.randrange(vocabulary) % 7))
        out.append(w.capitalize() if rng.random() < 0.1 else w)
    return " ".join(out)


def documents(spark, rows, extra: bool = False):
    """``rows``: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:  # names that the operators use themselves
        for field in EXTRA.split(", "):
            name, kind = field.split()
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


LONG = words(99, 30_000)
CASES = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, words(5, 60)), (5, words(5, 60)), (6, words(5, 60)),
    (7, words(7, 120) + "\nline two\nline two\n"), (8, "#$% <b> & | *"), (None, words(9, 40)), (None, None),
    (10, LONG), (11, "日本語 テキスト 😀 é́"), (12, words(12, 3)), (13, "a b c d e " * 30), (14, "0 1 2 3"),
]


def cases(spark, extra: bool = True):
    return documents(spark, CASES, extra)
