"""The registered queries of this subpackage: ``opN_<name>`` and ``pipeline``.

Each applies its operator, with the parameters of a production run, to its
whole table and derives the columns of the query from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxlens.llm import (bpe_count, decontaminate, divergence, html_text, id_files, language_id, lexical_search, near_dup,
                         packing, perplexity, quality_net, sharding, vector_tree)
from voxlens.llm.common import ready, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return language_id.report(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return perplexity.report(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return bpe_count.report(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return html_text.report(table(spark, sf_dir, "pages"))


def op5_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return id_files.round_trip(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return quality_net.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return near_dup.report(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return vector_tree.search(vectors, vectors["vec_id"] % 20 == 0)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = (op1_language_id, op2_quality_rules, op3_token_counts, op4_html_extraction, op5_token_id_files,
           op6_best_fit_packing, op7_sharding, op8_benchmark_decontamination, op9_quality_classifier,
           op10_minhash_near_dup, op11_lexical_search, op12_vector_tree, op13_source_divergence)
    return {q.__name__: q for q in own}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[p + 1:p + k], ' ') AS win
       FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(generate_series(0, len(w) - least(10, len(w)))) AS p
             FROM i WHERE len(w) > 0) t),
dw AS (SELECT doc_id, k, p, array_to_string(w[p + 1:p + k], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(generate_series(0, len(w) - k)) AS p
             FROM d CROSS JOIN (SELECT DISTINCT k FROM iw) ks WHERE len(w) >= k) t),
hits AS (SELECT dw.doc_id, dw.p, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
n AS (SELECT doc_id, COUNT(DISTINCT q) AS n_hit
      FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM hits) h) u
      GROUP BY doc_id),
m AS (SELECT doc_id, COUNT(DISTINCT item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM hits) h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(COALESCE(n.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(COALESCE(m.n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(m.ids, '')) AS items_sha256,
  COALESCE(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.doc_id"""

NEAR_DUP_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p + 1:p + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(0, greatest(len(w) - 4, 0))) AS p FROM d WHERE len(w) > 0) t),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT c.a, c.b
          FROM (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS common
                FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id) c
          JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
          WHERE 100 * c.common >= 80 * (na.n + nb.n - c.common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a) c ON d.doc_id = c.a"""


LEXICAL_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id,
             regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id,
        list_distinct(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
z AS (SELECT COUNT(*) AS n, CAST(SUM(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
q AS (SELECT item, item_id, unnest(w) AS t FROM i),
p AS (SELECT row, doc_id, len, t, COUNT(*) AS tf FROM (SELECT row, doc_id, len(w) AS len, unnest(w) AS t FROM d) u
      WHERE t IN (SELECT t FROM q) GROUP BY row, doc_id, len, t),
f AS (SELECT t, COUNT(*) AS df FROM p GROUP BY t),
s AS (SELECT q.item, q.item_id, p.row, p.doc_id,
        CAST(SUM(CAST(floor(1000 * ln((2 * z.n + 2) / CAST(2 * f.df + 1 AS DOUBLE))) AS BIGINT)
          * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 90 + (90 * p.len * z.n) // z.l)))) AS BIGINT) AS score
      FROM q JOIN p ON q.t = p.t JOIN f ON f.t = p.t CROSS JOIN z GROUP BY q.item, q.item_id, p.row, p.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s
      WHERE score > 0) r
WHERE rank <= 10"""


DIVERGENCE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
             regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT row, lang, source, unnest(w) AS t FROM d),
k AS (SELECT lang, t FROM u GROUP BY lang, t HAVING COUNT(DISTINCT row) >= 10),
v AS (SELECT lang, COUNT(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT u.lang, u.source, u.t, COUNT(*) AS c FROM u JOIN k ON u.lang = k.lang AND u.t = k.t GROUP BY u.lang, u.source, u.t),
n AS (SELECT lang, source, SUM(c) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.t, COALESCE(c.c, 0) AS c,
        1 + CAST(1000000000 AS HUGEINT) * (COALESCE(c.c, 0) + 2) // (COALESCE(n.n, 0) + 2 * v.v) AS p
      FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
q AS (SELECT x.lang, x.t, 1 + CAST(1000000000 AS HUGEINT) * (SUM(x.c) + 2) // (ANY_VALUE(y.n) + 2 * ANY_VALUE(v.v)) AS q
      FROM c x JOIN v ON v.lang = x.lang JOIN (SELECT lang, SUM(n) AS n FROM n GROUP BY lang) y ON y.lang = x.lang
      GROUP BY x.lang, x.t),
f AS (SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT p.lang, p.source, 'term', p.t, (p.p - q.q) * (p.p - q.q) // (p.p + q.q)
      FROM p JOIN q ON p.lang = q.lang AND p.t = q.t WHERE p.c > 0 AND p.p > q.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) o
WHERE part = 'pair' OR rank <= 10"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others are tested by brute force."""
    return {"op8_benchmark_decontamination": DECONTAMINATION_SQL, "op10_minhash_near_dup": NEAR_DUP_SQL,
            "op11_lexical_search": LEXICAL_SQL, "op13_source_divergence": DIVERGENCE_SQL}
