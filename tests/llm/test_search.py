"""Operators 11, 12 and 13 against brute force and on the cases that every operator must stand."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import CASES, cases, documents, words
from voxlens.llm import divergence, lexical_search, vector_tree
from voxlens.llm.common import ready


@pytest.fixture(scope="module")
def sp(spark):
    return ready(spark)


def lowered(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


# operator 11


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_search(docs, asked, top=10):
    split = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counts = [(i, Counter(split.findall(lowered(t)))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(x for _, _, x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in asked:
        found = []
        for i, c, size in counts:
            m = 100 - 90 + (90 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(split.findall(lowered(text))) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


DOCS = [(100 + i, words(i, 5 + 37 * i % 400, 60)) for i in range(150)] + [(300, "Common Zebra common"), (299, "common zebra, COMMON")]
ITEMS = [(k, words(k, 12, 60)) for k in range(20)] + [(50, "zebra"), (50, "ZEBRA common"), (None, "common"), (51, None),
                                                      (52, ""), (53, "nosuchterm"), (54, words(3, 900, 60))]


@pytest.mark.parametrize("limits", [{}, {"item_chars": 300}])
def test_search_equals_brute_force(sp, limits):
    docs = [r[:2] for r in DOCS + CASES]
    out = lexical_search.search(documents(sp, docs, True), items(sp, ITEMS), **limits).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in out), key=str) == brute_search(docs, ITEMS)


def test_search_of_many_blocks(sp, monkeypatch):
    blocks = lexical_search._Blocks()
    monkeypatch.setattr(lexical_search, "COLUMNS", 8)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lexical_search, "BUFFER_BYTES", 6000)
    made = [b for i, t in DOCS for b in blocks.add(i, t.encode())] + [blocks.close(s) for s in list(blocks.open)]
    assert sorted(i for b in made for i in b["ids"]) == sorted(i for i, _ in DOCS) and len(made) > 30
    own = lexical_search.Items([t.encode() if t else None for _, t in ITEMS])
    names = list(own.vocabulary)
    held = [(b, c, Counter(lexical_search.terms(t))) for b in made for c, t in enumerate(b["texts"])]
    own.weigh(len(held), sum(sum(b["lengths"]) for b in made), {own.vocabulary[t]: n for t, n in Counter(
        t for _, _, c in held for t in c if t in own.vocabulary).items()})
    tight = 0
    for b in made:
        lengths = np.array(b["lengths"])
        bound, spread = own.bounds(b["bits"], b["slices"], lengths), own.spread(lengths)
        for c, text in enumerate(b["texts"]):
            counts = Counter(lexical_search.terms(text))
            for item in range(len(own.of)):
                score = own.score(item, counts, int(spread[c]), names)
                assert bound[item, c] >= score
                tight += bound[item, c] <= 1.25 * score
    assert tight > 0.8 * len(held) * len(own.of) * 0.8


def test_search_of_empty_tables(sp):
    assert lexical_search.search(documents(sp, []), items(sp, ITEMS)).count() == 0
    assert lexical_search.search(documents(sp, [(1, None), (2, " ")]), items(sp, ITEMS)).count() == 0
    assert lexical_search.search(cases(sp), items(sp, [])).count() == 0


# operator 12


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, row int, v string, leaf string, score double")


def rows_of(x, ids=None):
    return [(int(i), [float(c) for c in v], 0, None, None, None, None) for i, v in zip(range(len(x)) if ids is None else ids, x)]


def brute_near(x, q, top):
    score = (x * x[q]).sum(axis=1)
    return [k for k in np.lexsort((np.arange(len(x)), -score)) if k != q][:top], score


def test_every_leaf_is_exact(sp):
    """With all leaves visited the answer is brute force's, ties included."""
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (700, 6)).astype(np.float32)
    x = x[(x != 0).any(axis=1)]
    x[200:400] = x[7]  # one vector holds a third of all rows
    out = vector_tree.search(vectors(sp, rows_of(x)), F.col("vec_id") % 20 == 0, top=20, recall=2.0, leaf_rows=30, least_rows=10,
                             pack=16, held=500).collect()
    by = {}
    for r in out:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(by) == list(range(0, len(x), 20))
    for q, found in by.items():
        near, score = brute_near(x.astype(float), q, 20)
        assert [(k, v, s) for k, v, s in sorted(found)] == [(k, v, score[v]) for k, v in enumerate(near, 1)]


def test_recall_of_clusters_and_of_unequal_norms(sp):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 16))[rng.integers(0, 60, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    x *= rng.uniform(0.5, 2, (3000, 1))
    seen = []
    calibrate = vector_tree.calibrate
    try:
        vector_tree.calibrate = lambda *a, **k: seen.append((calibrate(*a, **k), a[1].leaves)) or seen[-1][0]
        out = vector_tree.search(vectors(sp, rows_of(x), "double"), F.col("vec_id") % 20 == 0, leaf_rows=40, least_rows=10).collect()
    finally:
        vector_tree.calibrate = calibrate
    by = {}
    for r in out:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(by[q] & set(int(k) for k in brute_near(x, q, 20)[0])) for q in by)
    assert len(by) == 150 and all(len(v) == 20 for v in by.values())
    assert hits >= 0.9 * 20 * 150 and seen[0][0] < seen[0][1] / 2  # and most leaves are left out


def test_vector_cases(sp):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [0.0, -1.0]), (40, [nan, 0.0])]
    out = vector_tree.search(vectors(sp, [r + (0, None, None, None, None) for r in rows]), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out if r.query_id == 0) == \
        [(0, 1, 1, 1.0), (0, 2, 1, 1.0), (0, 3, None, 1.0), (0, 4, 20, 0.0)]
    assert sorted((r["rank"], r.vec_id) for r in out if r.query_id == 20) == [(1, 0), (2, 1), (3, 1), (4, None)]
    assert {r.query_id for r in out} == {0, 20}
    one = vectors(sp, [(0, [1.0], 0, None, None, None, None)])
    assert vector_tree.search(one, F.col("vec_id") % 20 == 0).count() == 0
    assert vector_tree.search(one.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# operator 13


def brute_audit(docs, min_docs, top=10):
    split = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    own, df = {}, {}
    for text, lang, source in docs:
        found = split.findall(lowered(text))
        own.setdefault(lang or "", {}).setdefault(source or "", Counter()).update(found)
        df.setdefault(lang or "", Counter()).update(set(found))
    out = []
    for lang, groups in own.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        total = {s: sum(c[t] for t in kept) for s, c in groups.items()}

        def p(count, n):
            return 1 + 10**9 * (count + 2) // (n + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, c in groups.items():
            pair = [(sum(f(p(c[t], total[s]), p(d[t], total[o])) for t in kept), o) for o, d in groups.items() if o != s]
            whole = {t: p(sum(d[t] for d in groups.values()), sum(total.values())) for t in kept}
            term = [(f(p(c[t], total[s]), whole[t]), t) for t in kept if c[t] and p(c[t], total[s]) > whole[t]]
            for part, rows, limit in (("pair", pair, None), ("term", term, top)):
                ordered = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:limit]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


def audited(spark, rows, min_docs, **options):
    df = spark.createDataFrame(rows, "text string, lang string, source string") \
        .withColumns({c: F.lit(None).cast("string") for c in ("term", "shard", "value", "part")})
    return sorted(map(tuple, divergence.audit(df, min_docs=min_docs, **options).collect()))


def audit_rows():
    rows = [(words(i, 20 + i % 60, 30), "en" if i % 3 else "de", f"s{i * i % 7}") for i in range(160)]
    rows += [(t, None, "s1") for _, t in CASES] + [("É été ÉTÉ 日本 a1b", "fr", None), (None, "fr", "x"), ("", "it", "y")]
    return rows + [rows[0]] * 40


@pytest.mark.parametrize("block_entries", [divergence.BLOCK_ENTRIES, 50])
def test_audit_equals_brute_force(sp, block_entries):
    """In one run a task, and in many small ones."""
    rows = audit_rows()
    for min_docs in (1, 5):
        assert audited(sp, rows, min_docs, block_entries=block_entries) == brute_audit(rows, min_docs)


def test_audit_in_small_tables(sp, monkeypatch):
    """Sums and pieces that overflow all the time give the same."""
    rows = audit_rows()
    df = sp.createDataFrame(rows, "text string, lang string, source string")
    runs = [p for p in divergence.runs(df.na.fill(""), "text", 3, 200).collect()]
    assert len({(r.shard, r.lang, r.first) for r in runs}) <= len(runs)
    found = sp.createDataFrame(
        [(lang, term, list(c), list(c.values())) for lang, term, df, c in _merge(runs) if df >= 2],
        "lang string, term binary, sources array<string>, counts array<long>")
    want = {(lang, t.encode(), n) for lang, t, n in _documents(rows) if n >= 2}
    assert {(r.lang, bytes(r.term)) for r in found.collect()} == {(lang, t) for lang, t, _ in want}


def _merge(runs):
    own = sorted(({**r.asDict(), "first": bytes(r.first), "terms": [bytes(t) for t in r.terms]} for r in runs),
                 key=lambda r: (r["shard"], r["lang"], r["first"]))
    for r in own:
        for name in ("df", "held", "source", "count"):
            r[name] = np.array(r[name])
    return list(divergence._merged(iter(own)))


def _documents(rows):
    split = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    df = Counter((lang or "", t) for text, lang, _ in rows for t in set(split.findall(lowered(text))))
    return [(lang, t, n) for (lang, t), n in df.items()]


def test_sums_that_overflow():
    rng = np.random.default_rng(3)
    sums, want, got = divergence._Sums(50), Counter(), Counter()
    for _ in range(40):
        keys, values = rng.integers(0, 200, 30), rng.integers(-5, 9, 30)
        want.update(dict(Counter()))
        for k, v in zip(keys.tolist(), values.tolist()):
            want[k] += v
        sums.add(keys, values)
        if sums.full():
            for k, v in zip(*(x.tolist() for x in sums.give())):
                got[k] += v
    for k, v in zip(*(x.tolist() for x in sums.give())):
        got[k] += v
    assert {k: v for k, v in want.items() if v} == {k: v for k, v in got.items() if v}
    offsets = np.array([0, 3, 3, 4, 9])
    for limit in (1, 4, 100):
        pairs = [(int(a), int(b)) for i, j in divergence._both(offsets, limit) for a, b in zip(i, j)]
        assert sorted(pairs) == [(a, b) for s, e in ((0, 3), (3, 4), (4, 9)) for a in range(s, e) for b in range(a + 1, e)]


def test_chances_are_exact():
    rng = np.random.default_rng(4)
    count, total = rng.integers(0, 10**13, 500), rng.integers(10**13, 10**15, 500)
    got = divergence.chance(count, total, 12345)
    assert got.tolist() == [1 + 10**9 * (int(c) + 2) // (int(t) + 24690) for c, t in zip(count, total)]


def test_audit_of_nothing(sp):
    assert audited(sp, [], 1) == []
    assert audited(sp, [("a b", "en", "x")], 10) == []
    assert audited(sp, [("a b", "en", "x"), ("a", "en", "y")], 10) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
