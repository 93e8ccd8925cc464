"""Operators 1, 2, 9, 10 and the pipeline: brute force and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import MEDIUM, SMALL
from llm.helpers import CASES, cases, documents, words
from voxlens.llm import catalog, graph, language_id, near_dup, perplexity, quality_net
from voxlens.llm.common import materialize, n_rows, ready, table
from voxlens.llm.graph import components


@pytest.fixture(scope="module")
def sp(spark):
    return ready(spark)


# ------------------------------------------------------------------ language identification
def test_language_held_out_accuracy(sp):
    out = catalog.queries()["op1_language_id"](sp, MEDIUM)
    truth = table(sp, MEDIUM, "documents").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    for held in (True, False):
        own = [r for r in rows if r.held_out == held and r.lang is not None]
        assert own and sum(r.lang == r.lang_pred for r in own) / len(own) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_cases(sp):
    docs = cases(sp).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").when(F.col("doc_id") == 7, "yy"))
    out = language_id.report(docs).collect()
    assert len(out) == len(CASES)
    by = {r.doc_id: r for r in out}
    for i in (1, 2, 3, 14):
        assert by[i].lang_pred == "und" and by[i].score == 0.0
    assert by[10].lang_pred in ("xx", "yy") and not by[1].held_out is None
    assert {r.lang_pred for r in language_id.report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.report(docs.limit(0)).count() == 0


def test_number_signs_are_no_letters(sp):
    known = [(i, w, lang) for i in range(40) for w, lang in ((words(i, 30), "aa"), (words(i, 30).upper(), "bb"))]
    docs = documents(sp, known + [(900 + i, t) for i, t in enumerate(["²", "½ ①", "Ⅷ 12", "x²", "ª", "é"])])
    got = {r.doc_id: r.lang_pred for r in language_id.report(docs).where("doc_id >= 900").collect()}
    assert [got[900 + i] == "und" for i in range(6)] == [True, True, True, False, False, False]


def test_equal_language_scores_go_to_the_first():
    rows = np.zeros((2, language_id.PLACES), np.uint8)
    language_id.presence("the same text", rows[:1])
    rows[1] = rows[0]
    assert language_id.fit(["b", "a"], rows).scores(["the same text"])[0] == ["a"]


def test_language_windows_cover_the_whole_text():
    a, b = "ab ab " * 400, "xy xy " * 400
    rows = np.zeros((2 * language_id.n_windows(a), language_id.PLACES), np.uint8)
    n = language_id.presence(a, rows)
    language_id.presence(b, rows[n:])
    model = language_id.fit(["a"] * n + ["b"] * n, rows[:2 * n])
    langs, scores = model.scores([a, b, a + b * 3, a * 3 + b, (a + b * 2) * 70])
    assert langs == ["a", "b", "b", "a", "b"] and all(0.5 <= s <= 1 for s in scores)


# ------------------------------------------------------------------ quality rules
def brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for k in range(len(w) - 4):
        at[tuple(w[k:k + 5])].append(k)
    hit = {p for ks in at.values() if len(ks) > 1 for k in ks for p in range(k, k + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_base_counts_against_brute_force():
    rng = random.Random(8)
    texts = [t for _, t in CASES] + ["".join(rng.choice("ab \n#\t\x0b|") for _ in range(rng.randrange(200))) for _ in range(400)]
    for t in texts:
        assert perplexity.base_counts(t) == brute_base(t)


def brute_kneser_ney(texts, order):
    """Per order: probability and raw count of each n-gram, and the mass that each context leaves, by the definition."""
    raw, c = {order: Counter()}, {}
    for t in texts:
        padded = "\0" * (order - 1) + t
        for i in range(len(t)):
            raw[order][padded[i:i + order]] += 1
    c[order] = raw[order]
    for k in range(order - 1, 0, -1):
        c[k], raw[k] = Counter(g[1:] for g in c[k + 1]), Counter()
        for g, v in raw[k + 1].items():
            raw[k][g[1:]] += v
    probability, left = {}, {}
    for k in range(1, order + 1):
        n = [max(1, sum(v == j for v in c[k].values())) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.05), j - 0.05) for j in (1, 2, 3)]
        total, held = Counter(), Counter()
        for g, v in c[k].items():
            total[g[:-1]] += v
            held[g[:-1]] += d[min(v, 3) - 1]
        left[k] = {h: held[h] / total[h] for h in total}
        probability[k] = {g: (v - d[min(v, 3) - 1]) / total[g[:-1]] + left[k][g[:-1]] * (
            1 / 4096 if k == 1 else probability[k - 1][g[1:]]) for g, v in c[k].items()}
    return probability, raw, left


def brute_bits(text, model, order):
    probability, raw, left = model
    padded = "\0" * (order - 1) + text
    own = {k: Counter(padded[i + order - k:i + order] for i in range(len(text))) for k in range(1, order + 1)}
    total = 0.0
    for i in range(len(text)):
        passed = 0.0
        for k in range(order, 0, -1):
            g = padded[i + order - k:i + order]
            if raw[k].get(g, 0) > own[k][g]:
                total += passed + math.log2(probability[k][g])
                break
            passed += math.log2(left[k].get(g[:-1], 1.0))
        else:
            total += passed - 12
    return -total / len(text)


@pytest.mark.parametrize("max_entries", [perplexity.MAX_ENTRIES, 10])
def test_entropy_against_brute_force(sp, max_entries):
    rows = [(i, words(i, 3 + i % 20)) for i in range(60)] + [(200 + i, words(3, 6)) for i in range(30)] + [
        (100, "éü 日本" * 3), (101, None), (102, "")]
    model = brute_kneser_ney(sorted({t for _, t in rows if t}), perplexity.ORDER)  # each text once
    out = perplexity.with_stats(documents(sp, rows), max_entries=max_entries).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.stats.bits is None) == (not r.text)
        if r.text:
            assert r.stats.bits == pytest.approx(brute_bits(r.text, model, perplexity.ORDER), abs=1e-6)


def test_bands_reject_on_both_sides(sp):
    rng = random.Random(5)
    rows = [(i, words(i, 150), "en") for i in range(300)] + [(i, words(300, 150), "en") for i in range(300, 450)]
    odd = "".join(chr(rng.randrange(300, 3000)) + " " * (k % 5 == 4) for k in range(900))
    same = "tete tete etet " * 30 + " ".join("te" * k for k in range(1, 30))
    rows += [(1000, odd, "en"), (1001, same, "en"), (1002, None, "en"), (1003, words(1, 9), None), (1004, words(7, 90), None)]
    out = {r.doc_id: r for r in perplexity.report(documents(sp, rows, extra=True)).collect()}
    assert len(out) == len(rows)
    assert all(out[i].kept for i in range(450))
    assert not out[1000].kept and not out[1000].base_failed and out[1000].bits_per_char > out[1000].upper
    assert not out[1001].kept and out[1001].bits_per_char < out[1001].lower
    assert out[1002].base_failed and not out[1002].kept and out[1003].base_failed and out[1004].kept


def test_near_copies_neither_teach_the_model_nor_widen_a_band(sp):
    body = words(7000, 150).split()
    rows = [(i, words(i, 150)) for i in range(200)] + [
        (300 + i, " ".join(body[:i] + [words(8000 + i, 1)] + body[i + 1:])) for i in range(100)] + [
        (500 + i, words(500 + i, 900)) for i in range(20)]
    out = {r.doc_id: r for r in perplexity.report(documents(sp, rows)).collect()}
    assert all(r.kept for r in out.values())
    alone = np.median([out[i].bits_per_char for i in range(200)])
    assert abs(np.median([out[i].bits_per_char for i in range(300, 400)]) - alone) < 0.15
    assert all(out[i].upper - out[i].lower < 0.5 for i in range(500, 520))


def test_quality_rule_cases(sp):
    docs = cases(sp)
    out = perplexity.report(docs).collect()
    assert Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == Counter(
        brute_base(t) for _, t in CASES)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in out)
    assert not any(r.kept and r.base_failed for r in out)
    kept = perplexity.filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in out)
    assert perplexity.report(docs.limit(0)).count() == 0
    assert perplexity.report(documents(sp, [(1, None), (2, "")])).where("kept").count() == 0


# ------------------------------------------------------------------ quality classifier
def test_quality_held_out(sp):
    labels = table(sp, MEDIUM, "labels")
    rows = catalog.queries()["op9_quality_classifier"](sp, MEDIUM).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    pos = np.array([r.score for r in held if r.quality == 1])
    neg = np.array([r.score for r in held if r.quality == 0])
    assert (pos[:, None] > neg[None, :]).mean() > 0.97
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    mean = np.mean([r.score for r in held])
    assert abs(mean - np.mean([r.quality for r in held])) < 0.06  # calibrated


def test_quality_cases(sp):
    docs = cases(sp)
    labels = sp.createDataFrame([(i, q, None) for i, q in ((4, 0), (5, 1), (7, 1), (8, 0), (None, 1), (10, None), (5, 1))],
                                "doc_id long, quality int, toxic int")
    out = quality_net.report(docs, labels).collect()
    assert len(out) == len(CASES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert {r.score for r in quality_net.report(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality_net.report(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert quality_net.report(docs.limit(0), labels).count() == 0
    assert quality_net.filter_documents(docs, labels).columns == docs.columns


def test_a_repeated_id_teaches_the_same_in_any_order(sp):
    rows = [(i % 30, words(i, 40) if i % 2 else words(i, 5) * 9) for i in range(90)]
    labels = sp.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    one, two = (quality_net.train(documents(sp, r).repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 5)))
    texts = [t for _, t in rows[:10]]
    assert np.allclose(one.score(texts), two.score(texts), atol=1e-3)


def test_fit_separates_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))).astype(float)
    p = quality_net.fit(x, y).probability(x)
    order = np.argsort(p)
    for part in np.array_split(order, 5):
        assert abs(p[part].mean() - y[part].mean()) < 0.1


# ------------------------------------------------------------------ near-duplicates
def brute_components(rows, size=4):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
        sets.append(frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    smallest: dict[int, int | None] = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return Counter((d, len(s), d if not s else smallest.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def changed(text, seed, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else "x" + w for w in text.split())


def near_rows():
    rows = [(i, words(i, 60)) for i in range(40)]
    base, other = words(500, 100), words(501, 45)
    rows += [(100 + i, changed(base, i, 0.03)) for i in range(60)]  # one large group of near copies
    rows += [(200 + i, changed(other, i, 0.05)) for i in range(20)] + [(300 + i, other) for i in range(10)]
    chain = words(502, 80).split()
    rows += [(400 + i, " ".join(chain[i * 3:i * 3 + 40])) for i in range(12)]  # links in a chain
    rows += [(430 + i, words(9, 30) + " " + words(600 + i, 60)) for i in range(20)]  # a common passage
    rows += [(460 + i, f"the same few words {i % 3}") for i in range(9)] + [(480, "A b"), (481, "a B"), (482, "a")]
    return rows


def test_a_link_is_missed_below_a_millionth():
    def short(n, s, m):
        return sum(math.comb(n, k) * s ** k * (1 - s) ** (n - k) for k in range(m))

    for s in (0.5, 0.6, 0.75, 0.8, 0.9, 0.95):
        own = near_dup.Limits(s)
        missed = short(near_dup.COORDINATES, s, own.matches) + short(near_dup.FINE, s, own.fine)
        assert own.matches > 0 and missed + (1 - s ** own.run) ** (near_dup.COORDINATES // own.run) < near_dup.MISS
    assert (near_dup.Limits(0.8).matches, near_dup.Limits(0.8).run) == (34, 3)
    for s in (0, 0.1, 1.2):
        with pytest.raises(ValueError):
            near_dup.Limits(s)


def test_links_of_a_lower_similarity_are_kept(sp):
    """Pairs alike by about 0.53, found where 0.5 is asked for and left alone at 0.8."""
    rows = []
    for k in range(100):
        own = words(5000 + k, 120).split()
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(own[:83] + words(9000 + k, 37).split()))]
    found = near_dup.near_duplicates(documents(sp, rows), similarity=0.5)
    want = sum(_jaccard(rows[2 * k][1], rows[2 * k + 1][1]) >= 0.5 for k in range(100))
    assert want > 90 and found.where("first").count() == 200 - want
    assert near_dup.near_duplicates(documents(sp, rows)).where("first").count() == 200


def _jaccard(a, b):
    x, y = set(near_dup.shingles(a).tolist()), set(near_dup.shingles(b).tolist())
    return len(x & y) / len(x | y)


def test_near_duplicates_against_brute_force(sp):
    rows = near_rows() + [(i, t) for i, t in CASES if i != 10] + [(None, words(7, 120) + "\nline two\nline two\n")]
    out = near_dup.report(documents(sp, rows, extra=True).repartition(6)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_parities_never_drop_an_alike_pair(sp):
    rng = np.random.default_rng(5)
    limits, rows = near_dup.Limits(0.8), []
    for k in range(300):
        n = int(rng.integers(1, 300))
        base = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
        lost, own = rng.integers(0, max(1, n // 4)), rng.integers(0, max(1, n // 5) + 1)
        other = np.concatenate([base[lost:], rng.integers(0, 2 ** 64, own, dtype=np.uint64)])
        x, y = set(base.tolist()), set(other.tolist())
        rows.append((near_dup.parity(base).tolist(), near_dup.parity(other).tolist(), len(x), len(y), len(x & y) / len(x | y)))
    df = sp.createDataFrame(rows, "p array<long>, q array<long>, p_n long, q_n long, alike double")
    out = df.select("alike", near_dup._parities_allow("p", "q", "p_n", "q_n", limits).alias("may")).collect()
    assert all(r.may for r in out if r.alike >= 0.8) and sum(r.alike >= 0.8 for r in out) > 50
    assert {len(r[0]) - len(r[1]) for r in rows} > {0}  # of unequal numbers of bits, too
    assert sum(not r.may for r in out if r.alike < 0.75) > 0.8 * sum(r.alike < 0.75 for r in out) > 20


def test_a_large_group_of_near_copies_makes_few_pairs(sp, monkeypatch):
    """Copies changed by up to a tenth, most pairs of which are not alike: the pairs tested on full sets stay few."""
    base = words(4000, 150)
    rows = [(i, changed(base, 100 + i, 0.001 * (10 + i % 90))) for i in range(250)]
    tested, confirmed = [], near_dup._confirmed

    def counted(pairs, sets, limits):
        tested.append(pairs.count())
        return confirmed(pairs, sets, limits)

    monkeypatch.setattr(near_dup, "_confirmed", counted)
    out = near_dup.report(documents(sp, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    assert sum(tested) < 2 * len(rows)


def test_links_of_a_large_group_are_not_followed_pair_by_pair(sp, monkeypatch):
    """Copies most of which the star leaves apart though each is alike to many others: pairs tested on full sets and
    links followed grow with the copies, not with their pairs."""
    base, rng = words(4100, 150).split(), random.Random(41)
    rows = []
    for i in range(900):
        own = list(base)
        for k in rng.sample(range(150), rng.randint(2, 6)):
            own[k] = f"own{i}x{k}"
        rows.append((i, " ".join(own)))
    tested, followed, confirmed, components = [], [], near_dup._confirmed, near_dup.components

    def counted(pairs, sets, limits):
        tested.append(pairs.count())
        return confirmed(pairs, sets, limits)

    def counted_edges(edges):
        followed.append(edges.count())
        return components(edges)

    monkeypatch.setattr(near_dup, "_confirmed", counted)
    monkeypatch.setattr(near_dup, "components", counted_edges)
    monkeypatch.setattr(near_dup, "FEW", 64)
    out = near_dup.report(documents(sp, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    assert len({r.component_id for r in out}) < 800
    assert sum(tested) + sum(followed) < 2 * len(rows)


def test_steps_on_few_rows_write_few_files(sp, monkeypatch):
    """Where shuffle partitions stay apart, a step on some hundred rows still doesn't take a task of each."""
    rows = [(i, changed(words(4200 + i // 6, 120), 100 + i, 0.015)) for i in range(300)]
    written, write = [], near_dup.materialize

    def counted(df, name="stage"):
        out = write(df, name)
        written.append((name, len(out.inputFiles())))
        return out

    for module in (near_dup, graph):
        monkeypatch.setattr(module, "materialize", counted)
    own = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: sp.conf.get(k) for k in own}
    docs = documents(sp, rows).repartition(6)
    try:
        for k, v in own.items():
            sp.conf.set(k, v)
        out = near_dup.report(docs).collect()
    finally:
        for k, v in before.items():
            sp.conf.set(k, v)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    narrow = {"nodes", "star", "edges", "links", "labels", "nearest", "pairs", "prefix", "places"}
    assert narrow - {"nearest"} <= {name for name, n in written}
    assert max(n for name, n in written if name in narrow) <= 6


def test_rows_of_written_stages_are_counted_as_they_are_written(sp, monkeypatch):
    """A query of its own for each number of rows and each end of a loop costs the driver memory (threads, plans)."""
    for df in (sp.range(7), sp.range(7).where("id < 0"), sp.range(40).groupBy("id").count().repartition(3)):
        assert n_rows(materialize(df)) == n_rows(df) == df.count()
    rows = [(i, changed(words(4300 + i // 6, 120), 100 + i, 0.015)) for i in range(120)]
    asked, kind = [], type(sp.range(1))
    count = kind.count

    def counted(df):
        asked.append(df)
        return count(df)

    monkeypatch.setattr(kind, "count", counted)
    out = near_dup.report(documents(sp, rows)).collect()
    judged = perplexity.report(documents(sp, rows)).collect()
    assert not asked
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    assert len(judged) == len(rows)


def test_deduplicate_keeps_one_of_each_group(sp):
    rows = [(i + 1000, t) for i, t in near_rows()] + [(i, t) for i, t in CASES if i != 10]  # an id has one text here
    docs = documents(sp, rows, extra=True)
    kept = near_dup.deduplicate(docs)
    assert kept.columns == docs.columns
    want = brute_components(rows)
    groups = {(c,) for (d, n, c) in want if n and c is not None}
    lone = sum(v for (d, n, c), v in want.items() if not n)
    alone_without_id = sum(v for (d, n, c), v in want.items() if n and c is None)
    assert kept.count() == len(groups) + lone + alone_without_id
    assert near_dup.deduplicate(docs.limit(0)).count() == 0


def test_components(sp):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 103), (103, 101), (101, 100), (7, 7)] + [(200, 200 + i) for i in range(50)]
    got = {r.node: r.label for r in components(sp.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, **{200 + i: 200 for i in range(50)}}


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages(sp):
    docs = table(sp, SMALL, "documents")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(sp, docs, SMALL), name)
        assert out.columns == columns and out.exceptAll(docs).count() == 0
        after = out.count()
        assert 0 < after <= before
        docs, before = out, after
    packed = corpus_pipeline.STAGES[-1][1](sp, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == before
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "near_deduplication", "benchmark_decontamination", "best_fit_packing"]


def test_pipeline_stages_against_brute_force(sp):
    docs = corpus_pipeline.materialize(table(sp, SMALL, "documents").unionByName(
        documents(sp, [(900_000 + i, t) for i, t in near_rows()])), "documents")
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return Counter(r.doc_id for r in df.select("doc_id").collect())

    labels = table(sp, SMALL, "labels")
    scored = quality_net.report(docs, labels)
    assert ids(stages["quality_classifier"](sp, docs, SMALL)) == ids(scored.where("score >= 0.5"))
    assert ids(stages["quality_rules"](sp, docs, SMALL)) == ids(perplexity.report(docs).where("kept"))

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = ids(stages["near_deduplication"](sp, docs, SMALL))
    groups = defaultdict(set)
    for doc, _, component in brute_components(rows):
        groups[component].add(doc)
    assert len(groups) < len(rows) and sum(kept.values()) == len(groups)
    assert all(sum(kept[d] for d in own) == 1 for own in groups.values())

    def windows(text, size):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
        return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}, len(w)

    bench = set()
    for r in table(sp, SMALL, "benchmark").collect():
        size = min(10, windows(r.text, 1)[1])
        bench |= windows(r.text, size)[0] if size else set()
    sizes = {len(w) for w in bench}
    clean = Counter(d for d, t in rows if not any(bench & windows(t, k)[0] for k in sizes))
    assert 0 < sum(clean.values()) < len(rows)
    assert ids(stages["benchmark_decontamination"](sp, docs, SMALL)) == clean


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_cases(sp, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = cases(sp)
    assert stage(sp, docs, SMALL).count() >= 0
    assert stage(sp, docs.limit(0), SMALL).count() == 0


def test_only_repeated_texts_are_shuffled_for_the_model(sp):
    """Before, every text travelled to meet the short list of repeated ones."""
    rows = [(k, words(100 + k, 90)) for k in range(200)] + [(1000 + k, words(100 + k, 90)) for k in range(5)] + [
        (1010 + k, words(110 + k, 90) + " more") for k in range(5)] + [(None, words(100, 90)), (3000, ""), (3001, None)]
    docs = documents(sp, rows).repartition(4)
    kept = perplexity.distinct_texts(docs, "text")
    assert len({r.text for r in kept.collect()}) == 200 and kept.count() == 201  # rows without an id stay
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_texts_that_share_a_footer_all_teach_the_model(sp):
    footer = words(1, 60)
    rows = [(k, words(100 + k, 90) + " " + footer) for k in range(300)]
    copies = [(1000 + k, rows[k][1] + " more") for k in range(20)] + [(2000, rows[0][1])]
    kept = perplexity.distinct_texts(documents(sp, rows + copies), "text")
    assert kept.count() == 300
