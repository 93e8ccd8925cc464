"""Operators 3, 4, 8 and the word helpers against plain Python and the library."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.helpers import CASES, cases, documents, words
from voxlens.llm import bpe_count, decontaminate, html_text, textops as X
from voxlens.llm.common import ready


@pytest.fixture(scope="module")
def sp(spark):
    return ready(spark)


def test_word_hashes_do_not_depend_on_place():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é😀\n.,") for _ in range(rng.randrange(80))) for _ in range(300)]
    seen: dict[str, int] = {}
    for t in texts:
        cp = X.code_points(t)
        starts, ends = X.runs(X.spaced_mask(cp))
        assert [t[a:b] for a, b in zip(starts, ends)] == re.findall(r"[^\x20\x09-\x0D]+", t)
        for a, b, h in zip(starts, ends, X.word_hashes(cp, starts, ends).tolist()):
            assert seen.setdefault(t[a:b], h) == h
    assert len(set(seen.values())) == len(seen)


def test_alnum_words():
    t = "Ab-c9 É_x\x7fY`z{0}"
    cp = X.lower_ascii(X.code_points(t))
    low = t.translate({k: k + 32 for k in range(65, 91)})
    assert [low[a:b] for a, b in zip(*X.runs(X.alnum_mask(cp)))] == \
        re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_windows_know_order():
    a = np.array([1, 2, 3, 2, 1], np.uint64)
    h = X.window_hashes(a, 3)
    assert len(set(h.tolist())) == 3 and not len(X.window_hashes(a[:2], 3))


ODD = ["  a b", "a  b", "a\n\nb \n c", "tail ", "tail\n", "\n", "   ", "x<|endoftext|> y", "<|endoftext|>" * 2,
       "don't we'll they're 'S", " a b", "a\x1cb c\x1d", "12345 1 2²", "a\tb", "\x85x", "aaaa" * 50]


def test_token_counts_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe_count.Merges(path, remembered=50)  # the memory overflows here
    rng = random.Random(4)
    texts = ODD + [t for _, t in CASES if t] + [
        "".join(rng.choice(" \n\tab'sé1.,😀 \x1c") for _ in range(rng.randrange(40))) for _ in range(500)]
    assert [own.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.count(None) == own.count("") == 0


def test_token_report(sp):
    out = bpe_count.report(cases(sp)).collect()
    assert len(out) == len(CASES)
    by = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in out)
    assert by[0] == (0, 0, False) and by[-1][2] and all(r.over_limit == (r.n_tokens > 512) for r in out)
    assert bpe_count.report(documents(sp, [])).count() == 0


PAGE = """<!DOCTYPE html><html class="has-sidebar"><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1><nav><a href=x>Home</a></nav></header><div class="cookie-notice">We use cookies, a lot of them.</div>
%s<aside>A side bar with text that is long enough to look like content, honest.</aside>
<form><label>Name</label><input></form><script>var t="</p>";</script><footer>&copy; foot</footer></body></html>"""
BODY = """<h2>Head</h2><p>First <b>par</b>agraph &amp; more &eacute;<br>line, with enough text to be one.</p><p>Short.
<div class="ad-box">Buy now, buy more, an advert that goes on and on.</div><p class="advert">Buy.</p>
<p>Second long paragraph,   with white   space.</p><div class="comments"><p>A reader says a lot of things.</p></div>"""
WANT = ("Head First paragraph & more é line, with enough text to be one. Short. "
        "Second long paragraph, with white space.")


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div id="content">%s</div>', "<div>%s</div>",
                                  '<main><article class="post">%s</article></main>'])
def test_main_text(wrap):
    assert html_text.main_text(PAGE % (wrap % BODY)) == WANT


@pytest.mark.parametrize("wrap", [
    '<div class="layout has-sidebar">%s</div>', '<div class="content no-sidebar">%s</div>',
    '<article class="post comments-closed">%s</article>', '<div class="page-with-sidebar"><article>%s</article></div>',
    '<div class="social"><article>%s</article></div>', '<div id="widget-area">%s</div>'])
def test_main_text_in_a_wrapper_of_barred_words(wrap):
    assert html_text.main_text(PAGE % (wrap % BODY)) == WANT


def test_main_text_takes_all_parts_of_the_article():
    long = "This is a long paragraph that makes a cluster of its own here. " * 5
    assert html_text.main_text(f"<main><p>Own.</p><article><p>{long}</p></article><article><p>b</p></article></main>") \
        == f"Own. {long}b"
    assert html_text.main_text(f"<p>Short one.</p><div>x</div><div>y</div><p>{long}</p><div>x</div><div>y</div><p>End.</p>"
                               ).startswith("Short one. ")
    held = f'<div class="comments"><p>{long}</p></div><article><p>Short article.</p></article>'
    assert html_text.main_text(held) == "Short article."
    assert html_text.main_text(f'<div class="sidebar-right"><p>side</p></div><p>{long}</p>') == long.strip()


LONG = "This is a long paragraph that makes a cluster of its own here. " * 5


def test_main_text_names_inside_the_article_are_its_own():
    page = f'<article><p>{LONG}</p><p class="notice-period">One month.</p><section id="navigation-history"><p>Sails.</p>' \
        '</section><p class="advert">Buy.</p><div class="cookie-notice">Crumbs.</div></article>'
    assert html_text.main_text(page) == f"{LONG}One month. Sails."
    assert html_text.main_text(page.replace("article>", "main>")) == f"{LONG}One month. Sails."


def test_main_text_clusters_outvote_names():
    # an element's name is evidence: a stub of an article doesn't hide the text of the page
    assert html_text.main_text(f"<article>Stub.</article><section>{LONG}</section><section>{LONG}</section>") == \
        f"{LONG}{LONG}".strip()
    assert html_text.main_text(f"<article><p>{LONG}</p></article><div>Some other words of the page.</div>") == LONG.strip()
    assert html_text.main_text(f'<div class="content">Stub.</div><div>{LONG}</div><div>{LONG}</div>') == \
        f"{LONG}{LONG}".strip()


def test_main_text_needs_its_smoothing():
    odds = "<div>x</div>" * 6  # short lines far from any cluster, in no named element
    page = f"{odds}<div>By one who was there.</div><div>{LONG}</div><div>So it was.</div><div>{LONG}</div><div>The end.</div>{odds}"
    want = f"By one who was there. {LONG}So it was. {LONG}The end."
    assert html_text.main_text(page) == want
    assert html_text.main_text(page, sigma=1e-3) != want
    ratio = np.array([0, 0, 9.0, 0, 0])
    assert html_text.smoothed(ratio, 1e-3).tolist() == ratio.tolist()
    smooth = html_text.smoothed(ratio, 1.0)
    assert smooth[2] > smooth[1] > smooth[0] > 0 and smooth[2] < 9


def brute_smoothed(ratio, sigma):
    reach = max(1, round(3 * sigma))
    out = []
    for i in range(len(ratio)):
        near = [j for j in range(len(ratio)) if abs(i - j) <= reach]
        weight = [np.exp(-(i - j) ** 2 / (2 * sigma ** 2)) for j in near]
        out.append(sum(w * ratio[j] for w, j in zip(weight, near)) / sum(weight))
    return out


def test_main_text_of_unmarked_pages_against_a_plain_reference():
    # pages without article, main or named containers: menus and footers by element, the article in plain divs
    rng = random.Random(9)
    for _ in range(60):
        junk = [words(rng.random(), rng.randrange(1, 3)) for _ in range(rng.randrange(2, 6))]
        body = [words(rng.random(), rng.randrange(30, 60)) for _ in range(rng.randrange(2, 9))]
        head = words(rng.random(), 3)
        tag = rng.choice(["div", "section", "blockquote", "p"])
        page = "<body><nav>" + "".join(f"<li><a href=x>{j}</a></li>" for j in junk) + f"</nav><div><h1>{head}</h1>" \
            + "".join(f"<{tag}>{b}</{tag}>" for b in body) + "</div><footer>" + " ".join(junk) + "</footer></body>"
        assert html_text.main_text(page) == " ".join([head, *body])
    for _ in range(30):
        ratio = [rng.choice([0, 1, 5.5, 40]) for _ in range(rng.randrange(1, 30))]
        sigma = rng.choice([0.4, 1.0, 2.5])
        assert np.allclose(html_text.smoothed(np.array(ratio, float), sigma), brute_smoothed(ratio, sigma))


def test_main_text_of_long_and_deep_pages():
    long = "".join(f"<p>{LONG}</p>" for _ in range(5000))
    assert html_text.main_text(f"<article>{long}</article>") == (LONG * 5000).strip()
    deep = "<div>a " * 5000
    assert html_text.main_text(deep + "</div>" * 5000) == ("a " * 5000).strip()
    assert html_text.main_text(f"<article>{deep}</section></article>b") == ("a " * 5000).strip()


def test_main_text_cases(sp):
    assert [html_text.main_text(h) for h in (None, "", "plain", "<p>a", "<article><p>x &am", "<article>x</art", "<nav>x</nav>")] \
        == ["", "", "plain", "a", "x &am", "x", ""]
    df = sp.createDataFrame([(1, "u", PAGE % f"<article>{BODY}</article>", 1), (1, "u", None, 1), (None, None, "", 2)],
                            "page_id long, url string, html string, text int")
    out = html_text.report(df).collect()
    assert sorted((r.text, r.n_chars) for r in out) == [("", 0), ("", 0), (WANT, len(WANT))]
    assert html_text.report(df.limit(0)).count() == 0
    clash = df.withColumnRenamed("text", "n_chars").withColumn("value", df.html)
    assert sorted(r.text for r in html_text.with_text(clash).collect()) == ["", "", WANT]


def brute_hits(text, items, size=10):
    def norm(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))

    doc, hit, ids = norm(text), set(), set()
    for item_id, t in items:
        w = norm(t)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            for j in range(len(doc) - k + 1):
                if doc[j:j + k] == w[i:i + k]:
                    hit.update(range(j, j + k))
                    ids.add(item_id)
    ids.discard(None)
    return len(doc), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 400])
def test_decontamination_against_brute_force(sp, block_chars):
    items = [(i, words(1000 + i, 25)) for i in range(12)] + [(50, "Zz-Yy xx"), (51, None), (52, "!!"), (None, words(77, 30)),
                                                             (3, words(78, 12))]
    passage = words(1003, 25).split()
    rows = [(i, t) for i, t in CASES if t != CASES[11][1]] + [
        (100, words(1, 30) + " " + " ".join(passage[2:20]).upper() + " " + words(2, 9)),
        (101, " ".join(passage[:9])), (102, "xx zz, YY? Xx"), (103, words(77, 30) + "\n" + words(1005, 25)),
        (104, " ".join(passage) + " " + " ".join(passage[5:]))]
    bench = sp.createDataFrame(items, "item_id long, text string")
    docs = documents(sp, rows, extra=True)
    got = sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.report(
        docs, bench, block_chars=block_chars).collect())
    assert got == sorted(brute_hits(t, items) for _, t in rows)
    left = decontaminate.remove_documents(docs, bench, block_chars=block_chars)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()}.isdisjoint({100, 102, 103, 104})
    cut = decontaminate.remove_spans(docs, bench, block_chars=block_chars)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert decontaminate.report(cut, bench).where("contaminated").where("doc_id <> 103").count() == 0
    assert decontaminate.report(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(docs.limit(0), bench).count() == 0


def test_decontamination_blocks_run_one_after_the_other(sp, monkeypatch):
    held, most = set(), []

    class Block:
        def __init__(self, inner):
            self.inner = inner
            held.add(id(self))
            most.append(len(held))

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def __reduce__(self):
            return self.inner.__reduce__()

        def destroy(self):
            held.discard(id(self))
            self.inner.destroy()

    found = decontaminate.blocks

    def watched(*args):
        n, parts = found(*args)
        return n, (Block(p) for p in parts)

    monkeypatch.setattr(decontaminate, "blocks", watched)
    bench = sp.createDataFrame([(i, words(500 + i, 40)) for i in range(20)], "item_id long, text string")
    docs = documents(sp, [(i, words(500 + i, 40)) for i in range(10)] + [(99, words(1, 40))])
    out = decontaminate.report(docs, bench, block_chars=300)
    assert {r.doc_id for r in out.where("contaminated").collect()} == set(range(10))
    assert len(most) > 3 and max(most) == 1 and not held
