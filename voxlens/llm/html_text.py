"""Operator 4, HTML extraction: streaming parser events, text-to-tag ratio per
line, Gaussian smoothing and threshold clustering.

The standard library's parser streams its events; block-level tags end a line.
A line carries its text, its number of tags and where it stands: in a container
that holds no article text (menus, headers, footers, asides, forms, scripts,
adverts, notices, comments: by element, or by words of class, id and role), and
in which article container, if any. The ratio of text to tags per line, nought
for barred lines, is smoothed with a Gaussian; lines above the threshold (the
standard deviation, at most the mean) form clusters.

Element names and words are evidence: the ratio of a line counts more in an article,
in main and in a container named as content. The clusters then decide. They vote
with their smoothed ratios for where the text lies: in what the page marks
(``article`` and the rest of ``main``), in named containers, or in neither. Of marked
text all containers are regions, of named text those with a cluster. Text in neither has
the region from the first to the last clustered line, with headings directly before and
paragraphs anywhere. No unbarred line inside a region is dropped.

Words that only tell a state (has-sidebar, comments-closed) bar nothing, nor do words
inside an article that are part of a name of their own (notice-period), and a
container that is barred by a word though it holds most of the page's text is
lifted, if no article or main lies outside.

Scale: one pass over the pages where they lie, no shuffle; a task holds one
Arrow batch. Defined cases: NULL or empty html gives the empty text; a page cut
off inside a tag loses that tag only; unclosed elements end with their
container; repeated pages are extracted row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.0
#: How much a line's ratio counts in neither, in an article, in main, in a container named as content.
EVIDENCE = (1.0, 8.0, 4.0, 2.0)

# fixed values: element names of HTML by their role here
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe li main menu nav noscript ol option p "
    "pre script section select style summary table tbody td template textarea tfoot th thead title tr ul".split())
BARRED = frozenset(
    "aside audio button canvas dialog footer form head iframe input label menu nav noscript object option script "
    "select style svg template textarea title video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that may stay unclosed; the next block ends them.
LEAVES = frozenset("p li dd dt td th".split())
#: Elements whose nesting is followed; all others are inline or may stay unclosed.
NESTING = (BLOCK | BARRED) - VOID - HEADINGS - LEAVES - {"tr", "option"}

# words of class, id and role that name containers without article text
_BARRED_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w+|adsense|banner\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|"
    r"alerts?|popup|modal|overlay|newsletter|subscri\w+|sign-?up|side-?bar|menu\w*|nav\w*|breadcrumbs?|header|"
    r"masthead|footer|comments?|commentlist|respon(?:d|ses?)|repl(?:y|ies)|disqus|discussion|related|recommend\w*|"
    r"shar(?:e|ing)|social|widgets?|toolbar|paginat\w+|pager|hidden|sr-only|visually-hidden|copyright|disclaimer|"
    r"login|search|complementary|contentinfo|dialog)(?=$|[\s_-])", re.I)
# those of them that tell an article element apart from the page's own article
_ASIDE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w+|sponsor\w*|promo\w*|comments?|commentlist|repl(?:y|ies)|related|"
    r"recommend\w*|widgets?|teaser)(?=$|[\s_-])", re.I)
# words that say of a container what it has or lacks, or in which state a part of it is
_STATE_WORDS = re.compile(
    r"(?:(?<!\S)|(?<=[_-]))(?:has|no|with|without)[_-]\S*|(?<!\S)\S+[_-](?:open|opened|closed|collapsed|expanded|"
    r"enabled|disabled)(?!\S)", re.I)
# parts of names that say how a container is laid out, not what it holds
_LAYOUT = re.compile(
    r"\d*|box|block|wrap|wrapper|container|area|section|inner|outer|bar|slot|unit|list|item|items|row|col|column|"
    r"left|right|top|bottom|center|form|link|links|button|buttons|text|body|title|label|panel|group|card|site|page|post|"
    r"user|main|global|inline|small|large", re.I)
_CONTENT_WORDS = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|articlebody)(?=$|[\s_-])", re.I)
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def barring_word(names: str, inside: bool, words: re.Pattern = _BARRED_WORDS) -> str | None:
    """The word of class, id and role that bars a container. Inside an article a name
    bars only if all its parts do, or tell the layout."""
    for name in _STATE_WORDS.sub(" ", names).split():
        found = words.search(name)
        if found and (not inside or all(words.fullmatch(part) or _LAYOUT.fullmatch(part)
                                        for part in re.split(r"[_-]+", words.sub("-", name)))):
            return found.group().strip(" _-").lower()
    return None


class Lines(HTMLParser):
    """Lines of one page: (text, tags, barred, container, heading, paragraph), and the tree
    of its containers as lists by number, parents first (0: the page)."""

    def __init__(self, lifted: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.lifted = lifted  # containers that are not barred by their words
        self.rows: list[tuple[str, int, bool, int, bool, bool]] = []
        self.parent: list[int] = [-1]
        self.bar: list[bool | str] = [False]
        self.by_element: list[bool] = [False]  # in an element that is barred whatever its words
        self.by_word: list[bool] = [False]
        self.kind: list[int] = [0]  # place in EVIDENCE
        self.size: list[int] = [0]  # characters of text outside its inner containers
        self.open: list[tuple[str, int]] = [("", 0)]
        self.opened: dict[str, int] = {}
        self.parts: list[str] = []
        self.tags = 0
        self.heading = None
        self.paragraph = False
        self.leaf_barred = False  # inside a paragraph or item that is barred by its own class

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            at = self.open[-1][1]
            barred = self.bar[at] or self.leaf_barred
            if barred == "header" and self.heading:
                barred = False  # an article's own heading
            self.rows.append((text, self.tags, bool(barred), at, self.heading is not None, self.paragraph))
        self.parts, self.tags = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.end_line()
            self.leaf_barred = self.leaf_barred and tag == "br"
            self.paragraph = tag == "p" or self.paragraph and tag == "br"
        self.tags += 1
        if tag in HEADINGS:
            self.heading = tag
        of = {k: v or "" for k, v in attrs}
        inside = self.kind[self.open[-1][1]]
        if tag in LEAVES and attrs:
            names = f"{of.get('class', '')} {of.get('id', '')}"
            self.leaf_barred = "hidden" in of or barring_word(names, inside > 0) is not None
        if tag in NESTING:
            self.enter(tag, of)

    def enter(self, tag: str, of: dict[str, str]) -> None:
        above, number = self.open[-1][1], len(self.parent)
        barred, by_element, kind, by_word = self.bar[above], self.by_element[above], self.kind[above], False
        names = f"{of.get('class', '')} {of.get('id', '')} {of.get('role', '')} {of.get('itemprop', '')}"
        own = 1 if tag == "article" else 2 if tag == "main" or of.get("role") == "main" else \
            3 if tag in ("div", "section", "td") and _CONTENT_WORDS.search(names) else 0
        words = _ASIDE_WORDS if tag == "article" else _BARRED_WORDS
        if tag in BARRED or "hidden" in of or of.get("aria-hidden") == "true" \
                or _HIDDEN_STYLE.search(of.get("style", "")):
            barred = by_element = True
        elif tag not in ("html", "body", "main") and (word := barring_word(names, kind in (1, 2), words)):
            if number not in self.lifted:
                barred = barred or ("header" if word == "header" and kind else own != 2)
                by_word = barred is True
        elif tag == "header":
            barred = barred or ("header" if kind else True)
            by_element = by_element or barred is True
        if own and not barred and (not kind or own < kind):
            kind = own
        for values, value in ((self.parent, above), (self.bar, barred), (self.by_element, by_element),
                              (self.by_word, by_word), (self.kind, kind), (self.size, 0)):
            values.append(value)
        self.open.append((tag, number))
        self.opened[tag] = self.opened.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # <div/> opens an element in HTML

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
            self.leaf_barred = self.paragraph = False
        if tag in HEADINGS:
            self.heading = None
        while self.opened.get(tag):  # what is still open inside ends with it
            last = self.open.pop()[0]
            self.opened[last] -= 1
            if last == tag:
                break

    def handle_data(self, data: str) -> None:
        at = self.open[-1][1]
        if self.bar[at] is not True:
            self.parts.append(data)
        self.size[at] += len(data.strip())

    def to_lift(self) -> list[int]:
        """Containers barred by a word that hold most of the text outside barred elements."""
        held = [0 if silent else n for silent, n in zip(self.by_element, self.size)]
        for number in range(len(held) - 1, 0, -1):
            held[self.parent[number]] += held[number]
        return [c for c, worded in enumerate(self.by_word) if worded and not self.by_element[c] and 2 * held[c] > held[0]]


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Convolution with a Gaussian cut at three deviations, normalised at the edges."""
    reach = max(1, int(round(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    middle = slice(reach, reach + len(ratio))
    return np.convolve(ratio, kernel)[middle] / np.convolve(np.ones(len(ratio)), kernel)[middle]


def content(page: Lines, sigma: float = SIGMA) -> list[bool]:
    """For each line whether it lies in a content region."""
    rows = page.rows
    keep = [bool(text) and not barred for text, _, barred, *_ in rows]
    if not any(keep):
        return keep
    kinds = [page.kind[row[3]] for row in rows]
    ratio = np.array([EVIDENCE[kind] * len(row[0]) / max(1, row[1]) if ok else 0.0
                      for row, kind, ok in zip(rows, kinds, keep)])
    smooth = smoothed(ratio, sigma)
    threshold = min(smooth.std(), smooth.mean())
    clustered = [ok and s >= threshold for ok, s in zip(keep, smooth)]
    if not any(clustered):
        clustered = keep
    votes: dict[str, float] = {}
    groups = [("neither", "marked", "marked", "named")[kind] for kind in kinds]
    for group, s, c in zip(groups, smooth, clustered):
        if c:
            votes[group] = votes.get(group, 0.0) + float(s)
    chosen = max(votes, key=votes.get)
    if chosen == "marked":
        return [ok and group == chosen for ok, group in zip(keep, groups)]
    keep = [ok and group == chosen for ok, group in zip(keep, groups)]
    if chosen == "named":
        region = list(range(len(page.parent)))  # the outermost named container around each container
        for c, above in enumerate(page.parent):
            if c and page.kind[above] == 3:
                region[c] = region[above]
        found = {region[row[3]] for row, ok, c in zip(rows, keep, clustered) if ok and c}
        return [ok and region[row[3]] in found for ok, row in zip(keep, rows)]
    at = [i for i, ok in enumerate(keep) if ok and clustered[i]]
    first, last = at[0], at[-1]
    while first and keep[first - 1] and rows[first - 1][4]:
        first -= 1
    return [ok and (first <= i <= last or rows[i][5]) for i, ok in enumerate(keep)]


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The article of one page."""
    if not html:
        return ""
    cut = html.rfind("<")
    if cut > html.rfind(">") and re.match(r"[a-zA-Z/!?]|$", html[cut + 1:cut + 2]):
        html = html[:cut]  # cut off inside a tag
    lifted: frozenset[int] = frozenset()
    while True:
        page = Lines(lifted)
        page.feed(html)
        page.close()
        page.end_line()
        more = page.to_lift()
        if not more or any(row[0] and not row[2] and page.kind[row[3]] in (1, 2) for row in page.rows):
            break
        lifted |= frozenset(more)
    return " ".join(row[0] for row, ok in zip(page.rows, content(page, sigma)) if ok)


def text_udf():
    """Scalar pandas UDF html -> main text."""

    @F.pandas_udf("string")
    def extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    return extract


def with_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """All columns of ``pages`` and the main text of ``html`` as ``name``."""
    return pages.select("*", text_udf()(F.col(html)).alias(name))


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    out = with_text(pages.select("page_id", "url", "html"), name="text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
