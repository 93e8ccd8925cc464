"""Operator 3, token counts: byte-pair merging over a heap and a linked list.

The symbols of a piece form a doubly linked list; a heap holds its adjacent
pairs by merge rank and place. The lowest pair is popped, checked for being
current, merged, and its new neighbours are pushed. A piece's token count is
its initial symbols minus its merges; no identifiers are made.

Pieces come from the vocabulary file's own splitting: runs of letters, of
numbers or of other characters, each with at most one space before it, English
contractions, and white space. A text is cut at single spaces first, since no
piece crosses from one such part into the next; a worker remembers the counts
of parts that it has met, up to ``REMEMBERED`` of them. Special strings inside a
text count as one token each, as the library's default has it.

Scale: one pass, no shuffle; a task holds one Arrow batch, the merge ranks and
the bounded memory of counts. Defined cases: NULL and empty texts have 0 bytes
and 0 tokens; repeated documents are counted row by row.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of text whose counts one worker remembers.
REMEMBERED = 800_000
#: Tokens beyond which a document is over the limit.
LIMIT = 512

# fixed values: white space of the splitting pattern, and the pattern itself
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
          rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class Merges:
    """Merge ranks of a byte-level vocabulary file, and the counts met so far."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.rank = {pair: (k, pair[0] + pair[1]) for k, pair in enumerate(pairs)}
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in sorted(
            spec.get("added_tokens", ()), key=lambda t: -len(t["content"]))) or r"(?!)")
        self.pieces = regex.compile(PIECES)
        self.ends_open = regex.compile(rf"(?:^|[{SPACE}])$")
        self.symbol = byte_symbols()
        self.remembered = remembered
        self.parts: dict[str, int] = {}
        self.known: dict[str, int] = {}

    def merge_count(self, piece: str) -> int:
        """Initial symbols minus merges of one piece."""
        symbols: list[str | None] = [self.symbol[b] for b in piece.encode("utf-8")]
        n = len(symbols)
        if n < 2:
            return n
        rank, left, right = self.rank, list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if found := rank.get((symbols[i], symbols[i + 1])):
                heap.append((found[0], i, found[1], i + 1))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, merged, j = heapq.heappop(heap)
            # stale if either end has gone or has become another symbol since it was pushed
            if symbols[i] is None or right[i] != j or symbols[j] is None or symbols[i] + symbols[j] != merged:
                continue
            symbols[i], symbols[j] = merged, None
            merges += 1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if found := rank.get((merged, symbols[k])):
                    heapq.heappush(heap, (found[0], i, found[1], k))
            if (h := left[i]) >= 0 and (found := rank.get((symbols[h], merged))):
                heapq.heappush(heap, (found[0], h, found[1], i))
        return n - merges

    def _piece(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = self.merge_count(piece)
            if len(piece) <= 64:
                if len(self.known) >= self.remembered:
                    self.known.clear()
                self.known[piece] = n
        return n

    def _part(self, part: str) -> int:
        return sum(map(self._piece, self.pieces.findall(part)))

    def _learn(self, parts: list[str]) -> None:
        """Remember the counts of new parts; -1 for one whose white space runs on
        into what follows, so that it can't be counted by itself."""
        known = self.parts
        if len(known) > self.remembered:
            known.clear()
        for part in set(parts):
            if part not in known:
                known[part] = -1 if self.ends_open.search(part) else self._part(" " + part)

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        first, *rest = text.split(" ")
        if not rest or self.ends_open.search(first):
            return self._part(text)
        try:
            counts = list(map(self.parts.__getitem__, rest))
        except KeyError:
            self._learn(rest)
            counts = list(map(self.parts.__getitem__, rest))
        return self._part(text) if -1 in counts else self._part(first) + sum(counts)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special.search(text):
            cut = self.special.split(text)
            return len(cut) - 1 + sum(self._plain(t) for t in cut if t)
        return self._plain(text)


_LOADED: dict[str, Merges] = {}


def loaded(path: str) -> Merges:
    """One per worker process and file, so that counts are remembered across tasks."""
    if path not in _LOADED:
        _LOADED[path] = Merges(path)
    return _LOADED[path]


def count_udf(vocabulary: str):
    """Scalar pandas UDF text -> tokens. ``vocabulary`` names a file of the public tokenizers."""

    @F.pandas_udf(T.LongType())
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers

        merges = loaded(public_tokenizers.path(vocabulary))
        for batch in texts:
            yield pd.Series([merges.count(t) for t in batch], dtype="int64")

    return tokens


def with_counts(docs: DataFrame, text: str = "text", name: str = "n_tokens",
                vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """All columns of ``docs`` and the token count of ``text``."""
    return docs.select("*", count_udf(vocabulary)(F.col(text)).alias(name))


def report(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    counted = with_counts(docs.select("doc_id", "text"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
