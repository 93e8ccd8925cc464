"""Token ids of whole texts by the tokenizers library, remembered word by word.

The vocabulary's splitting never lets a token cross white space, and its
normalisation acts within words, so the ids of a text are the ids of its words
in order. The library encodes each word that a worker has not met; met words
come from a bounded memory that outlives the task. Words of printable ASCII and Latin letters, whose
normalisation is lower-casing alone, go straight to the library's merges after
the vocabulary's own splitting, which costs a fifth of a whole call; a piece that was met
as a word is taken from the memory. All others take the whole call. Texts with the four control characters that Python takes for
white space but the vocabulary does not are encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array

from voxlens.llm.bpe_count import byte_symbols

#: Words whose ids a worker remembers (about 200 bytes each), over all its tasks; later ones
#: are encoded again in each batch. The first met are mostly the frequent ones.
REMEMBERED = 300_000
#: The id appended to each document.
END = 1

# fixed values: the splitting of the vocabulary file for which words may go straight to the merges,
# and the same for its lower-cased words of these characters
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIMPLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^0-9a-z\u00df-\u00f6\u00f8-\u017f]+")


class WordIds:
    """Encoder of one vocabulary; ids are unsigned 16-bit integers in bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("this encoder holds ids in 16 bits")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", ())]
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())
        self.model = self.tokenizer.model if steps == ["NFC", "Replace", "Lowercase"] and [
            s["type"] for s in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"].get("Regex") == SPLIT else None
        self.special = tuple(t["content"] for t in spec.get("added_tokens", ()))
        if not all("<" in s for s in self.special):
            self.model = None
        self.symbols = dict(enumerate(byte_symbols()))
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        """By whole calls of the library."""
        return [array("H", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _simple(self, word: str) -> bytes:
        """The ids of a word that only has to be lower-cased and split."""
        known, marks = self.known.get, self.marks.get
        low = word.lower()
        if (head := low[:-1]).isalpha() and not (tail := low[-1]).isalpha():  # a word and its comma
            return (known(head) or self._merged(head)) + (known(tail) or marks(tail) or self._merged(tail))
        return b"".join([known(p) or marks(p) or self._merged(p)
                         for p in ((low,) if low.isalpha() else _PIECES.findall(low))])

    def _merged(self, piece: str) -> bytes:
        """The ids of one piece of the splitting; those of single characters are remembered."""
        own = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.symbols)
        ids = array("H", [t.id for t in self.model.tokenize(own)]).tobytes()
        if len(piece) == 1:
            self.marks[piece] = ids
        return ids

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of new words, remembered while there is room."""
        found: dict[str, bytes] = {}
        whole = []
        known, plain = self.known.get, self.model is not None
        for word in words:
            if plain and word.isascii() and word.isalpha():  # one piece, most words
                low = word.lower()
                ids = known(low) if low != word else None
                found[word] = ids or array("H", [t.id for t in self.model.tokenize(low)]).tobytes()
            elif plain and (word.isprintable() if word.isascii() else _SIMPLE.fullmatch(word)) and not (
                    "<" in word and any(s in word for s in self.special)):
                found[word] = self._simple(word)
            else:
                whole.append(word)
        for at in range(0, len(whole), 4096):
            part = whole[at:at + 4096]
            found.update(zip(part, self._ids(part)))
        if len(self.known) + len(found) <= self.remembered:
            self.known.update(found)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        known = self.known.get
        out: list[bytes] = []
        partial: list[tuple[int, list[bytes | None], list[int], list[str]]] = []  # texts with words not met before
        for i, text in enumerate(texts):
            if not text:
                out.append(b"")
            elif "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
                out.append(self._ids([text])[0])
            else:
                words = text.split()
                ids = list(map(known, words))
                if None in ids:  # of the words only the new ones are held
                    at = [k for k, x in enumerate(ids) if x is None]
                    partial.append((i, ids, at, [words[k] for k in at]))
                    out.append(b"")
                else:
                    out.append(b"".join(ids))
        found = self._learn(list({w for _, _, _, new in partial for w in new}))
        for i, ids, at, new in partial:
            for k, w in zip(at, new):
                ids[k] = found[w]
            out[i] = b"".join(ids)
        return out


_LOADED: dict[str, WordIds] = {}


def loaded(vocabulary: str) -> WordIds:
    """One encoder per worker process and file of the public tokenizers."""
    if vocabulary not in _LOADED:
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        _LOADED[vocabulary] = WordIds(public_tokenizers.path(vocabulary))
    return _LOADED[vocabulary]
