"""Token ids from public tokenizer files, by way of a cache of words.

The two files' tokenizers never join ids over a space between two words, so the ids of a text are
those of its words, and most words have been seen before. What the cache lacks goes to the
tokenizers library's own model.
"""

from __future__ import annotations

import os
import re
import struct
from functools import cache

import regex
from tokenizers import Tokenizer

CACHED_WORDS = 800_000  # then the cache starts anew: about 160 MB
CACHED_LETTERS = 128  # longer words are not kept
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# Unicode white space, as the tokenizers' patterns take it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


CUT = "\x01"
# A full stop or comma not between a letter or digit and one of those, white space or the end: both
# vocabularies' patterns keep runs of marks together, and some take the space before a mark.
_CROWDED = re.compile(r"[.,](?:(?<=[\W_][.,])|(?<=\A[.,])|(?=_)|(?=[^\w\s\x01]))").search


def lone_marks(text: str) -> bool:
    """Whether each full stop and comma is a piece of its own, next to a word."""
    return _CROWDED(text) is None


def evenly_spaced(text: str) -> bool:
    """Whether words are parted by single spaces and line ends alone, and no character marks cuts."""
    flat = text.replace("\n", " ")
    if flat.isprintable():  # no white space but spaces, no control characters
        return flat != "" and "  " not in flat and flat[0] != " " and flat[-1] != " "
    return CUT not in text and flat != "" and flat == " ".join(text.split())


def _byte_letters() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves, the others for the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]


class _Cached(dict):
    """A dictionary that makes what it lacks, and starts anew when it holds ``most``."""

    def __init__(self, make, most):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self.make(key)
        if len(key) <= CACHED_LETTERS:
            self[key] = value
        return value


class WordEncoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers, without special tokens."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        self._normalizer = tokenizer.normalizer
        self._model = tokenizer.model
        self._pieces = _Cached(self._piece, most)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            letters = piece.replace(" ", BYTE_LETTERS[32])
        else:
            letters = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = [t.id for t in self._model.tokenize(letters)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


class LowerWords(WordEncoder):
    """For a vocabulary that lowers text and drops white space."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        super().__init__(path, most)
        self._find = regex.compile(
            rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
        ).findall
        self._words = _Cached(self._word, most)

    def encode(self, text: str) -> bytes:
        if text.isascii():
            text = text.lower()
        text = text.replace("\n", " ")
        if not lone_marks(text):
            return b"".join([
                self._words[w] if w.isalpha() else self._word(w) for w in text.split(" ")
            ])
        words = text.replace(".", " .").replace(",", " ,").split(" ")
        return b"".join(map(self._words.__getitem__, words))

    def _word(self, word: str) -> bytes:
        plain = word.lower() if word.isascii() else self._normalizer.normalize_str(word)
        if plain.isalpha():  # one piece, which need not be looked for nor kept twice
            return self._piece(plain)
        return b"".join(map(self._pieces.__getitem__, self._find(plain)))


class SpacedWords(WordEncoder):
    """For a vocabulary whose words carry the space before them."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        super().__init__(path, most)
        fine = regex.compile(
            rf"{CONTRACTIONS}| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
            rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        )
        self._find = fine.findall
        self._words = _Cached(self._word, most)

    def encode(self, text: str, lead: str = "") -> bytes:
        """The ids of ``lead + text``; ``lead`` is a space or nothing."""
        # White space other than single spaces and line ends between words goes the long way, and
        # so does the control character that marks the cuts here.
        if not evenly_spaced(text):
            return self._text(lead + text)
        text = (lead + text).replace(" ", CUT + " ").replace("\n", f"{CUT}\n{CUT}")
        if lone_marks(text):
            text = text.replace(".", CUT + ".").replace(",", CUT + ",")
        return b"".join(map(self._words.__getitem__, text.split(CUT)))

    def _word(self, word: str) -> bytes:
        bare = word[1:] if word.startswith(" ") else word
        if bare.isalpha():  # one piece, which need not be looked for nor kept twice
            return self._piece(word)
        return self._text(word)

    def _text(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self._find(text)))


@cache
def encoder(kind: type[WordEncoder], path: str, most: int = CACHED_WORDS) -> WordEncoder:
    """One encoder a process, so that its cache serves all its tasks."""
    return kind(path, most)
