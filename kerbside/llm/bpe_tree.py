"""Byte-level BPE of whole texts, long ones as a tree of halves, and back to text.

A long text is halved until its parts are short. The parts are rows of their own, encoded in parallel,
and then concatenated two by two. Where two parts meet, their ids are those of the whole text but for
the surroundings of the join: a window around it is encoded anew, and grows until it holds a token of
the left side's encoding and one of the right side's. That is exact:

- A *sure cut* is a place where no pattern of the vocabulary's word splitting can go on, whatever
  precedes: after a letter, number or other mark, before something that is none such. Beyond the
  sure cuts next to a join nothing changes.
- Within one word, tokens form the encoding of their bytes exactly if each two neighbours do (merges
  inside a token do not depend on what stands beside it). Left tokens up to a shared one, the
  window's from there to the next shared one, and right tokens from there on have only neighbours
  that stand beside each other in some true encoding.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import whole_rows
from kerbside.llm.tokens import BYTE_LETTERS, SPACE, SpacedWords, encoder

LEAF_CHARS = 16_384  # longer texts are halved
FIRST_TOKENS = 4  # of the window on either side of a join, doubled until both sides agree
PLAIN_BYTES = 512  # surroundings up to this size are encoded at once
ROWS = 500  # a batch's rows that are worked on at a time
NONE = -2  # no token in common

_SURE = (
    rf"(?<=\p{{L}})(?=\P{{L}})|(?<=\p{{N}})(?=\P{{N}})|(?<=[^{SPACE}])(?=[{SPACE}])"
)
_first_sure = regex.compile(_SURE).search
_last_sure = regex.compile(f"(?r){_SURE}").search


class TreeEncoder:
    """Ids as unsigned 32-bit numpy arrays, special tokens in a text as the library takes them."""

    def __init__(self, path: str):
        self.words = encoder(SpacedWords, path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self._specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)").finditer
        letters = {letter: byte for byte, letter in BYTE_LETTERS.items()}
        letters |= {chr(b): b for b in range(256) if b not in BYTE_LETTERS}
        entries = {i: bytes(letters[c] for c in t) for t, i in described["model"]["vocab"].items()}
        entries |= {i: content.encode() for content, i in self.special.items()}
        self.entries = [entries.get(i, b"") for i in range(max(entries) + 1)]
        self.lengths = np.array([len(e) for e in self.entries], np.int64)
        self.narrow = "<u2" if len(self.entries) <= 1 << 16 else "<u4"

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text in one go."""
        parts = [self.words.encode(text[a:b]) for a, b in self._plain(text)]
        if len(parts) == 1:
            return np.frombuffer(parts[0], "<u4")
        marks = [self.special[m[0]].to_bytes(4, "little") for m in self._specials(text)]
        joined = b"".join(p + m for p, m in zip(parts, [*marks, b""]))
        return np.frombuffer(joined, "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.entries.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def _plain(self, text: str) -> Iterator[tuple[int, int]]:
        start = 0
        for mark in self._specials(text):
            yield start, mark.start()
            start = mark.end()
        yield start, len(text)

    def halves(self, text: str, leaf: int = LEAF_CHARS) -> list[str]:
        """The leaves of a text's tree, from left to right; no cut inside a special token."""
        if len(text) <= leaf:
            return [text]
        middle = len(text) // 2
        reach = max(map(len, self.special), default=1) - 1
        for mark in self._specials(text, max(0, middle - reach), middle + reach):
            if mark.start() < middle < mark.end():
                middle = mark.end()
                break
        if middle >= len(text):
            return [text]
        return self.halves(text[:middle], leaf) + self.halves(text[middle:], leaf)

    def concatenate(self, leaves: list[tuple[str, np.ndarray]]) -> np.ndarray:
        """Join neighbours two by two until one is left."""
        while len(leaves) > 1:
            pairs = zip(leaves[::2], leaves[1::2])
            joined = [(a + b, self.join(a, x, b, y)) for (a, x), (b, y) in pairs]
            leaves = joined + leaves[len(leaves) & ~1:]
        return leaves[0][1] if leaves else np.array([], "<u4")

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """The ids of ``left + right`` from those of both."""
        if not left or not right:
            return left_ids if left else right_ids
        # Special tokens end what can change.
        x, y = 0, len(right)
        for x, _ in self._plain(left):
            pass
        _, y = next(self._plain(right))
        look, end = 64, len(left)
        while True:
            at = max(x, end - look)
            found = _last_sure(left, at, end)
            # The character at the border of what is searched counts as seen only inside it.
            if found and at < found.start() < end:
                x = found.start()
                break
            if at == x:
                break
            look *= 2
        found = _first_sure(right, 0, y)
        if found and 0 < found.start() < y:
            y = found.start()
        tail, head = left[x:], right[:y]
        kept = len(left_ids) - self._tokens(left_ids[::-1], len(tail.encode()))
        begun = self._tokens(right_ids, len(head.encode()))
        middle = self._surroundings(tail, left_ids[kept:], head, right_ids[:begun])
        return np.concatenate([left_ids[:kept], middle, right_ids[begun:]])

    def _tokens(self, ids: np.ndarray, size: int) -> int:
        """How many of the first ids make up ``size`` bytes."""
        n = 64
        while size:
            ends = np.cumsum(self.lengths[ids[:n]])
            if ends[-1] >= size:
                return int(np.searchsorted(ends, size)) + 1
            n *= 4
        return 0

    def _surroundings(self, tail: str, left: np.ndarray, head: str, right: np.ndarray) -> np.ndarray:
        text = tail + head
        if len(text) <= PLAIN_BYTES // 4:
            return np.frombuffer(self.words._text(text), "<u4")
        words = [w.encode() for w in self.words._find(text)]
        ends = np.cumsum([len(w) for w in words])
        border, whole = len(tail.encode()), int(ends[-1])
        # Where the words of either side alone begin and end, and their tokens.
        own_left = np.cumsum([0, *(len(w.encode()) for w in self.words._find(tail))])
        own_right = border + np.cumsum([0, *(len(w.encode()) for w in self.words._find(head))])
        left_ends = np.cumsum(self.lengths[left])
        right_ends = border + np.cumsum(self.lengths[right])
        right_starts = right_ends - self.lengths[right]
        out = []
        for word, b in zip(words, ends.tolist()):
            a = b - len(word)
            known = []  # what the left and the right side know of this word: ids and their ends
            at = int(np.searchsorted(own_left, a))
            if at < len(own_left) - 1 and own_left[at] == a:
                stop = min(int(own_left[at + 1]), b)
                first = int(np.searchsorted(left_ends, a, "right"))
                last = int(np.searchsorted(left_ends, stop, "right"))
                known.append((left[first:last], left_ends[first:last] - a))
            else:
                known.append((left[:0], left_ends[:0]))
            at = int(np.searchsorted(own_right, b))
            if 0 < at < len(own_right) and own_right[at] == b:
                begin = max(int(own_right[at - 1]), a)
                first = int(np.searchsorted(right_starts, begin))
                last = int(np.searchsorted(right_ends, b, "right"))
                known.append((right[first:last], right_ends[first:last] - a))
            else:
                known.append((right[:0], right_ends[:0]))
            out.append(self._word(word, *known))
        assert whole == border + len(head.encode())
        return np.concatenate(out)

    def _word(
        self, word: bytes, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]
    ) -> np.ndarray:
        """A word's ids, given those of a beginning and of an end of it; both may be empty or meet."""
        (left_ids, left_ends), (right_ids, right_ends) = left, right
        size = len(word)
        for ids, ends in (left, right):
            if len(ids) and ends[0] == self.lengths[ids[0]] and ends[-1] == size:
                return ids  # one side knows the whole word
        left_starts = left_ends - self.lengths[left_ids]
        right_starts = right_ends - self.lengths[right_ids]
        n = FIRST_TOKENS
        while size > PLAIN_BYTES:
            a = int(left_starts[-n]) if n < len(left_ids) else 0
            b = int(right_ends[n - 1]) if n < len(right_ids) else size
            if a == 0 and b == size:
                break
            if a < b:
                ids = self._model(word[a:b])
                ends = a + np.cumsum(self.lengths[ids])
                starts = ends - self.lengths[ids]
                from_left = _shared(starts, ends, left_starts, left_ends)
                from_right = _shared(starts, ends, right_starts, right_ends)
                first, until = from_left[0] if a else (-1, 0)
                last, after = from_right[-1] if b < size else (len(ids) - 1, len(right_ids))
                if NONE not in (first, last) and first <= last:
                    middle = ids[first + 1:last + 1]
                    return np.concatenate([left_ids[:until], middle, right_ids[after:]])
            n *= 2
        return self._model(word)

    def _model(self, word: bytes) -> np.ndarray:
        letters = word.decode("latin-1").translate(BYTE_LETTERS)
        return np.array([t.id for t in self.words._model.tokenize(letters)], "<u4")


def _shared(
    starts: np.ndarray, ends: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray
) -> list[tuple[int, int]]:
    """The first and the last token of a window that the other side has too, each with the count of
    the other side's tokens up to and with it."""
    at = np.searchsorted(other_starts, starts)
    place = np.minimum(at, len(other_starts) - 1)
    if len(other_starts):
        same = np.flatnonzero((other_starts[place] == starts) & (other_ends[place] == ends))
        if len(same):
            return [(int(k), int(at[k]) + 1) for k in same[[0, -1]]]
    return [(NONE, 0)] * 2


@cache
def tree_encoder(path: str) -> TreeEncoder:
    """One a process: its cache of words serves all tasks."""
    return TreeEncoder(path)


def encode_texts(docs: DataFrame, vocabulary: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``(row, ids)``: each row whole, and its text's ids as little-endian unsigned 32-bit integers.

    The ids are those of the tokenizers library without special tokens added, truncation or padding;
    a special token's own string in a text is that token. A null or empty text has no ids. Repeated
    rows, null ids and clashing column names are kept as they are; an empty table gives no rows.

    Texts up to ``leaf_chars`` are encoded where they are read. Of the longer ones each different
    text is encoded once: its leaves are dealt out evenly, and what one group joins is one text's ids.
    """
    rows = docs.select(whole_rows(docs).alias("row"))
    text = F.col("row.text")
    long = F.coalesce(F.length(text) > leaf_chars, F.lit(False))
    schema = T.StructType([*rows.schema, T.StructField("ids", T.BinaryType())])

    def short_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tree_encoder(vocabulary).encode
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                texts = batch.column(0).field("text").to_pylist()
                ids = pa.array([encode(t or "").tobytes() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["row", "ids"])

    short = rows.where(~long).mapInArrow(short_ids, schema)
    keyed = rows.where(long).select("row", F.sha2(text.cast("binary"), 256).alias("key"))
    leaves = encoded_leaves(keyed.select("key", "row.text"), vocabulary, leaf_chars)
    joined = concatenated(leaves, vocabulary)
    return short.unionAll(keyed.join(joined, "key").select("row", "ids"))


def encoded_leaves(texts: DataFrame, vocabulary: str, leaf_chars: int) -> DataFrame:
    """``(key, place, ids)`` of the leaves of the texts of ``(key, text)``, dealt out evenly.

    Equal keys hold equal texts; their leaves are encoded once. ``ids`` take as few bytes as the
    vocabulary allows; they spell the leaf.
    """
    cut_schema = "key string, place int, part string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves = tree_encoder(vocabulary).halves
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                parts = halves(text.as_py(), leaf_chars)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(parts)), pa.array(range(len(parts)), pa.int32()),
                     pa.array(parts)], names=["key", "place", "part"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree_encoder(vocabulary)
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                ids = [own.encode(t).astype(own.narrow).tobytes() for t in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(ids, pa.binary())], names=["key", "place", "ids"]
                )

    leaves = texts.mapInArrow(cut, cut_schema).dropDuplicates(["key", "place"])
    return leaves.mapInArrow(encode, "key string, place int, ids binary")


def concatenated(leaves: DataFrame, vocabulary: str) -> DataFrame:
    """``(key, ids)``: each text's leaves joined as a tree."""
    def join(group: pa.Table) -> pa.Table:
        own = tree_encoder(vocabulary)
        ids = [np.frombuffer(i, own.narrow) for i in group.sort_by("place")["ids"].to_pylist()]
        whole = own.concatenate([(own.decode(i), i.astype("<u4")) for i in ids])
        return pa.table({"key": group["key"][:1], "ids": pa.array([whole.tobytes()], pa.binary())})

    return leaves.groupBy("key").applyInArrow(join, "key string, ids binary")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded``: the text of ``ids``, special tokens kept; null for null ids."""
    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())])
    place = encoded.columns.index("ids")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree_encoder(vocabulary).decode
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                ids = batch.column(place).to_pylist()
                texts = [None if i is None else own(np.frombuffer(i, "<u4")) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], names=schema.names
                )

    return encoded.mapInArrow(decode, schema)
