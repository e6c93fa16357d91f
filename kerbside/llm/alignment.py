"""Alignment of two tokenizers' tokens over the same bytes.

The tokens of A and of B cover the same bytes. Byte offsets where a token of each ends cut both into
groups, and the tokens of a group are linked with one another. A batch of documents is merged in
lockstep: one NumPy state vector holds a pointer into A and one into B for each lane, all pointers
advance by one comparison a step, lanes that have ended are taken out, and each step emits the groups
it closed and their links. A lane is a document, or a part of a long one between two places that
both tokenizers cut at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.bpe_tree import tree_encoder
from kerbside.llm.common import whole_rows
from kerbside.llm.tokens import CUT, SpacedWords, _Cached, encoder

BATCH_CHARS = 2_000_000  # text merged at a time
LANE_CHARS = 512  # longer documents have several lanes
CACHED_WORDS = 300_000  # of either vocabulary; then the cache starts anew
SMALL_GROUP = 64  # links of larger groups are counted by id before they are multiplied out
# Pairs broadcast with their counts: at most so many, of three numbers each, whatever the input.
# All others are joined by a shuffle.
FREQUENT_PAIRS = 131_072
SPACE_MARK = "▁"  # fixed value: the space of piece vocabularies


class PieceWords:
    """Ids of a piece vocabulary for ``" " + text``, word by word where the vocabulary allows it.

    If no piece holds a space after another character, nor a line end, the ids of a text are those
    of its words with the spaces before them.
    """

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self._model.get_piece_size()
        pieces = [self._model.id_to_piece(i) for i in range(size)]
        of_bytes = [self._model.is_byte(i) for i in range(size)]
        self.entries = [
            bytes([int(p[3:5], 16)]) if b else p.replace(SPACE_MARK, " ").encode()
            for p, b in zip(pieces, of_bytes)
        ]
        self.lengths = np.array([len(e) for e in self.entries], np.int64)
        crossing = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}|\n").search
        alone = [0, self._model.piece_to_id("<0x0A>")]
        self._by_word = not any(map(crossing, pieces)) and self._model.encode("\n")[1:] == alone[1:]
        self._find = re.compile(r"\n| *[^ \n]+| +").findall
        self._words = _Cached(self._word, CACHED_WORDS)
        self._faithful = True  # so far, each word's pieces spelled the word

    def _word(self, word: str) -> bytes:
        # What follows a line end has no space put before it.
        ids = self._model.encode("\n" + word)[2:]
        if b"".join(map(self.entries.__getitem__, ids)) != word.encode():
            self._faithful = False
        return np.array(ids, "<u4").tobytes()

    def encode(self, spaced: str) -> np.ndarray | None:
        """The ids of a text that begins with a space; none if their bytes are not the text's."""
        if not self._by_word:
            ids = np.array(self._model.encode(spaced[1:]), "<u4")
            return ids if self._spell(ids) == spaced.encode() else None
        if SPACE_MARK in spaced:
            return None
        if "  " in spaced or CUT in spaced:
            words = self._find(spaced)
        else:
            words = spaced.replace("\n", f"{CUT}\n{CUT}").replace(" ", f"{CUT} ").split(CUT)
        ids = np.frombuffer(b"".join([self._words[w] for w in words if w]), "<u4")
        return ids if self._faithful or self._spell(ids) == spaced.encode() else None

    def _spell(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids.tolist()))


@cache
def piece_words(path: str) -> PieceWords:
    return PieceWords(path)


def lanes(spaced: str, size: int = LANE_CHARS) -> list[str]:
    """A text's parts, each beginning with a space after something else: both tokenizers cut there."""
    parts, start = [], 0
    while len(spaced) - start > size:
        at = spaced.find(" ", start + size)
        while at > 0 and spaced[at - 1].isspace():
            at = spaced.find(" ", at + 1)
        if at < 0:
            break
        parts.append(spaced[start:at])
        start = at
    return [*parts, spaced[start:]]


@dataclass
class Groups:
    """Groups in the order of the tokens: half-open ranges of A's and B's tokens."""

    a_from: np.ndarray
    a_to: np.ndarray
    b_from: np.ndarray
    b_to: np.ndarray


Step = tuple[Groups, tuple[np.ndarray, np.ndarray], list[tuple[int, int, int, int]]]


def lockstep(
    a_ends: np.ndarray, b_ends: np.ndarray, a_lanes: np.ndarray, b_lanes: np.ndarray
) -> Iterator[Step]:
    """Merge all lanes at once; for each step, the groups closed, their links, and large groups.

    ``a_ends`` and ``b_ends`` are the tokens' last byte offsets, counted through all lanes; a lane
    begins at the token in ``a_lanes`` and ``b_lanes``, whose last entry is the count of tokens.
    Links are token places; those of large groups are left to the caller.
    """
    a, a_stop, b = a_lanes[:-1].copy(), a_lanes[1:], b_lanes[:-1].copy()
    alive = a < a_stop
    a, a_stop, b = a[alive], a_stop[alive], b[alive]
    a_open, b_open = a.copy(), b.copy()  # where each lane's open group begins
    while len(a):
        a_end, b_end = a_ends[a], b_ends[b]
        cut = a_end == b_end
        forward_a, forward_b = a_end <= b_end, b_end <= a_end
        a = a + forward_a
        b = b + forward_b
        closed = np.flatnonzero(cut)
        if len(closed):
            groups = Groups(a_open[closed], a[closed], b_open[closed], b[closed])
            yield groups, *_links(groups)
            a_open[closed] = groups.a_to
            b_open[closed] = groups.b_to
            going = a < a_stop
            if not going.all():
                a, a_stop, b, a_open, b_open = (x[going] for x in (a, a_stop, b, a_open, b_open))


def _links(
    groups: Groups
) -> tuple[tuple[np.ndarray, np.ndarray], list[tuple[int, int, int, int]]]:
    n_a, n_b = groups.a_to - groups.a_from, groups.b_to - groups.b_from
    n = n_a * n_b
    if n.max() == 1:
        return (groups.a_from, groups.b_from), []
    large = n > SMALL_GROUP
    rest = list(zip(*(x[large].tolist() for x in vars(groups).values()))) if large.any() else []
    n = np.where(large, 0, n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    width = np.repeat(n_b, n)
    a = np.repeat(groups.a_from, n) + at // width
    return (a, np.repeat(groups.b_from, n) + at % width), rest


class Aligner:
    """Aligns batches of texts; a text's result depends on that text only."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        self.a = encoder(SpacedWords, vocabulary_a, CACHED_WORDS)
        self.a_lengths = tree_encoder(vocabulary_a).lengths
        self.b = piece_words(vocabulary_b)
        n_a, n_b = len(self.a_lengths), len(self.b.lengths)
        self.base = n_a, n_b
        # What follows a token in a document's list of groups: A's go on or end, B's go on or end.
        self.written = [
            b"%d%s" % (i, mark)
            for n, marks in ((n_a, (b",", b"|")), (n_b, (b",", b";")))
            for mark in marks
            for i in range(n)
        ]

    def align(self, texts: list[str | None]) -> pa.Table:
        """A row a text: counts, ``groups`` as text, and the linked id pairs with their numbers."""
        a_ids, b_ids, doc_of_lane = [], [], []
        for doc, text in enumerate(texts):
            if not text:
                continue
            own = []
            for part in lanes(" " + text):
                b = self.b.encode(part)
                if b is None:
                    break
                own.append((np.frombuffer(self.a.encode(part[1:], " "), "<u4"), b))
            else:
                a_ids += [x for x, _ in own]
                b_ids += [x for _, x in own]
                doc_of_lane += [doc] * len(own)
        starts = [np.cumsum([0, *map(len, ids)]) for ids in (a_ids, b_ids)]
        a, b = (np.concatenate([np.array([], "<u4"), *ids]).astype(np.int64) for ids in (a_ids, b_ids))
        a_doc, b_doc = (
            np.repeat(np.array(doc_of_lane, np.int64), np.diff(s)) for s in starts
        )
        del a_ids, b_ids
        steps = list(lockstep(
            np.cumsum(self.a_lengths[a]), np.cumsum(self.b.lengths[b]), *starts
        ))
        ends = [
            np.concatenate([np.array([], np.int64), *(getattr(g, k) for g, _, _ in steps)])
            for k in ("a_from", "a_to", "b_from", "b_to")
        ]
        order = np.argsort(ends[0])
        groups = Groups(*(x[order] for x in ends))
        n_a, n_b = self.base
        codes = [(a_doc[x] * n_a + a[x]) * n_b + b[y] for _, (x, y), _ in steps]
        large = [self._large(a_doc, a, b, *g) for _, _, rest in steps for g in rest]
        del steps
        codes, times = np.unique(
            np.concatenate([np.array([], np.int64), *codes]), return_counts=True
        )
        if large:
            codes, where = np.unique(
                np.concatenate([codes, *(c for c, _ in large)]), return_inverse=True
            )
            summed = np.zeros(len(codes), np.int64)
            np.add.at(summed, where, np.concatenate([times, *(t for _, t in large)]))
            times = summed
        docs = np.arange(len(texts) + 1)
        of_pair, pair = np.divmod(codes, n_a * n_b)
        pair_starts = np.searchsorted(of_pair, docs)
        pair = (pair // n_b << 32) | pair % n_b
        sizes = (groups.a_to - groups.a_from) * (groups.b_to - groups.b_from)
        of_group = a_doc[groups.a_from]
        group_starts = np.searchsorted(of_group, docs)
        linked = np.concatenate([[0], np.cumsum(sizes)])[group_starts]
        return pa.table({
            "n_a": np.diff(np.searchsorted(a_doc, docs)).astype(np.int64),
            "n_b": np.diff(np.searchsorted(b_doc, docs)).astype(np.int64),
            "n_groups": np.diff(group_starts).astype(np.int64),
            "n_links": np.diff(linked).astype(np.int64),
            "groups": pa.array(self._written(groups, a, b, a_doc, b_doc, len(texts)), pa.string()),
            "pairs": pa.ListArray.from_arrays(pa.array(pair_starts, pa.int32()), pa.array(pair)),
            "times": pa.ListArray.from_arrays(pa.array(pair_starts, pa.int32()), pa.array(times)),
        })

    def _large(
        self, a_doc: np.ndarray, a: np.ndarray, b: np.ndarray, a0: int, a1: int, b0: int, b1: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Codes and numbers of a large group's links: each pair of ids once."""
        n_a, n_b = self.base
        x, x_times = np.unique(a[a0:a1], return_counts=True)
        y, y_times = np.unique(b[b0:b1], return_counts=True)
        codes = ((a_doc[a0] * n_a + x) * n_b)[:, None] + y
        return codes.ravel(), np.outer(x_times, y_times).ravel()

    def _written(
        self, groups: Groups, a: np.ndarray, b: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray, n: int
    ) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each document: the ids of each group."""
        n_a, n_b = self.base
        size_a, size_b = groups.a_to - groups.a_from, groups.b_to - groups.b_from
        # A token's place: after its own side's earlier tokens and the other side's of earlier groups.
        at_a = np.arange(len(a)) + np.repeat(groups.b_from, size_a)
        at_b = np.arange(len(b)) + np.repeat(groups.a_to, size_b)
        out = np.empty(len(a) + len(b), np.int64)
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[groups.a_to - 1] = True
        b_last[groups.b_to - 1] = True
        out[at_a] = a + np.where(a_last, n_a, 0)
        out[at_b] = 2 * n_a + b + np.where(b_last, n_b, 0)
        docs = np.arange(n + 1)
        bounds = (np.searchsorted(a_doc, docs) + np.searchsorted(b_doc, docs)).tolist()
        written = self.written.__getitem__
        return [
            b"".join(map(written, out[s:e].tolist()))[:-1].decode() for s, e in zip(bounds, bounds[1:])
        ]


@cache
def aligner(vocabulary_a: str, vocabulary_b: str) -> Aligner:
    return Aligner(vocabulary_a, vocabulary_b)


def align_documents(docs: DataFrame, vocabulary_a: str, vocabulary_b: str) -> DataFrame:
    """``(row, n_a, n_b, n_groups, n_links, groups, pairs, times)``: each row whole, and its text's
    alignment.

    A encodes ``" " + text`` with a byte-level BPE file, B the text with a piece vocabulary that puts a
    space before it; strings of special tokens in a text are plain text. ``groups`` lists the ids of
    each group. ``pairs`` are the different linked ids, A's times 2^32 plus B's, and ``times`` how
    often each is linked. A null or empty text, and one that a tokenizer does not give back byte by
    byte, has no tokens: zeros, an empty list and no pairs. Repeated rows, null ids and clashing
    column names are kept as they are; an empty table gives no rows.
    """
    rows = docs.select(whole_rows(docs).alias("row"))
    counts = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    lists = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "times")]
    schema = T.StructType([*rows.schema, *counts, T.StructField("groups", T.StringType()), *lists])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(vocabulary_a, vocabulary_b).align
        for batch in batches:
            texts = batch.column(0).field("text").to_pylist()
            ends = np.cumsum([len(t or "") for t in texts])
            start = 0
            while start < len(texts):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + BATCH_CHARS, "right")))
                found = align(texts[start:stop])
                own = batch.column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [own, *(found[c].combine_chunks() for c in schema.names[1:])], names=schema.names
                )
                start = stop

    return rows.mapInArrow(aligned, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: in how many rows each pair is linked, and whether that is the most of all
    pairs with its id of A (ties included)."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("n")
    )
    of_a = counts.withColumn("a", F.shiftright("pair", 32))
    most = of_a.groupBy("a").agg(F.max("n").alias("most"))
    return of_a.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """``(key, n_best, count_sum)`` of each row with links: over its links, how many are best for
    their id of A, and the sum of their pairs' counts. ``key`` tells the rows apart.

    The most frequent pairs are broadcast, a bounded number of them; links of all others are joined.
    """
    links = aligned.select(key, F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    frequent = counts.orderBy(F.desc("n"), "pair").limit(FREQUENT_PAIRS)
    met = links.join(F.broadcast(frequent), "pair", "left")
    rest = met.where(F.col("n").isNull()).select(key, "pair", "times").join(counts, "pair")

    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy(key).agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )

    known = sums(met.where(F.col("n").isNotNull()))
    return known.unionAll(sums(rest)).groupBy(key).agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
