"""Substring dedup over sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import saved, text_key, whole_rows

# A sentence ends at white space after . ! or ? (and closing marks), or with its line.
BREAK = r"\s*\n\s*|(?:(?<=[.!?])|(?<=[.!?][\"')\]»”’]))\s+"
WORD = r"\S+\s*"
LONGEST = 24  # words; longer sentences are cut where their words say
CUT_ONE_IN = 6
LEAST_SENTENCES = 2
LEAST_WORDS = 20


def sentences(text: str) -> list[str]:
    """The sentences with the white space after them: joined, they are the text."""
    pieces, begin = [], 0
    for end in [*(m.end() for m in re.finditer(BREAK, text)), len(text)]:
        piece = text[begin:end]
        if not piece.strip():
            if piece and pieces:
                pieces[-1] += piece
                begin = end
            continue  # white space before the first sentence belongs to it
        begin = end
        if piece.count(" ") >= LONGEST and len(words := re.findall(WORD, piece)) > LONGEST:
            lead = piece[: len(piece) - sum(map(len, words))]
            ends = cuts(words)
            parts = ["".join(words[k:end]) for k, end in zip([0, *ends], ends)]
            pieces += [lead + parts[0], *parts[1:]]
        else:
            pieces.append(piece)
    if begin < len(text) and not pieces:
        pieces.append(text[begin:])
    return pieces


def cuts(words: list[str]) -> list[int]:
    """Where the pieces of a long sentence end: the same places in a passage wherever it begins.

    A piece ends after a word whose hash is a multiple of ``CUT_ONE_IN``; after ``LONGEST`` words
    without one, after that of them with the least hash, the last one in a loop of equal words.
    """
    ends, begin, least, at = [], 0, 2**64, 0
    hashes = [xxhash.xxh3_64_intdigest(word.rstrip()) for word in words]
    k = 0
    while k < len(words):
        if hashes[k] <= least:
            least, at = hashes[k], k
        if hashes[k] % CUT_ONE_IN == 0:
            at = k
        elif k + 1 - begin < LONGEST:
            k += 1
            continue
        ends.append(at + 1)
        begin = k = at + 1
        least = 2**64
    return ends if begin == len(words) else [*ends, len(words)]


def spans(pieces: list[str]) -> list[tuple[int, int, str]]:
    """``(first, last, words)`` of the span from each sentence: the shortest run of at least
    ``LEAST_SENTENCES`` sentences and ``LEAST_WORDS`` words, words joined by single spaces.
    """
    words = [piece.split() for piece in pieces]
    sizes = [len(w) for w in words]
    joined = [" ".join(w) for w in words]
    found, last, total = [], -1, 0
    for first in range(len(pieces)):
        while last + 1 < len(pieces) and (last - first + 1 < LEAST_SENTENCES or total < LEAST_WORDS):
            last += 1
            total += sizes[last]
        if last - first + 1 < LEAST_SENTENCES or total < LEAST_WORDS:
            break
        found.append((first, last, " ".join(joined[first:last + 1])))
        total -= sizes[first]
    return found


def span_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, place, span, proof)``: every span's place and 128-bit hash."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text_key", T.LongType()),
        T.StructField("place", T.IntegerType()), T.StructField("span", T.LongType()),
        T.StructField("proof", T.LongType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                doc, place, digests = [], [], []
                for k, text in enumerate(batch.column(2)):
                    for first, _, words in spans(sentences(text.as_py() or "")):
                        doc.append(k)
                        place.append(first)
                        digests.append(xxhash.xxh3_128_digest(words.encode()))
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                taken = pa.array(doc, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken),
                     pa.array(place, pa.int32()), pa.array(halves[:, 0].copy()),
                     pa.array(halves[:, 1].copy())],
                    names=schema.names,
                )

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return keyed.mapInArrow(cut, schema)


def dedup_spans(docs: DataFrame) -> DataFrame:
    """``(row, new_text, n_sentences, n_removed)``: each row of ``docs``, whole, and its text
    without the sentences that a repeated span covers.

    A span that occurs more than once stays at its first place: in the document of least
    ``doc_id``, the first time. Every sentence that any other of its places covers is removed.
    Counts are summed before the shuffle, so a frequent span costs one row a task. Rows without an
    id are first only if no row with an id has the span. Repeated rows (same id and text) are one
    document and are treated alike. Null stays null, an empty text has no sentence, a text of which
    all is removed becomes empty; nothing but ``doc_id`` and ``text`` is looked at.
    """
    every = saved(span_rows(docs), "spans", "zstd")
    repeated = saved(
        every.groupBy("span").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("first_id"),
            F.min("proof").alias("proof"), F.max("proof").alias("other"),
        ).where("n > 1 AND proof = other").select("span", "first_id"),
        "repeated-spans",
    )
    places = every.join(repeated, "span").select(
        "doc_id", "text_key", "place", "span",
        F.col("doc_id").eqNullSafe(F.col("first_id")).alias("first"),
    )
    by_doc = saved(
        places.groupBy(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"))
        .agg(F.collect_set(F.struct("place", "span", "first")).alias("found")),
        "found-spans",
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    # Found places grow with the documents: the same join at every size, not a broadcast at first.
    joined = docs.select(
        whole_rows(docs).alias("row"), "doc_id", text_key(F.col("text")).alias("text_key")
    ).hint("merge").join(by_doc, same, "left").select("row", "row.text", "found")
    schema = T.StructType([
        joined.schema["row"], T.StructField("new_text", T.StringType()),
        T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType()),
    ])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                rows = [
                    _without(text, found) for text, found in
                    zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
                ]
                texts, n, removed = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int64()),
                     pa.array(removed, pa.int64())],
                    names=schema.names,
                )

    return joined.mapInArrow(rebuild, schema)


def _without(text: str | None, found: list[dict] | None) -> tuple[str | None, int, int]:
    """The text without covered sentences; its sentences, those removed."""
    if text is None:
        return None, 0, 0
    pieces = sentences(text)
    gone: set[int] = set()
    if found:
        last = {first: last for first, last, _ in spans(pieces)}
        seen = set()
        for span in sorted(found, key=lambda f: f["place"]):
            if span["first"] and span["span"] not in seen:
                seen.add(span["span"])
            else:
                gone.update(range(span["place"], last[span["place"]] + 1))
    if not gone:
        return text, len(pieces), 0
    return "".join(p for k, p in enumerate(pieces) if k not in gone), len(pieces), len(gone)
