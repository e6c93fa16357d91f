"""Line dedup over content-defined chunks of lines."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import saved, text_key, whole_rows

# The rolling hash: a line's 32-bit hash and that of the line before, times these, modulo a prime.
FACTORS = (1_000_003, 8_191)
PRIME = 2_147_483_647


def line_chunks(text: str | None, divisor: int) -> list[list[str]]:
    """The lines of ``text`` cut into chunks.

    A chunk ends after a line where the rolling hash over the hashes of this line and the line
    before is a multiple of ``divisor``. The cut depends on two lines only, so after an inserted or
    removed line the same cuts come back. Null has no chunks; an empty text is one empty line.
    """
    if text is None:
        return []
    chunks: list[list[str]] = [[]]
    before = 0
    for line in text.split("\n"):
        own = int.from_bytes(hashlib.md5(line.encode()).digest()[:4], "big")
        chunks[-1].append(line)
        if (own * FACTORS[0] + before * FACTORS[1]) % PRIME % divisor == 0:
            chunks.append([])
        before = own
    return chunks if chunks[-1] else chunks[:-1]


def chunk_rows(docs: DataFrame, divisor: int, min_lines: int, texts: bool) -> DataFrame:
    """``(doc_id, text_key, place, digest[, chunk])`` of chunks of ``min_lines`` lines or more."""
    names = ["doc_id", "text_key", "place", "digest", "chunk"][:5 if texts else 4]
    types = [docs.schema["doc_id"].dataType, T.LongType(), T.IntegerType(), T.BinaryType(), T.StringType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, place, digest, chunk = [], [], [], []
            for k, text in enumerate(batch.column(2)):
                for at, lines in enumerate(line_chunks(text.as_py(), divisor)):
                    if len(lines) >= min_lines:
                        joined = "\n".join(lines)
                        doc.append(k)
                        place.append(at)
                        digest.append(hashlib.md5(joined.encode()).digest())
                        if texts:
                            chunk.append(joined)
            taken = pa.array(doc, pa.int64())
            columns = [
                batch.column(0).take(taken), batch.column(1).take(taken),
                pa.array(place, pa.int32()), pa.array(digest, pa.binary()),
            ] + ([pa.array(chunk, pa.string())] if texts else [])
            yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return keyed.mapInArrow(cut, schema)


def repeated_chunks(docs: DataFrame, divisor: int, min_lines: int) -> DataFrame:
    """``(digest, first_id)`` of chunks that occur more than once.

    Chunks are grouped by their digest and their bytes; copies are counted before the shuffle, so a
    frequent chunk costs one row a task. Should different chunks share a digest, both stay in place.
    """
    counted = chunk_rows(docs, divisor, min_lines, texts=True).groupBy("digest", "chunk").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_id")
    )
    return counted.groupBy("digest").agg(
        F.count("*").alias("texts"), F.max("n").alias("n"), F.max("first_id").alias("first_id")
    ).where("texts = 1 AND n > 1").select("digest", "first_id")


def dedup_lines(docs: DataFrame, divisor: int = 3, min_lines: int = 2) -> DataFrame:
    """``(row, new_text, n_lines, n_removed)``: each row of ``docs``, whole, and its text without
    repeated chunks.

    A chunk of ``min_lines`` lines or more that occurs more than once is removed everywhere but at
    its first place: in the document of least ``doc_id``, the first time. Rows without an id are
    first only if no row with an id has the chunk. Repeated rows (same id and text) are one
    document and are treated alike. A text of single-line chunks stays; a text all of whose chunks
    go becomes empty; null stays null; nothing but ``doc_id`` and ``text`` is looked at.
    """
    repeated = saved(repeated_chunks(docs, divisor, min_lines), "repeated-chunks")
    places = chunk_rows(docs, divisor, min_lines, texts=False).join(repeated, "digest").select(
        "doc_id", "text_key", "place", "digest",
        F.col("doc_id").eqNullSafe(F.col("first_id")).alias("first"),
    )
    by_doc = saved(
        places.groupBy(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"))
        .agg(F.collect_set(F.struct("place", "digest", "first")).alias("found")),
        "found-chunks",
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    # Found places grow with the documents: the same join at every size, not a broadcast at first.
    joined = docs.select(
        whole_rows(docs).alias("row"), "doc_id", text_key(F.col("text")).alias("text_key")
    ).hint("merge").join(by_doc, same, "left").select("row", "row.text", "found")
    schema = T.StructType([
        joined.schema["row"], T.StructField("new_text", T.StringType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType()),
    ])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_removed = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept, lines, removed = _without(text, found, divisor)
                texts.append(kept)
                n_lines.append(lines)
                n_removed.append(removed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_removed, pa.int64())],
                names=schema.names,
            )

    return joined.mapInArrow(rebuild, schema)


def _without(text: str | None, found: list[dict] | None, divisor: int) -> tuple[str | None, int, int]:
    """The text without the found chunks but the first places it holds; its lines, those removed."""
    if text is None:
        return None, 0, 0
    if not found:
        return text, text.count("\n") + 1, 0
    gone, seen = set(), set()
    for chunk in sorted(found, key=lambda f: f["place"]):
        if chunk["first"] and chunk["digest"] not in seen:
            seen.add(chunk["digest"])
        else:
            gone.add(chunk["place"])
    chunks = line_chunks(text, divisor)
    kept = [line for k, c in enumerate(chunks) if k not in gone for line in c]
    lines = sum(map(len, chunks))
    return "\n".join(kept), lines, lines - len(kept)
