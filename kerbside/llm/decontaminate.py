"""Benchmark decontamination: a prefix-filtered join of item windows with document words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import ascii_lower, saved, text_key

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# One block of windows is broadcast at a time: at most about this many of them, and bytes of text.
BLOCK_WINDOWS = 20_000
BLOCK_BYTES = 16 * 1024 * 1024


def words_of(text: Column) -> Column:
    """A-Z lowered; runs of letters, digits and non-ASCII characters. Null has no words.

    Split at what lies between them, which costs a fourth of extracting each. A gap at either end
    leaves an empty string there.
    """
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``(words, items, window_id)``: every distinct window with the ids of the items it is from.

    An item of fewer than ``window`` words, but not none, is one window. A null item id is the
    empty string.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words_of(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (
        items.select("item", F.explode(F.transform(
            starts, lambda s: F.slice("words", s, window)
        )).alias("words"))
        .groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("window_id", F.xxhash64("words"))
    )


def rarest_words(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` with ``token`` and ``offset``: the window's rarest word over all documents.

    Containment of a whole window needs each of its words, so a prefix of one word under any order
    loses nothing; the rarest leaves the fewest places to look at. Ties: the least word, then place.
    """
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = saved(
        docs.select(F.explode(words_of(F.col("text"))).alias("word"))
        .join(F.broadcast(vocabulary), "word")
        .groupBy("word").agg(F.count("*").alias("n")),
        "word-counts",
    )
    placed = windows.select(
        "window_id", "words", "items", F.posexplode("words").alias("place", "word")
    ).join(counts, "word", "left")
    order = F.struct(F.coalesce("n", F.lit(0)), "word", "place")
    return placed.groupBy("window_id", "words", "items").agg(
        F.min_by("word", order).alias("token"), F.min_by("place", order).alias("offset")
    )


def window_hits(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """``(doc_id, text_key, first, n, items)``: each place where a window occurs whole.

    Windows go in blocks of bounded size, each against all documents. Per block one pass: words
    are met by the block's prefix words, then bound by position and length, then compared word by
    word; only true hits leave the join.
    """
    every = saved(item_windows(benchmark, window), "windows")
    total = every.agg(
        F.count("*"), F.sum(F.length(F.concat_ws(" ", "words")) + F.length(F.concat_ws(" ", "items")))
    ).first()
    blocks = max(1, math.ceil(total[0] / BLOCK_WINDOWS), math.ceil((total[1] or 0) / BLOCK_BYTES))
    hits = None
    for block in range(blocks):
        chosen = every.where(F.pmod("window_id", F.lit(blocks)) == block)
        prefixed = saved(rarest_words(docs, chosen), "prefixes").select(
            "token", "offset", F.col("words").alias("wanted"), "items"
        )
        places = docs.select(
            "doc_id", text_key(F.col("text")).alias("text_key"), words_of(F.col("text")).alias("words")
        ).select("doc_id", "text_key", "words", F.posexplode("words").alias("place", "word"))
        first = F.col("place") - F.col("offset")
        size = F.size("wanted")
        found = places.join(
            F.broadcast(prefixed),
            (F.col("word") == F.col("token"))
            & (first >= 0) & (first + size <= F.size("words"))
            & (F.slice("words", first + 1, size) == F.col("wanted")),
        ).select("doc_id", "text_key", first.alias("first"), size.alias("n"), "items")
        hits = found if hits is None else hits.unionAll(found)
    return hits


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row a document: ``doc_id, text_key, n_words, n_hit, items, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window of ``window`` item words, ``items``
    lists the items with an occurring window, sorted as strings. Null and empty texts have no words.
    Repeated rows each get their row; rows that share an id are told apart by their text. An empty
    benchmark hits nothing. Only ``doc_id`` and ``text`` are looked at.
    """
    hits = saved(
        window_hits(docs, benchmark, window).groupBy("doc_id", "text_key").agg(
            F.collect_set(F.struct("first", "n")).alias("places"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        ).select(
            F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "items",
            F.size(F.array_distinct(F.flatten(F.transform(
                "places", lambda p: F.sequence(p["first"], p["first"] + p["n"] - 1)
            )))).cast("long").alias("n_hit"),
        ),
        "hits",
    )
    counted = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    return counted.join(hits, same, "left").select(
        "doc_id", "text_key", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents in which a window occurs; all their columns."""
    found = saved(
        window_hits(docs, benchmark, window)
        .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct(),
        "contaminated",
    )
    same = docs["doc_id"].eqNullSafe(found["hit_id"]) & (
        text_key(docs["text"]) == found["hit_key"]
    )
    return docs.hint("merge").join(found, same, "left_anti")
