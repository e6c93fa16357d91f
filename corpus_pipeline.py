"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import saved, table
from kerbside.llm.decontaminate import drop_contaminated
from kerbside.llm.langid import UNKNOWN, fit, identify
from kerbside.llm.line_dedup import dedup_lines
from kerbside.llm.packing import pack_documents
from kerbside.llm.simhash import drop_near_duplicates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Fingerprints over shingles of so many words are near-duplicates' up to so many differing bits.
NEAR_WORDS, NEAR_BITS = 4, 4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that the labelled rows teach go: null, empty, letterless."""
    model = fit(docs.select("text", "lang"))
    known = identify(docs, model).where(F.col("lang_pred") != UNKNOWN)
    return known.select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated multi-line chunks; ``n_chars`` follows the text."""
    new = {
        "text": F.col("new_text"),
        "n_chars": F.length("new_text").cast(docs.schema["n_chars"].dataType),
    }
    return dedup_lines(docs).select(*[
        new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns
    ])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the least id."""
    return drop_near_duplicates(docs, NEAR_WORDS, NEAR_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in sequences of 2048, one row a piece."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# Cross-parsing, tokenizing and packing have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written down before the next one reads it.

    Null and empty texts leave with the first stage, repeated rows and ties are decided by each
    stage's own rule, extra columns go through all but the last, and an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
