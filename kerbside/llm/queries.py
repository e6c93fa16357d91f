"""The queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.alignment import align_documents, pair_counts, score_links
from kerbside.llm.bpe_tree import decode_ids, encode_texts
from kerbside.llm.common import saved, table
from kerbside.llm.decontaminate import contamination
from kerbside.llm.embedding_dedup import near_vectors
from kerbside.llm.langid import fit, identify
from kerbside.llm.line_dedup import dedup_lines
from kerbside.llm.lm_score import fit as fit_language_model
from kerbside.llm.lm_score import score_documents
from kerbside.llm.packing import pack_documents
from kerbside.llm.pii import KINDS, base_structs, find_pii, spans_text
from kerbside.llm.prefix_trie import conversation_paths, prefix_trie, with_shared_heads
from kerbside.llm.simhash import near_duplicates
from kerbside.llm.span_dedup import dedup_spans
from kerbside.llm.token_files import read_token_files, write_token_files
from kerbside.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def id_remainder(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; -1 without an id, which is in no fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id", F.col("new_text").alias("text"), "n_lines", "n_removed"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    pieces = pack_documents(table(spark, sf_dir, "documents"), vocabulary, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)
    return groups.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_language_model(docs.where(id_remainder(5) != 1))
    return score_documents(docs, model).select(
        "doc_id", (id_remainder(5) == 1).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score",
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-files")
    shards = write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, shards, folder, docs.schema["doc_id"].dataType).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(id_remainder(4) != 2))
    return identify(docs.select("doc_id", "text"), model).select(
        "row.doc_id", (id_remainder(4, "row.doc_id") == 2).alias("held_out"), "lang_pred", "score",
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(spans_text(base_structs()), 256).alias("base_sha256"),
        spans_text(F.concat(base_structs(), "found")).alias("spans"),
    )


def op9_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_spans(table(spark, sf_dir, "documents")).select(
        "row.doc_id", F.col("new_text").alias("text"), "n_sentences", "n_removed"
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a node of the rebuilt conversations; none without conversations."""
    paths = saved(conversation_paths(table(spark, sf_dir, "conversations")), "conversations")
    return prefix_trie(with_shared_heads(paths, block=100, heads=6)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    )


def op12_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; a null text is empty: no ids, and the hashes of nothing."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode_ids(encode_texts(docs, vocabulary), vocabulary)
    return coded.select(
        "row.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; zeros and an empty text where there are no tokens."""
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    facts = saved(aligned.select(
        F.monotonically_increasing_id().alias("row_no"), "row.doc_id", *numbers,
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
        "pairs", "times",
    ), "aligned", "zstd")
    counts = saved(pair_counts(facts), "pair-counts")
    scored = facts.drop("pairs", "times").join(
        score_links(facts, counts, "row_no"), "row_no", "left"
    )
    sums = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return scored.select("doc_id", *numbers, *sums, "groups_sha256")


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_simhash": op4_simhash,
    "op5_lm_score": op5_lm_score,
    "op6_token_files": op6_token_files,
    "op7_language_id": op7_language_id,
    "op8_pii": op8_pii,
    "op9_span_dedup": op9_span_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe_tree": op12_bpe_tree,
    "op13_alignment": op13_alignment,
}
