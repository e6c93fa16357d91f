"""The pipeline, each stage against its own rule on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
from kerbside.llm.common import saved
from kerbside.llm.simhash import fingerprint
from odd_rows import DATA
from test_dedup import brute_components, brute_lines
from test_text import brute_contamination, check_packing


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, documents):
    blank = spark.createDataFrame(
        [(10_001, None, "en", "s", None), (10_002, "123 !!!", None, None, 7), (None, "the of and that", None, None, 15)],
        documents.schema,
    )
    docs = documents.unionAll(blank)
    for name, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, docs, DATA), f"test-{name}")
        before, now = pairs(docs), pairs(after) if "text" in after.columns else None
        if now is not None:
            assert after.columns == documents.columns and after.schema == documents.schema
        if name == "language":
            assert {i for i, _ in before} - {i for i, _ in now} == {10_001, 10_002}
            assert all(re.search(r"[^\W\d_]", t) for _, t in now)
        elif name == "line_dedup":
            assert sorted(now, key=str) == sorted(brute_lines(before).elements(), key=str)
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif name == "near_dedup":
            prints = [(i, fingerprint(t, corpus_pipeline.NEAR_WORDS)) for i, t in before]
            groups = brute_components(prints, corpus_pipeline.NEAR_BITS)
            assert {i for i, _ in now} == {i for i, _, least in groups if i == least}
        elif name == "decontaminate":
            items = pairs(spark.read.parquet(f"{DATA}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
            clean = {i for i, _, hit, _ in brute_contamination(before, items) if not hit}
            assert {i for i, _ in now} == clean and len(now) < len(before)
        else:
            check_packing(after.collect(), dict(before))
        docs = after


def test_run_gives_the_last_stage_s_rows(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_empty_documents(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, DATA), "test-empty")
        assert docs.count() == 0
