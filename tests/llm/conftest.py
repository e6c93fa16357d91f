from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

sys.path.insert(0, str(Path(__file__).resolve().parent))

from odd_rows import CLASHING, DATA, ODD  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents, with columns of documents and some named like helper columns."""
    rows = [(i, t, None, None, None, *["x"] * len(CLASHING)) for i, t in ODD]
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(
        rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}"
    )


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
