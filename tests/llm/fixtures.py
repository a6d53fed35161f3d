"""Fixtures that the test modules of this folder import."""

from __future__ import annotations

import os

import pytest

SF = os.environ.get("LLM_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def texts(spark):
    """Documents with clashing extra columns from a list of ``(doc_id, text)``."""

    def build(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, key long, score double, band string"
        full = [(i, t, "en", f"src{(i or 0) % 2}", None, 1, 0.5, "x") for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return build
