from __future__ import annotations

import pytest


@pytest.fixture
def rows(spark):
    """Small documents: nulls, empty and long texts, repeated rows, clashing columns."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        data = [(i, t, "en", "s", len(t or ""), 7, "x") for i, t in zip(ids, texts, strict=True)]
        kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, row string"
        return spark.createDataFrame(data, kind)

    return make
