"""The documents fixture of these tests."""

from __future__ import annotations

import pytest

#: Column types of documents in the small fixtures.
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text[, source]) tuples, with clashing extra columns."""
    def build(*rows, extra: str = ""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in extra.split():
            df = df.selectExpr("*", f"'kept' AS `{name}`")
        return df

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]
