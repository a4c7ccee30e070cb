"""Small tables that every operator has to take."""

import pytest


@pytest.fixture
def docs(spark):
    """Makes documents of (doc_id, text), with further columns whose names clash with the operators' own."""

    def make(rows):
        kinds = "doc_id long, text string, lang string, n_chars long, score double, block int, Spans string, n_bytes string"
        return spark.createDataFrame([(i, t, "en", len(t or ""), 0.5, 1, "s", "b") for i, t in rows], kinds)

    return make


@pytest.fixture
def by_id():
    return lambda df, *cols: {r["doc_id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}
