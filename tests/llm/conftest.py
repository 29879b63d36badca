from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use for columns of their own.
CLASHES = "rep key band u v component_id component mark line row digest start end place edge kept n_lines n_dropped score label target rank".split()


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a ``documents`` table from (id, text) pairs, with extra columns of clashing names."""

    def make(pairs):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(k, t, "en", "src", len(t) if t is not None else None) for k, t in pairs], DOCS)
        return df.withColumns({c: F.lit("x") for c in CLASHES})

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a long one, ties and repeated rows."""
    long_text = " ".join(f"word{k % 977} of{k % 13}" for k in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, long_text), (5, "one two three"), (6, "one two three"), (6, "one two three"), (None, "one two three"), (7, "🙂 \x00 é é <|endoftext|>"), (-8, "x")]
