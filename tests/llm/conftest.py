import pytest
from pyspark.sql import functions as F

#: Columns whose names the operators use inside.
CLASHES = ["id", "key", "text_a", "marks", "n_removed", "digest", "nth", "rank", "size", "bucket", "band", "row", "rep", "class_id", "tox_score", "tox_predicted", "m_key", "m_own", "m_copy", "copy", "words", "place", "range", "score", "n", "weight", "vector", "list", "share", "host", "path", "keys", "rule", "verdict", "blocks", "print", "stream"]


@pytest.fixture
def clashing():
    """Adds columns with clashing names."""
    return lambda df: df.select("*", *(F.lit(f"clash-{c}").alias(c) for c in CLASHES if c not in df.columns))


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text[, source])."""

    def make(*rows):
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")

    return make
