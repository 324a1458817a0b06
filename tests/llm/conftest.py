import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Frame of documents from (doc_id, text, source) tuples."""

    def make(rows, parts=3):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def words():
    """Deterministic pseudo-words."""

    def make(n, seed=0):
        x, out = seed * 7919 + 13, []
        for _ in range(n):
            x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            out.append("".join("abcdefghijklmnopqrstuvwxyz"[(x >> k) % 26] for k in (11, 23, 37, 49)))
        return out

    return make
