import pytest
from pyspark.sql import types as T

# Columns that operators make or use inside: an input that has them must not confuse anything.
CLASHING = ("n_words", "score", "spans", "name", "keys", "text_hash", "k", "t", "range", "ids", "tokens", "first", "label")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with further columns of clashing names."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in CLASHING]])

    def build(pairs):
        rows = [(i, t, None, None, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in pairs]
        return spark.createDataFrame(rows, schema)

    return build


LONG = "word " * 30_000
ODD = [(None, "secret words without a key stand here and here again for good"), (1, None), (2, ""), (3, " \t\n "), (4, "é"),
       (5, LONG), (6, "one two three"), (6, "one two three"), (7, "one two three"), (6, "another text of the same key")]


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Null key and text, empty and blank texts, a very long text, repeated rows, one key with two texts."""
    return docs_of(ODD)
