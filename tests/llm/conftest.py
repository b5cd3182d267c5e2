import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("hits", T.StringType()), T.StructField("rank", T.IntegerType())])  # two extra, clashing names


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text[, source]); with nulls and extra columns."""
    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, "x", 7) for r in rows], DOCUMENT)
    return make


@pytest.fixture
def odd(documents):
    """Null and empty texts, a long one, null ids, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return documents([(1, None), (2, ""), (3, " \n\t"), (4, long), (None, "one two three"), (5, "one two three"),
                      (5, "one two three"), (6, "one two three", None), (7, "ÄÖ ß é 日本語 \U0001F600")])
