import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # columns whose names clash with those of the operators
        T.StructField("score", T.StringType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("class", T.StringType()),
    ]
)
WORDS = "the quick brown fox jumps over a lazy dog while nine old owls watch from the tall oak near our red barn".split()


def rows(texts):
    return [(i, t, "en", "s", len(t or ""), "x", "x", "x", "x") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def corpus(spark):
    base = " ".join(WORDS * 4)
    texts = [None, "", "   \n\t", "one", "One", "two words here", base, base, base + " tail", base.replace("owls", "cats", 1), base * 200, "ünïcode ähm " * 30, "12345 !!!", "a@b.example.org +1 (555) 010-9999 x 10.0.0.1 x 4111 1111 1111 1111"]
    data = rows(texts) + [(None, base, None, None, None, None, None, None, None), (6, base, "en", "s", 1, "x", "x", "x", "x")]
    return spark.createDataFrame(data, DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
