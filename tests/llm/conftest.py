import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


#: Null, empty, blank, punctuation alone, one word, ties and repeated rows, a long text.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "?!"), (5, "word"), (6, "word"), (6, "word"), (None, "word"), (None, None),
    (7, "Ünïcödé ça va 漢字 😀"), (8, "long " * 20_000), (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])
