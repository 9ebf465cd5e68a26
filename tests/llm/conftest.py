import random

import pytest
from llm_fixtures import CLASHING, prose
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, extra=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in zip(ids, texts)]
        schema = DOCUMENTS
        if extra:  # more columns, whatever their names
            rows = [(*r, *([x] * len(extra))) for r, x in zip(rows, range(len(rows)))]
            schema = T.StructType([*DOCUMENTS.fields, *[T.StructField(c, T.LongType()) for c in extra]])
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty, long and repeated texts, ties, repeated rows, clashing columns."""
    rng = random.Random(5)
    a, b = prose(rng, 120), prose(rng, 90)
    long = " ".join(prose(rng, 400) for _ in range(60))
    texts = [a, a, a, b, b + "!", None, None, "", " \n\t", "x", "één twee", long, long, "a" * 3000, "ab " * 900, a, b]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 2, None]
    return make_docs(texts, ids, CLASHING)


@pytest.fixture(scope="session")
def rows_of():
    def rows(df):
        return [r.asDict(recursive=True) for r in df.collect()]

    return rows


@pytest.fixture(scope="session")
def texts_of():
    def texts(df):
        return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]

    return texts
