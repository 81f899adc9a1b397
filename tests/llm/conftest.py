"""Frames with the awkward rows that every operator must stand."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     # names that operators use inside
                     T.StructField("row", T.StringType()), T.StructField("hash", T.LongType()), T.StructField("node", T.StringType()),
                     T.StructField("score", T.DoubleType()), T.StructField("th", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (doc_id, text) pairs, with clashing columns."""
    def make(rows):
        return spark.createDataFrame([(i, t, "r", 1, "n", 0.5, 2) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def awkward(docs_of):
    """Null id, null and empty text, white space, a long text, equal rows, equal texts."""
    long = " ".join(f"word{i % 997} of{i}" for i in range(20_000))
    return docs_of([(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "one two three four five six"), (5, "one two three four five six"),
                    (6, "one two three four five six"), (None, "a text without an id is a text too"), (None, None), (7, "x")])


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def collected():
    return plain
