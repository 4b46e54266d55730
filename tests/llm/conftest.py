"""Small tables shared by the tests of the operators."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture()
def documents(spark):
    """Makes a documents table of (doc_id, text) pairs."""

    def make(pairs, extra=None):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
        frame = spark.createDataFrame(rows, DOCUMENTS)
        for name, value in (extra or {}).items():
            frame = frame.withColumn(name, value)
        return frame

    return make
