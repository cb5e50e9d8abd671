import os

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang, source), with further columns if asked for."""

    def make(rows, **more):
        full = [(r[0], r[1], *(tuple(r[2:4]) or ("en", "s")), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        for name, kind in more.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(None).cast(kind))
        return df

    return make


def tables(name):
    folder = f"/root/testdata/{name}"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder


@pytest.fixture(scope="session")
def sf():
    return tables("sf0.001")


@pytest.fixture(scope="session")
def larger():
    return tables("sf0.01")
