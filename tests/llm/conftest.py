import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names clash with the operators' own."""
    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if clash:
            for name in ("uid", "sha", "key", "fp", "size", "place", "score", "spans", "cluster", "block", "shingle"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
