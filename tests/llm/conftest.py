import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs(spark):
    """Makes a documents table, with a column whose name clashes with one the operators use, over three partitions."""
    def make(rows, extra=True):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if extra:
            for name in ("key", "chunk", "shard", "fingerprint", "spans", "kind", "n_words", "ids", "score"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df
    return make


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"
