import pytest
from llm_cases import SF
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """documents of the smallest size."""
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").cache()


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text) pairs."""
    def build(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "src", len(t) if t else None) for i, t in rows], DOCS)
    return build
