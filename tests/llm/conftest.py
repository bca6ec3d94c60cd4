import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("doc", T.StringType()), T.StructField("h", T.StringType()),
                     T.StructField("n_words", T.StringType())])


@pytest.fixture
def docs(spark):
    """Documents with extra columns whose names the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", None, "y") for i, t in rows], DOCS)
    return make
