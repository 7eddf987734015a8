import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture()
def documents(spark):
    """Make documents from texts or (text, lang, source, id); ids are the places from 0 else."""
    def make(rows, extra=None):
        full = []
        for i, r in enumerate(rows):
            text, lang, source, doc_id = (*r, *(None, None, i)[len(r) - 1:]) if isinstance(r, tuple) else (r, None, None, i)
            full.append((doc_id, text, lang, source, len(text or "")))
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in extra or ():  # columns whose names the operators might use
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
