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


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) pairs, or from (doc_id, text, lang, source)."""

    def make(rows, extra=None):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name, column in (extra or {}).items():
            df = df.withColumn(name, column)
        return df

    return make


@pytest.fixture
def stored(spark, tmp_path):
    """Write tables into a folder and return it: what a registered query takes."""

    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
