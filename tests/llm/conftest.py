import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def make(spark):
    """Documents from texts: ids from 0, or (id, text) pairs."""

    def build(texts, **extra):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in pairs], DOCS)
        from pyspark.sql import functions as F

        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return build
