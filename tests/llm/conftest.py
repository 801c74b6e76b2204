import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) with columns whose names operators use inside, and nulls in them."""

    def build(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("version", "key", "fp", "hash", "at", "spans", "removed", "scores", "log_ratio", "words", "`a.b`"):
            df = df.withColumn(name.strip("`"), F.lit(None).cast("string"))
        return df

    return build
