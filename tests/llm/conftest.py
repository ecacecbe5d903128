import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a table with extra columns whose names clash with the operators' own."""
    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        extra = {c: F.lit(None).cast("string") for c in ("class", "node", "value", "part", "seq", "rank", "filter", "vector", "kind", "base", "terms",
                                                         "score", "component", "length", "offset", "bucket", "_words", "_key", "rule") if c not in df.columns}
        return df.withColumns(extra)

    return make
