import pytest
from pyspark.sql import functions as F


@pytest.fixture
def clash():
    """Adds columns whose names operators use inside."""

    def add(df):
        for name in ("a", "b", "group", "key", "text2", "form", "root", "n", "v", "x", "field", "shard", "container", "tokens", "lang", "unit", "score"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit("clash"))
        return df

    return add
