"""Shared by the tests of this folder."""

import pytest
from pyspark.sql import functions as F

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """``documents([text, ...])`` or ``documents([(id, text), ...])`` as the table."""
    def make(texts, langs=None, extra=None):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        langs = langs or [None] * len(rows)
        df = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for (i, t), lang in zip(rows, langs)], SCHEMA)
        for name in extra or []:
            df = df.withColumn(name, F.lit(7))
        return df
    return make
