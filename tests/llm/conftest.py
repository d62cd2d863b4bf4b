import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "a", 35), (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
            (2, None, "en", None, None), (3, "", None, "a", 0), (None, "alpha beta gamma delta epsilon zeta", "en", "b", 35),
            (4, long_text, "de", "b", len(long_text)), (5, long_text, "de", None, len(long_text)), (6, "...\n\t ", "fr", "c", 6), (7, "word", "fr", "c", 4)]
    df = spark.createDataFrame(rows, docs_schema)
    from pyspark.sql import functions as F

    for name in ("score", "n_words", "items", "spans", "base", "key", "size", "_text", "rank", "k1", "cell", "did"):
        df = df.withColumn(name, F.lit("x"))
    return df
