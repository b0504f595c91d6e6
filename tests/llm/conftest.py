import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
EDGE_TEXTS = [None, "", " ", "\n", "one", " a  b\n\nc ", "x" * 5000, "tok word. " * 3000, "é ü ß ñ", "a\tb\r\nc",
              "same text here now ok", "same text here now ok"]


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in each column, empty and long texts, repeated rows and ids, columns with clashing names."""
    rows = [(i, t, f"s{i % 2}", "clash") for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "no id", None, None), (3, "\n", "s1", "clash"), (3, "\n", "s1", "clash")]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, length STRING").withColumns(
        {"start": spark_lit("x"), "shard": spark_lit("x"), "score": spark_lit("x"), "n": spark_lit("x")}
    )


def spark_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
