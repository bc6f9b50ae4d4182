"""Fixtures over the sample documents."""

import pytest
from samples import SCHEMA, rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with columns named like results and internals."""
    from pyspark.sql import functions as F
    names = ["size", "target", "copies", "slot", "shard", "score", "ids", "h", "sid", "n", "_m_id", "_c_text", "_j_id", "label",
             "n_tokens", "row", "part", "place", "toxic_score", "quality", "c0", "_id", "text_hash", "doc"]
    return docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
