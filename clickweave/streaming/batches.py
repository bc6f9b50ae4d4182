"""Micro-batch appends that a replay replaces, by Spark's own means.

Each micro-batch owns one value of the partition column ``batch``: the id of its
query (kept in the checkpoint, so another stream or a new checkpoint is another
query) and its batch number. It is written with dynamic partition overwrite,
which replaces just the partitions that the rows name. A batch that is replayed
after a crash - before or after its write or its registration - has the same rows
and key, so it replaces what the first attempt left; no other batch, stream or
run can hold that key. Spark's commit protocol does the staging and deleting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from clickweave.sources.schema import BATCH_COLUMN

QUERY_PROPERTY = "sql.streaming.queryId"


def batch_key(spark: SparkSession, batch_id: int) -> str:
    """Key of a micro-batch ("direct-<n>" outside a streaming query)."""
    return f"{spark.sparkContext.getLocalProperty(QUERY_PROPERTY) or 'direct'}-{batch_id}"


def replacing(df: DataFrame, key: str, partitions: list[str]) -> DataFrameWriter:
    """A writer of ``df`` under ``partitions`` and ``batch=<key>``."""
    return (df.withColumn(BATCH_COLUMN, F.lit(key)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions, BATCH_COLUMN))
