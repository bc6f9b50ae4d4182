"""The event table laid out by user, so that per-user work needs no shuffle.

Rows are bucketed by ``(user_id, slot)``. Ordinary users have slot -1. A user
with more than ``min_hot_rows`` rows would fill one bucket, and a bucket is one
task; such users (found in a sample, so there are few) are dealt over ``SLOTS``
slots by event id. Per-user results are then formed per ``(user_id, slot)``, and the
few slots of hot users are combined on the side.

File count: every append writes one file a bucket and month, as rows are dealt to
their buckets before the write. ``buckets_for`` sizes buckets by bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.joins import MAX_BROADCAST_BYTES
from clickweave.operators.sequence import DEFAULT_MIN_HOT_ROWS, DEFAULT_SAMPLE_FRACTION, DEFAULT_SEED
from clickweave.plans.library import label_new_returning, summary_new_returning
from clickweave.session import stored

#: Slots of a hot user, bytes of a bucket of one month, partition columns.
SLOTS = 64
BUCKET_BYTES = 256 << 20
MONTH = ["year", "month"]
ORDINARY = -1


def buckets_for(month_bytes: int, at_least: int = 8) -> int:
    """Buckets so that one file of a month holds about ``BUCKET_BYTES``."""
    return max(at_least, math.ceil(month_bytes / BUCKET_BYTES))


def checked(side: DataFrame, row_bytes: int) -> DataFrame:
    """A stored side, marked for broadcast when its measured size allows."""
    return F.broadcast(side) if side.count() * row_bytes <= MAX_BROADCAST_BYTES else side


def with_slot(curated: DataFrame, known: DataFrame | None = None, *, sample_fraction: float = DEFAULT_SAMPLE_FRACTION,
              min_hot_rows: int = DEFAULT_MIN_HOT_ROWS, seed: int = DEFAULT_SEED) -> DataFrame:
    """``curated`` with ``slot``. ``known``: users that are spread already."""
    some = curated.sample(fraction=sample_fraction, seed=seed).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    hot = some.where(F.col("n") >= min_hot_rows * sample_fraction).select(F.col("user_id").alias("_hot"))
    if known is not None:
        hot = hot.unionByName(known.select(F.col("user_id").alias("_hot"))).distinct()
    side = checked(stored(hot, "hot-users"), 64)
    return (curated.join(side, F.col("user_id") == F.col("_hot"), "left")
            .withColumn("slot", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("event_id"), F.lit(SLOTS)).cast("int"))
                        .otherwise(ORDINARY)).drop("_hot"))


def append_by_user(curated: DataFrame, name: str, location: str, buckets: int, **hot) -> None:
    """Append rows to the bucketed table ``name`` at ``location`` (made when it
    does not exist). Its buckets are those it was made with."""
    spark = curated.sparkSession
    known = None
    if spark.catalog.tableExists(name):
        known = spark.table(name).where(F.col("slot") != ORDINARY).select("user_id").distinct()
    rows = with_slot(curated, known, **hot)
    (rows.repartition(buckets, "user_id", "slot").write.mode("append").format("parquet").option("path", location)
     .partitionBy(*MONTH).bucketBy(buckets, "user_id", "slot").sortBy("user_id", "slot").saveAsTable(name))


def first_times(table: DataFrame) -> DataFrame:
    """(user_id, slot, earliest): the user's earliest time, known in each of its
    slots. Rows of a user that became hot later lie in the ordinary slot too."""
    slots = table.groupBy("user_id", "slot").agg(F.min("timestamp").alias("_own"))
    spread = table.where(F.col("slot") != ORDINARY).select(F.col("user_id").alias("_h")).distinct()
    spread = checked(stored(spread, "spread-users"), 64)
    combined = (slots.join(spread, F.col("user_id") == F.col("_h")).groupBy("_h").agg(F.min("_own").alias("_all")))
    combined = checked(stored(combined, "spread-first"), 96)
    return (slots.join(combined, F.col("user_id") == F.col("_h"), "left")
            .select(F.col("user_id").alias("_fu"), F.col("slot").alias("_fs"), F.coalesce("_all", "_own").alias("earliest")))


def q11_by_user(spark: SparkSession, name: str) -> DataFrame:
    """q11 (new against returning) on the layout by user: the events meet their
    user's first time bucket by bucket."""
    table = spark.table(name)
    event = table.alias("event")
    joined = event.join(first_times(table), (F.col("event.user_id") == F.col("_fu")) & (F.col("event.slot") == F.col("_fs")))
    return summary_new_returning(label_new_returning(joined))
