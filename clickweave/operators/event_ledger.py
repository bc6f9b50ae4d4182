"""Events that an earlier run has stored add nothing.

The ids of stored events are kept in hash buckets (``ids``, one folder a bucket and
run). In front of them stands a Bloom filter a bucket (``filters``): bitmaps of
32,768 bits each, built and merged by the built-in bitmap aggregates. A run's
ids are held against the filters first: for new events, nearly all ids end there
and the stored ids are not read. The few that all their bits let through are
looked up exactly, in their own buckets only, so a false alarm never drops an event.

A run is known by its number (its time stamp). Its own ids never count as seen, so
a run that failed half-way can be repeated; ids and filters are written by
replacing partitions, last of all the run's output. Ids are looked up and taken in by
small tasks (``session.small_tasks``): a task's memory does not grow with a run.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.joins import MAX_BROADCAST_BYTES
from clickweave.session import small_tasks, stored

#: Bits of one bitmap, hashes an id, default buckets and bitmaps a bucket (so
#: 10 bits an id hold about a million ids a bucket).
STRETCH, HASHES = 32_768, 4
DEFAULT_BUCKETS, DEFAULT_STRETCHES = 256, 320
_IDS = "event_id string, bucket int, run long"
_FILTERS = "stretch int, bits binary, bucket int"


class EventLedger:
    """Ids of stored events under ``root``. ``buckets`` and ``stretches`` (bitmaps
    a bucket) are fixed for the life of a ledger."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS, stretches: int = DEFAULT_STRETCHES):
        self.spark, self.root, self.buckets, self.stretches = spark, root, buckets, stretches

    def _read(self, name: str, schema: str) -> DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        try:
            return self.spark.read.schema(schema).parquet(os.path.join(self.root, name)).select(*names)
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _bits(self, ids: DataFrame) -> DataFrame:
        """(event_id, bucket, stretch, bit): the places of each id."""
        size = self.stretches * STRETCH
        places = F.array(*[F.pmod(F.xxhash64("event_id", F.lit(k + 1)), F.lit(size)) for k in range(HASHES)])
        each = ids.select("event_id", self._bucket(), F.explode(places).alias("place"))
        return each.select("event_id", "bucket", F.floor(F.col("place") / STRETCH).cast("int").alias("stretch"), (F.col("place") % STRETCH).alias("bit"))

    def suspects(self, ids: DataFrame) -> DataFrame:
        """Ids whose bits are all set in their bucket's filter."""
        byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
        hit = byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
        filters = self._read("filters", _FILTERS)
        # sized here: by the compressed size of the ids, all their places would be broadcast
        small = self.buckets * self.stretches * STRETCH // 8 <= MAX_BROADCAST_BYTES
        asked = self._bits(ids).join(filters.hint("broadcast" if small else "merge"), ["bucket", "stretch"])
        return asked.where(hit).groupBy("event_id", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES).select("event_id", "bucket")

    def fresh(self, rows: DataFrame, run: int) -> DataFrame:
        """``rows`` without those whose ``event_id`` an earlier run stored; of rows
        that repeat an id within the run, one stays. Rows without an id pass. The rows
        are stored."""
        with small_tasks(self.spark):
            return stored(self._fresh(rows, run), "landed-new")

    def _fresh(self, rows: DataFrame, run: int) -> DataFrame:
        ids = rows.where(F.col("event_id").isNotNull()).select("event_id").distinct()
        doubt = stored(self.suspects(ids), "ledger-doubt")
        some = doubt.count()
        side = F.broadcast(doubt) if some * 64 <= MAX_BROADCAST_BYTES else doubt
        seen = self._read("ids", _IDS).where(F.col("run") != run).join(side, ["bucket", "event_id"], "left_semi").select("event_id").distinct()
        left = rows if not some else rows.join(stored(seen, "ledger-seen"), "event_id", "left_anti").select(*rows.columns)
        # one row an id, chosen before the shuffle too: an id sent a million times is one row a task
        order = F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith("map")])
        one = left.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(F.min_by(F.struct(*rows.columns), order).alias("_row"))
        return one.select("_row.*").unionByName(left.where(F.col("event_id").isNull()))

    def commit(self, rows: DataFrame, run: int) -> None:
        """Take in the ids of the rows that a run has stored."""
        with small_tasks(self.spark):
            self._commit(rows, run)

    def _commit(self, rows: DataFrame, run: int) -> None:
        ids = stored(rows.where(F.col("event_id").isNotNull()).select("event_id").distinct(), "ledger-ids")
        new = self._bits(ids).groupBy("bucket", "stretch").agg(F.bitmap_construct_agg("bit").alias("bits")).select("stretch", "bits", "bucket")
        new = stored(new, "ledger-new")
        touched = new.select("bucket").distinct()
        old = self._read("filters", _FILTERS).join(F.broadcast(touched), "bucket", "left_semi").select("stretch", "bits", "bucket")
        both = stored(old.unionByName(new).groupBy("bucket", "stretch").agg(F.bitmap_or_agg("bits").alias("bits")), "ledger-filters")
        (both.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket")
         .parquet(os.path.join(self.root, "filters")))
        (ids.select("event_id", self._bucket(), F.lit(run).alias("run")).hint("rebalance", "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "run").parquet(os.path.join(self.root, "ids")))
