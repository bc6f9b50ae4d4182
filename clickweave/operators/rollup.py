"""Exact distinct counts per day that add up over any days.

COUNT(DISTINCT) of a span of days cannot be had from the days' counts; sets can.
Each value of a column (user, session, event id) gets a dense number from a
dictionary; a day's values are then a bitmap, and the union of days is OR:

* ``numbers``: value -> number, per column; a run's new values follow on from the
  largest number, found by an anti-join on the values alone. Numbers are only ever
  added, so they never change;
* ``days``: per day, column and stretch of 32,768 numbers one bitmap
  (``bitmap_construct_agg``), and per day and run the plain counts.

A run touches the days it has rows of: their bitmaps are OR-ed with the run's, its
counts take the place of an earlier attempt's, and the days' partitions are
replaced; so taking in a run twice changes nothing. Queries read the days table alone, which
is as large as the distinct values of its days, not their events. All of it are
built-in aggregates; hot values are combined before the shuffle. Values are taken in by
small tasks (``session.small_tasks``), so that a task's memory does not grow with a run.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.functions import round2
from clickweave.session import small_tasks, stored
from clickweave.sources.schema import PARTITION_COLUMNS

#: Columns whose distinct values are kept.
VALUES = ["event_id", "user_id", "session_id"]
#: Plain per-day counts: name and summed expression.
COUNTS = {"events": "1", "missing_product_id": "if(product_id IS NULL, 1, 0)", "missing_price": "if(price IS NULL, 1, 0)"}
_DAYS = "kind string, stretch long, run string, bits binary, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} string" for c in PARTITION_COLUMNS)
_NUMBERS = "value string, number long, kind string"


class DayRollup:
    """The roll-up tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _read(self, name: str, schema: str) -> DataFrame:
        path = os.path.join(self.root, name)
        try:
            return self.spark.read.schema(schema).parquet(path).select(*[c.split()[0] for c in schema.split(", ")])
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def numbers(self) -> DataFrame:
        return self._read("numbers", _NUMBERS)

    def days(self) -> DataFrame:
        return self._read("days", _DAYS)

    def add(self, rows: DataFrame, run: str) -> None:
        """Take in the rows of the run named ``run``."""
        with small_tasks(self.spark):
            self._add(rows, run)

    def _add(self, rows: DataFrame, run: str) -> None:
        values = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in VALUES])
        seen = stored(rows.select(*PARTITION_COLUMNS, F.inline(values)).where("value IS NOT NULL").distinct(), "rollup-values")
        self._number(seen.select("kind", "value").distinct())
        placed = seen.join(self.numbers().select("kind", "value", "number"), ["kind", "value"])
        bit = (placed.withColumn("stretch", F.bitmap_bucket_number("number"))
               .groupBy(*PARTITION_COLUMNS, "kind", "stretch").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))
        zero = [F.lit(None).cast("long").alias(c) for c in COUNTS]
        plain = rows.groupBy(*PARTITION_COLUMNS).agg(*[F.sum(F.expr(e)).alias(c) for c, e in COUNTS.items()])
        new = bit.select("kind", "stretch", F.lit("").alias("run"), "bits", *zero, *PARTITION_COLUMNS).unionByName(
            plain.select(F.lit("counts").alias("kind"), F.lit(0).cast("long").alias("stretch"), F.lit(run).alias("run"), F.lit(None).cast("binary").alias("bits"), *COUNTS, *PARTITION_COLUMNS))
        new = stored(new, "rollup-new")
        touched = new.select(*PARTITION_COLUMNS).distinct()
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in PARTITION_COLUMNS]
        old = self.days().where(F.col("run") != run).alias("o").join(F.broadcast(touched.alias("t")), same, "left_semi")
        both = stored(old.unionByName(new).groupBy(*PARTITION_COLUMNS, "kind", "stretch", "run").agg(
            F.bitmap_or_agg("bits").alias("bits"), *[F.sum(c).alias(c) for c in COUNTS]), "rollup-days")
        (both.hint("rebalance", *PARTITION_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITION_COLUMNS).parquet(os.path.join(self.root, "days")))

    def _number(self, values: DataFrame) -> None:
        """Give values without a number the next ones of their column."""
        known = self.numbers()
        # dealt by kind and value already: by the distinct values, by the join beyond a broadcast
        fresh = values.join(known, ["kind", "value"], "left_anti")
        placed = stored(fresh.sortWithinPartitions("kind").select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "rollup-fresh")
        if placed.isEmpty():
            return
        parts = placed.groupBy("kind", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        ahead = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = parts.select("kind", "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
        base = known.groupBy("kind").agg(F.max("number").alias("top"))
        starts = starts.join(base, "kind", "left")
        out = placed.join(F.broadcast(starts), ["kind", "part"]).select(  # a row a column and task
            "value", (F.coalesce(F.col("top") + 1, F.lit(0)) + F.col("before") + F.col("at") - F.col("first")).alias("number"), "kind")
        for kind in VALUES:  # one folder at a time: rows need not be sorted by folder
            out.where(F.col("kind") == kind).drop("kind").write.mode("append").parquet(os.path.join(self.root, "numbers", f"kind={kind}"))


def _distinct(days: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: distinct values of every column and the plain counts."""
    stretches = days.groupBy(*keys, "kind", "stretch").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"), *[F.sum(c).alias(c) for c in COUNTS])
    return stretches.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == c, F.col("n"))), F.lit(0)).alias(f"distinct_{c}") for c in VALUES],
        *[F.sum(c).alias(c) for c in COUNTS])


def daily_active_users(days: DataFrame) -> DataFrame:
    """q02 from the roll-up."""
    d = _distinct(days, PARTITION_COLUMNS)
    per = [(F.col("events").cast("double"), F.col(f"distinct_{c}").cast("double")) for c in ("user_id", "session_id")]
    return (d.select(*PARTITION_COLUMNS, F.concat("year", F.lit("-"), "month", F.lit("-"), "day").alias("date"), F.col("distinct_user_id").alias("daily_active_users"),
                     F.col("events").alias("total_events"), F.col("distinct_session_id").alias("total_sessions"),
                     *[round2(F.try_divide(a, b)).alias(f"avg_events_per_{n}") for (a, b), n in zip(per, ("user", "session"))])
            .orderBy(*[F.desc_nulls_last(c) for c in PARTITION_COLUMNS]).limit(30))


def quality_counters(days: DataFrame) -> DataFrame:
    """dq_check from the roll-up."""
    d = _distinct(days, [])
    return d.select(F.col("events").alias("total_records"), F.col("distinct_event_id").alias("unique_events"),
                    (F.col("events") - F.col("distinct_event_id")).alias("duplicate_events"),
                    F.col("distinct_user_id").alias("unique_users"), F.col("distinct_session_id").alias("unique_sessions"),
                    "missing_product_id", "missing_price")


def active_between(days: DataFrame, first: str, last: str) -> DataFrame:
    """Distinct users, sessions and events from day ``first`` to ``last`` (both
    included, ``yyyy-mm-dd``); only these days' partitions are read."""
    day = F.concat_ws("-", *PARTITION_COLUMNS)
    d = _distinct(days.where((day >= first) & (day <= last) & F.col("year").isNotNull()), [])
    return d.select(F.col("distinct_user_id").alias("users"), F.col("distinct_session_id").alias("sessions"),
                    F.coalesce("events", F.lit(0)).alias("events"))
