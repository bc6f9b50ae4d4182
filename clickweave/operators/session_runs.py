"""Session positions that go on from run to run.

A run numbers its own rows (``operators.sequence``). So that a session crossing
runs keeps counting, and late events move only what follows them, two small
tables lie beside the event table:

* ``counts``: per run and session, how many rows the run added and the last
  ``(time, event_id)`` among them. It is partitioned by run and bucketed by session, so
  the totals of all sessions are summed without a shuffle. A run is part of the
  table once its counts are there; they are written last.
* ``shifts``: per run, the stored rows that its late events pushed on: ``(session,
  time, event_id)`` and by how much. Readers add the shifts of later runs to the number a row
  was stored with; no event file is ever rewritten.

A run's rows of a session that begin after all its earlier rows take the
session's total as offset. Sessions with late rows are worked out on keys alone:
the stored keys from the first late day on (older partitions are pruned) and the
run's keys, summed up in order per session - split for hot sessions. Rows of
equal time and id stand in the order of their runs.

Events without a session are numbered per run, as they share no session. Both
tables are written by replacing the run's partition, so a repeated attempt of a
run with the same stamp leaves no trace of the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions import parse_event_time
from clickweave.operators.sequence import running_sums, session_start
from clickweave.session import small_tasks, stored

#: Buckets of the counts; a few times the cores of a cluster.
DEFAULT_BUCKETS = 64
_KEY = ["session_id", "_t", "event_id"]
_SHIFTS = "session_id STRING, _t TIMESTAMP, event_id STRING, shift BIGINT"


def _place() -> Column:
    """A row's place in its session: NULL times first."""
    return F.struct(F.col("_t").alias("t"), F.col("event_id").alias("k"))


class SessionRuns:
    """Session totals and shifts of one event table, under ``root``; the catalog
    names are ``<database>.<name>_counts`` and ``_shifts``."""

    def __init__(self, spark: SparkSession, root: str, database: str, name: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.counts, self.shifts = spark, f"{database}.{name}_counts", f"{database}.{name}_shifts"
        self.buckets, self._pending = buckets, None
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for table, columns, layout in (
                (self.counts, "session_id STRING, added BIGINT, last STRUCT<t: TIMESTAMP, k: STRING>",
                 f"CLUSTERED BY (session_id) INTO {buckets} BUCKETS"),
                (self.shifts, _SHIFTS, "")):
            new, place = not spark.catalog.tableExists(table), f"{root}/{table.rsplit('.', 1)[1]}"
            if new:  # the folder must exist; its runs are found again by a repair
                spark.createDataFrame([], f"{columns.replace(': ', ':')}, run BIGINT").write.mode("append").partitionBy("run").parquet(place)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, run BIGINT) USING parquet PARTITIONED BY (run) {layout} "
                      f"LOCATION '{place}'")
            if new:
                spark.sql(f"MSCK REPAIR TABLE {table}")

    def _replace(self, rows: DataFrame, table: str, run: int) -> None:
        """Write a run's rows of a table, in place of an earlier attempt's."""
        spec = f"PARTITION (run={run})"
        rows.createOrReplaceTempView("_session_runs_rows")
        self.spark.sql(f"INSERT OVERWRITE TABLE {table} {spec} SELECT * FROM _session_runs_rows")
        self.spark.catalog.dropTempView("_session_runs_rows")

    def totals(self, but: int | None = None) -> DataFrame:
        """Per session: rows so far and last place. No shuffle: buckets of all
        runs are read together."""
        t = self.spark.table(self.counts)
        t = t if but is None else t.where(F.col("run") != but)
        return t.groupBy("session_id").agg(F.sum("added").alias("total"), F.max("last").alias("last"))

    def begin(self, rows: DataFrame, earlier: DataFrame | None, **split) -> DataFrame:
        """``rows``: the curated rows of one run, numbered within it. Returns them
        numbered from their session's earlier rows on and stores the shifts of
        what was there (``earlier``: the table before the run). ``commit`` makes the
        run part of the table; call it when the rows are written. ``split``: the
        hot-key options of ``running_sums``. Small tasks keep all cores busy."""
        with small_tasks(self.spark):
            return self._begin(rows, earlier, split)

    def _begin(self, rows: DataFrame, earlier: DataFrame | None, split: dict) -> DataFrame:
        rows = stored(rows.withColumn("_t", parse_event_time("timestamp")), "run-rows")
        run = rows.agg(F.max(F.unix_micros("processed_timestamp"))).first()[0]
        if run is None:  # no rows
            self._pending = None
            return rows.drop("_t")
        touched = stored(rows.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
            F.count(F.lit(1)).alias("added"), F.min(_place()).alias("first"), F.max(_place()).alias("last")), "run-sessions")
        self._pending = (run, touched.select("session_id", "added", "last"))
        known = stored(touched.join(self.totals(but=run).withColumnRenamed("last", "until"), "session_id")
                       .select("session_id", "first", "total", (F.col("first") < F.col("until")).alias("late")), "run-known")
        plain = known.where(~F.col("late")).select("session_id", F.col("total").alias("_ahead"))
        late = known.where("late").select("session_id", "total", "first")
        if late.isEmpty():
            self._replace(self.spark.createDataFrame([], _SHIFTS), self.shifts, run)
            placed = rows.join(plain, "session_id", "left")
        elif earlier is None:
            raise ValueError("late rows of known sessions, but no table of earlier rows")
        else:
            keys = self._late_keys(rows, late, earlier.where(F.unix_micros("processed_timestamp") != run), split)
            moved = keys.where((F.col("old") > 0) & (F.col("new_before") > 0))
            self._replace(moved.select(*_KEY, F.col("new_before").alias("shift")), self.shifts, run)
            ahead = keys.where("new > 0").select(F.col("session_id").alias("_s"), F.col("_t").alias("_u"), F.col("event_id").alias("_e"), "_ahead")
            same = (F.col("session_id") == F.col("_s")) & F.col("_t").eqNullSafe(F.col("_u")) & (F.col("event_id") == F.col("_e"))
            behind = rows.join(late.select("session_id"), "session_id", "left_semi").join(ahead, same).drop("_s", "_u", "_e")
            rest = rows.join(late.select("session_id"), "session_id", "left_anti").join(plain, "session_id", "left")
            placed = rest.select(*rows.columns, "_ahead").unionByName(behind.select(*rows.columns, "_ahead"))
        number = (F.col("event_sequence") + F.coalesce("_ahead", F.lit(0))).cast("int")
        return (placed.withColumn("event_sequence", number).withColumn("is_session_start", session_start("event_sequence"))
                .select(*[c for c in rows.columns if c != "_t"]))

    def _late_keys(self, rows: DataFrame, late: DataFrame, earlier: DataFrame, split: dict) -> DataFrame:
        """Per place in a session with late rows: stored rows (``old``) and rows of
        the run (``new``) there, rows of the run before it (``new_before``) and stored
        rows up to it (``_ahead``)."""
        first = late.agg(F.min(F.struct(F.col("first.t").alias("t")))["t"].alias("t")).select(F.date_format("t", "yyyy-MM-dd")).first()[0]
        if first is not None:  # partitions of earlier days hold nothing that moves
            earlier = earlier.where(F.concat_ws("-", "year", "month", "day") >= F.lit(first)).where(F.col("year").isNotNull())
        old = earlier.withColumn("_t", parse_event_time("timestamp")).select(*_KEY, F.lit(1).alias("old"), F.lit(0).alias("new"))
        new = rows.select(*_KEY, F.lit(0).alias("old"), F.lit(1).alias("new"))
        keys = (old.unionByName(new).join(late.select("session_id"), "session_id", "left_semi")
                .groupBy(*_KEY).agg(F.sum("old").alias("old"), F.sum("new").alias("new")))
        keys = stored(keys, "run-late-keys")
        seen = keys.groupBy("session_id").agg(F.sum("old").alias("_seen"))
        before = late.join(seen, "session_id").select("session_id", (F.col("total") - F.col("_seen")).alias("_unseen"))
        summed = running_sums(keys, "session_id", "_t", "event_id", {"_old": "old", "_new": "new"}, **split)
        return stored(summed.join(before, "session_id").select(
            *_KEY, "old", "new", (F.col("_new") - F.col("new")).alias("new_before"), (F.col("_unseen") + F.col("_old")).alias("_ahead")), "run-late")

    def commit(self) -> None:
        """Store the session counts of the run begun last."""
        if self._pending:
            run, touched = self._pending
            self._replace(touched.repartition(self.buckets, "session_id"), self.counts, run)
            self._pending = None

    def read(self, table: DataFrame) -> DataFrame:
        """The event table with positions as one window over all its runs gives
        them (events without a session: as their run gave them)."""
        done = self.spark.sql(f"SHOW PARTITIONS {self.counts}").select(F.split("partition", "=")[1].cast("long").alias("run"))
        moved = (self.spark.table(self.shifts).join(F.broadcast(done), "run", "left_semi")
                 .groupBy(*_KEY).agg(F.collect_list(F.struct("run", "shift")).alias("_moves")))
        moved = moved.select(F.col("session_id").alias("_s"), F.col("_t").alias("_u"), F.col("event_id").alias("_e"), "_moves")
        rows = table.withColumn("_t", parse_event_time("timestamp"))
        same = (F.col("session_id") == F.col("_s")) & F.col("_t").eqNullSafe(F.col("_u")) & (F.col("event_id") == F.col("_e"))
        later = F.filter("_moves", lambda m: m["run"] > F.unix_micros("processed_timestamp"))
        shift = F.coalesce(F.aggregate(later, F.lit(0).cast("long"), lambda n, m: n + m["shift"]), F.lit(0))
        return (rows.join(moved, same, "left").withColumn("event_sequence", (F.col("event_sequence") + shift).cast("int"))
                .withColumn("is_session_start", session_start("event_sequence")).select(*table.columns))
