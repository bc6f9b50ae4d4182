"""Memory of one task: runs of roll-up, ledger and session positions are cut into
tasks by ``small_tasks``, whatever their compressed size."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from clickweave import session
from clickweave.operators.event_ledger import EventLedger
from clickweave.operators.rollup import DayRollup, quality_counters
from clickweave.operators.session_runs import SessionRuns

SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture
def tiny(monkeypatch):
    """Task sizes that a test's rows reach."""
    monkeypatch.setattr(session, "SMALL_TASKS", {
        SIZE: "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.files.maxPartitionBytes": "1m"})


def files(spark, before, name):
    """Files of the newest stored frame of a name, with rows."""
    new = sorted(set(glob.glob(os.path.join(session.work_dir(spark), f"{name}-*"))) - before, key=os.path.getmtime)
    return [n for n in (spark.read.parquet(f).count() for f in glob.glob(os.path.join(new[0], "*.parquet"))) if n]


def events(spark, n):
    k = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("evt_"), k).alias("event_id"), F.concat(F.lit("user_"), k % 5000).alias("user_id"), F.concat(F.lit("s_"), k % 9000).alias("session_id"),
        F.lit("p").alias("product_id"), F.lit(1.0).alias("price"), F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lpad((k % 3 + 1).cast("string"), 2, "0").alias("day"))


def test_settings_come_back(spark):
    before = spark.conf.get(SIZE)
    with pytest.raises(ValueError), session.small_tasks(spark):
        assert spark.conf.get(SIZE) == session.SMALL_TASKS[SIZE]
        raise ValueError
    assert spark.conf.get(SIZE) == before


def test_rollup_takes_values_in_by_small_tasks(spark, tmp_dir, tiny):
    old = set(glob.glob(os.path.join(session.work_dir(spark), "*")))
    roll = DayRollup(spark, tmp_dir)
    for run in ("a", "b", "b"):
        roll.add(events(spark, 60_000 if run == "a" else 70_000), run)
    for name in ("rollup-values", "rollup-fresh"):  # one task held all of them
        rows = files(spark, old, name)
        assert len(rows) > 1 and max(rows) < 0.6 * sum(rows)
    assert tuple(quality_counters(roll.days()).first())[:5] == (130_000, 70_000, 60_000, 5000, 9000)
    numbers = roll.numbers().groupBy("kind").agg(F.count("number"), F.count_distinct("number"), F.max("number") + 1).collect()
    assert {tuple(r) for r in numbers} == {("event_id", 70_000, 70_000, 70_000), ("user_id", 5000, 5000, 5000), ("session_id", 9000, 9000, 9000)}


def test_ledger_takes_ids_in_by_small_tasks(spark, tmp_dir, tiny):
    old = set(glob.glob(os.path.join(session.work_dir(spark), "*")))
    ledger, rows = EventLedger(spark, tmp_dir, 2, 40), events(spark, 60_000)
    first = ledger.fresh(rows, 1)
    ledger.commit(first, 1)
    assert first.count() == 60_000 and ledger.fresh(events(spark, 70_000), 2).count() == 10_000
    for name in ("landed-new", "ledger-ids"):
        sizes = files(spark, old, name)
        assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
    assert ledger._read("ids", "event_id string, bucket int, run long").count() == 60_000


def test_sessions_begin_by_small_tasks(spark, tmp_dir, tiny):
    old = set(glob.glob(os.path.join(session.work_dir(spark), "*")))
    runs = SessionRuns(spark, tmp_dir, "small_tasks", f"t{os.path.basename(tmp_dir).split('-')[-1].lower()}", 4)
    stamp, time = F.timestamp_seconds(F.lit(1_706_745_600)), F.lit("2024-01-01T00:00:00.000Z")
    rows = events(spark, 60_000).withColumns({"timestamp": time, "processed_timestamp": stamp, "event_sequence": F.lit(1), "is_session_start": F.lit(True)})
    assert runs.begin(rows, None).count() == 60_000
    sizes = files(spark, old, "run-sessions")
    assert len(sizes) > 1 and sum(sizes) == 9000


def test_ledger_never_broadcasts_the_places_of_ids(spark, tmp_dir):
    for stretches, join in ((8, "BroadcastHashJoin"), (4000, "SortMergeJoin")):
        ledger = EventLedger(spark, os.path.join(tmp_dir, join), 8, stretches)
        plan = ledger.suspects(events(spark, 100).select("event_id"))._jdf.queryExecution().sparkPlan().toString()
        assert join in plan and "BuildLeft" not in plan
