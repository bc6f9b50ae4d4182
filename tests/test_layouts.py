"""Layout by user and the day roll-up against the plain queries."""

import datetime as _dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from clickweave.operators import rollup
from clickweave.plans import library
from clickweave.plans.batch import transform
from clickweave.session import scratch_path
from clickweave.sources import user_layout
from clickweave.sources.schema import RAW_SCHEMA

STAMP = _dt.datetime(2025, 6, 1)
TYPES = ["page_view", "product_view", "add_to_cart", "purchase"]


def _events(spark, seed, n=400, users=12, days=9):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        user = "bot" if r.random() < 0.4 else f"u{r.randrange(users)}"
        rows.append({"event_id": f"e{seed}-{r.randrange(n)}", "user_id": user, "session_id": r.choice([None, f"{user}-{r.randrange(3)}"]),
                     "event_type": r.choice(TYPES), "timestamp": r.choice(["garbage", *[f"2025-0{1 + k % 2}-{1 + k:02d}T0{r.randrange(9)}:00:00Z" for k in range(days)]]),
                     "product_id": r.choice([None, "p"]), "price": r.choice([None, 2.5]), "quantity": 1})
    df = spark.createDataFrame([tuple(x.get(f.name) for f in RAW_SCHEMA.fields) for x in rows], RAW_SCHEMA)
    return transform(df, processed_at=STAMP).cache()


@pytest.mark.parametrize("hot", [{}, {"min_hot_rows": 100, "sample_fraction": 1.0}])
def test_user_layout_equals_q11_without_a_shuffle_of_events(spark, hot):
    name, place = f"t_users_{uuid.uuid4().hex[:8]}", scratch_path(spark, "t-users")
    parts = [_events(spark, s) for s in (1, 2)]
    # the bot becomes hot only with the second append in the hot case
    user_layout.append_by_user(parts[0], name, place, 4)
    user_layout.append_by_user(parts[1], name, place, 4, **hot)
    got = sorted(map(tuple, user_layout.q11_by_user(spark, name).collect()))
    # positions are those of the runs, as stored
    want = sorted(map(tuple, library.q11_new_vs_returning(parts[0].unionByName(parts[1])).collect()))
    assert got == want
    slots = {r.slot for r in spark.table(name).where("user_id = 'bot'").select("slot").distinct().collect()}
    assert (slots == {-1}) if not hot else len(slots) > 10
    df = user_layout.q11_by_user(spark, name)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Bucketed: true") >= 2
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:  # aggregated rows by type, or a side's few rows; never events by user
            assert "(user_id" not in line.split("hashpartitioning")[1], line


def test_user_layout_files_are_counted(spark):
    import glob
    name, place = f"t_users_{uuid.uuid4().hex[:8]}", scratch_path(spark, "t-users-files")
    user_layout.append_by_user(_events(spark, 3).repartition(7), name, place, 4)
    months = glob.glob(f"{place}/year=*/month=*")
    assert len(months) == 3 and all(len(glob.glob(f"{m}/*.parquet")) <= 4 for m in months)
    assert user_layout.buckets_for(1) == 8 and user_layout.buckets_for(100 << 30) == 400


def test_rollup_equals_count_distinct_over_any_days(spark):
    parts, roll = [_events(spark, s) for s in (4, 5, 6)], rollup.DayRollup(spark, scratch_path(spark, "t-roll"))
    assert roll.days().count() == 0
    all_rows = None
    for k, rows in enumerate(parts):
        roll.add(rows, f"run-{k}")
        all_rows = rows if all_rows is None else all_rows.unionByName(rows)
    roll.add(parts[1], "run-1")  # taken in twice: nothing changes
    def same(a, b):
        assert a.columns == b.columns and list(map(tuple, a.collect())) == list(map(tuple, b.collect()))
    same(rollup.daily_active_users(roll.days()), library.q02_daily_active_users(all_rows))
    same(rollup.quality_counters(roll.days()), library.dq_check(all_rows))
    day = F.concat_ws("-", *["year", "month", "day"])
    for first, last in (("2025-01-01", "2025-01-05"), ("2025-01-03", "2025-02-08"), ("2025-03-01", "2025-03-02")):
        want = all_rows.where((day >= first) & (day <= last) & F.col("year").isNotNull()).agg(
            F.count_distinct("user_id"), F.count_distinct("session_id"), F.count("*")).first()
        assert tuple(rollup.active_between(roll.days(), first, last).first()) == tuple(want)
    numbers = roll.numbers().groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("number").alias("d"), F.max("number").alias("m")).collect()
    assert len(numbers) == 3 and all(r.n == r.d == r.m + 1 for r in numbers)  # dense


def test_rollup_reads_only_asked_days(spark):
    roll = rollup.DayRollup(spark, scratch_path(spark, "t-roll-plan"))
    roll.add(_events(spark, 7), "a")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    df = rollup.active_between(roll.days(), "2025-01-01", "2025-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "2025-01-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
