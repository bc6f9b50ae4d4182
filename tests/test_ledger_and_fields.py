"""Events delivered twice, and producers that send thousands of fields."""

import datetime as _dt
import json
import os
import random

from pyspark.sql import functions as F

from clickweave.operators.event_ledger import EventLedger
from clickweave.plans.jobs import run_batch
from clickweave.session import scratch_path
from clickweave.sources import catalog, sinks
from clickweave.sources.schema import OTHER_COLUMN, producer_field

STAMPS = [_dt.datetime(2025, 6, 1, 0, 0, k) for k in range(9)]


def _raw(spark, events):
    raw = scratch_path(spark, "t-led")
    os.makedirs(raw)
    with open(os.path.join(raw, "a.json"), "w") as f:
        f.write("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")
    return raw


def _event(i, **more):
    return {"event_id": i, "user_id": "u", "session_id": "s", "event_type": "login", "timestamp": "2025-05-05T10:00:00Z"} | more


def test_ids_of_earlier_runs_add_nothing(spark):
    r = random.Random(3)
    ledger, target = EventLedger(spark, scratch_path(spark, "t-ledger"), 4, 1), scratch_path(spark, "t-led-out")
    sent, stored = [], set()
    for k in range(4):
        # half of a run's ids were sent before; some twice in the run, one id many times
        ids = [f"r{k}-{i}" for i in range(40)] + r.sample(sent, min(len(sent), 40))
        events = [_event(i) for i in ids + r.choices(ids, k=10) + [f"hot{k}"] * 50]
        run = run_batch(spark, _raw(spark, [*events, "{broken"]), target, processed_at=STAMPS[k], ledger=ledger)
        new = {e["event_id"] for e in events} - stored
        assert run.written.count() == len(new) and run.counters["corrupt_records"] == 1
        stored |= new
        sent += ids
        assert sorted(x.event_id for x in sinks.read_curated(spark, target).select("event_id").collect()) == sorted(stored)


def test_filters_are_small_and_false_alarms_are_checked(spark):
    ledger = EventLedger(spark, scratch_path(spark, "t-ledger-full"), 1, 1)
    many = spark.range(40_000).select(F.concat(F.lit("a"), F.col("id")).alias("event_id"))
    ledger.commit(many, 1)
    other = spark.range(5_000).select(F.concat(F.lit("b"), F.col("id")).alias("event_id"))
    alarms = ledger.suspects(other).count()
    assert 1_000 < alarms  # the one bitmap is overfull ...
    assert ledger.fresh(other, 2).count() == 5_000  # ... and still no event is lost
    assert ledger.suspects(many).count() == 40_000 and ledger.fresh(many, 2).count() == 0
    wide = EventLedger(spark, scratch_path(spark, "t-ledger-wide"), 4, 4)
    wide.commit(many, 1)
    assert wide.suspects(other).count() < 500


def test_a_repeated_run_does_not_shut_itself_out(spark):
    """A run that stored its ids and is tried again keeps its events."""
    ledger = EventLedger(spark, scratch_path(spark, "t-ledger-again"), 4, 1)
    events = [_event(f"x{i}") for i in range(20)]
    raw = _raw(spark, events)
    for target in (scratch_path(spark, "t-led-1"), scratch_path(spark, "t-led-2")):
        assert run_batch(spark, raw, target, processed_at=STAMPS[0], ledger=ledger).written.count() == 20
    assert run_batch(spark, raw, scratch_path(spark, "t-led-3"), processed_at=STAMPS[1], ledger=ledger).written.count() == 0
    assert run_batch(spark, _raw(spark, []), scratch_path(spark, "t-led-4"), processed_at=STAMPS[2], ledger=ledger).written.count() == 0


def test_thousands_of_new_fields_land(spark, monkeypatch):
    from clickweave.plans import batch
    monkeypatch.setattr(batch, "MAX_NEW_FIELDS", 5)
    often = {f"often{k}": str(k) for k in range(4)}
    events = [_event(f"f{i}", **often, **{f"field {i} {j}": f"v{i}.{j}" for j in range(50)}) for i in range(100)]
    target = scratch_path(spark, "t-fields")
    name = f"{catalog.DEFAULT_DATABASE}.t_fields"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    run_batch(spark, _raw(spark, events), target, database=catalog.DEFAULT_DATABASE, table="t_fields", processed_at=STAMPS[0])
    # a later run with few fields only: all become columns
    run_batch(spark, _raw(spark, [_event("g", often2="late", other_fields="clash", batch="b")]), target,
              database=catalog.DEFAULT_DATABASE, table="t_fields", processed_at=STAMPS[1])
    table = spark.table(name)
    assert {f"often{k}" for k in range(4)} <= set(table.columns) and OTHER_COLUMN in table.columns and len(table.columns) < 40
    rows = {r.event_id: r for r in table.select("*", *[producer_field(table, f"field {i} 49").alias(f"p{i}") for i in (0, 7)],
                                                producer_field(table, "often2").alias("o2"), producer_field(table, "never").alias("no")).collect()}
    assert len(rows) == 101 and rows["f7"].p7 == "v7.49" and rows["f0"].p0 == "v0.49" and rows["f1"].p0 is None
    assert (rows["g"].o2, rows["g"].raw_other_fields, rows["g"].raw_batch) == ("late", "clash", "b") and rows["f7"].o2 == "2" and rows["f7"].no is None
    assert sum(len(r[OTHER_COLUMN] or {}) for r in rows.values()) == 5000 - 1  # one of them was fifth in use
