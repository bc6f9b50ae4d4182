"""Session positions across runs equal one window over all runs."""

import datetime as _dt
import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from clickweave.operators.session_runs import SessionRuns
from clickweave.plans.jobs import run_batch
from clickweave.session import scratch_path
from clickweave.sources import sinks

STAMPS = [_dt.datetime(2025, 6, 1, 0, 0, k) for k in range(9)]


def _runs(seed, n_runs=4, events=120, sessions=9):
    """Events of ``n_runs`` runs; about a third come late, some repeat a key,
    some have no session or a bad time, one session is long."""
    r = random.Random(seed)
    out = [[] for _ in range(n_runs)]
    for i in range(events):
        when = i * n_runs // events
        run = when if r.random() < 0.65 else r.randrange(when, n_runs)
        day, minute = divmod(i * 37, 1440)
        time = f"2025-05-{1 + day:02d}T{minute // 60:02d}:{minute % 60:02d}:00Z" if r.random() < 0.95 else "garbage"
        session = r.choice([None, "long", "long", *[f"s{k}" for k in range(sessions)]])
        event = {"event_id": f"e{r.randrange(events)}", "user_id": "u", "session_id": session, "event_type": "page_view", "timestamp": time}
        out[run].append(event)
        if r.random() < 0.1:
            out[r.randrange(run, n_runs)].append(event)
    return out


def _write(spark, events):
    raw = scratch_path(spark, "t-sr")
    os.makedirs(raw)
    with open(os.path.join(raw, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(e) for e in events) + "\n")
    return raw


def _ledger(spark):
    return SessionRuns(spark, scratch_path(spark, "t-ledger"), "t_sessions", f"t{uuid.uuid4().hex[:8]}", buckets=4)


def _expected(runs):
    """(session, time, id, run) in order, numbered by session; equal places in
    the order of their runs."""
    rows = [(e["session_id"], e["timestamp"] if e["timestamp"] != "garbage" else "", e["event_id"], k)
            for k, events in enumerate(runs) for e in events if e["session_id"] is not None]
    out, count = [], {}
    for s, t, i, k in sorted(rows):
        count[s] = count.get(s, 0) + 1
        out.append((s, t, i, k, count[s]))
    return out


def _got(table):
    second = F.second("processed_timestamp").alias("run")
    rows = table.where("session_id IS NOT NULL").select("session_id", "timestamp", "event_id", second, "event_sequence", "is_session_start").collect()
    assert all(r.is_session_start == (r.event_sequence == 1) for r in rows)
    return sorted((r.session_id, "" if r.timestamp == "garbage" else r.timestamp, r.event_id, r.run, r.event_sequence) for r in rows)


@pytest.mark.parametrize("seed, split", [(1, {}), (2, {"min_hot_rows": 1, "sample_fraction": 1.0, "rows_per_bucket": 5})])
def test_runs_equal_one_window(spark, seed, split):
    runs, ledger, target = _runs(seed), _ledger(spark), scratch_path(spark, "t-sr-out")
    for k, events in enumerate(runs):
        run_batch(spark, _write(spark, events), target, processed_at=STAMPS[k], sessions=ledger, **split)
        assert _got(ledger.read(sinks.read_curated(spark, target))) == sorted(_expected(runs[:k + 1]))
    # events without a session are numbered by their run
    alone = sinks.read_curated(spark, target).where("session_id IS NULL").groupBy("processed_timestamp").agg(
        F.max("event_sequence").alias("top"), F.count("*").alias("n")).collect()
    assert all(r.top == r.n for r in alone)


def test_no_file_is_rewritten_and_old_days_are_not_read(spark):
    ledger, target = _ledger(spark), scratch_path(spark, "t-sr-files")
    def events(prefix, day, n):
        return [{"event_id": f"{prefix}{i}", "user_id": "u", "session_id": "s", "event_type": "login",
                 "timestamp": f"2025-05-{day:02d}T10:{i:02d}:00Z"} for i in range(n)]
    run_batch(spark, _write(spark, events("a", 1, 5) + events("b", 3, 5)), target, processed_at=STAMPS[0], sessions=ledger)
    def files():
        return {os.path.join(d, x): os.stat(os.path.join(d, x)).st_mtime_ns for d, _, names in os.walk(target) for x in names if x.endswith(".parquet")}
    before = files()
    run_batch(spark, _write(spark, events("c", 2, 3)), target, processed_at=STAMPS[1], sessions=ledger)
    assert before.items() <= files().items()
    got = {r.event_id: r.event_sequence for r in ledger.read(sinks.read_curated(spark, target)).collect()}
    assert [got[f"a{i}"] for i in range(5)] == [1, 2, 3, 4, 5] and [got[f"c{i}"] for i in range(3)] == [6, 7, 8]
    assert [got[f"b{i}"] for i in range(5)] == [9, 10, 11, 12, 13]
    moved = spark.table(ledger.shifts)
    assert {(r.event_id, r.shift) for r in moved.collect()} == {(f"b{i}", 3) for i in range(5)}  # day 1 has no shift


def test_a_repeated_attempt_leaves_no_trace(spark):
    """A run that failed before its rows were written is tried again."""
    ledger, target = _ledger(spark), scratch_path(spark, "t-sr-again")
    runs = _runs(5, n_runs=3)
    run_batch(spark, _write(spark, runs[0]), target, processed_at=STAMPS[0], sessions=ledger)
    from clickweave.plans.jobs import land, prepare_batch
    landing, _ = land(spark, _write(spark, runs[1]))
    ledger.begin(prepare_batch(landing, STAMPS[1]), sinks.read_curated(spark, target))  # never written
    assert _got(ledger.read(sinks.read_curated(spark, target))) == sorted(_expected(runs[:1]))
    for k in (1, 2):
        run_batch(spark, _write(spark, runs[k]), target, processed_at=STAMPS[k], sessions=ledger)
    assert _got(ledger.read(sinks.read_curated(spark, target))) == sorted(_expected(runs))


def test_totals_need_no_shuffle_and_empty_runs(spark):
    ledger, target = _ledger(spark), scratch_path(spark, "t-sr-plan")
    for k, events in enumerate(_runs(7, n_runs=2)):
        run_batch(spark, _write(spark, events), target, processed_at=STAMPS[k], sessions=ledger)
    plan = ledger.totals()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    run_batch(spark, _write(spark, []), target, processed_at=STAMPS[5], sessions=ledger)
    assert _got(ledger.read(sinks.read_curated(spark, target))) == sorted(_expected(_runs(7, n_runs=2)))
    # the tables are found again by a new process: same folder, a catalog without them
    again = SessionRuns(spark, os.path.dirname(_location(spark, ledger.counts)), "t_sessions", ledger.counts.split(".")[1].removesuffix("_counts"), buckets=4)
    assert again.totals().count() == ledger.totals().count()


def _location(spark, table):
    return next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect() if r.col_name == "Location")
