"""Streaming = batch, reruns add nothing, catalog repair and schema evolution."""

import datetime as _dt
import json
import os

import pytest
from pyspark.sql import functions as F

from clickweave.plans.batch import transform
from clickweave.session import scratch_path
from clickweave.sources import catalog, sinks
from clickweave.sources.json_events import read_raw_events
from clickweave.streaming import ingest, monitor

STAMP = _dt.datetime(2025, 6, 1)


def _lines(n, day=5):
    out = []
    for i in range(n):
        out.append(json.dumps({
            "event_id": f"e{i:04d}", "user_id": f"u{i % 7}", "session_id": f"s{i % 11}",
            "event_type": ["page_view", "purchase", "add_to_cart"][i % 3],
            "timestamp": f"2025-05-{day:02d}T{i % 24:02d}:{i % 60:02d}:00.000Z",
            "product_id": "p1" if i % 3 else None, "price": 2.5 if i % 3 else None,
            "quantity": 1 if i % 3 else None}))
    out.append("{broken")
    return out


def _drop(dirpath, name, lines):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_equals_batch_and_rerun_adds_nothing(spark):
    raw = scratch_path(spark, "t-raw")
    _drop(raw, "a.json", _lines(60))
    target, ck = scratch_path(spark, "t-target"), scratch_path(spark, "t-ck")
    ingest.incremental_transform(spark, raw, target, ck, processed_at=STAMP).awaitTermination()
    first = sinks.read_curated(spark, target)
    n1 = first.count()
    ingest.incremental_transform(spark, raw, target, ck, processed_at=STAMP).awaitTermination()
    assert sinks.read_curated(spark, target).count() == n1 == 60
    batch = transform(read_raw_events(spark, raw), processed_at=STAMP)
    cols = ["event_id", "event_sequence", "year", "month", "day", "hour", "event_category"]
    assert sorted(map(tuple, first.select(cols).collect())) == \
        sorted(map(tuple, batch.select(cols).collect()))
    # a new file is picked up by the next run, and only it
    _drop(raw, "b.json", [ln.replace('"e0', '"f0') for ln in _lines(9, day=6)[:-1]])
    ingest.incremental_transform(spark, raw, target, ck, processed_at=STAMP).awaitTermination()
    assert sinks.read_curated(spark, target).count() == 69


def test_error_routing(spark):
    raw = scratch_path(spark, "t-raw2")
    _drop(raw, "a.json", _lines(10))
    good, bad = scratch_path(spark, "t-good"), scratch_path(spark, "t-bad")
    ingest.error_routing(ingest.read_lines_stream(spark, raw), good, bad, scratch_path(spark, "t-ck2")).awaitTermination()
    assert spark.read.text(good).count() == 10
    assert [r.value for r in spark.read.text(bad).collect()] == ["{broken"]


def test_monitor_keeps_latest(spark):
    raw = scratch_path(spark, "t-raw3")
    for i in range(3):
        _drop(raw, f"f{i}.json", _lines(20, day=10 + i)[:-1])
    root = scratch_path(spark, "t-latest")
    lines = ingest.read_lines_stream(spark, raw, max_files_per_trigger=1)
    monitor.live_monitor(spark, lines, root, scratch_path(spark, "t-ck3"), n=5).awaitTermination()
    got = monitor.read_latest(spark, root).collect()
    assert len(got) == 5 and all(r.timestamp.startswith("2025-05-12") for r in got)


def test_repair_and_schema_evolution(spark):
    raw = scratch_path(spark, "t-raw4")
    _drop(raw, "a.json", _lines(30))
    cur = transform(read_raw_events(spark, raw), processed_at=STAMP)
    path = scratch_path(spark, "t-table")
    name = f"{catalog.DEFAULT_DATABASE}.t_evolve"
    catalog.create_database(spark)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    from clickweave.sources.schema import curated_ddl
    spark.sql(curated_ddl(name, path))
    assert catalog.show_partitions(spark, name).count() == 0
    sinks.write_curated(cur, path)
    catalog.repair_partitions(spark, name)
    assert catalog.show_partitions(spark, name).count() == 1
    extra = cur.withColumn("campaign", F.lit("spring"))
    extra = extra.select(*[c for c in extra.columns if c not in ("year", "month", "day")],
                         "year", "month", "day")
    added, missing = catalog.evolve_schema(spark, name, extra)
    assert added == ["campaign"] and missing == []
    sinks.write_curated(extra.select(*spark.table(name).columns), path)
    spark.catalog.refreshTable(name)
    counts = spark.table(name).agg(F.count("*").alias("n"), F.count("campaign").alias("c")).first()
    assert (counts.n, counts.c) == (60, 30)
    stats = catalog.compute_statistics(spark, name).first()
    assert stats.row_count == 60


def test_resequence_across_runs(spark):
    """Two runs of one session each number from 1; resequence renumbers the
    stored rows as one session."""
    from clickweave.plans.batch import resequence
    raw1, raw2 = scratch_path(spark, "t-r1"), scratch_path(spark, "t-r2")
    _drop(raw1, "a.json", _lines(6)[:-1])
    _drop(raw2, "b.json", [ln.replace('"e0', '"g0').replace("2025-05-05", "2025-05-06")
                           for ln in _lines(6)[:-1]])
    path = scratch_path(spark, "t-reseq")
    for raw in (raw1, raw2):
        sinks.write_curated(transform(read_raw_events(spark, raw), processed_at=STAMP), path)
    stored = sinks.read_curated(spark, path)
    per_run_starts = stored.where("is_session_start").count()
    again = resequence(stored)
    assert per_run_starts == 2 * again.where("is_session_start").count()
    seqs = sorted(r.event_sequence for r in again.where("session_id = 's1'").collect())
    assert seqs == list(range(1, len(seqs) + 1))


def test_runs_register_only_new_days(spark):
    from clickweave.plans.jobs import run_batch
    raw1, raw2 = scratch_path(spark, "t-d1"), scratch_path(spark, "t-d2")
    _drop(raw1, "a.json", _lines(8, day=7))
    _drop(raw2, "b.json", [ln.replace('"e0', '"h0') for ln in _lines(8, day=8)])
    target = scratch_path(spark, "t-days")
    spark.sql(f"DROP TABLE IF EXISTS {catalog.DEFAULT_DATABASE}.t_days")
    r1 = run_batch(spark, raw1, target, database=catalog.DEFAULT_DATABASE, table="t_days",
                   processed_at=STAMP)
    assert catalog.show_partitions(spark, r1.table).count() == 1
    r2 = run_batch(spark, raw2, target, database=catalog.DEFAULT_DATABASE, table="t_days",
                   processed_at=STAMP)
    parts = sorted(r[0] for r in catalog.show_partitions(spark, r2.table).collect())
    assert parts == ["year=2025/month=05/day=07", "year=2025/month=05/day=08"]
    assert spark.table(r2.table).count() == 16
    assert r2.counters["corrupt_records"] == 1
    # the summary of a run reads only the partitions that run wrote
    assert r2.summary().first().total_records == 8
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = r2.written._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2025-05-08" in partition_filters and "2025-05-07" not in partition_filters


def test_run_counters_with_hot_keys(spark):
    """With hot keys the observed input feeds two plan branches; the run
    counters must still count each input line once."""
    from clickweave.plans.jobs import run_batch
    raw = scratch_path(spark, "t-hot")
    _drop(raw, "a.json", _lines(120))
    normal = run_batch(spark, raw, scratch_path(spark, "t-hot-a"), processed_at=STAMP)
    forced = run_batch(spark, raw, scratch_path(spark, "t-hot-b"), processed_at=STAMP,
                       min_hot_rows=1, sample_fraction=1.0, rows_per_bucket=3)
    assert normal.counters == forced.counters
    assert forced.counters["rows_read"] == 121 and forced.counters["corrupt_records"] == 1
    cols = ["event_id", "event_sequence"]
    assert sorted(map(tuple, normal.written.select(cols).collect())) == \
        sorted(map(tuple, forced.written.select(cols).collect()))


def test_command_lines(spark, capsys):
    from clickweave.plans import jobs
    raw = scratch_path(spark, "t-cli")
    _drop(raw, "a.json", _lines(12))
    target = scratch_path(spark, "t-cli-out")
    assert jobs.main(["--source", raw, "--target", target, "--errors-path",
                      scratch_path(spark, "t-cli-err")]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["counters"]["valid_records"] == 12 and out["summary"]["total_records"] == 12
    stream_target = scratch_path(spark, "t-cli-stream")
    assert ingest.main(["--raw", raw, "--target", stream_target,
                        "--checkpoint", scratch_path(spark, "t-cli-ck")]) == 0
    assert sinks.read_curated(spark, stream_target).count() == 12


def test_stream_registers_new_days(spark):
    raw = scratch_path(spark, "t-sreg")
    _drop(raw, "a.json", _lines(10, day=3))
    target, ck = scratch_path(spark, "t-sreg-out"), scratch_path(spark, "t-sreg-ck")
    name = f"{catalog.DEFAULT_DATABASE}.t_stream"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ingest.incremental_transform(spark, raw, target, ck, database=catalog.DEFAULT_DATABASE,
                                 table="t_stream", processed_at=STAMP).awaitTermination()
    def days():
        return sorted(r[0].rsplit("/batch=", 1)[0] for r in catalog.show_partitions(spark, name).collect())
    assert days() == ["year=2025/month=05/day=03"]
    _drop(raw, "b.json", [ln.replace('"e0', '"k0') for ln in _lines(10, day=4)[:-1]])
    ingest.incremental_transform(spark, raw, target, ck, database=catalog.DEFAULT_DATABASE,
                                 table="t_stream", processed_at=STAMP).awaitTermination()
    assert days() == ["year=2025/month=05/day=03", "year=2025/month=05/day=04"]
    assert spark.table(name).count() == 20


def _events(prefix, n, day=5, **more):
    return [json.dumps({"event_id": f"{prefix}{i}", "user_id": "u", "session_id": f"s{i}", "event_type": "page_view",
                        "timestamp": f"2025-05-{day:02d}T10:{i:02d}:00.000Z"} | more) for i in range(n)]


def test_two_streams_and_a_new_checkpoint_share_a_target(spark):
    raw, target = scratch_path(spark, "t-two"), scratch_path(spark, "t-two-out")
    _drop(raw, "a.json", _events("a", 10))
    ingest.incremental_transform(spark, raw, target, scratch_path(spark, "ck-1"), processed_at=STAMP).awaitTermination()
    other = scratch_path(spark, "t-two-b")
    _drop(other, "b.json", _events("b", 7))
    ingest.incremental_transform(spark, other, target, scratch_path(spark, "ck-2"), processed_at=STAMP).awaitTermination()
    ids = sorted(r.event_id for r in sinks.read_curated(spark, target).collect())
    assert ids == sorted([f"a{i}" for i in range(10)] + [f"b{i}" for i in range(7)])


def test_replay_after_a_crash_repeats_nothing(spark, monkeypatch):
    """A batch that fails after its write, before it is registered, stands there
    once when it is replayed, and is registered."""
    target = scratch_path(spark, "t-crash")
    batch = spark.createDataFrame([(x,) for x in _events("c", 10)], "value string")
    name = f"{catalog.DEFAULT_DATABASE}.t_crash"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    run = ingest.transform_batches(target, database=catalog.DEFAULT_DATABASE, table="t_crash", processed_at=STAMP)
    real = catalog.register_table
    def crash(*a, **k):
        raise RuntimeError("lost")
    monkeypatch.setattr(catalog, "register_table", crash)
    for _ in range(2):
        try:
            run(batch, 0)
            raise AssertionError("the crash was swallowed")
        except RuntimeError:
            pass
    monkeypatch.setattr(catalog, "register_table", real)
    run(batch, 0)
    run(batch, 0)  # again: it replaces itself
    run(spark.createDataFrame([], "value string"), 1)  # an empty batch
    assert sinks.read_curated(spark, target).count() == 10
    assert spark.table(name).count() == 10


def test_errors_lie_under_type_and_date_and_survive_new_checkpoints(spark):
    good, bad = scratch_path(spark, "t-g"), scratch_path(spark, "t-b")
    for k in range(2):
        raw = scratch_path(spark, "t-er")
        _drop(raw, "a.json", _events(f"x{k}", 5) + ["{broken", json.dumps({"a": 1}) + json.dumps({"b": 2})])
        ingest.error_routing(ingest.read_lines_stream(spark, raw), good, bad, scratch_path(spark, "ck-er")).awaitTermination()
    assert spark.read.text(good).count() == 10
    errors = spark.read.text(bad)
    assert errors.columns == ["value", "error_type", "year", "month", "day", "batch"] and errors.count() == 4
    assert errors.select("error_type").distinct().collect()[0][0] == ingest.MALFORMED


def _monitored(spark, raw, root, checkpoint, n=4):
    lines = ingest.read_lines_stream(spark, raw, max_files_per_trigger=1)
    monitor.live_monitor(spark, lines, root, checkpoint, n=n, buckets=3).awaitTermination()
    return [tuple(r) for r in monitor.read_latest(spark, root).collect()]


def test_monitor_restart_and_repeats(spark):
    raw, root, ck = (scratch_path(spark, x) for x in ("t-mon-in", "t-mon", "ck-mon"))
    assert monitor.read_latest(spark, root) is None
    _drop(raw, "a.json", _events("m", 6) + _events("bad", 2, timestamp="garbage"))
    first = _monitored(spark, raw, root, ck)
    assert [r[0] for r in first] == [f"2025-05-05T10:0{i}:00.000Z" for i in (5, 4, 3, 2)]
    _drop(raw, "b.json", _events("m", 6))  # the same rows in a later batch
    assert _monitored(spark, raw, root, ck) == first
    for k in range(2, 5):
        _drop(raw, f"n{k}.json", _events(f"n{k}", 2, day=5 + k))
    got = _monitored(spark, raw, root, ck)  # a restart goes on from its state
    assert [r[0][8:10] for r in got] == ["09", "09", "08", "08"]


def test_monitor_replay_gives_the_same_rows(spark, monkeypatch):
    """A batch that fails after its view was written is replayed on restart."""
    raw, root, ck = (scratch_path(spark, x) for x in ("t-rep-in", "t-rep", "ck-rep"))
    _drop(raw, "a.json", _events("r", 9) + [ln.replace("page_view", "search") for ln in _events("r", 3)])
    real = monitor.replace_lists
    def failing(path):
        write = real(path)
        def run(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost")
        return run
    monkeypatch.setattr(monitor, "replace_lists", failing)
    try:
        _monitored(spark, raw, root, ck)
        raise AssertionError("the crash was swallowed")
    except Exception as error:
        assert "lost" in str(error)
    before = [tuple(r) for r in monitor.read_latest(spark, root).collect()]
    monkeypatch.setattr(monitor, "replace_lists", real)
    assert _monitored(spark, raw, root, ck) == before and len(before) == 4


def test_monitor_equals_the_sorted_table(spark):
    import random
    r = random.Random(8)
    rows = [[f"e{r.randrange(60)}", r.choice([None, *range(40)]), *[str(r.randrange(3))] * 9] for _ in range(400)]
    held = []
    for at in range(0, 400, 37):
        held = monitor.merged(held, rows[at:at + 37], 60)
    best = {}
    for row in rows:
        if row[0] not in best or monitor._newer(row, best[row[0]]):
            best[row[0]] = row
    assert held == sorted(best.values(), key=monitor._rank)


def test_dedup_state_crosses_batches_and_untimed_events_are_given(spark):
    raw, out = scratch_path(spark, "t-dd"), scratch_path(spark, "t-dd-out")
    _drop(raw, "a.json", _events("d", 5) + _events("bad", 2, timestamp="garbage"))
    _drop(raw, "b.json", _events("d", 5))
    lines = ingest.read_lines_stream(spark, raw, max_files_per_trigger=1)
    q = (ingest.dedup_stream(lines).select("event_id").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "ck-dd")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [f"d{i}" for i in range(5)]
    assert ingest.untimed_events(spark.read.text(raw)).count() == 2


def test_new_fields_reach_the_table(spark):
    from clickweave.plans.jobs import run_batch
    raw, target = scratch_path(spark, "t-new"), scratch_path(spark, "t-new-out")
    _drop(raw, "a.json", _events("o", 3))
    name = f"{catalog.DEFAULT_DATABASE}.t_new"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    run_batch(spark, raw, target, database=catalog.DEFAULT_DATABASE, table="t_new", processed_at=STAMP)
    later = scratch_path(spark, "t-new2")
    _drop(later, "b.json", _events("p", 2, day=6, campaign="spring", hour="late"))
    run = run_batch(spark, later, target, database=catalog.DEFAULT_DATABASE, table="t_new", processed_at=_dt.datetime(2025, 6, 2))
    rows = {r.event_id: (r.campaign, r.raw_hour, r.hour) for r in spark.table(name).collect()}
    assert rows["o0"] == (None, None, 10) and rows["p0"] == ("spring", "late", 10) and len(rows) == 5
    assert run.written.select("campaign").distinct().collect()[0][0] == "spring"
    stream = scratch_path(spark, "t-new3")
    _drop(stream, "c.json", _events("q", 1, day=7, coupon="x"))
    live = f"{catalog.DEFAULT_DATABASE}.t_new_live"
    spark.sql(f"DROP TABLE IF EXISTS {live}")
    ingest.incremental_transform(spark, stream, scratch_path(spark, "t-new-live"), scratch_path(spark, "ck-new"),
                                 database=catalog.DEFAULT_DATABASE, table="t_new_live", processed_at=STAMP).awaitTermination()
    spark.catalog.refreshTable(live)
    assert spark.table(live).where("coupon = 'x'").count() == 1
    with pytest.raises(ValueError, match="tables of their own"):
        catalog.register_table(spark, target, table="t_new", days=[], batch="direct-0")


def test_run_over_many_days_with_a_bad_time(spark):
    """3,000 days and one unparsable time in one run: it ends, the default
    partition is registered, and the summary reads pruned partitions."""
    from clickweave.plans.jobs import in_days, run_batch
    raw, target = scratch_path(spark, "t-many"), scratch_path(spark, "t-many-out")
    start = _dt.date(2010, 1, 1)
    _drop(raw, "a.json", [json.dumps({"event_id": f"e{i}", "user_id": "u", "event_type": "login",
                                      "timestamp": f"{start + _dt.timedelta(days=i)}T00:00:00Z"}) for i in range(300)]
          + _events("bad", 1, timestamp="garbage"))
    name = f"{catalog.DEFAULT_DATABASE}.t_many"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    run = run_batch(spark, raw, target, database=catalog.DEFAULT_DATABASE, table="t_many", processed_at=STAMP)
    again = scratch_path(spark, "t-many2")
    _drop(again, "a.json", _events("z", 1, timestamp="garbage", ) + _events("y", 1, day=9))
    run = run_batch(spark, again, target, database=catalog.DEFAULT_DATABASE, table="t_many", processed_at=_dt.datetime(2025, 6, 3))
    assert run.summary().first().total_records == 2
    plan = run.written._jdf.queryExecution().executedPlan().toString()
    assert "2025-05-09" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert spark.table(name).where("year IS NULL").count() == 2
    # the filter itself, at the size of a long backfill
    days = [(f"{y:04d}", f"{m:02d}", f"{d:02d}") for y in range(1990, 2000) for m in range(1, 13) for d in range(1, 26)]
    assert sinks.read_curated(spark, target).where(in_days([*days, (None, None, None)])).count() == 2


def test_money_and_bad_prices(spark):
    from clickweave.plans.library import q08_daily_revenue, q10_category_performance
    def bought(i, price, quantity):
        return json.dumps({"event_id": f"p{i}", "user_id": "u", "session_id": "s", "event_type": "purchase", "product_category": "c",
                           "timestamp": "2025-05-05T10:00:00Z", "product_id": "x", "price": price, "quantity": quantity})
    def day(lines):
        from clickweave.sources.json_events import parse_json_lines
        return transform(parse_json_lines(spark.createDataFrame([(x,) for x in lines], "value string")), processed_at=STAMP)
    r = q08_daily_revenue(day([bought(i, 0.125, 1000) for i in range(4)])).first()
    assert (r.total_revenue, r.avg_order_value) == (500.0, 125.0)
    r = q08_daily_revenue(day([bought(0, -10.01, 1), bought(1, -10.02, 1)])).first()
    assert (r.total_revenue, r.avg_order_value) == (-20.03, -10.02)
    bad = day([bought(0, "NaN", 1), bought(1, "Infinity", 1), bought(2, 1e300, 1), bought(3, 2.5, 2)])
    assert q08_daily_revenue(bad).first().total_revenue == 5.0
    assert q10_category_performance(bad).first().revenue == 5.0
    assert bad.count() == 4


def test_trailing_content_is_corrupt(spark):
    from clickweave.sources.json_events import parse_json_lines
    lines = ['{"event_id": "a"}{"event_id": "b"}', '{"event_id": "c"} x', '{"event_id": "d"}, {"event_id": "e"}', '{"event_id": "f"}', "[1]", "null", "5"]
    rows = parse_json_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.event_id for r in rows if r._corrupt_record is None] == ["f"]
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted(set(lines) - {'{"event_id": "f"}'})


def test_default_stamp_and_day(spark):
    """Without a fixed stamp or day: the run's own stamp and today's partition."""
    from clickweave.functions import today_filter
    from clickweave.plans.jobs import run_batch
    now = _dt.datetime.now(_dt.timezone.utc)
    raw = scratch_path(spark, "t-now")
    _drop(raw, "a.json", _events("t", 2, timestamp=now.strftime("%Y-%m-%dT%H:%M:%SZ")))
    run = run_batch(spark, raw, scratch_path(spark, "t-now-out"))
    stamps = [r[0] for r in run.written.select("processed_timestamp").distinct().collect()]
    assert len(stamps) == 1 and abs((stamps[0].replace(tzinfo=_dt.timezone.utc) - now).total_seconds()) < 600
    assert run.written.where(today_filter()).count() == 2


def test_day_queries_prune_partitions(spark):
    import __spark_entry__ as entry
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    queries = entry.queries()
    for key in ("today_partition_filter", "literal_partition_filter", "q01_event_distribution", "q04_hourly_activity",
                "q05_session_funnel", "q12_latest_events", "nq1_event_distribution"):
        plan = queries[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0], key
        if key == "q01_event_distribution":
            assert plan.count("FileScan parquet") == 1
