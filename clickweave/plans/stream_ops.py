"""Registered streaming entries, each run to completion with
``availableNow`` over files derived from the test tables, then read back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from clickweave.plans import fixtures
from clickweave.plans.registry import FIXED_STAMP
from clickweave.session import scratch_path
from clickweave.sources.json_events import parse_json_lines
from clickweave.sources.schema import CORRUPT_COLUMN, CURATED_COLUMNS
from clickweave.sources.sinks import read_curated
from clickweave.sources.testdata import json_lines_from_tables
from clickweave.streaming import ingest, monitor

NO_STAMP = [c for c in CURATED_COLUMNS if c != "processed_timestamp"]
INBOX_FILES = 4


def _count():
    return F.count(F.lit(1))


def _inbox(spark, sf) -> str:
    """Producer output: the JSON lines as plain text files, no folders."""
    def build():
        path = scratch_path(spark, "inbox")
        (json_lines_from_tables(spark, sf).select("value")
         .repartition(INBOX_FILES).write.mode("overwrite").text(path))
        return path
    return fixtures.once(spark, "inbox", sf, build)


def stream_deliver_raw(spark, sf):
    """T1. Records delivered into the gzip raw zone, counted back."""
    raw = scratch_path(spark, "delivered")
    q = ingest.deliver_raw(spark, _inbox(spark, sf), raw, scratch_path(spark, "ck-deliver"))
    q.awaitTermination()
    return spark.read.text(raw).agg(_count().alias("delivered_records"))


def stream_error_route(spark, sf):
    """T2. Each micro-batch split into well-formed and malformed lines."""
    good, errors = scratch_path(spark, "good"), scratch_path(spark, "errors")
    lines = ingest.read_lines_stream(spark, fixtures.raw_zone(spark, sf), max_files_per_trigger=32)
    ingest.error_routing(lines, good, errors, scratch_path(spark, "ck-route")).awaitTermination()
    g = spark.read.text(good).agg(F.lit("good").alias("kind"), _count().alias("records"))
    e = spark.read.text(errors).agg(F.lit("error").alias("kind"), _count().alias("records"))
    return g.unionByName(e)


def incremental_transform(spark, sf):
    """T3. Raw files → curated table, run twice: the second run finds no new
    file and appends nothing."""
    target = scratch_path(spark, "stream-target")
    ck = scratch_path(spark, "ck-transform")
    raw = fixtures.raw_zone(spark, sf)
    counts = []
    for _ in range(2):
        ingest.incremental_transform(spark, raw, target, ck,
                                     processed_at=FIXED_STAMP).awaitTermination()
        counts.append(read_curated(spark, target).count())
    if counts[0] != counts[1]:
        raise RuntimeError(f"second run appended {counts[1] - counts[0]} rows")
    return read_curated(spark, target).select(*NO_STAMP)


def newline_framing(spark, sf):
    """T4. One JSON object per line, parsed line by line in a stream."""
    out = scratch_path(spark, "framed")
    lines = ingest.read_lines_stream(spark, _inbox(spark, sf))
    parsed = (parse_json_lines(lines).where(F.col(CORRUPT_COLUMN).isNull())
              .select("event_id", "event_type"))
    q = (parsed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "ck-framing"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def live_monitor(spark, sf):
    """T5. The 100 latest valid events, maintained batch by batch."""
    root = scratch_path(spark, "latest")
    lines = ingest.read_lines_stream(spark, fixtures.raw_zone(spark, sf), max_files_per_trigger=64)
    monitor.live_monitor(spark, lines, root, scratch_path(spark, "ck-monitor")).awaitTermination()
    return monitor.read_latest(spark, root)


def stream_dedup(spark, sf):
    """T6. A product's events delivered twice; repeats dropped within the
    watermark delay."""
    root = scratch_path(spark, "dedup-in")
    lines = json_lines_from_tables(spark, sf).select("value")
    lines.write.mode("overwrite").text(os.path.join(root, "first"))
    (lines.where(F.col("value").contains('"product_id":"prod_023"'))
     .write.mode("overwrite").text(os.path.join(root, "again")))
    out = scratch_path(spark, "dedup-out")
    # one file a micro-batch, so repeats meet state of earlier batches; the files
    # hold all days in no order, so the delay spans them
    lines = ingest.read_lines_stream(spark, root, max_files_per_trigger=2)
    deduped = ingest.dedup_stream(lines, delay="1000 days").select("event_id", "event_type")
    q = (deduped.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "ck-dedup"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(_count().alias("event_count"))


STREAM_OPS = {
    "stream_deliver_raw": stream_deliver_raw,
    "stream_error_route": stream_error_route,
    "incremental_transform": incremental_transform,
    "newline_framing": newline_framing,
    "live_monitor": live_monitor,
    "stream_dedup": stream_dedup,
}
