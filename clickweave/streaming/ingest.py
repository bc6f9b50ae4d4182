"""Structured Streaming over raw event files.

The stream source is a folder of newline-delimited JSON files (plain or
gzip). Every query keeps its progress in a checkpoint folder, so a restart —
or a second run with ``availableNow`` — only processes files it has not
committed yet (the "job bookmark" of the batch world).

``foreachBatch`` sinks write each micro-batch under a partition of its own
(``streaming.batches``): a replayed batch replaces what an earlier attempt left
and never repeats or loses rows, whatever stream or checkpoint writes to the same
place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.enrich import PARSED_TIME
from clickweave.plans.batch import landed_facts, transform
from clickweave.session import stored
from clickweave.sources import catalog
from clickweave.sources.json_events import corrupt_lines, parse_json_lines
from clickweave.sources.schema import CORRUPT_COLUMN, PARTITION_COLUMNS
from clickweave.sources.sinks import write_curated
from clickweave.streaming.batches import batch_key, replacing


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def read_lines_stream(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None,
                      max_bytes_per_trigger: int | None = None) -> DataFrame:
    """T4. Streaming text lines of every file under ``path`` (sub-folders
    included, gzip decoded by extension). A micro-batch takes in at most so many
    files, or files of so many bytes (at least one)."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


#: Buffer sizes of the delivery: bytes of one delivered file, files of one batch.
DELIVERY_BYTES = 5 << 20
DELIVERY_FILES = 64


def deliver_raw(spark: SparkSession, inbox: str, raw_zone: str, checkpoint: str,
                trigger: str | None = "availableNow", file_bytes: int = DELIVERY_BYTES, files: int = DELIVERY_FILES):
    """T1. Buffered delivery: records from ``inbox`` appended to gzip files
    under ``raw_zone/year=/month=/day=`` of their arrival (processing) date.

    Size or time, whichever is first: ``trigger="300 seconds"`` is the time, and a
    micro-batch takes in at most ``files * file_bytes`` bytes, dealt by line over
    ``files`` tasks, so a delivered file holds about ``file_bytes`` of text at most,
    however long the backlog. (A batch that is smaller gives smaller files.)"""
    lines = read_lines_stream(spark, inbox, max_bytes_per_trigger=files * file_bytes)
    arrived = lines.repartition(files).select(
        "value",
        F.date_format(F.current_date(), "yyyy").alias("year"),
        F.date_format(F.current_date(), "MM").alias("month"),
        F.date_format(F.current_date(), "dd").alias("day"))
    writer = (arrived.writeStream.format("text")
              .option("compression", "gzip")
              .option("checkpointLocation", checkpoint)
              .partitionBy(*PARTITION_COLUMNS)
              .outputMode("append"))
    return _trigger(writer, trigger).start(raw_zone)


#: Arrival date of a line, when the stream's plan gives it.
ARRIVED = "_arrived"
#: Error type of a line that is not one JSON object (a fixed label).
MALFORMED = "malformed-json"


def route_errors(good_path: str, error_path: str):
    """T2. ``foreachBatch`` function: each line is parsed once (typed rows go to
    the shared work folder); well-formed lines are appended under
    ``good_path/year=/month=/day=/batch=`` of their arrival date, malformed ones
    under ``error_path/error_type=/year=/month=/day=/batch=``. The arrival date
    is that of the first attempt: it is taken in the stream's own plan, where
    Spark fixes it a batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = batch_key(spark, batch_id)
        lines = batch if ARRIVED in batch.columns else batch.withColumn(ARRIVED, F.current_date())
        day = lines.agg(F.min(ARRIVED)).first()[0]
        if day is None:
            return
        tagged = stored(parse_json_lines(lines, keep_line=True).select(
            F.col("_line").alias("value"), F.col(CORRUPT_COLUMN).isNotNull().alias("_bad"),
            *[F.lit(day.strftime(f)).alias(c) for c, f in zip(PARTITION_COLUMNS, ("%Y", "%m", "%d"))]), "routed")
        bad = tagged.where("_bad").withColumn("error_type", F.lit(MALFORMED))
        replacing(tagged.where(~F.col("_bad")).select("value", *PARTITION_COLUMNS), key, PARTITION_COLUMNS).text(good_path)
        errors = ["error_type", *PARTITION_COLUMNS]
        replacing(bad.select("value", *errors), key, errors).text(error_path)
    return run


def error_routing(lines: DataFrame, good_path: str, error_path: str, checkpoint: str, trigger: str | None = "availableNow"):
    """T2 as a started query over a stream of lines."""
    writer = (lines.withColumn(ARRIVED, F.current_date()).writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(route_errors(good_path, error_path)))
    return _trigger(writer, trigger).start()


def transform_batches(target: str, database: str | None = None,
                      table: str = catalog.DEFAULT_TABLE, processed_at=None,
                      errors_path: str | None = None, **seq_opts):
    """T3. ``foreachBatch`` function: the batch transform applied to each
    micro-batch of raw lines, written under the batch's own partitions of
    the table, which are registered when a database is given. Sequences are
    numbered within the batch, as a batch run numbers within its run."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = batch_key(spark, batch_id)
        landing = stored(parse_json_lines(batch), "landed")
        facts = landed_facts(landing)
        curated = transform(landing, processed_at=processed_at, extra=facts.fields, **seq_opts)
        write_curated(curated, target, batch=key)
        if errors_path:
            replacing(corrupt_lines(landing), key, []).text(errors_path)
        if database:
            name = catalog.register_table(spark, target, database, table, days=facts.days, batch=key)
            catalog.evolve_schema(spark, name, curated)
    return run


def incremental_transform(spark: SparkSession, raw_zone: str, target: str, checkpoint: str,
                          database: str | None = None, trigger: str | None = "availableNow",
                          processed_at=None, errors_path: str | None = None,
                          table: str = catalog.DEFAULT_TABLE,
                          max_files_per_trigger: int | None = None, **seq_opts):
    """T3. Process every raw file not yet seen into the curated table.
    ``max_files_per_trigger`` bounds a micro-batch; set it when the first run
    meets a backlog."""
    lines = read_lines_stream(spark, raw_zone, max_files_per_trigger)
    writer = (lines.writeStream
              .option("checkpointLocation", checkpoint)
              .foreachBatch(transform_batches(target, database, table=table,
                                              processed_at=processed_at,
                                              errors_path=errors_path, **seq_opts)))
    return _trigger(writer, trigger).start()


def dedup_stream(lines: DataFrame, delay: str = "1 hour") -> DataFrame:
    """T6. Well-formed events with a valid time, a repeated ``event_id``
    dropped when it arrives within ``delay`` of the first (state is kept only
    for the watermark delay, so it stays bounded).

    Events later than ``delay`` are dropped by the watermark. Events whose time
    does not parse cannot be placed in it: ``untimed_events`` of the same lines
    gives them, and the query's progress counts them (``dedup_input``)."""
    landing = parse_json_lines(lines)
    timed = (landing.where(F.col(CORRUPT_COLUMN).isNull())
             .withColumn(PARSED_TIME, F.try_to_timestamp("timestamp"))
             .observe("dedup_input", F.count(F.lit(1)).alias("events"),
                      F.count_if(F.col(PARSED_TIME).isNull()).alias("untimed")))
    return (timed.where(F.col(PARSED_TIME).isNotNull()).withWatermark(PARSED_TIME, delay)
                 .dropDuplicatesWithinWatermark(["event_id"]))


def untimed_events(lines: DataFrame) -> DataFrame:
    """Well-formed events that ``dedup_stream`` leaves out: no valid time."""
    landing = parse_json_lines(lines)
    return landing.where(F.col(CORRUPT_COLUMN).isNull() & F.try_to_timestamp("timestamp").isNull())


def main(argv: list[str] | None = None) -> int:
    """Command line for the incremental transform::

        python -m clickweave.streaming.ingest --raw <raw folder> --target <table folder> \\
            --checkpoint <checkpoint folder> [--database clickstream_db] [--trigger "300 seconds"]

    With the default ``availableNow`` trigger it processes the files not seen
    yet and stops; with a processing-time trigger it keeps running."""
    import argparse

    from clickweave.session import get_session

    ap = argparse.ArgumentParser(description="raw JSON files -> curated table, incrementally")
    ap.add_argument("--raw", required=True)
    ap.add_argument("--target", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--database", default=None)
    ap.add_argument("--table", default=catalog.DEFAULT_TABLE)
    ap.add_argument("--errors-path", default=None)
    ap.add_argument("--trigger", default="availableNow")
    ap.add_argument("--max-files-per-trigger", type=int, default=None)
    args = ap.parse_args(argv)
    spark = get_session(app="clickweave-stream")
    query = incremental_transform(spark, args.raw, args.target, args.checkpoint,
                                  database=args.database, table=args.table,
                                  trigger=args.trigger, errors_path=args.errors_path,
                                  max_files_per_trigger=args.max_files_per_trigger)
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main())
