"""T5: a live "latest events" view kept by a stateful stream.

Sorting a whole append stream is not allowed, and it is not needed. Events are
dealt to buckets by a hash of ``event_id``; the state of a bucket is the list of
its ``n`` latest events, one row per event id, held in Spark's state store
(``applyInPandasWithState``). A micro-batch merges its rows into the lists, chunk
by chunk, so a task holds one chunk and ``n`` rows. The changed lists replace
their buckets' partitions of the view (dynamic partition overwrite). A replayed
batch starts from the state of the batch before it, gives the same lists and
replaces the same partitions; a restart goes on from the checkpoint.

The view is ``buckets * n`` rows at most; readers order these and take ``n``. The
``n`` latest of all events are among the ``n`` latest of the buckets they are in.
A view belongs to one checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from clickweave.functions import finite_number
from clickweave.operators import quality
from clickweave.sources.json_events import parse_json_lines

LATEST_COLUMNS = ["timestamp", "event_type", "user_id", "session_id", "product_id",
                  "product_name", "price", "device_type", "page_url"]
BUCKETS = 16
#: A list's rows: event time in microseconds (NULL for a bad time) and the event.
_ROW = ["event_id", "at", *LATEST_COLUMNS]
_TYPES = {"at": "long", "price": "double", "bucket": "int", "n": "int"}
_VIEW = ["bucket", "n", *_ROW]
VIEW_SCHEMA = ", ".join(f"`{c}` {_TYPES.get(c, 'string')}" for c in _VIEW)


def _rank(row: list) -> tuple:
    """Sort key of the view: latest first, bad times last, then event id."""
    return row[1] is None, -(row[1] or 0), row[0]


def _newer(a: list, b: list) -> bool:
    """Of two rows of one event: the later, then the one whose text sorts last."""
    return (a[1] is not None, a[1] or 0, json.dumps(a)) > (b[1] is not None, b[1] or 0, json.dumps(b))


def merged(held: list[list], rows: Iterator[list], n: int) -> list[list]:
    """The ``n`` first rows of ``held`` and ``rows``, one an event."""
    best: dict[str, list] = {}
    for row in [*held, *rows]:
        if row[0] not in best or _newer(row, best[row[0]]):
            best[row[0]] = row
    return sorted(best.values(), key=_rank)[:n]


def latest_lists(n: int):
    """``applyInPandasWithState`` function of a bucket's list."""
    def run(key, chunks, state):
        held = json.loads(state.get[0]) if state.exists else []
        for chunk in chunks:
            values = chunk[_ROW].astype(object).where(chunk[_ROW].notna(), None).values.tolist()
            held = merged(held, ([r[0], None if r[1] is None else int(r[1]), *r[2:]] for r in values), n)
        state.update((json.dumps(held),))
        out = pd.DataFrame(held, columns=_ROW, dtype=object)
        out.insert(0, "n", n)
        out.insert(0, "bucket", key[0])
        yield out.astype({"at": "Int64", "price": "float64", "bucket": "int32", "n": "int32"})
    return run


def latest_stream(lines: DataFrame, n: int = 100, buckets: int = BUCKETS) -> DataFrame:
    """Changed lists of a stream of lines, in update mode."""
    events = quality.require_fields(quality.drop_corrupt(parse_json_lines(lines)))
    rows = (events.withColumn("at", F.unix_micros(F.try_to_timestamp("timestamp")))
            .withColumn("price", finite_number("price"))
            .select(F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int").alias("bucket"), *_ROW))
    return rows.groupBy("bucket").applyInPandasWithState(latest_lists(n), VIEW_SCHEMA, "rows string", "update", GroupStateTimeout.NoTimeout)


def replace_lists(root: str):
    """``foreachBatch`` function: changed lists replace those of their buckets."""
    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(root))
    return run


def live_monitor(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str,
                 n: int = 100, trigger: str | None = "availableNow", buckets: int = BUCKETS):
    """T5 as a started query that keeps the view at ``root``."""
    writer = (latest_stream(lines, n, buckets).writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint).foreachBatch(replace_lists(root)))
    if trigger in (None, "availableNow"):
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The view, latest first; None before the first batch."""
    try:
        view = spark.read.schema(VIEW_SCHEMA).parquet(root)
    except AnalysisException:
        return None
    top = view.agg(F.max("n")).first()[0]
    if top is None:
        return None
    return view.orderBy(F.desc_nulls_last("at"), F.asc_nulls_last("event_id")).limit(top).select(*LATEST_COLUMNS)
