"""The batch job — raw JSON folder in, curated table out.

    run_batch(spark, source, target, database)

The raw text is read and parsed once: typed rows go to the shared work
folder, and the run counters (rows read, corrupt, NULL per required field,
valid) ride along on that write through ``observe``. The hot-key sample, the
transform, the malformed lines, the days and the new fields all come from the
stored rows. The summary is computed from the rows just written.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.event_ledger import EventLedger
from clickweave.operators.quality import observe_run
from clickweave.operators.session_runs import SessionRuns
from clickweave.operators.sequence import DEFAULT_SAMPLE_FRACTION, DEFAULT_SEED
from clickweave.plans.batch import clean, conform, landed_facts, run_stamp, transform
from clickweave.session import stored
from clickweave.sources import catalog
from clickweave.sources.json_events import read_raw_events, write_corrupt
from clickweave.sources.sinks import read_curated, write_curated

#: Options of the hot-key split, of both the run's numbering and its sums.
SPLIT_OPTIONS = ("sample_fraction", "min_hot_rows", "rows_per_bucket", "seed")
#: Event types printed by the command line.
TYPES_SHOWN = 100


@dataclass
class RunResult:
    stamp: _dt.datetime
    counters: dict = field(default_factory=dict)
    table: str | None = None
    written: DataFrame | None = None
    target: str | None = None
    errors: str | None = None

    def summary(self) -> DataFrame:
        return run_summary(self.written)

    def type_counts(self) -> DataFrame:
        return run_type_counts(self.written)


def land(spark: SparkSession, source: str, layout: str = "lines",
         spread_lines: bool = False) -> tuple[DataFrame, dict]:
    """Parse the input once into the shared work folder: ``(landing, counters)``."""
    observed, obs = observe_run(read_raw_events(spark, source, layout, spread_lines=spread_lines))
    landing = stored(observed, "landed")
    return landing, dict(obs.get)


def prepare_batch(landing: DataFrame, stamp: _dt.datetime, extra: list[str] = (), **seq_opts) -> DataFrame:
    """The curated rows of one run, from its landed rows."""
    fraction = seq_opts.get("sample_fraction", DEFAULT_SAMPLE_FRACTION)
    seed = seq_opts.get("seed", DEFAULT_SEED)
    return transform(landing, processed_at=stamp, extra=extra,
                     sample_raw=landing.sample(fraction=fraction, seed=seed), **seq_opts)


def in_days(days: list[tuple] | None):
    """Filter on partition columns only (so it prunes): one membership test of
    the day's text, and the default partition when a day is NULL; all days when
    they are too many to name (None)."""
    if days is None:
        return F.lit(True)
    known = ["-".join(d) for d in days if None not in d]
    cond = F.concat("year", F.lit("-"), "month", F.lit("-"), "day").isin(known)
    return cond | F.col("year").isNull() if len(known) < len(days) else cond


def run_number(stamp: _dt.datetime) -> int:
    """A run's time stamp as a whole number (microseconds)."""
    aware = stamp if stamp.tzinfo else stamp.replace(tzinfo=_dt.timezone.utc)
    return (aware - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)) // _dt.timedelta(microseconds=1)


def stored_rows(spark: SparkSession, target: str) -> DataFrame | None:
    """The table's rows; None before its first run."""
    try:
        return read_curated(spark, target)
    except AnalysisException:
        return None


def run_batch(spark: SparkSession, source: str, target: str, database: str | None = None,
              table: str = catalog.DEFAULT_TABLE, layout: str = "lines",
              errors_path: str | None = None, processed_at: _dt.datetime | None = None,
              spread_lines: bool = False, sessions: SessionRuns | None = None,
              ledger: EventLedger | None = None, **seq_opts) -> RunResult:
    """S5. Transform every raw file under ``source`` and append the result to
    the partitioned table at ``target``; register it in ``database`` when
    given. Malformed records go to ``errors_path`` when given. Fields that
    producers added become text columns of the files and of the table.

    ``sessions``: the table's session totals; positions then go on from the
    session's earlier runs (read the table through ``sessions.read``).
    ``ledger``: the ids of stored events; events of earlier runs are left out."""
    stamp = processed_at or run_stamp()
    landing, counters = land(spark, source, layout, spread_lines)
    if ledger:
        valid = conform(landing)
        landing = ledger.fresh(valid, run_number(stamp))
    days, extra = landed_facts(landing)
    curated = prepare_batch(landing, stamp, extra, **seq_opts)
    if errors_path and counters.get("corrupt_records", 0) > 0:
        write_corrupt(landing, errors_path)
    if sessions:
        curated = sessions.begin(curated, stored_rows(spark, target), **{k: v for k, v in seq_opts.items() if k in SPLIT_OPTIONS})
    write_curated(curated, target)
    if sessions:
        sessions.commit()
    if ledger:
        ledger.commit(clean(landing), run_number(stamp))
    name = None
    if database:
        name = catalog.register_table(spark, target, database, table, days=days)
        catalog.evolve_schema(spark, name, curated)
        if extra:
            spark.catalog.refreshTable(name)
    written = (read_curated(spark, target, extra=extra).where(in_days(days))
               .where(F.col("processed_timestamp") == F.lit(stamp)))
    return RunResult(stamp=stamp, counters=counters, table=name, written=written,
                     target=target, errors=errors_path)


def run_summary(written: DataFrame) -> DataFrame:
    """A17. Totals of one run: rows, distinct users, distinct sessions
    (``distinct().count()`` semantics: a NULL session counts as one value)."""
    return written.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("user_id").alias("distinct_users"),
        (F.count_distinct("session_id")
         + F.max(F.when(F.col("session_id").isNull(), 1).otherwise(0))).cast("bigint")
        .alias("distinct_sessions"))


def run_type_counts(written: DataFrame) -> DataFrame:
    """A17. Rows per event type in one run."""
    return written.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


def main(argv: list[str] | None = None) -> int:
    """Command line for the batch job, e.g. with ``spark-submit``::

        spark-submit -m clickweave.plans.jobs --source s3a://raw/raw/ \\
            --target s3a://curated/transformed/ --database clickstream_db
    """
    import argparse
    import json
    import sys

    from clickweave.session import get_session

    ap = argparse.ArgumentParser(description="raw JSON events -> curated partitioned table")
    ap.add_argument("--source", required=True)
    ap.add_argument("--target", required=True)
    ap.add_argument("--database", default=None)
    ap.add_argument("--table", default=catalog.DEFAULT_TABLE)
    ap.add_argument("--layout", choices=["lines", "array"], default="lines")
    ap.add_argument("--errors-path", default=None)
    ap.add_argument("--spread-lines", action="store_true")
    ap.add_argument("--sessions", default=None,
                    help="folder of the table's session totals: positions go on across runs (needs --database)")
    ap.add_argument("--ledger", default=None, help="folder of the ids of stored events: these are left out")
    ap.add_argument("--catalog", choices=["session", "hive"], default="session",
                    help="hive: use the metastore that the cluster configures")
    args = ap.parse_args(argv)
    extra = {"spark.sql.catalogImplementation": "hive"} if args.catalog == "hive" else None
    spark = get_session(app="clickweave-batch", extra=extra)
    run = run_batch(spark, args.source, args.target, database=args.database, table=args.table,
                    layout=args.layout, errors_path=args.errors_path,
                    spread_lines=args.spread_lines,
                    sessions=SessionRuns(spark, args.sessions, args.database, args.table) if args.sessions else None,
                    ledger=EventLedger(spark, args.ledger) if args.ledger else None)
    summary = run.summary().first().asDict()
    # event types are free text: the most frequent ones, and how many there are
    counts = run.type_counts()
    types = {r.event_type: r["count"] for r in counts.orderBy(F.desc("count"), "event_type").limit(TYPES_SHOWN).collect()}
    if args.database and not catalog.is_durable(spark):
        print("note: this session's catalog is in memory; the table's registration ends with the process "
              "(give --catalog hive, or run under a session with a persistent catalog)", file=sys.stderr)
    print(json.dumps({"stamp": run.stamp.isoformat(), "counters": run.counters,
                      "summary": summary, "event_types": types, "n_event_types": counts.count()}, default=str))
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main())
