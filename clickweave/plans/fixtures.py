"""File-backed inputs derived from the test tables, for the source, sink,
catalog and streaming entries.

Each is written once per session and ``sf_dir`` under the shared work folder
(``spark.checkpoint.dir``), then read back by the entries that need it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from clickweave.plans.batch import transform
from clickweave.plans.jobs import RunResult, run_batch
from clickweave.plans.registry import FIXED_STAMP
from clickweave.session import configure, scratch_path
from clickweave.sources.json_events import read_raw_events
from clickweave.sources.testdata import json_lines_from_tables

#: Database of the registered entries.
FIXTURE_DATABASE = "clickweave_fixture"

_CACHE: dict[tuple, object] = {}


def _key(spark: SparkSession, *parts) -> tuple:
    return (spark.sparkContext.applicationId, *parts)


def once(spark: SparkSession, name: str, sf_dir: str, build):
    """``build()`` run once per session, name and test-table folder; later
    calls return the first result (a written path, a run result)."""
    key = _key(spark, name, os.path.abspath(sf_dir))
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def raw_zone(spark: SparkSession, sf_dir: str) -> str:
    """The JSON fixture as gzip JSON-lines files under arrival-style folders
    ``raw/year=/month=/day=`` (written once)."""
    def build():
        configure(spark)
        path = scratch_path(spark, "raw")
        # Delivery buffers a few MB per file: at these sizes about one
        # file per day, as a buffered delivery stream would write.
        (json_lines_from_tables(spark, sf_dir)
            .repartition("year", "month", "day")
            .write.mode("overwrite").partitionBy("year", "month", "day")
            .option("compression", "gzip").text(path))
        return path
    return once(spark, "raw_zone", sf_dir, build)


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S3 over the raw zone: landing rows with ``_corrupt_record``."""
    return read_raw_events(spark, raw_zone(spark, sf_dir), "lines")


def json_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8 over the raw zone (lazy)."""
    return transform(landing(spark, sf_dir), processed_at=FIXED_STAMP)


def stored_run(spark: SparkSession, sf_dir: str) -> RunResult:
    """The batch job run once over the raw zone into a fresh table folder,
    registered under a name of its own (``clickweave_fixture``), so a user's
    table of the production name is never touched."""

    def build():
        source = raw_zone(spark, sf_dir)
        table = f"run_{uuid.uuid4().hex[:12]}"
        return run_batch(spark, source, scratch_path(spark, "transformed"),
                         database=FIXTURE_DATABASE, table=table,
                         errors_path=scratch_path(spark, "errors"), processed_at=FIXED_STAMP)
    return once(spark, "stored", sf_dir, build)
