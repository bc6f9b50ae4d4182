"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every entry reads the test tables of ``sf_dir`` (through the mapping in
``sources.testdata`` and the batch transform), so its work grows with them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickweave.plans import library
from clickweave.operators.sequence import DEFAULT_SAMPLE_FRACTION, DEFAULT_SEED
from clickweave.plans.batch import transform
from clickweave.session import configure
from clickweave.sources.testdata import raw_events_from_tables

AS_OF = _dt.date(2024, 1, 15)
# Fixed job stamp for registered queries, so repeated runs give equal rows.
FIXED_STAMP = _dt.datetime(2024, 2, 1, 0, 0, 0, tzinfo=_dt.timezone.utc)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return raw_events_from_tables(spark, sf_dir)


def curated(spark: SparkSession, sf_dir: str, **seq_opts) -> DataFrame:
    """The curated table built lazily from the test tables. Hot-key detection
    for the session sequence reads a sample drawn right after the scan."""
    fraction = seq_opts.get("sample_fraction", DEFAULT_SAMPLE_FRACTION)
    seed = seq_opts.get("seed", DEFAULT_SEED)
    sample = raw_events_from_tables(spark, sf_dir, sample_fraction=fraction, seed=seed)
    return transform(raw_events(spark, sf_dir), processed_at=FIXED_STAMP, sample_raw=sample,
                     **seq_opts)


def stored_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table as it is stored: written once per session and test
    folder, partitioned by day, then read with its declared schema. Day filters
    prune its partitions."""
    from clickweave.plans import fixtures
    from clickweave.session import scratch_path
    from clickweave.sources.sinks import read_curated, write_curated

    def build():
        path = scratch_path(spark, "curated")
        write_curated(curated(spark, sf_dir), path)
        return path
    return read_curated(spark, fixtures.once(spark, "curated", sf_dir, build))


def _library_entry(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(stored_curated(spark, sf_dir), as_of=AS_OF)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _library_entry(fn) for name, fn in library.LIBRARY.items()}
