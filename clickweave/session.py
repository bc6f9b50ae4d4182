"""Spark session settings and the shared work folder.

Settings every job relies on:

* session time zone UTC, so hours and dates of event times do not depend on
  the machine;
* partition column type inference off, so ``year/month/day`` stay the
  zero-padded strings the queries compare against;
* AQE on, with partition coalescing to the advisory size and skew-join
  splitting, so shuffle sizes are planned from runtime statistics rather
  than guessed.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce shuffle partitions to the advisory size rather than keeping
    # the configured count: partitions follow data volume at any scale.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Settings without which results would be wrong.
REQUIRED = ("spark.sql.session.timeZone", "spark.sql.sources.partitionColumnTypeInference.enabled")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session. A setting that
    the session refuses is left as it is, unless results depend on it."""
    for key, value in BASE_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
        if key in REQUIRED and spark.conf.get(key) != value:
            raise RuntimeError(f"the session refuses {key}={value}")
    return spark


def get_session(master: str | None = None, app: str = "clickweave",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings above.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests
    and the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Shuffled and scanned bytes of a task in ``small_tasks``.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.files.maxPartitionBytes": "16m"}


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Tasks of few bytes for what is run inside. Spark sizes tasks by compressed
    bytes; ids and short texts take ten times as many and more where a sort or a hash
    table holds them, so a task of the usual size holds gigabytes. The number of
    tasks follows the rows, the memory of one does not. Decides sizes, never rows."""
    before = {key: spark.conf.get(key) for key in SMALL_TASKS}
    try:
        for key, value in SMALL_TASKS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it. Only when it is
    unset and the master is local (tests, the bench) a fresh folder is made; on
    a cluster each machine would see a folder of its own, so that is an error.
    """
    current = spark.conf.get("clickweave.work.dir", None)
    if current:
        return current
    sc = spark.sparkContext
    current = (spark.conf.get("spark.checkpoint.dir", None)
               or sc.getConf().get("spark.checkpoint.dir", None))
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="clickweave-work-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    spark.conf.set("clickweave.work.dir", current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared work folder."""
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back: computed once,
    and safe against lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
