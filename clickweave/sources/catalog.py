"""The catalog side — database, table, partitions, statistics,
schema evolution and named (saved) queries."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.sources.schema import BATCH_COLUMN, PARTITION_COLUMNS, curated_ddl

log = logging.getLogger(__name__)

DEFAULT_DATABASE = "clickstream_db"
DEFAULT_TABLE = "transformed"


def is_durable(spark: SparkSession) -> bool:
    """Whether registered tables outlive this process."""
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "in-memory"


def create_database(spark: SparkSession, database: str = DEFAULT_DATABASE) -> None:
    """K4."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def register_table(spark: SparkSession, location: str, database: str = DEFAULT_DATABASE,
                   table: str = DEFAULT_TABLE, replace: bool = False,
                   days: list[tuple] | None = None, batch: str | None = None) -> str:
    """K5 + K7. External partitioned Parquet table over ``location`` with the
    curated columns. A table created now has its partitions discovered by a
    full repair; an existing one only gets the ``days`` just written (when
    known). ``batch``: the micro-batch that wrote them; its table has the batch
    as one more partition column. Returns the qualified name."""
    create_database(spark, database)
    name = f"{database}.{table}"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: files stay
    existed = spark.catalog.tableExists(name)
    spark.sql(curated_ddl(name, location, batched=batch is not None))
    if existed and partition_columns(spark, name) != PARTITION_COLUMNS + [BATCH_COLUMN] * (batch is not None):
        raise ValueError(f"{name} is partitioned by {partition_columns(spark, name)}: runs and streams append to tables of their own")
    if existed and days is not None:
        add_partitions(spark, name, days if batch is None else [(*d, batch) for d in days])
    else:
        repair_partitions(spark, name)
    return name


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _partition_spec(day: tuple) -> str:
    values = ", ".join(f"{c}={'NULL' if v is None else repr(v)}" for c, v in zip((*PARTITION_COLUMNS, BATCH_COLUMN), day))
    return f"PARTITION ({values})"


#: Partitions named in one statement.
SPECS = 500


def add_partitions(spark: SparkSession, name: str, days: list[tuple]) -> None:
    """Register the given ``(year, month, day)`` partitions; those the catalog
    knows already are skipped by it. Nothing is listed: the cost follows the run.
    A NULL day (events whose time did not parse) is the default partition."""
    wanted = sorted({tuple(d) for d in days}, key=lambda d: tuple(x or "" for x in d))
    for i in range(0, len(wanted), SPECS):
        specs = " ".join(_partition_spec(d) for d in wanted[i:i + SPECS])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def repair_partitions(spark: SparkSession, name: str) -> None:
    """K7. Register partition folders written since the last repair."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    """K8. One row per partition: ``year=…/month=…/day=…``."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def compute_statistics(spark: SparkSession, name: str) -> DataFrame:
    """K9. ``ANALYZE TABLE`` (feeds the cost-based optimizer), then the row
    count and size the catalog now holds, as a one-row frame."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    stats = (spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
             .where(F.col("col_name") == F.lit("Statistics")))
    return stats.select(
        F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"),
        F.regexp_extract("data_type", r"(\d+) bytes", 1).cast("bigint").alias("size_bytes"))


#: What ``DESCRIBE EXTENDED <table> <column>`` tells, with the names used here.
_TOLD = {"min": "min_value", "max": "max_value", "num_nulls": "null_count", "distinct_count": "distinct_count"}


def compute_column_statistics(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """K9. Row count, and per column NULLs, extremes, distinct values (an
    estimate) and an equi-height histogram, kept in the catalog for the cost-based
    optimizer (see ``use_statistics``). One row a column."""
    histograms = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(histograms)
    spark.conf.set(histograms, "true")
    try:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")
    finally:
        spark.conf.set(histograms, before)
    out = []
    for c in columns:
        told = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} `{c}`").collect()}
        known = {new: None if told.get(old) in (None, "NULL") else told[old] for old, new in _TOLD.items()}
        out.append((c, *known.values(), told.get("histogram", "NULL") != "NULL"))
    rows = spark.createDataFrame(out, "column_name string, " + ", ".join(f"{n} string" for n in _TOLD.values()) + ", has_histogram boolean")
    return rows.withColumns({n: F.col(n).cast("bigint") for n in ("null_count", "distinct_count")})


def compute_partition_statistics(spark: SparkSession, name: str) -> None:
    """K9. Row count and size of every partition, counted without a scan of the
    columns; a day filter is then planned by the days' own sizes."""
    spark.sql(f"ANALYZE TABLE {name} PARTITION ({', '.join(partition_columns(spark, name))}) COMPUTE STATISTICS")


def partition_rows(spark: SparkSession, name: str, day: tuple) -> int | None:
    """Row count that the catalog holds for one partition."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name} {_partition_spec(day)}").where(F.col("col_name") == "Partition Statistics").collect()
    found = rows and re.search(r"(\d+) rows", rows[0]["data_type"])
    return int(found.group(1)) if found else None


def use_statistics(spark: SparkSession) -> None:
    """Let plans follow the statistics: filter and join estimates, join order."""
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled", "spark.sql.cbo.planStats.enabled"):
        spark.conf.set(key, "true")


def list_tables(spark: SparkSession, database: str = DEFAULT_DATABASE) -> DataFrame:
    """K10."""
    return spark.sql(f"SHOW TABLES IN {database}")


def evolve_schema(spark: SparkSession, name: str, df: DataFrame) -> tuple[list[str], list[str]]:
    """K6. Columns of ``df`` that the table lacks are added to the table;
    table columns missing from ``df`` are only logged (the table keeps them,
    older files keep their values). Returns ``(added, missing)``."""
    table_cols = {f.name: f for f in spark.table(name).schema.fields}
    added = [f for f in df.schema.fields if f.name not in table_cols]
    missing = [c for c in table_cols if c not in {*df.columns, BATCH_COLUMN}]
    if added:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    for c in missing:
        log.warning("column %s of %s is absent from the new data; kept in the table", c, name)
    return [f.name for f in added], missing


def create_saved_views(spark: SparkSession, df: DataFrame, as_of=None) -> dict[str, str]:
    """K11. Every saved query as a temporary view; returns name → description."""
    from clickweave.plans.saved import SAVED_QUERIES
    out = {}
    for view, (description, fn) in SAVED_QUERIES.items():
        fn(df, as_of=as_of).createOrReplaceTempView(view)
        out[view] = description
    return out


def create_library_views(spark: SparkSession, df: DataFrame, as_of=None,
                         exact: bool = True) -> list[str]:
    """Every query of the library as a temporary view named after it, so the
    queries can also be run as SQL (``SELECT * FROM q05_session_funnel``)."""
    from clickweave.plans.library import LIBRARY
    for view, fn in LIBRARY.items():
        fn(df, as_of=as_of, exact=exact).createOrReplaceTempView(view)
    return list(LIBRARY)
