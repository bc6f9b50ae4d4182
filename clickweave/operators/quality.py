"""Cleaning: corrupt records, required fields, personal fields, counters.

Counting is done in one pass with ``DataFrame.observe`` on the frame that is
written, instead of one ``count()`` job per check, so the input is parsed
once per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickweave.sources.schema import CORRUPT_COLUMN, DROPPED_FIELDS, REQUIRED_FIELDS


def corrupt_condition(col: str = CORRUPT_COLUMN) -> Column:
    return F.col(col).isNotNull()


def drop_corrupt(df: DataFrame, col: str = CORRUPT_COLUMN) -> DataFrame:
    """F1. Keep well-formed rows and drop the corrupt-text column."""
    if col not in df.columns:
        return df
    return df.where(F.col(col).isNull()).drop(col)


def count_corrupt(df: DataFrame, col: str = CORRUPT_COLUMN) -> DataFrame:
    """F2. One-row frame with the number of malformed rows."""
    if col not in df.columns:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("corrupt_records"))
    return df.agg(F.count_if(corrupt_condition(col)).alias("corrupt_records"))


def require_fields(df: DataFrame, fields: list[str] = REQUIRED_FIELDS) -> DataFrame:
    """F3. Drop rows with NULL in any required field (empty strings pass)."""
    present = [f for f in fields if f in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def null_count_columns(fields: list[str] = REQUIRED_FIELDS, present: list[str] | None = None
                       ) -> list[Column]:
    """F4. NULL count per required field, counted the way sequential filters
    count: field *i* only over rows whose earlier fields are all non-NULL."""
    out = []
    earlier: list[str] = []
    for f in fields:
        if present is not None and f not in present:
            out.append(F.lit(0).cast("bigint").alias(f"null_{f}"))
            continue
        cond = F.col(f).isNull()
        for e in earlier:
            cond = cond & F.col(e).isNotNull()
        out.append(F.count_if(cond).alias(f"null_{f}"))
        earlier.append(f)
    return out


def null_counts(df: DataFrame, fields: list[str] = REQUIRED_FIELDS) -> DataFrame:
    """F4 as a one-row frame."""
    return df.agg(*null_count_columns(fields, df.columns))


def drop_columns(df: DataFrame, names: list[str] = DROPPED_FIELDS) -> DataFrame:
    """F5. ``drop`` ignores names that are not present."""
    return df.drop(*names)


def observe_run(df: DataFrame, name: str = "run_counters") -> tuple[DataFrame, Observation]:
    """A18. Attach read / corrupt / NULL-per-field counters to ``df``; they are
    filled by the first action over the returned frame (the write)."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows_read")]
    if CORRUPT_COLUMN in df.columns:
        metrics.append(F.count_if(corrupt_condition()).alias("corrupt_records"))
        ok = F.col(CORRUPT_COLUMN).isNull()
    else:
        metrics.append(F.lit(0).cast("bigint").alias("corrupt_records"))
        ok = F.lit(True)
    earlier = ok
    for f in REQUIRED_FIELDS:
        metrics.append(F.count_if(earlier & F.col(f).isNull()).alias(f"null_{f}"))
        earlier = earlier & F.col(f).isNotNull()
    metrics.append(F.count_if(earlier).alias("valid_records"))
    bad_time = earlier & F.try_to_timestamp(F.col("timestamp")).isNull()
    metrics.append(F.count_if(bad_time).alias("bad_time_records"))
    return df.observe(obs, *metrics), obs
