"""The raw → curated transform as one lazy DataFrame plan.

    raw ─▶ drop corrupt (F1) ─▶ required fields (F3) ─▶ typed numbers
        ─▶ job stamp, event time, date parts, hour, date (E1-E5)
        ─▶ drop personal fields (F5) ─▶ quality flags (E6) ─▶ category (E7)
        ─▶ session sequence + start flag (W1, W2) ─▶ curated columns

Everything up to the sequence is row-local (one narrow stage). The sequence
is the only shuffle; it is skew-safe (see ``operators.sequence``).
"""

from __future__ import annotations

import datetime as _dt
import logging
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions import finite_number
from clickweave.operators import enrich, quality
from clickweave.operators.sequence import sequence_within, session_start
from clickweave.sources.json_events import MAX_NEW_FIELDS
from clickweave.sources.schema import (
    CURATED_FIELDS, DROPPED_FIELDS, EXTRA_COLUMN, MORE_FIELDS, OTHER_COLUMN, PARTITION_COLUMNS, RAW_FIELDS,
    curated_schema, extra_column,
)

log = logging.getLogger(__name__)


def typed_numbers(df: DataFrame) -> DataFrame:
    """``price`` → DOUBLE, ``quantity`` → INT. What is not a finite number
    becomes NULL; the row is kept. ``"1.0"`` gives quantity 1."""
    types = dict(df.dtypes)
    if "price" in types:
        df = df.withColumn("price", finite_number("price"))
    if types.get("quantity") == "string":
        df = df.withColumn("quantity", F.col("quantity").try_cast("double").try_cast("int"))
    return df


def conform(df: DataFrame) -> DataFrame:
    """Add raw fields missing from the batch as typed NULL columns, so the
    transform never depends on which fields a batch happened to carry."""
    have = set(df.columns)
    for name, t in RAW_FIELDS:
        if name not in have:
            df = df.withColumn(name, F.lit(None).cast(t))
    return df


def clean(raw: DataFrame) -> DataFrame:
    """F1 + F3 + number typing."""
    return typed_numbers(quality.require_fields(quality.drop_corrupt(conform(raw))))


def enrich_events(df: DataFrame, processed_at: _dt.datetime | None = None) -> DataFrame:
    """E1-E7 and F5; keeps the parsed time in a temporary column."""
    df = enrich.with_processed_timestamp(df, processed_at)
    df = enrich.with_event_time(df)
    df = enrich.with_time_parts(df)
    df = quality.drop_columns(df, DROPPED_FIELDS)
    df = enrich.with_quality_flags(df)
    return enrich.with_event_category(df)


def add_sequence(df: DataFrame, sample: DataFrame | None = None, **seq_opts) -> DataFrame:
    """W1 + W2 on a frame that still has the parsed time column."""
    df = sequence_within(df, "session_id", enrich.PARSED_TIME, "event_id",
                         "event_sequence", sample=sample, **seq_opts)
    return df.withColumn("is_session_start", session_start("event_sequence"))


def to_curated(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Table column order; ``extra`` producer fields come from ``_extra``."""
    rest = F.map_filter(EXTRA_COLUMN, lambda k, v: ~k.isin([n for n in extra if n != MORE_FIELDS]))
    own = {OTHER_COLUMN: F.when(F.size(rest) > 0, rest)} if MORE_FIELDS in extra else {}
    own |= {extra_column(n): F.col(EXTRA_COLUMN)[n] for n in extra if n != MORE_FIELDS}
    return df.select(*[own.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in curated_schema(extra).fields]) \
        if extra else df.select(*[F.col(n).cast(t).alias(n) for n, t in CURATED_FIELDS])


def sequence_sample(sample_raw: DataFrame) -> DataFrame:
    """Session key, parsed time and event id of raw rows drawn for hot-key
    detection."""
    return enrich.with_event_time(clean(sample_raw)).select("session_id", enrich.PARSED_TIME, "event_id")


#: Days of one run that are registered by name; a run with more (producers with
#: wrong clocks) has its partitions found by a repair.
MAX_DAYS = 5000


class LandedFacts(NamedTuple):
    """``days``: the ``(year, month, day)`` partitions a run writes, ascending, a
    NULL day for times that do not parse; None beyond ``MAX_DAYS``. ``fields``: the
    new producer fields that become columns, sorted."""

    days: list[tuple] | None
    fields: list[str]


def landed_facts(landing: DataFrame) -> LandedFacts:
    """What a run must know before it writes, by one aggregation over the landed
    rows; the driver gets at most ``MAX_DAYS`` days and ``MAX_NEW_FIELDS`` names. Of
    more names than that the most used become columns, the others stay together in
    a map column (``MORE_FIELDS`` ends the list)."""
    timed = enrich.with_time_parts(enrich.with_event_time(clean(landing)))
    days = F.array(F.struct(*PARTITION_COLUMNS, F.lit(None).cast("string").alias("field")))
    names = F.transform(F.coalesce(F.map_keys(EXTRA_COLUMN), F.array().cast("array<string>")), lambda n: F.struct(
        *[F.lit(None).cast("string").alias(c) for c in PARTITION_COLUMNS], n.alias("field"))) if EXTRA_COLUMN in landing.columns else None
    told = (timed.select(F.inline(F.concat(days, names) if names is not None else days))
            .groupBy(*PARTITION_COLUMNS, "field").agg(F.count(F.lit(1)).alias("uses")))
    most_used = told.where(F.col("field").isNotNull()).orderBy(F.desc("uses"), "field").limit(MAX_NEW_FIELDS + 1)
    rows = told.where(F.col("field").isNull()).limit(MAX_DAYS + 1).unionByName(most_used).collect()
    used = [r["field"] for r in rows if r["field"] is not None]
    fields = sorted(used[:MAX_NEW_FIELDS]) + [MORE_FIELDS] * (len(used) > MAX_NEW_FIELDS)
    found = [tuple(r[c] for c in PARTITION_COLUMNS) for r in rows if r["field"] is None]
    if len(found) > MAX_DAYS:
        log.warning("more than %d days in one run: partitions are registered by a repair", MAX_DAYS)
        return LandedFacts(None, fields)
    return LandedFacts(sorted(found, key=lambda d: tuple(x or "" for x in d)), fields)


def transform(raw: DataFrame, processed_at: _dt.datetime | None = None,
              sample_raw: DataFrame | None = None, on_bad_time: str = "keep",
              extra: list[str] = (), **seq_opts) -> DataFrame:
    """E8. Raw events (any subset of the 16 fields, optionally with
    ``_corrupt_record``) → curated rows in table column order.

    ``on_bad_time``: ``"keep"`` (default) keeps an event whose time does not
    parse, with NULL date parts (it lands in the default partition);
    ``"reject"`` drops it.

    ``sample_raw``: the same input sampled at ``seq_opts['sample_fraction']``
    (default ``DEFAULT_SAMPLE_FRACTION``) before any parsing; hot-key
    detection then reads it instead of re-deriving every row.

    ``extra``: new producer fields to keep as text columns."""
    if on_bad_time not in ("keep", "reject"):
        raise ValueError("on_bad_time must be 'keep' or 'reject'")
    df = enrich_events(clean(raw), processed_at)
    if on_bad_time == "reject":
        df = df.where(F.col(enrich.PARSED_TIME).isNotNull())
    sample = sequence_sample(sample_raw) if sample_raw is not None else None
    return to_curated(add_sequence(df, sample=sample, **seq_opts), extra)


def resequence(curated: DataFrame, **seq_opts) -> DataFrame:
    """Renumber ``event_sequence`` over everything in ``curated`` — for sessions
    that span several runs, whose per-run numbering restarts (D7)."""
    df = enrich.with_event_time(curated.drop("event_sequence", "is_session_start"))
    return to_curated(add_sequence(df, **seq_opts))


def run_stamp() -> _dt.datetime:
    """Job time stamp fixed once per run (time-zone aware UTC, so the driver's
    local zone cannot shift it)."""
    return _dt.datetime.now(_dt.timezone.utc)

