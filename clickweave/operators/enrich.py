"""Row-local enrichment of cleaned events (no shuffle anywhere here)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions import parse_event_time

# Event type → category. Anything not listed is "other".
EVENT_CATEGORIES = [
    ("browsing", ["product_view", "category_view", "search"]),
    ("cart", ["add_to_cart", "remove_from_cart"]),
    ("conversion", ["checkout_start", "payment_info", "purchase"]),
    ("engagement", ["page_view", "login", "logout", "signup"]),
]
OTHER_CATEGORY = "other"

PARSED_TIME = "_event_time"


def event_category(col: str | Column = "event_type") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, types in EVENT_CATEGORIES:
        cond = c.isin(types)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_CATEGORY))


def with_processed_timestamp(df: DataFrame, processed_at: _dt.datetime | None = None) -> DataFrame:
    """E1. One job time stamp per run: a literal when given, so that every
    action over the same plan sees the same value."""
    value = F.lit(processed_at).cast("timestamp") if processed_at else F.current_timestamp()
    return df.withColumn("processed_timestamp", value)


def with_event_time(df: DataFrame) -> DataFrame:
    """E2. Parsed event time in a temporary column (dropped before storage)."""
    return df.withColumn(PARSED_TIME, parse_event_time("timestamp"))


def with_time_parts(df: DataFrame) -> DataFrame:
    """E3-E5. ``year``/``month``/``day`` as zero-padded strings, ``hour``,
    ``event_date``. A time that did not parse gives NULL in all five."""
    t = F.col(PARSED_TIME)
    return (df
            .withColumn("year", F.date_format(t, "yyyy"))
            .withColumn("month", F.date_format(t, "MM"))
            .withColumn("day", F.date_format(t, "dd"))
            .withColumn("hour", F.hour(t))
            .withColumn("event_date", F.to_date(t)))


def with_quality_flags(df: DataFrame) -> DataFrame:
    """E6. Never NULL: a missing column counts as absent data."""
    cols = set(df.columns)
    pid = F.col("product_id").isNotNull() if "product_id" in cols else F.lit(False)
    price = F.col("price").isNotNull() if "price" in cols else F.lit(False)
    return df.withColumn("has_product_data", pid).withColumn("has_price_data", price)


def with_event_category(df: DataFrame) -> DataFrame:
    """E7."""
    return df.withColumn("event_category", event_category("event_type"))
