"""Joins with an explicit, checked decision about broadcasting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its measured size is at most this many bytes;
# otherwise the join shuffles both sides and AQE splits skewed partitions
# (spark.sql.adaptive.skewJoin.enabled).
MAX_BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame's rows as text, plus 16 bytes a value: an upper estimate of
    what a broadcast holds, whatever the width of the rows."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return df.agg(F.sum(size)).first()[0] or 0


def lookup_join(fact: DataFrame, dim: DataFrame, cond: Column | list | str,
                how: str = "left", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join a large fact table to a dimension table.

    The dimension is measured first (an action over the projected dimension
    only, cheap next to the fact scan). Within the bound it is broadcast, so the
    fact side is never shuffled, which also makes skewed fact keys harmless.
    Beyond it the plan is a shuffle join left to AQE, which splits hot fact
    partitions.
    """
    if measured_bytes(dim) <= max_broadcast_bytes:
        dim = F.broadcast(dim)
    return fact.join(dim, cond, how)
