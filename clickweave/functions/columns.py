"""Column expressions shared by the transform and the query library.

Everything here is a composition of built-in functions, so it stays inside
whole-stage code generation and is evaluated on the executors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(col: str | Column = "timestamp") -> Column:
    """ISO-8601 text to a timestamp; ``...Z``, ``+00:00`` and other offsets
    all parse, anything else gives NULL instead of failing the job."""
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col)


def today_parts(as_of: _dt.date | str | None = None) -> tuple[Column, Column, Column]:
    """Zero-padded ``(year, month, day)`` strings of ``as_of`` (default: today).

    With ``as_of=None`` the parts are built from ``current_date()``, which the
    optimizer folds into literals, so the filter still prunes partitions.
    """
    if as_of is None:
        day = F.current_date()
        return (F.date_format(day, "yyyy"), F.date_format(day, "MM"),
                F.date_format(day, "dd"))
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return (F.lit(f"{as_of.year:04d}"), F.lit(f"{as_of.month:02d}"),
            F.lit(f"{as_of.day:02d}"))


def today_filter(as_of: _dt.date | str | None = None) -> Column:
    """``year/month/day`` equal to the day ``as_of``, compared as strings."""
    y, m, d = today_parts(as_of)
    return (F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d)


def when_count(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: NULL over zero rows."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def flag(cond: Column) -> Column:
    """``MAX(CASE WHEN cond THEN 1 ELSE 0 END)``: 1 if any row matches."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def pct(num: Column, den: Column) -> Column:
    """``num * 100 / den`` in DOUBLE; NULL (not an error) when ``den`` is 0."""
    return F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double"))


def round2(x: Column) -> Column:
    """Round half-up to two decimals, in DOUBLE."""
    return F.round(x.cast("double"), 2)


def rate(num: Column, den: Column) -> Column:
    """Percentage rounded to two decimals; zero denominators give NULL."""
    return round2(pct(num, den))


#: Prices at and beyond this magnitude are not money; they count as bad values.
PRICE_LIMIT = 1e12


def finite_number(col: str | Column) -> Column:
    """Text or number to DOUBLE; what is not a finite number of sensible size
    becomes NULL, the row stays."""
    x = (F.col(col) if isinstance(col, str) else col).try_cast("double")
    return F.when(F.abs(x) < F.lit(PRICE_LIMIT), x)


def amount(price: Column, quantity: Column) -> Column:
    """Line amount ``price * quantity`` as DECIMAL(38,6): sums are exact and do
    not depend on the order in which partitions are added up. A bad price
    (see ``finite_number``) gives NULL."""
    return (finite_number(price).cast("decimal(19,6)") * quantity.cast("decimal(10,0)")).cast("decimal(38,6)")


def money(total: Column, divisor: Column | None = None) -> Column:
    """A DECIMAL total, or its exact quotient, rounded half away from zero to
    two places, as DOUBLE; NULL on a zero divisor."""
    if divisor is not None:
        total = F.try_divide(total, divisor.cast("decimal(20,0)"))
    return F.round(total, 2).cast("double")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds elapsed from ``start`` to ``end`` (truncated)."""
    return F.timestamp_diff("SECOND", start, end)
