"""Column-level helpers (JVM-side built-ins only, no Python UDFs)."""

from clickweave.functions.columns import (  # noqa: F401
    amount,
    elapsed_seconds,
    finite_number,
    flag,
    money,
    parse_event_time,
    pct,
    rate,
    round2,
    today_parts,
    today_filter,
    when_count,
)
