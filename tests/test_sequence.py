"""The skew-safe session sequence equals the plain window, hot keys or not."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pytest

from clickweave.operators.sequence import bucketed, hot_keys, plain_sequence, sequence_within

HOT = dict(min_hot_rows=1, sample_fraction=1.0, rows_per_bucket=50)


def _skewed(spark, n=20000):
    """~40% NULL session, ~30% one bot session, the rest spread; timestamps
    with many ties (second precision) and a few NULL times."""
    df = spark.range(n).select(
        F.format_string("evt_%06d", "id").alias("event_id"),
        F.when(F.col("id") % 10 < 4, F.lit(None).cast("string"))
         .when(F.col("id") % 10 < 7, F.lit("bot"))
         .otherwise(F.format_string("s_%d", F.col("id") % 97)).alias("session_id"),
        F.when(F.col("id") % 501 == 0, F.lit(None).cast("timestamp"))
         .otherwise(F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919) % 5000))
         .alias("t"))
    return df


def _compare(a, b):
    left = a.select("event_id", F.col("seq").alias("a"))
    right = b.select("event_id", F.col("seq").alias("b"))
    joined = left.join(right, "event_id", "full")
    bad = joined.where(~F.col("a").eqNullSafe(F.col("b"))).count()
    return bad, joined.count()


def test_hot_path_matches_plain_window(spark):
    df = _skewed(spark).cache()
    fast = sequence_within(df, "session_id", "t", "event_id", "seq", **HOT)
    plain = plain_sequence(df, "session_id", "t", "event_id", "seq")
    bad, n = _compare(fast, plain)
    assert n == 20000 and bad == 0


TIMES = {
    "even": lambda: F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")),
    "one wrong clock": lambda: F.timestamp_seconds(F.when(F.col("id") == 7, 0).otherwise(F.lit(1_700_000_000) + F.col("id"))),
    "no valid time": lambda: F.lit(None).cast("timestamp"),
    "one millisecond": lambda: F.timestamp_millis(F.lit(1_700_000_000_123)),
}


@pytest.mark.parametrize("case", list(TIMES))
def test_hot_key_is_split_evenly(spark, case):
    """Rows per bucket of one hot key: at most twice the target, however its
    times lie, and the numbers of the plain window."""
    n, target = 40_000, 2_000
    df = spark.range(n).select(F.format_string("evt_%06d", "id").alias("event_id"),
                               F.lit(None).cast("string").alias("session_id"), TIMES[case]().alias("t")).cache()
    opts = dict(min_hot_rows=1000, sample_fraction=0.2, rows_per_bucket=target)
    hot = hot_keys(df.sample(fraction=0.2, seed=17), "session_id", "t", "event_id", **opts)
    rows = bucketed(df, hot, "session_id", "t", "event_id").groupBy("_bucket").count().collect()
    assert sum(r["count"] for r in rows) == n
    assert max(r["count"] for r in rows) <= 2 * target
    fast = sequence_within(df, "session_id", "t", "event_id", "seq", **opts)
    bad, m = _compare(fast, plain_sequence(df, "session_id", "t", "event_id", "seq"))
    assert bad == 0 and m == n
    df.unpersist()


def test_null_session_option(spark):
    df = _skewed(spark, 2000)
    out = sequence_within(df, "session_id", "t", "event_id", "seq", null_key="null")
    assert out.count() == 2000
    assert out.where("session_id IS NULL AND seq IS NOT NULL").isEmpty()
    assert out.where("session_id IS NOT NULL AND seq IS NULL").isEmpty()


def test_default_settings_match_plain_window(spark):
    df = _skewed(spark, 3000)
    fast = sequence_within(df, "session_id", "t", "event_id", "seq")
    plain = plain_sequence(df, "session_id", "t", "event_id", "seq")
    bad, n = _compare(fast, plain)
    assert n == 3000 and bad == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]),
                          st.one_of(st.none(), st.integers(0, 20))),
                min_size=1, max_size=60))
def test_random_rows(spark, rows):
    data = [(f"e{i:03d}", k, t) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id string, session_id string, ts int") \
        .withColumn("t", F.timestamp_seconds("ts"))
    fast = sequence_within(df, "session_id", "t", "event_id", "seq", **HOT)
    plain = plain_sequence(df, "session_id", "t", "event_id", "seq")
    bad, n = _compare(fast, plain)
    assert bad == 0 and n == len(data)
