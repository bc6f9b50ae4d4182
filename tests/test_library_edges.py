"""Edge rows: NULL sessions, zero denominators, empty input, equivalent forms."""

import datetime as _dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickweave.plans import library
from clickweave.plans.batch import transform
from clickweave.sources.schema import RAW_SCHEMA

STAMP = _dt.datetime(2025, 1, 1)


def _frame(spark, rows):
    full = [tuple(r.get(f.name) for f in RAW_SCHEMA.fields) for r in rows]
    return transform(spark.createDataFrame(full, RAW_SCHEMA), processed_at=STAMP)


def _ev(i, etype, session="s1", user="u1", t=0, **kw):
    ts = (_dt.datetime(2025, 3, 4, 5, 0, 0) + _dt.timedelta(seconds=t)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return dict(event_id=f"e{i:02d}", user_id=user, session_id=session, event_type=etype,
                timestamp=ts, **kw)


def test_zero_denominators_give_null(spark):
    rows = [_ev(1, "purchase", session=None, referrer="r", product_id="p", price=5.0, quantity=1),
            _ev(2, "add_to_cart", session=None, referrer="r", product_id="p", price=5.0, quantity=1)]
    df = _frame(spark, rows)
    ref = library.q06_top_referrers(df).first()
    assert ref.sessions == 0 and ref.conversion_rate is None  # no error under ANSI
    prod = library.q03_product_performance(df)  # views = 0 → filtered, rates would be NULL
    assert prod.count() == 0
    (r,) = library._funnel_counts(df, ["product_id"]).collect()
    assert (r.views, r.cart_adds, r.purchases) == (0, 1, 1)


def test_empty_input(spark):
    df = _frame(spark, [_ev(1, "page_view")]).where(F.lit(False))
    dq = library.dq_check(df).first()
    assert dq.total_records == 0 and dq.missing_price is None  # SUM over no rows
    funnel = library.q05_session_funnel(df, _dt.date(2025, 3, 4)).collect()
    assert [r.sessions for r in funnel] == [None] * 4


def test_null_session_is_one_group(spark):
    rows = [_ev(1, "page_view", session=None, t=5), _ev(2, "page_view", session=None, t=1),
            _ev(3, "page_view", session="s", t=3)]
    df = _frame(spark, rows)
    seq = {r.event_id: r.event_sequence for r in df.collect()}
    assert seq == {"e02": 1, "e01": 2, "e03": 1}
    dq = library.dq_check(df).first()
    assert dq.unique_sessions == 1  # COUNT(DISTINCT) skips NULL
    from clickweave.plans.jobs import run_summary
    assert run_summary(df).first().distinct_sessions == 2  # distinct().count() does not


def test_q11_join_form_equals_window_form(spark):
    rows = [_ev(i, t, user=f"u{i % 3}", session=f"s{i % 4}", t=i * 7 % 11)
            for i, t in enumerate(["page_view", "purchase", "search", "login"] * 4)]
    df = _frame(spark, rows)
    joined = library.classify_new_returning(df).select("event_id", "user_type")
    first = F.min("timestamp").over(Window.partitionBy("user_id"))
    windowed = df.select("event_id", F.when(F.col("timestamp") == first, "New User")
                         .otherwise("Returning User").alias("user_type"))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, windowed.collect()))


def test_q05_one_aggregate_equals_union_form(spark):
    rows = [_ev(i, t, session=f"s{i % 5}", t=i)
            for i, t in enumerate(["product_view", "add_to_cart", "checkout_start", "purchase",
                                   "page_view", "product_view"] * 3)]
    df = _frame(spark, rows)
    day = _dt.date(2025, 3, 4)
    a = library.q05_session_funnel(df, day).collect()

    # union form on the same frame
    flags = library.session_funnel_flags(df.where(library.today_filter(day)))
    n = [F.sum(f"_s{i}").cast("bigint") for i in range(4)]
    branches = [flags.agg(F.lit("Product View").alias("stage"), n[0].alias("sessions"))]
    for i, label in enumerate(["Add to Cart", "Checkout Start", "Purchase"], start=1):
        branches.append(flags.agg(F.lit(label).alias("stage"), n[i].alias("sessions")))
    u = branches[0]
    for b in branches[1:]:
        u = u.unionByName(b)
    assert sorted((r.stage, r.sessions) for r in a) == sorted(map(tuple, u.collect()))


@pytest.mark.parametrize("fn", sorted(library.LIBRARY))
def test_every_library_query_runs_on_tiny_input(spark, fn):
    df = _frame(spark, [_ev(1, "purchase", product_id="p", product_category="c", price=1.5,
                            quantity=2, device_type="mobile", referrer="https://x")])
    out = library.LIBRARY[fn](df, _dt.date(2025, 3, 4)).collect()
    assert isinstance(out, list)


def test_edge_rows_from_fixture_list(spark):
    rows = [
        _ev(1, "teleport", session="a", t=0),                       # unknown type
        _ev(2, "purchase", session="a", t=1, product_id="p", product_category="c",
            price=None, quantity=1),                                # purchase without price
        _ev(3, "purchase", session="b", t=2, product_id="p", product_category="c",
            price=2.5, quantity=2, referrer=""),                    # empty referrer
        _ev(3, "purchase", session="b", t=3, product_id="p", product_category="c",
            price=2.5, quantity=2),                                 # duplicate event id
        _ev(5, "page_view", session="solo", t=4),                   # one-event session
    ]
    df = _frame(spark, rows)
    cats = {r.event_id: r.event_category for r in df.collect()}
    assert cats["e01"] == "other"
    (cat,) = library.q10_category_performance(df).collect()
    assert cat.revenue == 10.0 and cat.purchases == 3  # the NULL price adds nothing
    assert library.q06_top_referrers(df).count() == 0  # '' is not a referrer
    dq = library.dq_check(df).first()
    assert (dq.total_records, dq.unique_events, dq.duplicate_events) == (5, 4, 1)
    sessions = {r.conversion_status: r.session_count
                for r in library.q09_session_duration(df).collect()}
    assert sessions == {"Converted": 2}  # 'solo' has one event: start == end, left out


def test_bad_time_keep_or_reject(spark):
    rows = [_ev(1, "page_view"), dict(_ev(2, "page_view"), timestamp="garbage")]
    full = [tuple(r.get(f.name) for f in RAW_SCHEMA.fields) for r in rows]
    raw = spark.createDataFrame(full, RAW_SCHEMA)
    assert transform(raw, processed_at=STAMP).count() == 2
    kept = transform(raw, processed_at=STAMP, on_bad_time="reject").collect()
    assert [r.event_id for r in kept] == ["e01"]


def test_approximate_distinct_option(spark):
    rows = [_ev(i, "page_view", user=f"u{i % 7}", session=f"s{i % 5}", t=i) for i in range(40)]
    df = _frame(spark, rows)
    exact = library.q02_daily_active_users(df).first()
    approx = library.q02_daily_active_users(df, exact=False).first()
    assert exact.daily_active_users == 7 and abs(approx.daily_active_users - 7) <= 1
    for name, fn in library.LIBRARY.items():
        fn(df, _dt.date(2025, 3, 4), exact=False).collect()
