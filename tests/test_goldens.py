"""Query library on a made-up day; expected values worked out by hand
(FIXTURES.md, section 2)."""

import datetime as _dt

import pytest

from golden_events import AS_OF, raw_rows


@pytest.fixture(scope="module")
def day(spark):
    from clickweave.plans.batch import transform
    from clickweave.sources.schema import RAW_SCHEMA
    rows = raw_rows()
    df = spark.createDataFrame([tuple(r.get(f.name) for f in RAW_SCHEMA.fields) for r in rows],
                               RAW_SCHEMA)
    return transform(df, processed_at=_dt.datetime(2024, 3, 9)).cache()


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_shape(day):
    from pyspark.sql import functions as F
    r = day.agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("u"),
                F.count_distinct("session_id").alias("s"),
                F.count_distinct("event_type").alias("t"),
                F.count_if("has_product_data").alias("hp"),
                F.count_if("has_price_data").alias("hpr"),
                F.count_if("is_session_start").alias("ss")).first()
    # six session starts: the events without a session count as one group
    assert (r.n, r.u, r.s, r.t, r.hp, r.hpr, r.ss) == (27, 4, 5, 13, 16, 16, 6)


def test_categories(day):
    got = {r.event_category: r["count"] for r in day.groupBy("event_category").count().collect()}
    assert got == {"browsing": 11, "cart": 4, "conversion": 5, "engagement": 6, "other": 1}


def test_q01(day):
    from clickweave.plans.library import q01_event_distribution
    got = rows_by(q01_event_distribution(day, AS_OF), "event_type")
    v = got["product_view"]
    assert (v["event_count"], v["unique_users"], v["unique_sessions"], v["percentage"]) == (9, 3, 3, 33.33)
    for t in ["page_view", "add_to_cart", "purchase"]:
        assert got[t]["event_count"] == 3 and got[t]["percentage"] == 11.11
    for t in ["login", "logout", "search", "signup", "category_view", "checkout_start", "payment_info", "remove_from_cart", "wishlist"]:
        assert got[t]["event_count"] == 1 and got[t]["percentage"] == 3.7
    assert got["wishlist"]["unique_sessions"] == 0


def test_q02(day):
    from clickweave.plans.library import q02_daily_active_users
    (r,) = q02_daily_active_users(day).collect()
    assert (r.date, r.daily_active_users, r.total_events, r.total_sessions,
            r.avg_events_per_user, r.avg_events_per_session) == ("2024-03-08", 4, 27, 5, 6.75, 5.4)


def test_q03_threshold_and_counts(day):
    from clickweave.plans.library import _funnel_counts, q03_product_performance
    from pyspark.sql import functions as F
    (r,) = q03_product_performance(day).collect()  # only the lamp has more than five views
    assert tuple(r) == ("l-1", "Desk lamp", "Home", 6, 1, 1, 16.67, 100.0, 16.67)
    counts = rows_by(_funnel_counts(day.where(F.col("product_id").isNotNull()), ["product_id"]),
                     "product_id")
    got = {k: (v["views"], v["cart_adds"], v["purchases"]) for k, v in counts.items()}
    assert got == {"t-1": (1, 1, 1), "m-1": (2, 1, 1), "l-1": (6, 1, 1)}


def test_q04(day):
    from clickweave.plans.library import q04_hourly_activity
    got = [tuple(r) for r in q04_hourly_activity(day, AS_OF).collect()]
    assert got == [(8, 12, 2, 2, 16.67), (21, 6, 2, 2, 0.0), (23, 9, 1, 1, 11.11)]


def test_q05(day):
    from clickweave.plans.library import q05_session_funnel
    got = [tuple(r) for r in q05_session_funnel(day, AS_OF).collect()]
    # one session checked out, two bought: stages are independent
    assert got == [("Product View", 3, 100.0, 0.0), ("Add to Cart", 3, 100.0, 0.0),
                   ("Checkout Start", 1, 33.33, 66.67), ("Purchase", 2, 66.67, -100.0)]


def test_q06(day):
    from clickweave.plans.library import q06_top_referrers
    got = [tuple(r) for r in q06_top_referrers(day).collect()]  # the empty referrer is left out
    assert got == [("https://news.example", 2, 2, 2, 0, 0.0), ("https://mail.example", 1, 1, 1, 0, 0.0)]


def test_q07(day):
    from clickweave.plans.library import q07_device_analysis
    got = rows_by(q07_device_analysis(day), "device_type")
    pick = ("unique_users", "sessions", "total_events", "avg_events_per_session", "purchases",
            "session_conversion_rate")
    assert tuple(got["desktop"][k] for k in pick) == (2, 2, 8, 3.63, 2, 100.0)  # 29 / 8 = 3.625
    assert tuple(got["mobile"][k] for k in pick) == (2, 2, 12, 4.25, 1, 50.0)
    assert tuple(got["tablet"][k] for k in pick) == (1, 1, 5, 3.0, 0, 0.0)


def test_q08_exact_half_rounds_up(day):
    from clickweave.plans.library import q08_daily_revenue
    (r,) = q08_daily_revenue(day).collect()
    # 33.75 + 13.00 + 39.98; per user 43.365
    assert (r.purchasing_users, r.total_purchases, r.total_revenue, r.avg_order_value,
            r.revenue_per_user) == (2, 3, 86.73, 28.91, 43.37)


def test_q09(day):
    from clickweave.plans.library import q09_session_duration
    got = {r.conversion_status: tuple(r)[1:] for r in q09_session_duration(day).collect()}
    # D lasts no time; the two events without a session are one group of 40 s
    assert got == {"Converted": (2, 8.0, 160.0), "Not Converted": (3, 3.33, 86.67)}


def test_q10(day):
    from clickweave.plans.library import q10_category_performance
    got = {r.product_category: tuple(r)[1:] for r in q10_category_performance(day).collect()}
    assert got == {"Home": (1, 1, 6, 1, 1, 39.98, 16.67),
                   "Kitchen": (1, 2, 2, 1, 1, 33.75, 50.0),
                   "Pantry": (1, 2, 1, 1, 1, 13.0, 100.0)}


def test_q11(day):
    from clickweave.plans.library import q11_new_vs_returning
    got = {r.user_type: tuple(r)[1:] for r in q11_new_vs_returning(day).collect()}
    assert got == {"New User": (4, 4, 1.0, 0, 0.0), "Returning User": (4, 23, 4.09, 3, 75.0)}


def test_q12(day):
    from clickweave.plans.library import q12_latest_events
    got = q12_latest_events(day, AS_OF).collect()
    assert len(got) == 27
    assert [r.timestamp for r in got] == sorted((r.timestamp for r in got), reverse=True)


def test_dq_check(day):
    from clickweave.plans.library import dq_check
    assert tuple(dq_check(day).first()) == (27, 27, 0, 4, 5, 11, 11)


def test_saved_queries(day):
    from clickweave.plans.library import nq1_event_distribution, nq3_product_performance
    assert {r.event_type: r.event_count for r in nq1_event_distribution(day, AS_OF).collect()}["page_view"] == 3
    assert nq3_product_performance(day).count() == 0


def test_library_as_sql_views(spark, day):
    from clickweave.sources.catalog import create_library_views
    views = create_library_views(spark, day, as_of=AS_OF)
    assert "q09_session_duration" in views
    got = {r.conversion_status: r.session_count
           for r in spark.sql("SELECT * FROM q09_session_duration").collect()}
    assert got == {"Converted": 2, "Not Converted": 3}
