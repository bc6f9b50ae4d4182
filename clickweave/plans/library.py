"""Query library over the curated table: ``fn(df, as_of=None, exact=True) -> DataFrame``.

``df`` is the curated table (``spark.table("transformed")`` or the lazy
output of :func:`clickweave.plans.batch.transform`). ``as_of`` replaces
"today" in the day-filtered queries; the filter is on the partition columns,
so on the stored table only that day's files are read.

Conventions (SURVEY §2.15):
* ratios are DOUBLE rounded half-up to 2 decimals; a zero denominator gives
  NULL instead of an error;
* money is summed and divided in DECIMAL (price to six places), so totals do
  not depend on the order partitions are added; DOUBLE at the end;
* every ORDER BY … LIMIT ends in a unique key, so top-k results are stable;
* NULLs sort last in both directions;
* distinct counts are exact unless ``exact=False`` is passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickweave.functions import (
    amount, elapsed_seconds, flag, money, parse_event_time, rate, round2, today_filter, today_parts,
    when_count,
)

# Labels that appear in query output.
LABEL_CONVERTED = "Converted"
LABEL_NOT_CONVERTED = "Not Converted"
LABEL_NEW_USER = "New User"
LABEL_RETURNING_USER = "Returning User"


def _is(event_type: str):
    return F.col("event_type") == F.lit(event_type)


def _count():
    return F.count(F.lit(1))


def _distinct(col: str, exact: bool = True):
    """``COUNT(DISTINCT col)``; with ``exact=False`` a HyperLogLog++ estimate
    (2% relative error) that needs no ``Expand`` and no shuffle of distinct
    values — an option for very large tables, never the default."""
    return F.count_distinct(col) if exact else F.approx_count_distinct(col, rsd=0.02)


def _ratio(num, den):
    """``ROUND(num * 1.0 / den, 2)`` in DOUBLE; NULL on a zero denominator."""
    return round2(F.try_divide(num.cast("double"), den.cast("double")))


def _date_label():
    return F.concat(F.col("year"), F.lit("-"), F.col("month"), F.lit("-"), F.col("day"))


def share_of_total(agg: DataFrame, count_col: str, out: str = "percentage") -> DataFrame:
    """W3. ``count * 100 / SUM(count) OVER ()`` on an aggregated frame: the
    unkeyed window sees one row per group, not the events, and the table is
    scanned once."""
    total = F.sum(count_col).over(W.partitionBy())
    return agg.withColumn(out, rate(F.col(count_col), total))


# --------------------------------------------------------------------------
# Main library (q01 … q12)
# --------------------------------------------------------------------------

def q01_event_distribution(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per event type today: events, users, sessions and share of events."""
    agg = (df.where(today_filter(as_of))
             .groupBy("event_type")
             .agg(_count().alias("event_count"),
                  _distinct("user_id", exact).alias("unique_users"),
                  _distinct("session_id", exact).alias("unique_sessions")))
    return (share_of_total(agg, "event_count")
            .orderBy(F.desc("event_count"), F.asc_nulls_last("event_type")))


def q02_daily_active_users(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per day: DAU, events, sessions, events per user / session; last 30."""
    agg = (df.groupBy("year", "month", "day")
             .agg(_distinct("user_id", exact).alias("daily_active_users"),
                  _count().alias("total_events"),
                  _distinct("session_id", exact).alias("total_sessions")))
    return (agg.select(
                "year", "month", "day", _date_label().alias("date"),
                "daily_active_users", "total_events", "total_sessions",
                _ratio(F.col("total_events"), F.col("daily_active_users")).alias("avg_events_per_user"),
                _ratio(F.col("total_events"), F.col("total_sessions")).alias("avg_events_per_session"))
            .orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("month"), F.desc_nulls_last("day"))
            .limit(30))


def _funnel_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return (df.groupBy(*keys)
              .agg(when_count(_is("product_view")).alias("views"),
                   when_count(_is("add_to_cart")).alias("cart_adds"),
                   when_count(_is("purchase")).alias("purchases")))


def q03_product_performance(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per product: views, cart adds, purchases and three rates; views > 5."""
    keys = ["product_id", "product_name", "product_category"]
    agg = _funnel_counts(df.where(F.col("product_id").isNotNull()), keys)
    v, c, p = F.col("views"), F.col("cart_adds"), F.col("purchases")
    return (agg.where(v > 5)
               .select(*keys, "views", "cart_adds", "purchases",
                       rate(c, v).alias("view_to_cart_rate"),
                       rate(p, c).alias("cart_to_purchase_rate"),
                       rate(p, v).alias("overall_conversion_rate"))
               .orderBy(F.desc("purchases"), F.desc("views"),
                        *[F.asc_nulls_last(k) for k in keys])
               .limit(50))


def q04_hourly_activity(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per hour of today: events, users, sessions, purchase share."""
    purchase = F.when(_is("purchase"), F.lit(1.0)).otherwise(F.lit(0.0))
    return (df.where(today_filter(as_of))
              .groupBy("hour")
              .agg(_count().alias("event_count"),
                   _distinct("user_id", exact).alias("unique_users"),
                   _distinct("session_id", exact).alias("unique_sessions"),
                   round2(F.avg(purchase) * F.lit(100.0)).alias("purchase_rate"))
              .orderBy(F.asc_nulls_last("hour")))


FUNNEL_STAGES = [  # Fixed values: stage label, event type.
    ("Product View", "product_view"),
    ("Add to Cart", "add_to_cart"),
    ("Checkout Start", "checkout_start"),
    ("Purchase", "purchase"),
]


def session_funnel_flags(df: DataFrame) -> DataFrame:
    """Per session: 1 if the session reached each stage (stages are
    independent: a purchase without a view still counts as a purchase)."""
    return (df.groupBy("session_id")
              .agg(*[flag(_is(t)).alias(f"_s{i}") for i, (_, t) in enumerate(FUNNEL_STAGES)]))


def q05_session_funnel(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Four funnel stages today: sessions, % of first stage, % lost against
    the previous stage. One aggregate, then four rows — one scan."""
    flags = session_funnel_flags(df.where(today_filter(as_of)))
    sums = flags.agg(*[F.sum(f"_s{i}").cast("bigint").alias(f"_n{i}")
                       for i in range(len(FUNNEL_STAGES))])
    rows = []
    first = F.col("_n0")
    for i, (label, _) in enumerate(FUNNEL_STAGES):
        n = F.col(f"_n{i}")
        if i == 0:
            pct_col, drop_col = F.lit(100.0), F.lit(0.0)
        else:
            prev = F.col(f"_n{i - 1}")
            pct_col = rate(n, first)
            drop_col = round2(F.lit(100.0) - F.try_divide(n.cast("double") * F.lit(100.0),
                                                          prev.cast("double")))
        rows.append(F.struct(F.lit(label).alias("stage"), n.alias("sessions"),
                             pct_col.cast("double").alias("percentage"),
                             drop_col.cast("double").alias("drop_off_rate")))
    return sums.select(F.inline(F.array(*rows)))


def q06_top_referrers(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per non-empty referrer: users, sessions, events, purchases, rate; top 20."""
    agg = (df.where(F.col("referrer").isNotNull() & (F.col("referrer") != F.lit("")))
             .groupBy("referrer")
             .agg(_distinct("user_id", exact).alias("unique_users"),
                  _distinct("session_id", exact).alias("sessions"),
                  _count().alias("total_events"),
                  when_count(_is("purchase")).alias("purchases")))
    return (agg.withColumn("conversion_rate", rate(F.col("purchases"), F.col("sessions")))
               .orderBy(F.desc("unique_users"), F.asc_nulls_last("referrer"))
               .limit(20))


def q07_device_analysis(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per device type: users, sessions, events, mean position in session
    (named avg_events_per_session, D16), purchases, session conversion."""
    agg = (df.where(F.col("device_type").isNotNull())
             .groupBy("device_type")
             .agg(_distinct("user_id", exact).alias("unique_users"),
                  _distinct("session_id", exact).alias("sessions"),
                  _count().alias("total_events"),
                  round2(F.avg("event_sequence")).alias("avg_events_per_session"),
                  when_count(_is("purchase")).alias("purchases")))
    return (agg.withColumn("session_conversion_rate", rate(F.col("purchases"), F.col("sessions")))
               .orderBy(F.desc("unique_users"), F.asc_nulls_last("device_type")))


def q08_daily_revenue(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per day of purchases: buyers, purchases, revenue, average order value,
    revenue per buyer; last 30 days."""
    agg = (df.where(_is("purchase") & F.col("price").isNotNull() & F.col("quantity").isNotNull())
             .groupBy("year", "month", "day")
             .agg(_distinct("user_id", exact).alias("purchasing_users"),
                  _count().alias("total_purchases"),
                  F.sum(amount(F.col("price"), F.col("quantity"))).alias("_amount")))
    total = F.col("_amount")
    return (agg.select(
                "year", "month", "day", _date_label().alias("date"),
                "purchasing_users", "total_purchases",
                money(total).alias("total_revenue"),
                money(total, F.col("total_purchases")).alias("avg_order_value"),
                money(total, F.col("purchasing_users")).alias("revenue_per_user"))
            .orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("month"), F.desc_nulls_last("day"))
            .limit(30))


def session_times(df: DataFrame) -> DataFrame:
    """Per session: first and last time (text order), events, purchase flag."""
    return (df.groupBy("session_id")
              .agg(F.min("timestamp").alias("opened_at"),
                   F.max("timestamp").alias("closed_at"),
                   _count().alias("event_count"),
                   flag(_is("purchase")).alias("bought")))


def q09_session_duration(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Converted vs not: sessions, mean events, mean whole seconds from first
    to last event; sessions whose first and last time are equal are left out."""
    st = session_times(df).where(F.col("opened_at") != F.col("closed_at"))
    secs = elapsed_seconds(parse_event_time("opened_at"), parse_event_time("closed_at"))
    agg = (st.groupBy("bought")
             .agg(_count().alias("session_count"),
                  round2(F.avg("event_count")).alias("avg_events"),
                  round2(F.avg(secs)).alias("avg_duration_seconds")))
    status = (F.when(F.col("bought") == 1, F.lit(LABEL_CONVERTED))
               .otherwise(F.lit(LABEL_NOT_CONVERTED)))
    return (agg.select(status.alias("conversion_status"), "session_count", "avg_events",
                       "avg_duration_seconds")
               .orderBy(F.asc_nulls_last("conversion_status")))


def q10_category_performance(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Per category: products, users, views, cart adds, purchases, revenue,
    purchase-per-view rate."""
    bought = F.when(_is("purchase"), amount(F.col("price"), F.col("quantity"))).otherwise(F.lit(0))
    agg = (df.where(F.col("product_category").isNotNull())
             .groupBy("product_category")
             .agg(_distinct("product_id", exact).alias("unique_products"),
                  _distinct("user_id", exact).alias("unique_users"),
                  when_count(_is("product_view")).alias("views"),
                  when_count(_is("add_to_cart")).alias("cart_adds"),
                  when_count(_is("purchase")).alias("purchases"),
                  F.sum(bought).alias("_amount")))
    return (agg.select("product_category", "unique_products", "unique_users", "views",
                       "cart_adds", "purchases", money(F.col("_amount")).alias("revenue"),
                       rate(F.col("purchases"), F.col("views")).alias("conversion_rate"))
               .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("product_category")))


def first_event_per_user(df: DataFrame) -> DataFrame:
    """Per user: the earliest event time (text order)."""
    return df.groupBy("user_id").agg(F.min("timestamp").alias("earliest"))


def classify_new_returning(df: DataFrame) -> DataFrame:
    """J1 + F14. Every event with ``user_type``: 'New User' for the row(s) at
    the user's first time, 'Returning User' otherwise (D17).

    An equi-join on the per-user aggregate: AQE broadcasts the aggregate when
    its measured size allows, else sort-merge with hot users split."""
    first = first_event_per_user(df).withColumnRenamed("user_id", "_fu")
    event = df.alias("event")
    return label_new_returning(event.join(first, F.col("event.user_id") == F.col("_fu"), "inner"))


def label_new_returning(joined: DataFrame) -> DataFrame:
    """``user_type`` of events (alias ``event``) beside their user's ``earliest``."""
    kind = (F.when(F.col("event.timestamp") == F.col("earliest"), F.lit(LABEL_NEW_USER))
             .otherwise(F.lit(LABEL_RETURNING_USER)))
    return joined.select("event.*", "earliest", kind.alias("user_type"))


def q11_new_vs_returning(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """First-event rows against the rest: users, events, mean position,
    purchases, purchases per session."""
    return summary_new_returning(classify_new_returning(df), exact)


def summary_new_returning(events: DataFrame, exact: bool = True) -> DataFrame:
    """q11 of events with ``user_type``."""
    agg = (events
           .groupBy("user_type")
           .agg(_distinct("user_id", exact).alias("users"),
                _count().alias("total_events"),
                round2(F.avg("event_sequence")).alias("avg_events_per_session"),
                when_count(_is("purchase")).alias("purchases"),
                _distinct("session_id", exact).alias("_sessions")))
    return agg.select("user_type", "users", "total_events", "avg_events_per_session",
                      "purchases", rate(F.col("purchases"), F.col("_sessions")).alias("conversion_rate"))


LATEST_COLUMNS = ["timestamp", "event_type", "user_id", "session_id", "product_id",
                  "product_name", "price", "device_type", "page_url"]


def q12_latest_events(df: DataFrame, as_of=None, exact: bool = True, n: int = 100) -> DataFrame:
    """The latest ``n`` events of today (top-k, ties broken by event id)."""
    return (df.where(today_filter(as_of))
              .orderBy(F.desc_nulls_last("timestamp"), F.asc_nulls_last("event_id"))
              .limit(n)
              .select(*LATEST_COLUMNS))


def dq_check(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Seven data-quality counters over the whole table."""
    return df.agg(
        _count().alias("total_records"),
        _distinct("event_id", exact).alias("unique_events"),
        (_count() - _distinct("event_id", exact)).alias("duplicate_events"),
        _distinct("user_id", exact).alias("unique_users"),
        _distinct("session_id", exact).alias("unique_sessions"),
        when_count(F.col("product_id").isNull()).alias("missing_product_id"),
        when_count(F.col("price").isNull()).alias("missing_price"))


# --------------------------------------------------------------------------
# Saved (named) queries and the short forms shown in the documentation
# --------------------------------------------------------------------------

def nq1_event_distribution(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Saved query "Event Type Distribution": events and users per type today."""
    return (df.where(today_filter(as_of))
              .groupBy("event_type")
              .agg(_count().alias("event_count"), _distinct("user_id", exact).alias("unique_users"))
              .orderBy(F.desc("event_count"), F.asc_nulls_last("event_type")))


def nq2_daily_active_users(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Saved query "Daily Active Users"."""
    agg = (df.groupBy("year", "month", "day")
             .agg(_distinct("user_id", exact).alias("daily_active_users"),
                  _count().alias("total_events")))
    return (agg.withColumn("avg_events_per_user",
                           _ratio(F.col("total_events"), F.col("daily_active_users")))
               .orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("month"),
                        F.desc_nulls_last("day"))
               .limit(30))


def nq3_product_performance(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Saved query "Product Performance": by product id, views > 10, top 20."""
    agg = (df.where(F.col("product_id").isNotNull())
             .groupBy("product_id")
             .agg(when_count(_is("product_view")).alias("views"),
                  when_count(_is("purchase")).alias("purchases")))
    return (agg.where(F.col("views") > 10)
               .withColumn("conversion_rate", rate(F.col("purchases"), F.col("views")))
               .orderBy(F.desc("purchases"), F.asc_nulls_last("product_id"))
               .limit(20))


def rq1_event_counts(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Events per type over the whole table, largest first."""
    return (df.groupBy("event_type").agg(_count().alias("event_count"))
              .orderBy(F.desc("event_count"), F.asc_nulls_last("event_type")))


def rq2_daily_users(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """DAU and events per day, newest first."""
    return (df.groupBy("year", "month", "day")
              .agg(_distinct("user_id", exact).alias("daily_active_users"),
                   _count().alias("total_events"))
              .orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("month"),
                       F.desc_nulls_last("day")))


def rq3_product_views(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Views and purchases per product id and name (no threshold)."""
    return (df.where(F.col("product_id").isNotNull())
              .groupBy("product_id", "product_name")
              .agg(when_count(_is("product_view")).alias("views"),
                   when_count(_is("purchase")).alias("purchases")))


def rq4_event_counts_unsorted(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Smoke query: rows per event type."""
    return df.groupBy("event_type").count()


def rq5_product_counts_year(df: DataFrame, as_of=None, exact: bool = True,
                            year: str | None = None) -> DataFrame:
    """Rows per product within one year partition (default: the year of
    ``as_of``, else the current year)."""
    if year is None:
        year_col = today_parts(as_of)[0]
    else:
        year_col = F.lit(str(year))
    return (df.where(F.col("year") == year_col)
              .groupBy("product_id").agg(_count().alias("event_count")))


def rq6_quality_short(df: DataFrame, as_of=None, exact: bool = True) -> DataFrame:
    """Three-counter form of the quality check."""
    return df.agg(_count().alias("total_records"),
                  _distinct("event_id", exact).alias("unique_events"),
                  _distinct("user_id", exact).alias("unique_users"))


LIBRARY = {
    "q01_event_distribution": q01_event_distribution,
    "q02_daily_active_users": q02_daily_active_users,
    "q03_product_performance": q03_product_performance,
    "q04_hourly_activity": q04_hourly_activity,
    "q05_session_funnel": q05_session_funnel,
    "q06_top_referrers": q06_top_referrers,
    "q07_device_analysis": q07_device_analysis,
    "q08_daily_revenue": q08_daily_revenue,
    "q09_session_duration": q09_session_duration,
    "q10_category_performance": q10_category_performance,
    "q11_new_vs_returning": q11_new_vs_returning,
    "q12_latest_events": q12_latest_events,
    "dq_check": dq_check,
    "nq1_event_distribution": nq1_event_distribution,
    "nq2_daily_active_users": nq2_daily_active_users,
    "nq3_product_performance": nq3_product_performance,
    "rq1_event_counts": rq1_event_counts,
    "rq2_daily_users": rq2_daily_users,
    "rq3_product_views": rq3_product_views,
    "rq4_event_counts_unsorted": rq4_event_counts_unsorted,
    "rq5_product_counts_year": rq5_product_counts_year,
    "rq6_quality_short": rq6_quality_short,
}
