"""One registered entry per single operator of the inventory.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over data derived from the
test tables: the curated table built from ``events``/``part`` (``_cur``), the
JSON-lines fixture with its damaged rows (``_landing`` / ``_json_cur``), or
the table the batch job wrote and registered (``_stored``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clickweave.functions import (
    amount, elapsed_seconds, flag, money, parse_event_time, rate, round2, today_filter, when_count,
)
from clickweave.operators import quality
from clickweave.plans import fixtures, library
from clickweave.plans.batch import conform, typed_numbers
from clickweave.plans.registry import AS_OF, stored_curated
from clickweave.session import scratch_path, stored
from clickweave.sources import catalog, sinks
from clickweave.sources.schema import CORRUPT_COLUMN, CURATED_COLUMNS, EXTRA_COLUMN

NO_STAMP = [c for c in CURATED_COLUMNS if c != "processed_timestamp"]


def _cur(spark, sf):
    return stored_curated(spark, sf)


def _landing(spark, sf):
    return fixtures.landing(spark, sf)


def _json_cur(spark, sf):
    return fixtures.json_curated(spark, sf)


def _count():
    return F.count(F.lit(1))


def _is(t):
    return F.col("event_type") == F.lit(t)


def _amount():
    return amount(F.col("price"), F.col("quantity"))


# ---- §2.1 sources --------------------------------------------------------

def scan_raw_json(spark, sf):
    """S1. Well-formed lines of the gzip JSON raw zone (recursive scan)."""
    return (quality.drop_corrupt(_landing(spark, sf))
            .select("event_id", "user_id", "event_type", "timestamp"))


def raw_schema(spark, sf):
    """S2. Landing text fields typed to the raw schema (price, quantity)."""
    df = typed_numbers(quality.drop_corrupt(_landing(spark, sf)))
    return df.select("event_id", "price", "quantity", "device_type", "referrer")


def permissive_corrupt(spark, sf):
    """S3. Malformed lines kept as text beside the parsed ones."""
    return _landing(spark, sf).agg(
        F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("corrupt_records"),
        _count().alias("total_lines"))


def scan_curated(spark, sf):
    """S4. The stored, partitioned table read back."""
    run = fixtures.stored_run(spark, sf)
    return sinks.read_curated(spark, run.target).select(*NO_STAMP)


def job_args(spark, sf):
    """S5. The batch job called with (source, target, database): run totals."""
    return fixtures.stored_run(spark, sf).summary()


def preview_limit(spark, sf):
    """S6. ``SELECT * … LIMIT 10`` (ordered by event id for a stable answer)."""
    return _cur(spark, sf).orderBy("event_id").limit(10).select(*NO_STAMP)


# ---- §2.2 sinks and catalog -----------------------------------------------

def sink_partitioned_parquet(spark, sf):
    """K1. Rows per written partition folder."""
    run = fixtures.stored_run(spark, sf)
    return sinks.partition_counts(sinks.read_curated(spark, run.target))


def sink_corrupt_text(spark, sf):
    """K2. Malformed records written as text, read back and counted."""
    run = fixtures.stored_run(spark, sf)
    return spark.read.text(run.errors).agg(_count().alias("corrupt_records"))


def query_result_sink(spark, sf):
    """K3. A query result written as CSV with a header and read back."""
    result = library.q06_top_referrers(_cur(spark, sf), as_of=AS_OF)
    path = scratch_path(spark, "result-csv")
    sinks.write_result_csv(result, path)
    return sinks.read_result_csv(spark, path, result.schema)


def _direct_table(spark, sf) -> str:
    """The curated table of the test tables, registered under a name of its own."""
    def build():
        path = scratch_path(spark, "direct")
        sinks.write_curated(_cur(spark, sf), path)
        return catalog.register_table(spark, path, fixtures.FIXTURE_DATABASE, f"direct_{uuid.uuid4().hex[:12]}")
    return fixtures.once(spark, "direct", sf, build)


def _plain(name):
    """A generated table name without its random ending."""
    return F.regexp_replace(name, "_[0-9a-f]{12}$", "")


def catalog_database(spark, sf):
    """K4. The database as the catalog lists it, and the rows of its table."""
    name = _direct_table(spark, sf)
    listed = spark.sql(f"SHOW DATABASES LIKE '{fixtures.FIXTURE_DATABASE}'").select("namespace")
    return listed.withColumn("total_rows", spark.table(name).agg(_count()).scalar())


def catalog_register(spark, sf):
    """K5. Table created over the files, partitions discovered; rows by type."""
    name = _direct_table(spark, sf)
    return spark.table(name).groupBy("event_type").agg(_count().alias("event_count"))


def schema_evolve(spark, sf):
    """K6. A later batch adds a column: the table gains it, older rows read
    it as NULL."""
    path = scratch_path(spark, "evolve")
    base = _cur(spark, sf)
    sinks.write_curated(base, path)
    name = catalog.register_table(spark, path, fixtures.FIXTURE_DATABASE, f"evolve_{uuid.uuid4().hex[:12]}")
    extra = (base.where(_is("purchase"))
                 .withColumn("campaign", F.col("referrer")))
    extra = extra.select(*[c for c in extra.columns if c not in ("year", "month", "day")],
                         "year", "month", "day")
    added, _ = catalog.evolve_schema(spark, name, extra)
    sinks.write_curated(extra.select(*spark.table(name).columns), path)
    catalog.repair_partitions(spark, name)
    spark.catalog.refreshTable(name)
    return (spark.table(name).groupBy("event_type")
            .agg(_count().alias("row_count"), F.count("campaign").alias("with_campaign")))


def repair_partitions(spark, sf):
    """K7. Partitions known before and after ``MSCK REPAIR TABLE``."""
    path = scratch_path(spark, "repair")
    name = f"{fixtures.FIXTURE_DATABASE}.repair_{uuid.uuid4().hex[:12]}"
    catalog.create_database(spark, fixtures.FIXTURE_DATABASE)
    from clickweave.sources.schema import curated_ddl
    spark.sql(curated_ddl(name, path))
    before = catalog.show_partitions(spark, name).count()
    sinks.write_curated(_cur(spark, sf), path)
    catalog.repair_partitions(spark, name)
    after = catalog.show_partitions(spark, name).agg(_count().alias("partitions_after"))
    return after.select(F.lit(before).cast("bigint").alias("partitions_before"), "partitions_after")


def show_partitions(spark, sf):
    """K8."""
    return catalog.show_partitions(spark, _direct_table(spark, sf))


def table_statistics(spark, sf):
    """K9. Row count recorded by ``ANALYZE TABLE``."""
    return catalog.compute_statistics(spark, _direct_table(spark, sf)).select("row_count")


def show_tables(spark, sf):
    """K10. The listing of the registered table, with its rows."""
    name = _direct_table(spark, sf)
    listed = (catalog.list_tables(spark, fixtures.FIXTURE_DATABASE)
              .where(F.col("tableName") == name.split(".")[1]).select(_plain("tableName").alias("tableName")))
    return listed.withColumn("row_count", spark.table(name).agg(_count()).scalar())


def saved_queries(spark, sf):
    """K11. Saved queries as views; the "Product Performance" one read back."""
    catalog.create_saved_views(spark, _cur(spark, sf), as_of=AS_OF)
    return spark.table("product_performance")


# ---- §2.3 cleaning, projection, filters -----------------------------------

def drop_corrupt(spark, sf):
    """F1."""
    return (quality.drop_corrupt(_landing(spark, sf))
            .groupBy("event_type").agg(_count().alias("rows_kept")))


def count_corrupt(spark, sf):
    """F2."""
    return quality.count_corrupt(_landing(spark, sf))


def require_fields(spark, sf):
    """F3."""
    df = quality.require_fields(quality.drop_corrupt(_landing(spark, sf)))
    return df.groupBy("event_type").agg(_count().alias("rows_kept"))


def null_counts(spark, sf):
    """F4. Sequential NULL counts of the required fields."""
    return quality.null_counts(quality.drop_corrupt(_landing(spark, sf)))


def drop_columns(spark, sf):
    """F5. Personal fields removed (missing ones ignored)."""
    return typed_numbers(quality.drop_columns(conform(quality.drop_corrupt(_landing(spark, sf))))).drop(EXTRA_COLUMN)


def select_columns(spark, sf):
    """F6."""
    return _cur(spark, sf).select("user_id", "event_type", "timestamp")


def not_null_filter(spark, sf):
    """F7."""
    return _cur(spark, sf).where(F.col("session_id").isNotNull()).select("event_id", "session_id")


def non_empty_filter(spark, sf):
    """F8. NULL referrers are not kept either."""
    return _cur(spark, sf).where(F.col("referrer") != F.lit("")).select("event_id", "referrer")


def equality_filter(spark, sf):
    """F9."""
    return _cur(spark, sf).where(_is("purchase")).select("event_id", "user_id", "price")


def column_inequality(spark, sf):
    """F10."""
    st = library.session_times(_cur(spark, sf))
    return (st.where(F.col("opened_at") != F.col("closed_at"))
              .select("session_id", "opened_at", "closed_at"))


def having_filter(spark, sf):
    """F11. Filter on an aggregate by its alias."""
    return (_cur(spark, sf).where(F.col("product_id").isNotNull())
            .groupBy("product_id").agg(when_count(_is("product_view")).alias("views"))
            .where("views > 5"))


def today_partition_filter(spark, sf):
    """F12."""
    return _cur(spark, sf).where(today_filter(AS_OF)).select("event_id", "year", "month", "day")


def literal_partition_filter(spark, sf):
    """F13."""
    df = _cur(spark, sf)
    return (df.where((F.col("year") == "2024") & (F.col("month") == "01") & (F.col("day") == "23"))
              .select("event_id", "event_type"))


def qualified_star(spark, sf):
    """F14. ``t.*`` plus a computed column."""
    return (library.classify_new_returning(_cur(spark, sf))
            .drop("processed_timestamp", "earliest"))


# ---- §2.4 enrichment -----------------------------------------------------

def processed_timestamp(spark, sf):
    """E1. Job stamp (fixed per run)."""
    return _cur(spark, sf).select("event_id", "processed_timestamp")


def parse_timestamp(spark, sf):
    """E2. ISO text → timestamp; bad text → NULL."""
    df = quality.drop_corrupt(_landing(spark, sf))
    return df.select("event_id", "timestamp", parse_event_time("timestamp").alias("event_time"))


def date_partitions(spark, sf):
    """E3."""
    return _cur(spark, sf).select("event_id", "year", "month", "day")


def event_hour(spark, sf):
    """E4."""
    return _cur(spark, sf).select("event_id", "hour")


def event_date(spark, sf):
    """E5."""
    return _cur(spark, sf).select("event_id", "event_date")


def quality_flags(spark, sf):
    """E6."""
    return _cur(spark, sf).select("event_id", "has_product_data", "has_price_data")


def event_category(spark, sf):
    """E7."""
    return (_cur(spark, sf).groupBy("event_type", "event_category")
            .agg(_count().alias("event_count")))


def batch_transform(spark, sf):
    """E8. Raw JSON lines (with damaged rows) → curated rows."""
    return _json_cur(spark, sf).select(*NO_STAMP)


# ---- §2.5 join -------------------------------------------------------------

def join_first_event(spark, sf):
    """J1. Events joined to their user's first event time."""
    df = library.classify_new_returning(_cur(spark, sf))
    return df.select("event_id", "user_id", "earliest", "user_type")


# ---- §2.6 aggregation -------------------------------------------------------

def group_count(spark, sf):
    """A1."""
    return _cur(spark, sf).groupBy("device_type").agg(_count().alias("event_count"))


def count_distinct(spark, sf):
    """A2."""
    return (_cur(spark, sf).groupBy("event_category")
            .agg(F.count_distinct("user_id").alias("unique_users"),
                 F.count_distinct("session_id").alias("unique_sessions"),
                 F.count_distinct("product_id").alias("unique_products")))


def distinct_count_rows(spark, sf):
    """A3. ``select(col).distinct().count()``: NULL counts as one value."""
    return (_cur(spark, sf).select("session_id").distinct()
            .agg(_count().alias("distinct_sessions")))


def conditional_sum(spark, sf):
    """A4."""
    return (_cur(spark, sf).groupBy("device_type")
            .agg(when_count(_is("purchase")).alias("purchases"),
                 when_count(_is("product_view")).alias("views")))


def conditional_max_flag(spark, sf):
    """A5."""
    return (_cur(spark, sf).groupBy("session_id")
            .agg(flag(_is("product_view")).alias("viewed_product"),
                 flag(_is("purchase")).alias("completed_purchase")))


def conditional_avg_rate(spark, sf):
    """A6."""
    p = F.when(_is("purchase"), F.lit(1.0)).otherwise(F.lit(0.0))
    return (_cur(spark, sf).groupBy("hour")
            .agg(round2(F.avg(p) * F.lit(100.0)).alias("purchase_rate")))


def conditional_revenue_sum(spark, sf):
    """A7. A purchase without a price adds nothing."""
    c = F.when(_is("purchase"), _amount()).otherwise(F.lit(0))
    return _cur(spark, sf).groupBy("product_category").agg(money(F.sum(c)).alias("revenue"))


def sum_product(spark, sf):
    """A8. ``SUM`` and ``AVG`` of price × quantity (DECIMAL)."""
    df = _cur(spark, sf).where(F.col("price").isNotNull() & F.col("quantity").isNotNull())
    agg = df.groupBy("event_type").agg(F.sum(_amount()).alias("_c"), _count().alias("_n"))
    return agg.select("event_type", money(F.col("_c")).alias("total_amount"),
                      money(F.col("_c"), F.col("_n")).alias("avg_amount"))


def avg_product(spark, sf):
    """A8. ``ROUND(AVG(price × quantity), 2)`` per event type
    (DECIMAL)."""
    return sum_product(spark, sf).select("event_type", "avg_amount")


def avg_numeric(spark, sf):
    """A9."""
    return (_cur(spark, sf).groupBy("device_type")
            .agg(round2(F.avg("event_sequence")).alias("avg_sequence")))


def min_max_timestamp(spark, sf):
    """A10. First and last time per user (text order of the ISO strings)."""
    return (_cur(spark, sf).groupBy("user_id")
            .agg(F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")))


def ratio_guarded(spark, sf):
    """A11. Zero denominators give NULL."""
    df = _cur(spark, sf).where(F.col("product_id").isNotNull())
    agg = df.groupBy("product_id").agg(when_count(_is("purchase")).alias("purchases"),
                                       when_count(_is("product_view")).alias("views"))
    return agg.select("product_id", rate(F.col("purchases"), F.col("views")).alias("conversion_rate"))


def ratio_unguarded(spark, sf):
    """A12. ``ROUND(COUNT(*) * 1.0 / COUNT(DISTINCT session), 2)`` — a group
    whose sessions are all NULL would divide by 0: NULL, not an error."""
    agg = (_cur(spark, sf).groupBy("referrer")
           .agg(_count().alias("_n"), F.count_distinct("session_id").alias("_s")))
    return agg.select("referrer", round2(F.try_divide(F.col("_n").cast("double"),
                                                     F.col("_s").cast("double")))
                      .alias("events_per_session"))


def global_aggregate(spark, sf):
    """A13."""
    return _cur(spark, sf).agg(
        _count().alias("total_records"),
        F.count_distinct("user_id").alias("unique_users"),
        money(F.sum(_amount())).alias("total_amount"),
        round2(F.avg("event_sequence")).alias("avg_sequence"))


def multi_key_group(spark, sf):
    """A14."""
    return _cur(spark, sf).groupBy("year", "month", "day").agg(_count().alias("event_count"))


def group_key_expression(spark, sf):
    """A15. Group by a flag, output a label computed from it."""
    st = library.session_times(_cur(spark, sf))
    label = (F.when(F.col("bought") == 1, F.lit(library.LABEL_CONVERTED))
             .otherwise(F.lit(library.LABEL_NOT_CONVERTED)))
    return (st.groupBy("bought").agg(_count().alias("session_count"))
              .select(label.alias("conversion_status"), "session_count"))


def duplicate_count(spark, sf):
    """A16. Product ``prod_023`` events delivered twice."""
    df = _cur(spark, sf)
    doubled = df.unionByName(df.where(F.col("product_id") == F.lit("prod_023")))
    return doubled.agg(_count().alias("total_records"),
                       F.count_distinct("event_id").alias("unique_events"),
                       (_count() - F.count_distinct("event_id")).alias("duplicate_events"))


def run_summary(spark, sf):
    """A17. Totals of the batch run, from the rows it wrote."""
    return fixtures.stored_run(spark, sf).summary()


def run_type_counts(spark, sf):
    """A17. Rows per event type of the batch run."""
    return fixtures.stored_run(spark, sf).type_counts()


def run_counters(spark, sf):
    """A18. Counters observed while the batch run wrote its rows."""
    counters = fixtures.stored_run(spark, sf).counters
    cols = ["rows_read", "corrupt_records", "null_event_id", "null_user_id",
            "null_event_type", "null_timestamp", "valid_records"]
    return spark.createDataFrame([tuple(int(counters[c]) for c in cols)],
                                 ", ".join(f"{c} bigint" for c in cols))


# ---- §2.7 windows ----------------------------------------------------------

def event_sequence(spark, sf):
    """W1."""
    return _cur(spark, sf).select("event_id", "session_id", "event_sequence")


def is_session_start(spark, sf):
    """W2."""
    return _cur(spark, sf).select("event_id", "is_session_start")


def share_of_total(spark, sf):
    """W3."""
    agg = _cur(spark, sf).groupBy("device_type").agg(_count().alias("event_count"))
    return library.share_of_total(agg, "event_count")


# ---- §2.8 sort / top-k -----------------------------------------------------

def order_by(spark, sf):
    """O1."""
    return (_cur(spark, sf).groupBy("hour").agg(_count().alias("event_count"))
            .orderBy(F.asc_nulls_last("hour")))


def order_by_multi(spark, sf):
    """O2."""
    return (_cur(spark, sf).groupBy("year", "month", "day").agg(_count().alias("event_count"))
            .orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("month"), F.desc_nulls_last("day")))


def top_k(spark, sf):
    """O3. The 20 most active users (ties by user id)."""
    return (_cur(spark, sf).groupBy("user_id").agg(_count().alias("event_count"))
            .orderBy(F.desc("event_count"), F.asc("user_id")).limit(20))


# ---- §2.9 set operations, CTEs ---------------------------------------------

def union_all(spark, sf):
    """U1. The funnel as four branches glued with UNION ALL over one stored
    row of sums, so the table is scanned once."""
    flags = library.session_funnel_flags(_cur(spark, sf).where(today_filter(AS_OF)))
    n = [F.col(f"n{i}") for i in range(4)]
    sums = stored(flags.agg(*[F.sum(f"_s{i}").cast("bigint").alias(f"n{i}") for i in range(4)]), "funnel-sums")

    def pct_of(i, j):
        return F.try_divide(n[i].cast("double") * 100.0, n[j].cast("double"))

    out = sums.select(F.lit("Product View").alias("stage"), n[0].alias("sessions"),
                      F.lit(100.0).alias("percentage"), F.lit(0.0).alias("drop_off_rate"))
    for i, label in enumerate(["Add to Cart", "Checkout Start", "Purchase"], start=1):
        out = out.unionByName(sums.select(
            F.lit(label).alias("stage"), n[i].alias("sessions"),
            round2(pct_of(i, 0)).alias("percentage"),
            round2(F.lit(100.0) - pct_of(i, i - 1)).alias("drop_off_rate")))
    return out


def distinct_rows(spark, sf):
    """U2."""
    return _cur(spark, sf).select("user_id", "device_type").distinct()


def cte(spark, sf):
    """U3. Chained intermediate results (per session → per outcome)."""
    st = library.session_times(_cur(spark, sf))
    multi = st.where(F.col("opened_at") != F.col("closed_at"))
    return (multi.groupBy("bought")
                 .agg(_count().alias("session_count"),
                      round2(F.avg("event_count")).alias("avg_events")))


# ---- §2.10 scalar functions -------------------------------------------------

def scalar_dates(spark, sf):
    """X1-X6. Date parts of the parsed event time (bad time → NULL everywhere)."""
    df = quality.drop_corrupt(_landing(spark, sf))
    t = parse_event_time("timestamp")
    return df.select("event_id", F.year(t).alias("y"), F.month(t).alias("m"),
                     F.dayofmonth(t).alias("d"), F.hour(t).alias("h"),
                     F.to_date(t).alias("dt"))


def scalar_strings(spark, sf):
    """X9-X11. ``lpad``, cast to text, ``concat`` (NULL if a part is NULL)."""
    df = _cur(spark, sf)
    return df.select(
        "event_id",
        F.lpad(F.month("event_date").cast("string"), 2, "0").alias("padded_month"),
        F.col("hour").cast("string").alias("hour_text"),
        F.concat(F.col("session_id"), F.lit("/"), F.col("product_id")).alias("session_product"))


def scalar_elapsed_seconds(spark, sf):
    """X17-X18. Whole seconds between a session's first and last event."""
    st = library.session_times(_cur(spark, sf))
    secs = elapsed_seconds(parse_event_time("opened_at"), parse_event_time("closed_at"))
    return st.select("session_id", secs.alias("elapsed_seconds"))


def scalar_null_safe(spark, sf):
    """X12-X14. ``round``, ``nullif``, ``case when`` around a division."""
    df = _cur(spark, sf).where(F.col("product_id").isNotNull())
    agg = df.groupBy("product_id").agg(when_count(_is("add_to_cart")).alias("adds"),
                                       when_count(_is("purchase")).alias("purchases"))
    return agg.select(
        "product_id",
        F.nullif(F.col("adds"), F.lit(0)).alias("adds_or_null"),
        rate(F.col("purchases"), F.col("adds")).alias("cart_to_purchase_rate"),
        F.when(F.col("purchases") > 0, F.lit("sold")).otherwise(F.lit("unsold")).alias("status"))


SINGLE_OPS = {name: fn for name, fn in list(globals().items())
              if callable(fn) and getattr(fn, "__module__", None) == __name__
              and not name.startswith("_")}
