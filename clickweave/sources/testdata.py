"""Raw events derived from the generic test tables ``events`` and ``part``.

The test tables do not carry web events, so each ``events`` row is mapped to
one raw event with fixed, documented rules (see FIXTURES.md §3). The mapping
is a projection plus one dimension lookup, so its cost grows linearly with
``events``. The DuckDB oracle applies the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.joins import lookup_join
from clickweave.sources.schema import RAW_FIELDS

# Event types that carry product fields / a quantity.
PRODUCT_TYPES = ["product_view", "add_to_cart", "remove_from_cart", "purchase"]
QUANTITY_TYPES = ["add_to_cart", "remove_from_cart", "purchase"]
# Device by user_id % 4 (3 → no device).
DEVICES = ["desktop", "mobile", "tablet"]
# Referrer by event_id % 5 (4 → no referrer).
REFERRERS = ["https://google.com", "https://bing.com", "direct", ""]
NO_SESSION_K = 97
PAGE_URL = "https://example.com/"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _event_type(src: F.Column, k: F.Column) -> F.Column:
    k4, k8, k5, k3 = k % 4, k % 8, k % 5, k % 3
    return (F.when(src == "view",
                   F.when(k4 == 0, "page_view")
                    .when(k4.isin(1, 2), "product_view")
                    .when(k8 == 3, "category_view")
                    .otherwise("search"))
             .when(src == "click",
                   F.when(k4.isin(0, 1), "add_to_cart")
                    .when(k4 == 2, "remove_from_cart")
                    .otherwise("checkout_start"))
             .when(src == "purchase",
                   F.when(k5 == 0, "payment_info").otherwise("purchase"))
             .when(src == "signup",
                   F.when(k3 == 0, "signup").when(k3 == 1, "login").otherwise("logout"))
             .otherwise(src))


def _pick(index: F.Column, values: list[str]) -> F.Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def spread(df: DataFrame) -> DataFrame:
    """Give a source with fewer splits than task slots (one small file is one
    split) a round-robin spread over the slots, so the per-row mapping runs
    on every core. Large inputs already have many splits and pass unchanged."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def raw_events_from_tables(spark: SparkSession, sf_dir: str, keep_key: bool = False,
                           sample_fraction: float | None = None, seed: int = 17) -> DataFrame:
    """One raw event (16 string/number fields) per ``events`` row; with
    ``keep_key`` also the mapping key ``_k`` and the source time ``_ts``.

    With ``sample_fraction`` only a seeded sample of ``events`` is mapped,
    without the product lookup (product fields NULL): the input for hot-key
    detection, drawn right after the scan."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    if sample_fraction is not None:
        ev = ev.sample(fraction=sample_fraction, seed=seed)
    else:
        ev = spread(ev)

    # ``k`` is extracted once, inside a generator (``inline`` of a one-element
    # array): filters on mapped fields cannot be pushed below it, so the
    # extraction stays after the spread and runs on every core. The type
    # rules then work on the integer column.
    base = (ev.select(F.inline(F.array(F.struct(
                F.col("event_id").alias("_e"), F.col("user_id").alias("_u"),
                F.col("ts").alias("_ts"), F.col("event_type").alias("_src"),
                F.get_json_object(F.col("props"), "$.k").try_cast("int").alias("_k")))))
              .withColumn("event_type", _event_type(F.col("_src"), F.col("_k"))))

    if sample_fraction is None:
        part = (spark.read.parquet(f"{sf_dir}/part.parquet")
                .select("p_partkey", "p_name", "p_type", "p_retailprice"))
        joined = lookup_join(base, part, F.col("_k").cast("bigint") == F.col("p_partkey"), "left")
    else:
        joined = base.select("*", *[F.lit(None).cast(t).alias(c) for c, t in
                                    [("p_name", "string"), ("p_type", "string"),
                                     ("p_retailprice", "double")]])

    is_product = F.col("event_type").isin(PRODUCT_TYPES)
    cols = {
        "event_id": F.concat(F.lit("evt_"), F.col("_e").cast("string")),
        "user_id": F.concat(F.lit("user_"), F.col("_u").cast("string")),
        "session_id": F.when(F.col("_k") == NO_SESSION_K, F.lit(None).cast("string"))
                       .otherwise(F.concat(F.lit("s_"), F.col("_u").cast("string"), F.lit("_"),
                                           F.date_format(F.col("_ts"), "yyyyMMdd"))),
        "event_type": F.col("event_type"),
        "timestamp": F.date_format(F.col("_ts"), TIME_FORMAT),
        "page_url": F.lit(PAGE_URL),
        "product_id": F.when(is_product, F.concat(F.lit("prod_"),
                                                  F.lpad(F.col("_k").cast("string"), 3, "0"))),
        "product_name": F.when(is_product, F.col("p_name")),
        "product_category": F.when(is_product, F.col("p_type")),
        "price": F.when(is_product, F.col("p_retailprice")),
        "quantity": F.when(F.col("event_type").isin(QUANTITY_TYPES),
                           (F.lit(1) + F.col("_e") % 3).cast("int")),
        "user_agent": F.lit(None).cast("string"),
        "ip_address": F.lit(None).cast("string"),
        "device_type": _pick(F.col("_u") % 4, DEVICES),
        "referrer": _pick(F.col("_e") % 5, REFERRERS),
        "additional_data": F.lit(None).cast("string"),
    }
    out = [cols[name].cast(t).alias(name) for name, t in RAW_FIELDS]
    if keep_key:
        out += [F.col("_k"), F.col("_ts")]
    return joined.select(*out)


# Rows of the JSON fixture that arrive damaged, chosen by k.
BROKEN_LINE_K = 13       # the line loses its last character (not valid JSON)
NO_USER_K = 42           # user_id is not sent
NO_TYPE_NO_USER_K = 57   # neither event_type nor user_id is sent
BAD_TIME_K = 71          # timestamp is sent as the text "garbage"
BAD_TIME_TEXT = "garbage"


def json_lines_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events as producers would send them: one JSON text per event
    (``value``), with the damaged rows above, plus ``year/month/day`` of the
    event time to file them under arrival-style folders."""
    m = raw_events_from_tables(spark, sf_dir, keep_key=True)
    k = F.col("_k")
    replaced = {
        "user_id": F.when(k.isin(NO_USER_K, NO_TYPE_NO_USER_K), F.lit(None).cast("string"))
                    .otherwise(F.col("user_id")),
        "event_type": F.when(k == NO_TYPE_NO_USER_K, F.lit(None).cast("string"))
                       .otherwise(F.col("event_type")),
        "timestamp": F.when(k == BAD_TIME_K, F.lit(BAD_TIME_TEXT)).otherwise(F.col("timestamp")),
    }
    fields = [replaced.get(name, F.col(name)).alias(name) for name, _ in RAW_FIELDS]
    line = F.when(k == BROKEN_LINE_K, F.expr("substring(_line, 1, length(_line) - 1)")) \
            .otherwise(F.col("_line"))
    return (m.select(F.to_json(F.struct(*fields)).alias("_line"), k, F.col("_ts"))
             .select(line.alias("value"),
                     F.date_format("_ts", "yyyy").alias("year"),
                     F.date_format("_ts", "MM").alias("month"),
                     F.date_format("_ts", "dd").alias("day")))
