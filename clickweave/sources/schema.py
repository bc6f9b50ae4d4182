"""Event schemas: raw (as sent), landing (as parsed), curated (as stored)."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw event fields, in the order producers send them.
RAW_FIELDS = [
    ("event_id", T.StringType()),
    ("user_id", T.StringType()),
    ("session_id", T.StringType()),
    ("event_type", T.StringType()),
    ("timestamp", T.StringType()),
    ("page_url", T.StringType()),
    ("product_id", T.StringType()),
    ("product_name", T.StringType()),
    ("product_category", T.StringType()),
    ("price", T.DoubleType()),
    ("quantity", T.IntegerType()),
    ("user_agent", T.StringType()),
    ("ip_address", T.StringType()),
    ("device_type", T.StringType()),
    ("referrer", T.StringType()),
    ("additional_data", T.StringType()),
]

# Fields an event must carry to be kept.
REQUIRED_FIELDS = ["event_id", "user_id", "event_type", "timestamp"]

# Personal or unused fields removed before storage.
DROPPED_FIELDS = ["user_agent", "ip_address", "additional_data"]

CORRUPT_COLUMN = "_corrupt_record"
# Fields that producers send beside the known ones, as a map of texts.
EXTRA_COLUMN = "_extra"

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])

# The parser lands every field as text: a producer that sends "9.5" for a
# price or 1.0 for a quantity must not turn the whole row corrupt. Numbers are
# cast afterwards with try_cast, so a bad value becomes NULL and the row stays.
LANDING_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n, _ in RAW_FIELDS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType(), True),
       T.StructField(EXTRA_COLUMN, T.MapType(T.StringType(), T.StringType()), True)]
)

PARTITION_COLUMNS = ["year", "month", "day"]
# One more partition column of tables that streams append to (streaming.batches).
BATCH_COLUMN = "batch"

# Fields beyond those that one run turns into columns stay in this map; in a list
# of new fields MORE_FIELDS stands for it.
OTHER_COLUMN = "other_fields"
MORE_FIELDS = "\0more"

# Curated table: kept raw fields, then the derived ones, partitions last.
CURATED_FIELDS = [
    ("event_id", T.StringType()),
    ("user_id", T.StringType()),
    ("session_id", T.StringType()),
    ("event_type", T.StringType()),
    ("timestamp", T.StringType()),
    ("page_url", T.StringType()),
    ("product_id", T.StringType()),
    ("product_name", T.StringType()),
    ("product_category", T.StringType()),
    ("price", T.DoubleType()),
    ("quantity", T.IntegerType()),
    ("device_type", T.StringType()),
    ("referrer", T.StringType()),
    ("processed_timestamp", T.TimestampType()),
    ("hour", T.IntegerType()),
    ("event_date", T.DateType()),
    ("event_category", T.StringType()),
    ("event_sequence", T.IntegerType()),
    ("is_session_start", T.BooleanType()),
    ("has_product_data", T.BooleanType()),
    ("has_price_data", T.BooleanType()),
    ("year", T.StringType()),
    ("month", T.StringType()),
    ("day", T.StringType()),
]

CURATED_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in CURATED_FIELDS])
CURATED_COLUMNS = [n for n, _ in CURATED_FIELDS]


def extra_column(field: str) -> str:
    """Table column of a new producer field; a name that a table column has
    already is prefixed."""
    taken = {BATCH_COLUMN, OTHER_COLUMN, *(n.lower() for n, _ in CURATED_FIELDS)}
    return f"raw_{field}" if field.lower() in taken else field


def curated_schema(extra: list[str] = ()) -> T.StructType:
    """Table columns with new fields (text, and the map of the others) before the
    partition columns."""
    stored = [f for f in CURATED_SCHEMA.fields if f.name not in PARTITION_COLUMNS]
    parts = [f for f in CURATED_SCHEMA.fields if f.name in PARTITION_COLUMNS]
    new = [T.StructField(OTHER_COLUMN, T.MapType(T.StringType(), T.StringType()), True) if n == MORE_FIELDS
           else T.StructField(extra_column(n), T.StringType(), True) for n in extra]
    return T.StructType([*stored, *new, *parts])


def producer_field(df, name: str):
    """A producer field beyond the known ones, wherever it is kept: in a column
    of its own, in the map of other fields, or nowhere (NULL)."""
    from pyspark.sql import functions as F
    found = [F.col(f"`{extra_column(name)}`")] if extra_column(name) in df.columns else []
    found += [F.col(OTHER_COLUMN)[name]] if OTHER_COLUMN in df.columns else []
    return F.coalesce(*found, F.lit(None).cast("string"))


def curated_ddl(table: str, location: str, batched: bool = False) -> str:
    """CREATE TABLE statement for the curated table at ``location``; ``batched``
    tables have a partition level more, one folder a micro-batch."""
    fields = [*CURATED_SCHEMA.fields, *([T.StructField(BATCH_COLUMN, T.StringType())] if batched else [])]
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in fields)
    parts = ", ".join([*PARTITION_COLUMNS, *([BATCH_COLUMN] if batched else [])])
    return (f"CREATE TABLE IF NOT EXISTS {table} (\n  {cols}\n) USING parquet "
            f"PARTITIONED BY ({parts}) LOCATION '{location}'")
