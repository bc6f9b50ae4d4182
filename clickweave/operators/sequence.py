"""Position of each event inside its session, safe against hot sessions.

``row_number() OVER (PARTITION BY session ORDER BY time, event_id)`` puts a
whole session into one task, and the window operator buffers it. One session
key may hold a large share of all rows (every event without a session id
shares the NULL key; a bot can flood one session), so the plain window does
not survive scale. This operator gives exactly the same numbers:

1. A seeded sample of the keys gives the hot ones: keys whose estimated size
   is at least ``min_hot_rows``. Their number is at most rows / min_hot_rows,
   so it follows the data and needs no cap. Without a hot key the plain window
   is the plan.
2. Each hot key gets bucket edges: quantiles of ``(time, tie)`` over sampled
   rows, ``PER_BUCKET`` of them per bucket of about ``rows_per_bucket`` rows. They
   follow the rows, not the clock: one wrong date, a burst inside one
   millisecond or times that do not parse (NULL sorts first, then by tie) all
   give even buckets.
3. Every row gets its bucket by binary search in the key's edges - a monotone
   function of the sort order - and the window runs over ``(key, bucket)``.
4. Rows per hot ``(key, bucket)`` are counted by a partial aggregation, summed
   cumulatively per key and added to the local numbers.

The sample only decides where work is split, never the result. The table of hot
keys is written to the shared folder and broadcast only when its measured size
allows. Rows that agree in key, time and tie stay together: their order is
arbitrary in the plain window too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.operators.joins import MAX_BROADCAST_BYTES
from clickweave.session import stored

DEFAULT_SAMPLE_FRACTION = 0.01
DEFAULT_MIN_HOT_ROWS = 2_000_000
DEFAULT_ROWS_PER_BUCKET = 1_000_000
DEFAULT_SEED = 17
#: Sampled rows per bucket edge.
PER_BUCKET = 32


def hot_keys(sample: DataFrame, key: str, time_col: str, tie_col: str, *,
             sample_fraction: float = DEFAULT_SAMPLE_FRACTION,
             min_hot_rows: int = DEFAULT_MIN_HOT_ROWS,
             rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
             seed: int = DEFAULT_SEED) -> DataFrame | None:
    """``_hk`` (hot key) and ``_edges`` (sorted ``(time, tie)`` lower bounds of
    buckets 1, 2, ...), stored; None without a hot key."""
    rows = sample.select(F.col(key).alias("_hk"), F.struct(F.col(time_col).alias("t"), F.col(tie_col).alias("k")).alias("_at"))
    big = (rows.groupBy("_hk").agg(F.count(F.lit(1)).alias("_hn"))
           .where(F.col("_hn") >= F.lit(min_hot_rows * sample_fraction))
           .withColumn("_nb", F.ceil(F.col("_hn") / F.lit(sample_fraction * rows_per_bucket))))
    if big.isEmpty():  # nothing is written for the usual run
        return None
    big = stored(big.withColumnRenamed("_hk", "_bk"), "sequence-keys")
    # the sample is thinned to PER_BUCKET rows a bucket before it is gathered
    rate = F.col("_nb") * F.lit(float(PER_BUCKET)) / F.col("_hn")
    thin = (rows.join(big, F.col("_hk").eqNullSafe(F.col("_bk")))
            .where(F.rand(seed) < rate).groupBy("_hk").agg(F.sort_array(F.collect_list("_at")).alias("_s"), F.first("_nb").alias("_nb")))
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.col("_nb") - 1, F.lit(1))),
                      lambda i: F.get("_s", F.floor(i * F.size("_s") / F.col("_nb")).cast("int")))
    edges = F.when(F.col("_nb") > 1, F.array_distinct(F.filter(cut, lambda e: e.isNotNull()))).otherwise(F.array().cast(f"array<{dict(rows.dtypes)['_at']}>"))
    return stored(thin.select("_hk", edges.alias("_edges")), "sequence-edges")


def bucket_of(time_col: str, tie_col: str, most: int) -> Column:
    """Number of edges at or below the row's ``(time, tie)``: binary search in
    at most ``most`` edges; 0 without edges."""
    at = F.struct(F.col(time_col).alias("t"), F.col(tie_col).alias("k"))
    steps = F.array(*[F.lit(1 << i) for i in range(max(1, most.bit_length()) - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= F.size("_edges")) & (F.get("_edges", n + step - 1) <= at), n + step).otherwise(n))
    return F.when(F.col("_edges").isNull(), F.lit(0)).otherwise(found)


def bucketed(df: DataFrame, hot: DataFrame, key: str, time_col: str, tie_col: str) -> DataFrame:
    """``df`` with ``_bucket`` and ``_hot``."""
    size, most = hot.agg(F.sum(F.size("_edges") * 64 + 64), F.max(F.size("_edges"))).first()
    side = F.broadcast(hot) if (size or 0) <= MAX_BROADCAST_BYTES else hot
    return (df.join(side, F.col(key).eqNullSafe(F.col("_hk")), "left")
              .withColumn("_bucket", bucket_of(time_col, tie_col, most or 1))
              .withColumn("_hot", F.col("_edges").isNotNull()).drop("_hk", "_edges"))


def sequence_within(df: DataFrame, key: str, time_col: str, tie_col: str,
                    out: str = "event_sequence", *,
                    sample_fraction: float = DEFAULT_SAMPLE_FRACTION,
                    min_hot_rows: int = DEFAULT_MIN_HOT_ROWS,
                    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                    seed: int = DEFAULT_SEED,
                    null_key: str = "group",
                    sample: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of the row within ``key``, ordered by
    ``time_col`` (NULLs first) then ``tie_col``. NULL keys form one group
    (``null_key="group"``) or get NULL (``null_key="null"``).

    ``sample``: optional rows with key, time and tie already drawn at
    ``sample_fraction``."""
    if null_key not in ("group", "null"):
        raise ValueError("null_key must be 'group' or 'null'")
    if null_key == "null":
        some = None if sample is None else sample.where(F.col(key).isNotNull())
        rest = sequence_within(df.where(F.col(key).isNotNull()), key, time_col, tie_col, out, sample_fraction=sample_fraction,
                               min_hot_rows=min_hot_rows, rows_per_bucket=rows_per_bucket, seed=seed, sample=some)
        return rest.unionByName(df.where(F.col(key).isNull()).withColumn(out, F.lit(None).cast("int")))
    if sample is None:
        sample = df.sample(fraction=sample_fraction, seed=seed)
    hot = hot_keys(sample, key, time_col, tie_col, sample_fraction=sample_fraction, min_hot_rows=min_hot_rows,
                   rows_per_bucket=rows_per_bucket, seed=seed)
    if hot is None:
        return plain_sequence(df, key, time_col, tie_col, out)

    one = _sums_by_bucket(df.withColumn("_one", F.lit(1)), hot, key, time_col, tie_col, {"_rn": "_one"})
    return one.withColumn(out, F.col("_rn").cast("int")).drop("_one", "_rn")


def _sums_by_bucket(df: DataFrame, hot: DataFrame, key: str, time_col: str, tie_col: str, sums: dict[str, str]) -> DataFrame:
    """Running sums inside (key, bucket), plus the sums of the buckets before."""
    rows = bucketed(df, hot, key, time_col, tie_col)
    w = (Window.partitionBy(key, "_bucket")
         .orderBy(F.col(time_col).asc_nulls_first(), F.col(tie_col).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    local = rows.select("*", *[F.sum(c).over(w).alias(f"_w_{out}") for out, c in sums.items()])
    per_bucket = rows.where(F.col("_hot")).groupBy(key, "_bucket").agg(*[F.sum(c).alias(f"_b_{out}") for out, c in sums.items()])
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(F.col(key).alias("_ok"), F.col("_bucket").alias("_ob"), *[
        F.coalesce(F.sum(f"_b_{out}").over(before), F.lit(0)).alias(f"_o_{out}") for out in sums])
    buckets = hot.agg(F.sum(F.size("_edges") + 1)).first()[0]
    side = F.broadcast(offsets) if buckets * 128 <= MAX_BROADCAST_BYTES else offsets
    joined = local.join(side, F.col(key).eqNullSafe(F.col("_ok")) & (F.col("_bucket") == F.col("_ob")), "left")
    done = [(F.col(f"_w_{out}") + F.coalesce(f"_o_{out}", F.lit(0))).alias(out) for out in sums]
    return joined.select(*df.columns, *done)


def running_sums(df: DataFrame, key: str, time_col: str, tie_col: str, sums: dict[str, str], *,
                 sample_fraction: float = DEFAULT_SAMPLE_FRACTION, min_hot_rows: int = DEFAULT_MIN_HOT_ROWS,
                 rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, seed: int = DEFAULT_SEED) -> DataFrame:
    """``df`` with running sums (``sums``: result column to summed column) within
    ``key``, by ``time_col`` then ``tie_col``, the row itself included; hot keys
    are split like those of ``sequence_within``."""
    hot = hot_keys(df.sample(fraction=sample_fraction, seed=seed), key, time_col, tie_col, sample_fraction=sample_fraction,
                   min_hot_rows=min_hot_rows, rows_per_bucket=rows_per_bucket, seed=seed)
    if hot is not None:
        return _sums_by_bucket(df, hot, key, time_col, tie_col, sums)
    w = (Window.partitionBy(key).orderBy(F.col(time_col).asc_nulls_first(), F.col(tie_col).asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, 0))
    return df.select("*", *[F.sum(c).over(w).alias(out) for out, c in sums.items()])


def plain_sequence(df: DataFrame, key: str, time_col: str, tie_col: str,
                   out: str = "event_sequence") -> DataFrame:
    """The textbook window, for comparison in tests and small inputs."""
    w = (Window.partitionBy(key)
         .orderBy(F.col(time_col).asc_nulls_first(), F.col(tie_col).asc_nulls_first()))
    return df.withColumn(out, F.row_number().over(w))


def session_start(col: str | Column = "event_sequence") -> Column:
    """W2. First event of its session."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c == F.lit(1), F.lit(False))
