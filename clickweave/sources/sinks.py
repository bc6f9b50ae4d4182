"""K1, K3: writing the curated table and query results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.sources.schema import PARTITION_COLUMNS, curated_schema
from clickweave.streaming.batches import replacing


#: Row group bytes of files written for data skipping (its Bloom filters take a
#: 64th of that, some 10 bits a row); bits of a column's rank.
SKIPPING_ROW_GROUP = 16 << 20
RANK_BITS = 8


def rank_bounds(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Per column the values that cut a hash sample of its distinct values into
    ``2 ** RANK_BITS`` ranges. They only steer the order of rows."""
    out = {}
    for c in columns:
        some = df.select(F.col(c).cast("string").alias("v")).where("v IS NOT NULL").distinct().orderBy(F.xxhash64("v"), "v").limit(16 << RANK_BITS)
        values = sorted(r["v"] for r in some.collect())
        cuts = 1 << RANK_BITS
        out[c] = sorted({values[k * len(values) // cuts] for k in range(1, cuts)}) if values else []
    return out


def rank_of(value: Column, bounds: list[str]) -> Column:
    """Number of bounds at or below a value, by binary search, spread over
    ``RANK_BITS`` bits (so that a column of few values weighs as much in the curve as
    one of many); NULL ranks first."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= len(bounds)) & (F.get(table, n + step - 1) <= value.cast("string")), n + step).otherwise(n))
    return F.floor(found * (1 << RANK_BITS) / (len(bounds) + 1)).cast("int")


def z_value(ranks: list[Column]) -> Column:
    """Bits of the ranks in turn: near in the result means near in all of them."""
    out = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for k, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + k))
    return out


def write_curated(df: DataFrame, path: str, mode: str = "append", compact: bool = True,
                  batch: str | None = None, skipping: dict[str, list[str]] | None = None) -> None:
    """K1. Parquet (snappy), partitioned by ``year/month/day``.

    ``compact``: ``REBALANCE`` on the partition columns lets AQE cut the rows
    into advisory-size tasks per day: a hot day is split over several files
    (never one giant task) and small days are coalesced, instead of every
    task writing one small file per day it saw. It costs one shuffle of the
    output; a run that covers one or two days with large tasks can skip it.

    ``batch``: key of a micro-batch; its rows go under ``batch=<key>`` below the
    day, replacing what an earlier attempt of the same batch left.

    ``skipping``: bounds of columns (``rank_bounds``). Rows of a day are ordered
    along a Z curve over these columns, so a file or row group spans a small range
    of each, and its minima and maxima rule it out for filters on any of them;
    ``event_id`` gets a Bloom filter a row group."""
    if compact and not skipping:
        df = df.hint("rebalance", *PARTITION_COLUMNS)
    if skipping:
        z = z_value([rank_of(F.col(c), bounds) for c, bounds in skipping.items()])
        df = df.withColumn("_z", z).repartitionByRange(*PARTITION_COLUMNS, "_z").sortWithinPartitions(*PARTITION_COLUMNS, "_z").drop("_z")
    writer = replacing(df, batch, PARTITION_COLUMNS) if batch else df.write.mode(mode).partitionBy(*PARTITION_COLUMNS)
    if skipping:
        writer = (writer.option("parquet.bloom.filter.enabled#event_id", "true").option("parquet.bloom.filter.max.bytes", SKIPPING_ROW_GROUP // 64)
                  .option("parquet.block.size", SKIPPING_ROW_GROUP))
    writer.option("compression", "snappy").parquet(path)


def read_curated(spark, path: str, merge_schema: bool = False, extra: list[str] = ()) -> DataFrame:
    """S4. The stored table with its declared schema: no footer is read to
    infer or merge schemas (that costs one read per file on a large table),
    and the partition values stay zero-padded strings. Columns added later
    by schema evolution are read through the catalog table, or here by naming
    their producer fields (``extra``) or with ``merge_schema=True``."""
    reader = spark.read.option("basePath", path)
    if merge_schema:
        return reader.option("mergeSchema", "true").parquet(path)
    schema = curated_schema(extra)
    return reader.schema(schema).parquet(path).select(*[f"`{n}`" for n in schema.names])


def write_result_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3. A query result as CSV files with a header line (one file per
    output task; a result is not assumed to be small)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_result_csv(spark, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per stored partition."""
    return df.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))
