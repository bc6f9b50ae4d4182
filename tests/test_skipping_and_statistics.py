"""Data skipping inside a day, statistics that plans follow, sized delivery."""

import datetime as _dt
import glob
import gzip
import json
import os
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from clickweave.session import scratch_path
from clickweave.sources import catalog, sinks
from clickweave.sources.schema import CURATED_SCHEMA, curated_ddl
from clickweave.streaming import ingest


def _day(spark, n=40_000, users=400):
    types = ["page_view", "product_view", "search", "add_to_cart", "purchase", "login", "logout", "signup"]
    kind = F.array(*[F.lit(t) for t in types])
    row = spark.range(n).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.format_string("user_%06d", F.pmod(F.xxhash64("id"), F.lit(users))).alias("user_id"),
        F.get(kind, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(8)).cast("int")).alias("event_type"),
        F.lit("2025-05-05T10:00:00Z").alias("timestamp"), F.sha2(F.col("id").cast("string"), 256).alias("page_url"), (F.col("id") % 50).cast("int").alias("quantity"),
        F.lit("2025").alias("year"), F.lit("05").alias("month"), F.lit("05").alias("day"))
    return row.select(*[(F.col(f.name) if f.name in row.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CURATED_SCHEMA.fields]).cache()


def _groups_hit(path, column, value):
    """(row groups whose minimum and maximum allow the value, all row groups)."""
    hit = total = 0
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(at).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit, total


def test_z_order_rules_out_row_groups(spark, monkeypatch):
    monkeypatch.setattr(sinks, "SKIPPING_ROW_GROUP", 1 << 16)
    rows, plain, sorted_ = _day(spark), scratch_path(spark, "t-plain"), scratch_path(spark, "t-z")
    sinks.write_curated(rows.repartition(8), plain, compact=False)
    bounds = sinks.rank_bounds(rows, ["event_type", "user_id"])
    assert bounds["event_type"] == sorted(bounds["event_type"]) and len(bounds["user_id"]) > 100
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_curated(rows, sorted_, skipping=bounds)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for column, value in (("event_type", "purchase"), ("user_id", "user_000123")):
        hit, total = _groups_hit(plain, column, value)
        assert hit == total
        hit, total = _groups_hit(sorted_, column, value)
        assert total >= 8 and hit <= 0.7 * total, (column, hit, total)
    back = sinks.read_curated(spark, sorted_)
    assert back.exceptAll(rows.select(back.columns)).count() == 0 and back.count() == rows.count()
    # a Bloom filter stands in every file for event_id
    names = glob.glob(f"{sorted_}/**/*.parquet", recursive=True)
    assert names and back.where("event_id = 'e77'").count() == 1


def test_statistics_change_estimates_and_plans(spark):
    name, path = f"{catalog.DEFAULT_DATABASE}.t_stats", scratch_path(spark, "t-stats")
    catalog.create_database(spark)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = _day(spark)
    sinks.write_curated(rows, path)
    spark.sql(curated_ddl(name, path))
    catalog.repair_partitions(spark, name)
    stats = {r.column_name: r for r in catalog.compute_column_statistics(spark, name, ["quantity", "user_id", "session_id"]).collect()}
    q = stats["quantity"]
    assert (q.min_value, q.max_value, q.null_count, q.has_histogram) == ("0", "49", 0, True) and 45 <= q.distinct_count <= 55
    assert stats["session_id"].null_count == 40_000 and 380 <= stats["user_id"].distinct_count <= 420
    catalog.compute_partition_statistics(spark, name)
    assert catalog.partition_rows(spark, name, ("2025", "05", "05")) == 40_000

    def estimate():
        few = spark.table(name).where("quantity = 7").select("user_id", F.col("quantity").alias("q"))
        return few._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    blind = estimate()
    catalog.use_statistics(spark)
    told = estimate()
    assert told * 3 < blind
    # between the two sizes: only the estimate makes the small side a broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(told + (blind - told) // 2))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    def plan():
        t = spark.table(name)
        few = t.where("quantity = 7").select("user_id", F.col("quantity").alias("q"))
        return t.select("user_id", "event_id").join(few, "user_id")._jdf.queryExecution().executedPlan().toString()
    with_stats = plan()
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled", "spark.sql.cbo.planStats.enabled"):
        spark.conf.unset(key)
    without = plan()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in with_stats and "BroadcastHashJoin" not in without


def test_a_backlog_is_delivered_in_bounded_files(spark):
    r = random.Random(1)
    inbox, out = scratch_path(spark, "t-backlog"), scratch_path(spark, "t-delivered")
    os.makedirs(inbox)
    total = 0
    for k in range(12):
        lines = [json.dumps({"event_id": f"{k}-{i}", "x": "".join(r.choices("abcdef", k=80))}) for i in range(400)]
        total += len(lines)
        with open(os.path.join(inbox, f"f{k}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
    bound = 20_000
    ingest.deliver_raw(spark, inbox, out, scratch_path(spark, "ck-backlog"), file_bytes=bound, files=4).awaitTermination()
    sizes = []
    for name in glob.glob(f"{out}/**/*.gz", recursive=True):
        with gzip.open(name) as f:
            sizes.append(len(f.read()))
    assert spark.read.text(out).count() == total
    assert max(sizes) <= 1.3 * bound and sum(sizes) > 10 * bound
    day = _dt.datetime.now(_dt.timezone.utc).strftime("year=%Y/month=%m/day=%d")
    assert os.path.isdir(os.path.join(out, day))
