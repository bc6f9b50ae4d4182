"""The dimension lookup gives the same rows whether it broadcasts or not."""

from pyspark.sql import functions as F

from clickweave.operators.joins import lookup_join


def test_lookup_join_paths_agree(spark):
    fact = spark.range(5000).select(F.col("id").alias("f"), (F.col("id") % 50).alias("k"))
    dim = spark.range(40).select(F.col("id").alias("dk"), (F.col("id") * 10).alias("v"))
    cond = F.col("k") == F.col("dk")
    small = lookup_join(fact, dim, cond, "left")
    big = lookup_join(fact, dim, cond, "left", max_broadcast_bytes=0)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    hinted = small._jdf.queryExecution().optimizedPlan().toString()
    unhinted = big._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in unhinted.lower()
