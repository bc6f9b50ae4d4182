"""Connected components of a link table by label propagation on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every node of the edges (a, b): label is the smallest
    node of its component.

    Each round takes the smallest label among a node's neighbours and then that
    label's own label, so the distance covered doubles; labels are written to
    the shared folder every round. Nothing is collected but a count.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    now = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    while True:
        near = (both.join(now.select(F.col("v").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near")))
        step = now.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = stored(step, "cc-step")
        jump = step.select(F.col("v").alias("w"), F.col("label").alias("far"))
        new = stored(step.join(jump, step["label"] == jump["w"]).select("v", "old", F.least("label", "far").alias("label")), "cc-labels")
        if new.where("label <> old").isEmpty():
            return new.select("v", "label")
        now = new.select("v", "label")
