"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / quality`` (u from a hash of
its id), so that ordering a source by key draws without replacement with
probability in proportion to quality. A source with target T and size S takes
``floor(T / S)`` complete epochs; the rest of the target is filled by the
documents of smallest key, whole, up to the point where the prefix sum of sizes
comes nearest the rest.

No source is ever sorted as a whole. The prefix sum is taken over three levels
of ever finer key ranges: sums per logarithmic key range, sums per linear slice
of the one range that holds the cut, and only the documents of the one slice
that holds the cut are sorted. A source with a third of all rows therefore
sends partial sums, not rows, and the result equals the full sort.

DataFrame functions only. Texts are read once: size, source and key go to a
stored thin table.

Edge cases: a null text has size 0; null source is a source of its own, last;
sources of size 0 have target 0; a null doc_id draws by its text; repeated rows
share one key, count one by one and are taken together; null or non-positive quality counts as 1;
an empty table gives an empty mix. Input columns named like internal ones are
safe: internal names start with ``_m_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import maybe_broadcast, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Logarithmic ranges per factor of two of the key; linear slices per range.
PER_DOUBLING = 16
SLICES = 4096


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def es_key(doc_id: Column, text: Column) -> Column:
    """-ln(u); u is a 48-bit number from the md5 of the id."""
    seed = F.coalesce(doc_id.cast("string"), F.md5(F.encode(text, "utf-8")), F.lit(""))
    u = (F.conv(F.substring(F.md5(seed.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return -F.log(u)


def targets(sizes: DataFrame, weights: list[int], cap: float) -> DataFrame:
    """Adds ``target`` to rows (source, source_size).

    Sources in code-point order (null last) weigh ``weights``, repeating. Water
    filling in closed form: ordered by cap/weight, sources are capped as long as
    the level that the others would get exceeds their cap. One row per source.
    """
    by_name = W.orderBy(F.col("_m_source").isNull(), F.col("_m_source"))
    order = W.orderBy("_m_ratio", F.col("_m_source").isNull(), "_m_source")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    weighed = (sizes.withColumn("_m_n", F.row_number().over(by_name) - 1)
               .withColumn("_m_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_m_n") % len(weights) + 1).cast("int")).cast("double"))
               .withColumn("_m_cap", cap * F.col("source_size"))
               .withColumn("_m_ratio", F.col("_m_cap") / F.col("_m_weight")))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_m_cap").over(before), F.lit(0.0))
    return (weighed.withColumn("_m_level", left / F.sum("_m_weight").over(onward))
            .withColumn("_m_first", F.min(F.when(F.col("_m_level") <= F.col("_m_ratio"),
                                                 F.struct("_m_ratio", "_m_n", "_m_level"))).over(whole))
            .withColumn("target", F.least(F.col("_m_cap"), F.coalesce("_m_first._m_level", F.lit(0.0)) * F.col("_m_weight")))
            .select("_m_source", "source_size", "target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: list[int] | None = None,
        cap: float = 3.0, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``keep`` columns, ``size``, ``source_size``,
    ``target`` and ``copies`` (how often the mix takes it; taken words are
    ``copies * size``).

    ``quality`` has rows (doc_id, quality); documents without one count as 1.
    ``keep`` defaults to doc_id only; naming wide columns carries them along.
    """
    weights = weights or [5, 2, 1]
    keep = keep or ["doc_id"]
    base = docs.select(*[F.col(c).alias(f"_m_keep_{i}") for i, c in enumerate(keep)],
                       F.col("doc_id").alias("_m_id"), F.col("source").alias("_m_source"),
                       n_words(F.col("text")).alias("size"), F.col("text").alias("_m_text"))
    base = base.withColumn("_m_key", es_key(F.col("_m_id"), F.col("_m_text"))).drop("_m_text")
    if quality is not None:
        side = (quality.select(F.col("doc_id").alias("_m_qid"), F.col("quality").cast("double").alias("_m_q"))
                .where("_m_q > 0").groupBy("_m_qid").agg(F.max("_m_q").alias("_m_q")))
        side = maybe_broadcast(stored(side, "mix-quality"), 24)
        base = base.join(side, base["_m_id"] == side["_m_qid"], "left").withColumn(
            "_m_key", F.col("_m_key") / F.coalesce("_m_q", F.lit(1.0))).drop("_m_qid", "_m_q")
    base = stored(base.withColumn(
        "_m_range", F.floor(F.log2(F.col("_m_key")) * PER_DOUBLING).cast("int")), "mix-keys")

    plan = stored(targets(base.groupBy("_m_source").agg(F.sum("size").alias("source_size")), weights, cap)
                  .withColumn("_m_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
                  .withColumn("_m_rest", F.col("target") - F.col("_m_epochs") * F.col("source_size")), "mix-targets")
    plan = maybe_broadcast(plan, F.coalesce(F.octet_length("_m_source"), F.lit(0)) + 64)

    def cut(sums: DataFrame, slot: str) -> DataFrame:
        """The first slot of each source whose prefix sum reaches the rest,
        with what is left to fill in it."""
        prefix = W.partitionBy("_m_source").orderBy(slot).rowsBetween(W.unboundedPreceding, W.currentRow)
        return (sums.withColumn("_m_to", F.sum("_m_sum").over(prefix)).where("_m_to >= _m_rest AND _m_rest > 0")
                .groupBy("_m_source").agg(F.min(F.struct(F.col(slot), (F.col("_m_rest") - F.col("_m_to") + F.col("_m_sum")).alias("left"))).alias("_m_at"))
                .select(F.col("_m_source").alias("_m_of"), F.col(f"_m_at.{slot}").alias(f"{slot}_cut"), F.col("_m_at.left").alias(f"{slot}_left")))

    same = F.col("_m_source").eqNullSafe(F.col("_m_of"))
    low = F.pow(F.lit(2.0), F.col("_m_range") / PER_DOUBLING)
    slice_ = F.floor((F.col("_m_key") / low - 1) / (math.pow(2, 1 / PER_DOUBLING) - 1) * SLICES).cast("int")
    sums = base.groupBy("_m_source", "_m_range").agg(F.sum("size").alias("_m_sum"))
    sums = sums.join(plan.select(F.col("_m_source").alias("_m_of"), "_m_rest"), same).drop("_m_of")
    ranges = stored(cut(sums, "_m_range"), "mix-ranges")
    small = maybe_broadcast(ranges, F.coalesce(F.octet_length("_m_of"), F.lit(0)) + 64)

    inside = base.join(small, same & (F.col("_m_range") == F.col("_m_range_cut"))).withColumn("_m_slice", slice_)
    sums = (inside.groupBy("_m_source", "_m_slice").agg(F.sum("size").alias("_m_sum"), F.first("_m_range_left").alias("_m_rest")))
    slices = stored(cut(sums, "_m_slice").join(ranges.withColumnRenamed("_m_of", "_m_o"), F.col("_m_o").eqNullSafe(F.col("_m_of"))).drop("_m_o"), "mix-slices")
    small = maybe_broadcast(slices, F.coalesce(F.octet_length("_m_of"), F.lit(0)) + 64)

    # the documents of the one slice with the cut, sorted: an exact boundary (key, id)
    last = (base.join(small, same & (F.col("_m_range") == F.col("_m_range_cut"))).withColumn("_m_slice", slice_)
            .where("_m_slice = _m_slice_cut"))
    order = [F.col("_m_key"), F.col("_m_id"), F.col("size")]
    run = F.sum("size").over(W.partitionBy("_m_source").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    last = last.withColumn("_m_run", run).where(F.col("_m_run") - F.col("size") / 2 <= F.col("_m_slice_left"))
    edge = last.groupBy("_m_source").agg(F.max(F.struct(*order)).alias("_m_edge"))
    bounds = (slices.join(edge.withColumnRenamed("_m_source", "_m_e"), F.col("_m_e").eqNullSafe(F.col("_m_of")), "left").drop("_m_e"))
    plan = (plan.join(bounds, F.col("_m_of").eqNullSafe(F.col("_m_source")), "left").drop("_m_of"))
    plan = stored(plan, "mix-plan")
    plan = maybe_broadcast(plan.withColumnRenamed("_m_source", "_m_of"), F.coalesce(F.octet_length("_m_of"), F.lit(0)) + 160)
    joined = base.join(plan, same, "left")
    here = F.struct(F.col("_m_key").alias("_m_key"), F.col("_m_id").alias("_m_id"), F.col("size").alias("size"))
    where = F.when(F.col("_m_range_cut").isNull(), False)  # nothing left to fill
    where = where.when(F.col("_m_range") != F.col("_m_range_cut"), F.col("_m_range") < F.col("_m_range_cut"))
    where = where.when(slice_ != F.col("_m_slice_cut"), slice_ < F.col("_m_slice_cut"))
    where = where.when(F.col("_m_edge").isNull(), False).otherwise(here <= F.col("_m_edge"))
    joined = joined.withColumn("copies", F.col("_m_epochs") + where.cast("long"))
    return joined.select(*[F.col(f"_m_keep_{i}").alias(c) for i, c in enumerate(keep)],
                         F.col("size").alias("size"), "source_size", "target", "copies")


def repeated(docs: DataFrame, quality: DataFrame | None = None, weights: list[int] | None = None,
             cap: float = 3.0) -> DataFrame:
    """The mix as documents: every document as often as it is taken, with the
    columns of ``docs``. Copies are made on thin rows; a document's text is
    carried in the stored table, not through the searches for the cut."""
    names = docs.columns
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
                        *[F.col(c).alias(f"_in_{c}") for c in ("doc_id", "source", "text")])
    mixed = mix(plain.withColumnsRenamed({f"_in_{c}": c for c in ("doc_id", "source", "text")}), quality, weights, cap,
                keep=[f"c{i}" for i in range(len(names))])
    mixed = mixed.where("copies > 0").withColumn("_m_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return mixed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
