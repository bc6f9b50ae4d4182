"""Registered queries of the corpus operators, and their DuckDB SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_chunks, chaining, jaccard_tiles, maglev, manifest, mixing, nndescent, oracle, periodic, rans, simhash, token_counts, topk,
               toxicity)
from .common import documents


def quality_weights(labels: DataFrame) -> DataFrame:
    """Sampling weights of documents: 2 where labelled good, 0.5 where poor."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("quality"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), score_col="score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file (never copied into the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), limit=2048)


def op3_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = rans.round_trip(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), end_id=1)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


#: Shards of the sharding query.
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op6_maglev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maglev.place(documents(spark, sf_dir).select("doc_id", "text"), SHARDS).select("doc_id", "slot", "shard")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_likeness(documents(spark, sf_dir))


def op5_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(documents(spark, sf_dir)).drop("text_hash")


def op9_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tiles.join(documents(spark, sf_dir))


def op10_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    return bpe_chunks.encode(documents(spark, sf_dir), path, ["doc_id"],
                             lambda ids, text: bpe_chunks.digests(ids, path),
                             "n_tokens long, ids_sha256 string, decoded_sha256 string")


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the run query looks at: in one document of ten, all words
    from a place on repeat with a period (place and period by its id)."""
    h = 1 if doc_id is None else zlib.crc32(b"%d" % doc_id)
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(documents(spark, sf_dir), rewrite=planted_period)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda top, r: F.when(
        top.isNull() | (r.length * top.period > top.length * r.period), r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("top"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_nndescent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_token_counts": op2_token_counts,
    "op3_rans": op3_rans,
    "op4_topk": op4_topk,
    "op6_maglev": op6_maglev,
    "op8_simhash": op8_simhash,
    "op5_chaining": op5_chaining,
    "op7_toxicity": op7_toxicity,
    "op9_jaccard_tiles": op9_jaccard_tiles,
    "op10_bpe_chunks": op10_bpe_chunks,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_nndescent": op12_nndescent,
    "op13_manifest": op13_manifest,
}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
