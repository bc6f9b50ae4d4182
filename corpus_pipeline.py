"""The corpus pipeline: documents to token ids in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's documents. All but the
last return the columns of ``documents``; other columns of the table pass, whatever
their names. An empty table gives an empty table of the same columns. Rows of one
doc_id are rows of their own unless a stage says otherwise. A very long text is one
row of a task in every stage, at up to some fifty times its bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from clickweave.llm import bpe_chunks, chaining, jaccard_tiles, mixing, toxicity
from clickweave.llm.common import documents, stored
from clickweave.llm.registry import quality_weights, tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents scored as toxic (0.3 and more) go. Null and empty
    texts have the score of an empty window; equal texts share their fate; without
    labels of both classes nothing goes."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of documents linked by Jaccard similarity of
    0.75 and more, the one with the smallest doc_id stays (of several texts of that
    id one). Other texts of an id that are in no group stay; of equal rows one
    stays. Null, empty and blank texts and rows without doc_id stay."""
    return jaccard_tiles.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: passages of 50 and more words that an earlier document
    holds are cut out; a document left without words by that goes. Null and empty
    texts and rows without doc_id stay as they are; of several texts of one doc_id
    one is searched and cut, the others stay."""
    return chaining.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents as often as the mix of sources takes them. Null and
    empty texts have no words and are taken as often as their source's whole
    epochs; a null source is a source; ties in the draw go by doc_id."""
    return mixing.repeated(docs, quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: token ids of every document of the mix, one row a document
    and copy; null and empty texts have no ids."""
    return bpe_chunks.encode(docs, tokenizer("byte_bpe_50k.json"), ["doc_id", "source"],
                             lambda ids, text: (len(ids) // 4, np.frombuffer(ids, "<u4").astype(np.int32)),
                             "n_tokens long, ids array<int>")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

#: No SQL expresses the trained classifier or the tokenizer: tests hold every
#: stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
