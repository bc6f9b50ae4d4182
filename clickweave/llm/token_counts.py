"""Token counts of whole texts without materialising ids.

Pieces are counted once per distinct pre-token of the corpus; a document's
count is the sum over its pre-token frequencies.

Plan: (1) each task counts its distinct pre-tokens, one shuffle merges them
into the vocabulary table; (2) the library's model splits every distinct
pre-token once, the table is stored; (3) a second pass builds per-document
frequencies. The most frequent pre-tokens (at most ``FREQUENT``, which bounds
the broadcast) are joined on the map side; only the frequencies of all other
pre-tokens, a few per cent by Zipf's law, are shuffled to the table and summed
back per document. Common words never meet in one task.

The result is the library's: special strings found in raw text count one token
each and split the text, texts outside the plain alphabet go through the
library's own normalizer and pre-tokenizer.

Edge cases: null and empty texts have 0 tokens; every input row gives one row,
repeated or not; null doc_id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, stored
from .tokens import BYTE_PATTERN, PLAIN, WORD_PATTERN, codec, mapped

#: Entries of the broadcast dictionary (about 60 bytes each in a task).
FREQUENT = 150_000
#: Distinct pre-tokens held by a task before it hands its counts on.
HELD = 300_000


def pretokens(path: str, text: str) -> tuple[list[str], int]:
    """Pre-tokens of a text (byte-level form where not plain ASCII) and the
    number of special strings in it."""
    c = codec(path)
    if "<|" not in text and PLAIN.fullmatch(text):
        if c.kind == "word":
            return WORD_PATTERN.findall(text.lower()), 0
        return BYTE_PATTERN.findall(text), 0
    special = [t.content for t in c.tok.get_added_tokens_decoder().values()]
    parts = re.split("|".join(map(re.escape, special)), text) if special else [text]
    out: list[str] = []
    for part in parts:
        if c.tok.normalizer is not None:
            part = c.tok.normalizer.normalize_str(part)
        out += ["\0" + piece for piece, _ in c.tok.pre_tokenizer.pre_tokenize_str(part)]
    return out, len(parts) - 1


def canonical(path: str, found: Counter) -> dict[str, int]:
    """Counts by byte-level form. Forms from the library start with NUL until
    here; plain ones are mapped, unless ASCII without space (equal to its form)."""
    out: dict[str, int] = {}
    for piece, n in found.items():
        if piece[0] == "\0":
            piece = piece[1:]
        elif not (piece.isascii() and piece.isprintable() and " " not in piece):
            piece = mapped(piece)
        out[piece] = out.get(piece, 0) + n
    return out


def count(docs: DataFrame, path: str, limit: int = 2048, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; one row per input row."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))

    def local(parts):
        held: Counter = Counter()

        def flush():
            table = canonical(path, held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], names=["piece", "n"])

        for part in parts:
            for text in part.column("text").to_pylist():
                if text:
                    held.update(pretokens(path, text)[0])
                    if len(held) >= HELD:
                        yield flush()
        yield flush()

    def pieces(part: pa.RecordBatch):
        model = codec(path).model
        n = [len(model.tokenize(p)) for p in part.column("piece").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("piece"), part.column("n"), pa.array(n, pa.int32())], names=["piece", "n", "pieces"])

    from .common import ship
    ship(spark)
    vocabulary = texts.select("text").mapInArrow(local, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    vocabulary = stored(batches(vocabulary, pieces, "piece string, n long, pieces int"), "pretokens")
    top = (vocabulary.where((F.col("n") > 1) & (F.length("piece") <= 64))
           .orderBy(F.col("n").desc(), "piece").limit(frequent).select("piece", "pieces").toArrow())
    known = spark.sparkContext.broadcast(dict(zip(top["piece"].to_pylist(), top["pieces"].to_pylist())))

    def per_document(part: pa.RecordBatch):
        sizes, sums, rare, times = [], [], [], []
        have = known.value
        for text in part.column("text").to_pylist():
            text = text or ""
            found, special = pretokens(path, text) if text else ([], 0)
            total, others, freq = special, [], []
            for piece, n in canonical(path, Counter(found)).items():
                p = have.get(piece)
                if p is None:
                    others.append(piece)
                    freq.append(n)
                else:
                    total += p * n
            sizes.append(len(text.encode()))
            sums.append(total)
            rare.append(others)
            times.append(freq)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
             pa.array(rare, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))],
            names=["doc_id", "n_bytes", "known", "rare", "times"])

    rows = batches(texts, per_document, "doc_id long, n_bytes long, known long, rare array<string>, times array<int>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "pretoken-frequencies")
    loose = (rows.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
             .select("row", F.col("x.rare").alias("piece"), F.col("x.times").alias("times")))
    sums = (loose.join(vocabulary.select("piece", "pieces"), "piece")
            .groupBy("row").agg(F.sum(F.col("pieces") * F.col("times").cast("long")).alias("loose")))
    tokens = F.col("known") + F.coalesce("loose", F.lit(0))
    return (rows.select("row", "doc_id", "n_bytes", "known").join(sums, "row", "left")
            .select("doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit")))
