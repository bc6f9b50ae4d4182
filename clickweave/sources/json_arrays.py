"""S1, array layout: files that are one JSON array each, read as a stream of
elements by many tasks.

The text source cuts files at every "}" instead of at line ends, so a large file
is split like any text file and a row is a small piece. Where an element ends
follows from two running states, both prefix sums over the pieces in file order:

* quotes before a piece (escaped ones aside): odd means that it begins inside a
  string;
* brackets and braces outside strings: an element ends at a "}" that brings the
  depth back to 1.

Prefix sums run inside a block of a file (the part one task reads) and over the
few blocks of a file. The pieces of an element are joined and parsed by
themselves, so a broken element costs itself and not its file. Memory is that of an element;
what belongs to no element of sensible size (after a quote that is missing, say)
comes out piece by piece, each a corrupt record. A file whose text is not an
array is one corrupt record; there, too, one beyond ``ELEMENT_BYTES`` comes in pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.session import stored

#: Elements (and files that are no array) up to this size are joined.
ELEMENT_BYTES = 64 << 20
_BLOCK = ["file", "block"]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value, first, last): pieces in file order by (block, at)."""
    read = spark.read.option("recursiveFileLookup", "true").option("lineSep", "}").text(path)
    rows = stored(read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                              F.monotonically_increasing_id().alias("at"), "value"), "array-pieces")
    place = F.struct("block", "at")
    ends = rows.groupBy("file").agg(F.min(F.struct(place.alias("p"), F.substring(F.ltrim("value"), 1, 1).alias("c"))).alias("head"),
                                    F.max(place).alias("tail"))
    # a file without "{" before its first bracket may begin with blank pieces only if it is no array
    ends = ends.select(F.col("file").alias("_f"), (F.col("head.c") == "[").alias("is_array"), F.col("tail"))
    return rows.join(_few(ends), F.col("file") == F.col("_f")).select(*rows.columns, "is_array", (place == F.col("tail")).alias("is_last"))


def _few(side: DataFrame) -> DataFrame:
    """A stored side of a row a file or block; broadcast when it is small."""
    from clickweave.operators.joins import MAX_BROADCAST_BYTES
    side = stored(side, "array-side")
    return F.broadcast(side) if side.count() * 512 <= MAX_BROADCAST_BYTES else side


def _before(rows: DataFrame, amount: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: sum of ``amount`` over the file's earlier pieces."""
    rows = rows.withColumn("_amount", amount)
    blocks = rows.groupBy(*_BLOCK).agg(F.sum("_amount").alias("_sum"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("file").alias("_f"), F.col("block").alias("_b"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*_BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_own", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
            .join(_few(blocks), (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
            .withColumn(name, F.col("_base") + F.col("_own")).drop("_f", "_b", "_base", "_own", "_amount"))


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """One JSON text (``value``) per array element of every file under ``path``."""
    pieces = _pieces(spark, path)
    # the last piece has no "}" after it, unless the array was never closed
    pieces = pieces.withColumn("closed", ~F.col("is_last") | ~F.rtrim("value").endswith("]"))
    rows = pieces.where("is_array").withColumn("plain", F.regexp_replace("value", r"(?s)\\.", ""))
    rows = _before(rows.withColumn("quotes", _count(F.col("plain"), '"')), F.col("quotes"), "quotes_before")
    inside = F.col("quotes_before") % 2 == 1
    bare = F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), F.col("plain")), r'"[^"]*("|$)', "")
    rows = rows.withColumn("bare", bare).withColumn("ends_bare", F.col("closed") & ((F.col("quotes_before") + F.col("quotes")) % 2 == 0))
    change = _count(F.col("bare"), "{[") - _count(F.col("bare"), "}]") - F.col("ends_bare").cast("int")
    rows = rows.withColumn("change", change)
    rows = _before(rows, F.col("change"), "depth")
    ends = F.col("ends_bare") & (F.col("depth") + F.col("change") == 1)
    rows = _before(rows.select(*_BLOCK, "at", "value", "closed", "is_last", ends.cast("int").alias("ends")), F.col("ends"), "element")
    text = F.concat(F.col("value"), F.when(F.col("closed"), "}").otherwise(""))
    rows = stored(rows.select("file", "element", F.struct("block", "at", text.alias("text")).alias("piece"), F.col("is_last")), "array-elements")
    other = (pieces.where("NOT is_array").select("file", F.lit(-1).cast("long").alias("element"),
                                               F.struct("block", "at", text.alias("text")).alias("piece"), "is_last"))
    rows = rows.unionByName(other)
    sizes = rows.groupBy("file", "element").agg(F.sum(F.octet_length("piece.text")).alias("bytes")).where(F.col("bytes") > ELEMENT_BYTES)
    huge = _few(sizes.select("file", "element"))
    whole = rows.join(huge, ["file", "element"], "left_anti").groupBy("file", "element").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["text"]), "").alias("text"), F.max("is_last").alias("is_last"))
    # between two ends lie a comma (the "[" at first, the "]" at last), perhaps elements that are no objects, and the object
    core = F.regexp_replace("text", r"^\s*[\[,]", "")
    core = F.when(F.col("is_last"), F.regexp_replace(core, r"\]\s*$", "")).otherwise(core)
    items = F.from_json(F.concat(F.lit("["), core, F.lit("]")), "array<string>")
    lines = F.when(F.col("element") < 0, F.array("text")).when(F.trim(core) == "", F.array().cast("array<string>")).when(
        items.isNull(), F.array(core)).otherwise(items)
    loose = rows.join(huge, ["file", "element"], "left_semi").select(F.col("piece.text").alias("value"))
    return whole.select(F.explode(lines).alias("value")).unionByName(loose)
