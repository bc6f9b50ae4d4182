"""Raw JSON events in, malformed records set aside.

Two layouts:

* ``lines`` (default, what streaming producers write): one JSON object per
  line, any number of lines per file, gzip or plain. Files are split by Spark
  when not compressed; each line is parsed on its own, so a broken line costs
  exactly one record.
* ``array``: each file is one JSON array of objects. Files are cut into elements
  by many tasks (``sources.json_arrays``), which are then parsed exactly like lines.

Parsing is ``from_json`` of the line as the only element of an array of
text maps. A line that is not exactly one JSON object - broken, or with
anything after the object - becomes NULL or another length, keeps its text in
``_corrupt_record`` and is counted, independent of which columns a later step
reads. Fields outside the known ones are kept as text in the map ``_extra``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.sources.json_arrays import array_elements
from clickweave.sources.schema import CORRUPT_COLUMN, EXTRA_COLUMN, RAW_FIELDS

PARSE_OPTIONS = {"mode": "PERMISSIVE"}
LINE_COLUMN = "value"
#: New fields that one run may add as columns; the others share a map column.
MAX_NEW_FIELDS = 1000


def parse_json_lines(lines: DataFrame, text_col: str = LINE_COLUMN,
                     keep_line: bool = False) -> DataFrame:
    """One landing row per non-blank line: the 16 fields as text,
    ``_corrupt_record`` (the line itself when it is not exactly one JSON object)
    and ``_extra`` (other fields, NULL when there are none); with ``keep_line``
    also the original text as ``_line``."""
    # The parse sits inside a generator (``inline`` of a one-element array):
    # later filters on parsed fields (corrupt, required) cannot be pushed
    # below a generator, so each line is parsed exactly once. Under a plain
    # projection the optimizer would copy the parse into every pushed filter.
    as_array = F.concat(F.lit("["), F.col(text_col), F.lit("]"))
    items = F.from_json(as_array, T.ArrayType(T.MapType(T.StringType(), T.StringType())), PARSE_OPTIONS)
    parsed = (lines.where(F.trim(F.col(text_col)) != F.lit(""))
                   .select(F.inline(F.array(F.struct(items.alias("_items"), F.col(text_col).alias("_line")))))
                   .select("_line", F.when(F.size("_items") == 1, F.get("_items", F.lit(0))).alias("_j")))
    known = [name for name, _ in RAW_FIELDS]
    fields = [F.col("_j")[name].alias(name) for name in known]
    other = F.map_filter("_j", lambda k, v: ~k.isin(known))
    extra = [F.col("_line")] if keep_line else []
    return parsed.select(*fields, F.when(F.col("_j").isNull(), F.col("_line")).alias(CORRUPT_COLUMN),
                         F.when(F.size(other) > 0, other).alias(EXTRA_COLUMN), *extra)


def read_json_lines_text(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of every file under ``path`` (sub-folders included; ``.gz``
    decoded by extension). Folder names such as ``year=…`` are not turned into
    columns: the event's own time decides its partition later."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def read_raw_events(spark: SparkSession, path: str, layout: str = "lines",
                    spread_lines: bool = False) -> DataFrame:
    """S1 + S3. Landing rows (text fields + ``_corrupt_record``).

    Plain text files are split by Spark; a gzip file is not, so one huge gzip
    file is decompressed by one task. ``spread_lines`` then rebalances the
    decompressed lines (AQE sizes the partitions) before parsing, so parsing
    and everything after it runs wide. It costs a shuffle of the raw text, so
    it is off by default: delivered files are small (buffered delivery)."""
    if layout == "lines":
        lines = read_json_lines_text(spark, path)
        if spread_lines:
            lines = lines.hint("rebalance")
        return parse_json_lines(lines)
    if layout == "array":
        return parse_json_lines(array_elements(spark, path))
    raise ValueError(f"unknown layout {layout!r}; use 'lines' or 'array'")


def corrupt_lines(landing: DataFrame) -> DataFrame:
    """K2 input: the text of each malformed record, as column ``value``."""
    return (landing.where(F.col(CORRUPT_COLUMN).isNotNull())
                   .select(F.col(CORRUPT_COLUMN).alias("value")))


def write_corrupt(landing: DataFrame, path: str) -> None:
    """K2. Append malformed records as text lines for later analysis."""
    corrupt_lines(landing).write.mode("append").text(path)


def to_json_lines(raw: DataFrame) -> DataFrame:
    """Raw event rows → one JSON object text per row (NULL fields omitted,
    as producers leave out absent keys)."""
    return raw.select(F.to_json(F.struct(*raw.columns)).alias(LINE_COLUMN))
