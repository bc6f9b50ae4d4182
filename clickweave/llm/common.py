"""Helpers shared by the corpus operators: stored intermediates, checked
broadcasts and vectorised word hashing over Arrow string batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.session import scratch_path

#: Characters that separate words: space, tab, LF, VT, FF, CR (ASCII only).
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Byte map that lower-cases A-Z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Side tables up to this many bytes may be broadcast.
BROADCAST_BYTES = 16 << 20


#: Most rows of a record batch that goes to Python.
BATCH_ROWS = 1000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, so that Python
    functions run wherever the package is not installed, and bound the rows of a
    record batch: texts are long, and a batch stands in the JVM and in Python at
    once. Once a context."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.isModifiable(rows) and not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(top):  # already inside an archive
        return
    path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(top)}_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back: the lineage
    ends there, and a lost executor costs only its own running tasks."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_stored_at"] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Empty the folders of *stored* frames that nothing reads any more: neither
    a frame made from them that is still to be computed, nor a result."""
    for frame in frames:
        path = frame.__dict__.get("_stored_at")
        if path:
            frame.sparkSession.createDataFrame([], "gone int").coalesce(1).write.mode("overwrite").parquet(path)


def maybe_broadcast(side: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a *stored* side for broadcast when its measured size is within
    ``limit``; otherwise leave the join to shuffle (AQE splits skew)."""
    size = side.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0] or 0
    return F.broadcast(side) if size <= limit else side


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that each input bit moves every output bit
    (two rounds of xor-shift and odd multiplication)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(32))


def _table(width: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 256 * width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_WIDTH = 32
_RANDOM = _table(_WIDTH)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte values and row offsets of a string array; null counts as empty."""
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    off = np.frombuffer(array.buffers()[1], np.int64)[array.offset: array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def words(raw: np.ndarray, off: np.ndarray, lower: bool = True):
    """64-bit hashes of all words of a batch.

    Returns ``(hash, first, start, end)``: words of row r are
    ``first[r]:first[r+1]``; start/end are byte positions in ``raw``. A word
    hash is the sum of a random value per (byte, place in the word), so the
    whole batch is hashed with a handful of array operations.
    """
    if not len(raw):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), none, none
    inside = ~SPACE[raw]
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(raw)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = off[1:][off[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, off)
    if not len(start):
        return np.zeros(0, np.uint64), first, start, end
    letters = raw[inside]
    if lower:
        letters = LOWER[letters]
    size = end - start
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(letters)) - np.repeat(at, size)
    with np.errstate(over="ignore"):
        value = _RANDOM[(place % _WIDTH) * 256 + letters]
        if len(size) and size.max() > _WIDTH:
            value = value * (2 * (place // _WIDTH) + 1).astype(np.uint64)
        return mix(np.add.reduceat(value, at) + size.astype(np.uint64)), first, start, end


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words starting at each word, and whether all k lie in
    the word's own row."""
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(min(k, n)):
            total[: n - j] += hashes[j:] * np.uint64(2 * (j * 0x632BE5AB + 0x5851F42D) + 1)
        last = np.repeat(first[1:], np.diff(first))
        return mix(total), np.arange(n) + k <= last


#: Bytes of a record batch that a function sees at once; array work takes some
#: fifty times that in a task.
PIECE_BYTES = 2 << 20


def batches(df: DataFrame, fn, schema: str, piece: int = PIECE_BYTES) -> DataFrame:
    """``mapInArrow`` with one function call per piece of a record batch, so
    memory follows ``piece`` bytes (or the longest row), not the batch."""
    ship(df.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, piece):
            yield from fn(part)
        pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def slices(parts: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut into pieces of some ``piece`` bytes, a row at least."""
    for part in parts:
        rows = max(1, int(part.num_rows * piece / max(1, part.nbytes)))
        for at in range(0, part.num_rows, rows):
            yield part.slice(at, rows)


def bit_map(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap (words of 64 bits) of the column ``bit``, values under
    ``1 << bits``. Bits are merged into words on the executors; the driver gets
    a map of fixed size, whatever the input."""
    rows = (keys.select(F.shiftright("bit", 6).alias("w"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    if rows.num_rows:
        out[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return out


def marked(words_: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Which bits of a bitmap are set."""
    return ((words_[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)


def repeated_keys(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the top ``bits`` bits of the 32-bit ``key`` values that occur
    more than once: one thin shuffle of counts."""
    again = keys.groupBy("key").count().where("count > 1")
    return bit_map(again.select(F.shiftrightunsigned(F.col("key"), 32 - bits).cast("long").alias("bit")), bits)


#: Ranges that 32-bit keys are dealt over (a power of two), and keys that a task
#: gathers before it sends them off.
RANGES, GATHERED = 1024, 1 << 20


def repeated_in(df: DataFrame, fn, bits: int, piece: int = PIECE_BYTES) -> np.ndarray:
    """``repeated_keys`` of the uint32 arrays that ``fn`` gives for the pieces of
    record batches. Keys travel as sorted blocks by range; a task marks the keys of
    one range in maps of fixed size, whatever their number, and the driver gets
    the bitmap alone."""
    ship(df.sparkSession)
    span = 2**32 // RANGES

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def block():
            keys = np.sort(np.concatenate(held))
            # a key is sent twice at most
            keep = np.ones(len(keys), bool)
            keep[2:] = keys[2:] != keys[:-2]
            keys = keys[keep]
            cut = np.searchsorted(keys, np.arange(RANGES + 1, dtype=np.uint64) * span)
            some = np.flatnonzero(np.diff(cut))
            off = np.append(cut[some], len(keys)).astype(np.int32) * 4
            blocks = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(off), pa.py_buffer(keys)])
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), blocks], names=["range", "keys"])

        for part in slices(parts, piece):
            held.append(fn(part))
            count += len(held[-1])
            if count >= GATHERED:
                yield block()
                held, count = [], 0
        if count:
            yield block()
        pa.default_memory_pool().release_unused()

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint32(32 - bits)
        at, seen, again = None, np.zeros(span, bool), np.zeros(span >> int(low), bool)

        def bitmap():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(again, bitorder="little").tobytes()], pa.binary())],
                                              names=["range", "bits"])

        for part in parts:
            for k, keys in zip(part.column("range").to_pylist(), part.column("keys")):
                if k != at:
                    if again.any():
                        yield bitmap()
                    at = k
                    seen[:] = again[:] = False
                keys = np.frombuffer(keys.as_buffer(), np.uint32) % np.uint32(span)
                again[keys[seen[keys]] >> low] = True
                again[keys[1:][keys[1:] == keys[:-1]] >> low] = True
                seen[keys] = True
        if again.any():
            yield bitmap()
    maps = (df.mapInArrow(deal, "range int, keys binary").repartition("range").sortWithinPartitions("range")
            .mapInArrow(mark, "range int, bits binary").toArrow())
    out = np.zeros((RANGES, (1 << bits) // RANGES // 64), np.uint64)
    for k, found in zip(maps["range"].to_pylist(), maps["bits"]):
        out[k] = np.frombuffer(found.as_buffer(), np.uint64)
    return out.reshape(-1)
