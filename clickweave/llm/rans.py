"""Token ids in a static range asymmetric numeral system (rANS) file format.

All blocks share one frequency table, counted over the whole corpus and scaled
to ``1 << SCALE`` with at least 1 for each id that occurs. A block holds whole
documents, about ``BLOCK`` ids, in ascending doc_id order. Its ids are dealt to
interleaved lanes (id k goes to lane k modulo lanes), each lane with its own
64-bit state, so a step encodes or decodes one id of every lane at once. Every
``CHECKPOINT`` steps a checkpoint notes all lane states and the place in the
word stream; decoding can start at any of them, so a block's parts can be
decoded in parallel. A block carries the crc32 of its ids and of its payload.

Block layout (little-endian): magic, ids, lanes, words, checkpoints, crc32 of
ids, crc32 of payload (uint32 each); payload = checkpoint step and word place
(uint32 each) and states (uint64) per checkpoint, the first being the start of
decoding; then the words (uint32) in decoding order. The frequency table is a
file of its own (id, freq).

Files are written by Spark as Parquet with one row a block (doc_ids, lengths,
payload), so that a lost task leaves no half file. Plan: one pass encodes texts
to ids (stored, 16 bits an id where the vocabulary allows); ids are counted per
task; a range shuffle by doc_id puts documents in order; blocks are coded where
they lie. Starts are prefix sums over one row a partition.

Edge cases: null and empty texts hold only the end id; null doc_id comes first;
equal doc_ids keep a fixed order (by a hash of their ids); a document longer than
a block makes a block of its own size, which is decoded by its checkpoints in
several tasks (its parts have the payload's checksum, not that of the ids); an empty table writes no blocks.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickweave.session import scratch_path

from .common import batches, maybe_broadcast, stored
from .tokens import codec

MAGIC = 0x314E4152
SCALE = 20
BLOCK = 1 << 18
LANES = 1024
CHECKPOINT = 128
LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<7I")


class Table:
    """Shared frequencies: ``freq[id]`` sums to ``1 << SCALE``."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.first = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self._symbol = None

    @property
    def symbol(self) -> np.ndarray:
        """Id of each slot (for decoding)."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol


def scaled(counts: np.ndarray) -> np.ndarray:
    """Counts as frequencies that sum to ``1 << SCALE``; ids that occur get 1 or
    more. The rest is settled on the largest ones, in a fixed order."""
    whole = 1 << SCALE
    used = counts > 0
    if used.sum() > whole:
        raise ValueError("vocabulary too large for the scale")
    if not used.any():
        return np.zeros(len(counts), np.int64)
    freq = np.where(used, np.maximum(1, (counts * (whole / counts.sum())).astype(np.int64)), 0)
    order = np.argsort(-freq, kind="stable")
    extra = int(freq.sum()) - whole
    if extra < 0:
        freq[order[0]] -= extra
    while extra > 0:
        big = order[freq[order] > 1]
        take = np.minimum(freq[big] - 1, np.maximum(1, freq[big] * extra // max(1, int(freq[big].sum()))))
        over = np.cumsum(take) - extra
        take = np.where(over > 0, np.maximum(0, take - over), take)
        freq[big] -= take
        extra -= int(take.sum())
    return freq


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = int(min(LANES, max(1, n // 64)))
    steps = -(-n // lanes)
    f_all, c_all = table.freq[ids], table.first[ids]
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks = []
    bits, low32 = np.uint64(SCALE), np.uint64(0xFFFFFFFF)
    limit_bits = np.uint64(31 - SCALE + 32)
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        f, x = f_all[a:b], state[: b - a]
        big = x >= f << limit_bits
        if big.any():
            words.append((x[big] & low32).astype("<u4")[::-1])
            x[big] >>= np.uint64(32)
        q = x // f
        state[: b - a] = (q << bits) + (x - q * f) + c_all[a:b]
        if step % CHECKPOINT == 0:
            marks.append((step, sum(map(len, words)), state.copy()))
    total = sum(map(len, words))
    payload = b"".join(struct.pack("<2I", step, total - behind) + s.astype("<u8").tobytes() for step, behind, s in reversed(marks))
    if words:
        payload += np.concatenate(words)[::-1].tobytes()
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return _HEAD.pack(MAGIC, n, lanes, total, len(marks), crc, zlib.crc32(payload)) + payload


class Part(NamedTuple):
    """What decoding from one checkpoint to the next needs."""

    step: int
    last: int
    state: bytes
    words: bytes


def parts_of(block: bytes) -> tuple[int, int, int, list[Part]]:
    """(ids, lanes, crc32 of the ids, parts) of a block."""
    magic, n, lanes, total, marks, crc, payload_crc = _HEAD.unpack_from(block)
    payload = memoryview(block)[_HEAD.size:]
    if magic != MAGIC or zlib.crc32(payload) != payload_crc:
        raise ValueError("damaged block")
    mark = 8 + 8 * lanes
    at = [struct.unpack_from("<2I", payload, k * mark) for k in range(marks)]
    out = []
    for k, ((step, word), (last, end)) in enumerate(zip(at, [*at[1:], (-(-n // lanes) if n else 0, total)])):
        state = bytes(payload[k * mark + 8:(k + 1) * mark])
        out.append(Part(step, last, state, bytes(payload[marks * mark + 4 * word:marks * mark + 4 * end])))
    return n, lanes, crc, out


def decode_part(n: int, lanes: int, part: Part, table: Table) -> np.ndarray:
    """The ids from one checkpoint to the next."""
    words, at = np.frombuffer(part.words, "<u4"), 0
    state = np.frombuffer(part.state, "<u8").astype(np.uint64)
    begin = part.step * lanes
    out = np.empty(max(0, min(n, part.last * lanes) - begin), np.uint32)
    bits, mask = np.uint64(SCALE), np.uint64((1 << SCALE) - 1)
    symbol, freq, first = table.symbol, table.freq, table.first
    for k in range(part.step, part.last):
        a, b = k * lanes, min(n, (k + 1) * lanes)
        x = state[: b - a]
        slot = x & mask
        s = symbol[slot.astype(np.int64)]
        out[a - begin:b - begin] = s
        x = freq[s] * (x >> bits) + slot - first[s]
        need = np.flatnonzero(x < LOW)
        if len(need):
            x[need] = (x[need] << np.uint64(32)) | words[at:at + len(need)]
            at += len(need)
        state[: b - a] = x
    return out


def decode_block(block: bytes, table: Table, part: int | None = None) -> np.ndarray:
    """All ids of a block, or those from checkpoint ``part`` to the next."""
    n, lanes, crc, parts = parts_of(block)
    if part is not None:
        return decode_part(n, lanes, parts[part], table)
    out = np.concatenate([decode_part(n, lanes, p, table) for p in parts]) if parts else np.zeros(0, np.uint32)
    if zlib.crc32(out.astype("<u4").tobytes()) != crc:
        raise ValueError("ids do not match their checksum")
    return out


def token_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids): ids of each whole text and the end id, 16 bits each."""
    def run(part: pa.RecordBatch):
        c, end = codec(path), np.array([end_id], "<u4").tobytes()
        out = [np.frombuffer(c.encode(t) + end, "<u4").astype("<u2").tobytes() for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "ids"])
    return batches(docs.select(docs["doc_id"], docs["text"]), run, "doc_id long, ids binary")


def frequencies(ids: DataFrame, size: int) -> np.ndarray:
    """Frequency table over all ids. One row per (task, id) is shuffled; the
    driver gets one number per vocabulary entry."""
    def count(parts):
        total = np.zeros(size, np.int64)
        for part in parts:
            raw = b"".join(part.column("ids").to_pylist())
            total += np.bincount(np.frombuffer(raw, "<u2"), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])
    rows = ids.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return scaled(counts)


def write(docs: DataFrame, path: str, end_id: int, folder: str, partitions: int | None = None) -> None:
    """Encode all documents into ``folder``/blocks and ``folder``/table."""
    spark = docs.sparkSession
    from .tokens import library
    size = library(path).get_vocab_size(with_added_tokens=True)
    if size > 1 << 16:
        raise ValueError("stored ids are 16 bits wide")
    ids = stored(token_ids(docs, path, end_id), "rans-ids")
    freq = frequencies(ids, size)
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, freq long").coalesce(1).write.parquet(f"{folder}/table")
    sent = spark.sparkContext.broadcast(freq)

    def blocks(parts):
        table = Table(sent.value)
        names, lengths, held, before, number = [], [], [], 0, 0

        def flush():
            nonlocal names, lengths, held, before, number
            numbers = np.frombuffer(b"".join(held), "<u2").astype(np.uint32)
            row = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([len(numbers)], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([encode_block(numbers, table)], pa.binary())],
                names=["block", "before", "n_ids", "doc_ids", "lengths", "payload"])
            before, number = before + len(numbers), number + 1
            names, lengths, held = [], [], []
            return row

        filled = 0
        for part in parts:
            for doc, own in zip(part.column("doc_id").to_pylist(), part.column("ids").to_pylist()):
                names.append(doc)
                lengths.append(len(own) // 2)
                held.append(own)
                filled += len(own) // 2
                if filled >= BLOCK:
                    yield flush()
                    filled = 0
        if held:
            yield flush()

    order = [F.col("doc_id"), F.xxhash64("ids")]
    dealt = (ids.repartitionByRange(partitions, *order) if partitions else ids.repartitionByRange(*order))
    coded = dealt.sortWithinPartitions(*order).mapInArrow(
        blocks, "block int, before long, n_ids long, doc_ids array<long>, lengths array<int>, payload binary")
    coded.withColumn("file", F.spark_partition_id()).write.parquet(f"{folder}/blocks")


#: Ids of a block beyond which its parts are decoded in rows of their own.
WHOLE = 2 * BLOCK


def read(spark, folder: str) -> DataFrame:
    """Decode the files: one row per document with ``start``, ``n_tokens`` and
    ``ids`` (binary uint32). Blocks are decoded independently; a block of more
    than ``WHOLE`` ids (a very long document) is cut at its checkpoints, its parts go
    to tasks of their own and are joined by document."""
    table = spark.read.parquet(f"{folder}/table").toArrow()
    freq = np.zeros((table["id"].to_numpy().max() + 1) if table.num_rows else 0, np.int64)
    freq[table["id"].to_numpy()] = table["freq"].to_numpy()
    sent = spark.sparkContext.broadcast(freq)
    blocks = spark.read.parquet(f"{folder}/blocks")
    # files are in doc_id order: ids before a file = sum over earlier files, one row a file
    ahead = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = stored(blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
                   .select("file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")), "rans-files")
    placed = blocks.join(maybe_broadcast(files, 16), "file")

    def run(parts):
        coder = Table(sent.value)
        for part in parts:
            for r in part.to_pylist():
                ids = decode_block(r["payload"], coder)
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                start = r["ahead"] + r["before"] + ends - lengths
                raw = ids.astype("<u4").tobytes()
                own = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(start), pa.array(lengths), pa.array(own, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
    whole = placed.where(F.col("n_ids") <= WHOLE).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
    large = placed.where(F.col("n_ids") > WHOLE)
    return whole if large.isEmpty() else whole.unionByName(_read_parts(large, sent))


def _read_parts(placed: DataFrame, sent) -> DataFrame:
    """Large blocks, part by part: rows as of ``read``."""
    def cut(parts):
        names = ["file", "block", "part", "n", "lanes", "step", "last", "state", "words", "number", "doc_id", "start", "size", "skip", "take"]
        for part in parts:
            for r in part.to_pylist():
                n, lanes, _, found = parts_of(r["payload"])
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                start = ends - lengths
                for k, p in enumerate(found):
                    a, b = p.step * lanes, min(n, p.last * lanes)
                    # documents with ids in a..b, and which of these
                    docs = np.arange(np.searchsorted(ends, a, "right"), np.searchsorted(start, b, "left"))
                    skip = np.maximum(start[docs] - a, 0)
                    take = np.minimum(ends[docs], b) - np.maximum(start[docs], a)
                    row = [r["file"], r["block"], k, n, lanes, p.step, p.last, p.state, p.words, docs.tolist(), [r["doc_ids"][d] for d in docs],
                           (r["ahead"] + r["before"] + start[docs]).tolist(), lengths[docs].tolist(), skip.tolist(), take.tolist()]
                    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()] + [pa.list_(pa.int64())] * 6
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

    def run(parts):
        coder = Table(sent.value)
        for part in parts:
            for r in part.to_pylist():
                raw = decode_part(r["n"], r["lanes"], Part(r["step"], r["last"], r["state"], r["words"]), coder).astype("<u4").tobytes()
                own = [raw[4 * s:4 * (s + t)] for s, t in zip(r["skip"], r["take"])]
                m = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["file"]] * m, pa.int32()), pa.array([r["block"]] * m, pa.int32()), pa.array(r["number"], pa.int64()), pa.array([r["part"]] * m, pa.int32()),
                     pa.array(r["doc_id"], pa.int64()), pa.array(r["start"], pa.int64()), pa.array(r["size"], pa.int64()), pa.array(own, pa.binary())],
                    names=["file", "block", "number", "part", "doc_id", "start", "size", "ids"])

    lists = ", ".join(f"{c} array<long>" for c in ("number", "doc_id", "start", "size", "skip", "take"))
    pieces = placed.mapInArrow(cut, f"file int, block int, part int, n long, lanes int, step int, last int, state binary, words binary, {lists}")
    decoded = pieces.repartition("file", "block", "part").mapInArrow(
        run, "file int, block int, number long, part int, doc_id long, start long, size long, ids binary")
    joined = F.aggregate(F.transform(F.sort_array(F.collect_list(F.struct("part", "ids"))), lambda p: p["ids"]), F.lit(b""), lambda a, x: F.concat(a, x))
    return (decoded.groupBy("file", "block", "number").agg(F.max("doc_id").alias("doc_id"), F.max("start").alias("start"), F.max("size").alias("n_tokens"), joined.alias("ids"))
            .select("doc_id", "start", "n_tokens", "ids"))


def round_trip(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the documents' ids, then read the files back."""
    folder = folder or scratch_path(docs.sparkSession, "rans")
    write(docs, path, end_id, folder)
    return read(docs.sparkSession, folder)
