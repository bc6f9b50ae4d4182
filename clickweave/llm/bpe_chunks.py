"""BPE encoding and decoding with content-defined chunk reuse.

A rolling (gear) hash over the last 32 bytes cuts every text where the content
says so, so equal passages are cut into equal chunks wherever they stand. A
chunk that occurs in several documents is encoded once, centrally; ids of
chunks are then joined, and each joint is repaired.

Joints: a cut is placed only after a non-space ASCII byte that is followed by
ASCII white space, where pre-tokens always end, or, in a run of ``LONGEST``
bytes without such a place, between two characters. Over joints of the second
kind the ids may disagree with those of the whole text: the text around the
joint is encoded again in growing windows, until a window's ids agree with the
chunks' ids at both of its ends.

Plan: (1) one thin shuffle of 16-byte chunk hashes finds the chunks that
occur more than once; (2) a second pass encodes in place every document none
of whose chunks is shared - nothing to reuse - and sets the others aside,
compressed; a bitmap of fixed size tells the two apart, a false alarm only
takes the longer way; (3) the shared chunks of the documents set aside are
encoded once each, joined back by hash and assembled per document, where the
chunks that nothing shares are encoded. Texts and ids travel compressed. Chunk hashes are 128 bits of a cryptographic hash.

Edge cases: null and empty texts have no ids and decode to the empty text;
repeated rows and null doc_id are fine, a row is its own unit; very long texts
are cut like any other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, batches, bit_map, marked, mix, stored
from .tokens import Codec, decoder
from .tokens import codec as codec_of

#: Average chunk: about 5 * 2**CUT_BITS bytes of prose. Longest: LONGEST.
CUT_BITS = 8
LONGEST = 1 << 16
#: Entries of a generation of the memo: workers of long jobs also hold what other steps left.
MEMO = 250_000
#: Bits of the map of shared chunk hashes (4 MB, whatever the input).
MAP_BITS = 25

with np.errstate(over="ignore"):
    _GEAR = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)


def codec(path: str) -> Codec:
    return codec_of(path, MEMO)


def rolling(raw: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes that end at each byte, by doubling."""
    h = _GEAR[raw]
    for s in (1, 2, 4, 8, 16):
        if len(h) > s:
            h[s:] = h[s:] + (h[:-s] << np.uint32(s))
    return h


def cuts(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of one text (the last is its length)."""
    n = len(raw)
    if not n:
        return []
    space = SPACE[raw]
    good = np.zeros(n, bool)
    good[:-1] = (raw[:-1] < 128) & ~space[:-1] & space[1:]
    # the top bits of the hash depend on all 32 bytes
    at = np.flatnonzero(good & (rolling(raw) >> np.uint32(32 - CUT_BITS) == 0)) + 1
    out, last = [], 0
    for c in [*at.tolist(), n]:
        while c - last > LONGEST:  # a place between two characters
            last += LONGEST
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if c > last:
            out.append(c)
            last = c
    return out


def safe_joint(left: bytes, right: bytes) -> bool:
    """Whether pre-tokens always end between these."""
    return left[-1] < 128 and not SPACE[left[-1]] and bool(SPACE[right[0]]) and left[-1] not in range(0x1C, 0x20)


def repair(path: str, parts: list[bytes], ids: list[bytes]) -> bytes:
    """Ids of the joined parts, given each part's own ids.

    At an unsafe joint the window around it, between two places where ids cannot
    interact, is encoded again; work is that of the windows, or of the run of
    unsafe joints once.
    """
    if all(safe_joint(a, b) for a, b in zip(parts, parts[1:])):
        return b"".join(ids)
    c = codec(path)
    # runs of parts with safe joints between the runs are independent
    out, run, run_ids = [], [parts[0]], [ids[0]]
    for part, got in zip(parts[1:], ids[1:]):
        if safe_joint(run[-1], part):
            out.append(b"".join(run_ids) if len(run) == 1 else _agree(c, run, run_ids))
            run, run_ids = [], []
        run.append(part)
        run_ids.append(got)
    out.append(b"".join(run_ids) if len(run) == 1 else _agree(c, run, run_ids))
    return b"".join(out)


#: Bytes on either side of a joint within which a window must end.
NEAR = 4096


def _agree(c, parts: list[bytes], ids: list[bytes]) -> bytes:
    """Join parts one by one. The window around a joint runs between the nearest
    two changes from non-space to space, where ids cannot interact: the ids of
    its two sides are taken off what is known and those of the window put there.
    Where a side has no such change nearby, the parts are encoded as one, once."""
    text, done, from_start = parts[0], bytearray(ids[0]), True
    for part, got in zip(parts[1:], ids[1:]):
        p, q = _change(text, len(text) - 1, -1), _change(part, 1, 1)
        if p is None or q is None or (p == 0 and not from_start):
            return c.encode(b"".join(parts).decode())
        tail, head = c.encode(text[p:].decode()), c.encode(part[:q].decode())
        if not done.endswith(tail) or not got.startswith(head):
            return c.encode(b"".join(parts).decode())
        if tail:
            del done[-len(tail):]
        done += c.encode((text[p:] + part[:q]).decode())
        done += memoryview(got)[len(head):]
        text = text + part
        if len(text) > 2 * NEAR:  # only the end is looked at again
            text, from_start = text[-2 * NEAR:], False
    return bytes(done)


def _change(raw: bytes, at: int, step: int) -> int | None:
    """Nearest change from non-space to space at or beyond ``at``, or that end
    of the text; None when neither is near."""
    for _ in range(NEAR):
        if at <= 0 or at >= len(raw):
            return max(0, min(at, len(raw)))
        if safe_joint(raw[at - 1:at], raw[at:at + 1]):
            return at
        at += step
    return None


def chunk_hash(part: bytes) -> bytes:
    return hashlib.blake2b(part, digest_size=16).digest()


def _marked(hashes: list[bytes], bits: np.ndarray) -> np.ndarray:
    """Which chunk hashes the map of shared ones holds."""
    head = np.frombuffer(b"".join(hashes), ">u8")[::2].astype(np.uint64)
    return marked(bits, head >> np.uint64(64 - MAP_BITS))


def digests(ids: bytes, path: str) -> tuple[int, str, str]:
    numbers = np.frombuffer(ids, "<u4")
    text = decoder(path).decode(numbers.tolist())
    return len(numbers), hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()


def encode(docs: DataFrame, path: str, keep: list[str], per_document=None, schema: str | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns and the columns that
    ``per_document(ids, text) -> tuple`` gives, of types ``schema`` (default:
    ``ids binary``, little-endian uint32)."""
    spark = docs.sparkSession
    per_document = per_document or (lambda ids, text: (ids,))
    schema = schema or "ids binary"
    kept = docs.select(*[F.col(c).alias(f"_c_keep_{i}") for i, c in enumerate(keep)], F.col("text").alias("_c_text"))
    names = [f"_c_keep_{i}" for i in range(len(keep))]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    out_names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def hashes(part: pa.RecordBatch):
        found = []
        for text in part.column("_c_text").to_pylist():
            raw = (text or "").encode()
            last = 0
            for end in cuts(np.frombuffer(raw, np.uint8)):
                found.append(chunk_hash(raw[last:end]))
                last = end
        if found:
            heads = np.frombuffer(b"".join(found), ">i8")[::2].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(heads)], names=["_c_hash", "_c_head"])

    seen = batches(kept.select("_c_text"), hashes, "_c_hash binary, _c_head long")
    shared = seen.groupBy("_c_hash", "_c_head").count().where("count > 1").select("_c_head")
    bits = spark.sparkContext.broadcast(bit_map(shared.select(F.shiftrightunsigned("_c_head", 64 - MAP_BITS).alias("bit")), MAP_BITS))

    def first(part: pa.RecordBatch):
        """Encode documents without shared chunks; set the others aside."""
        c, squeeze = codec(path), zstandard.ZstdCompressor(level=1)
        result, aside = [], []
        for text in part.column("_c_text").to_pylist():
            raw = (text or "").encode()
            ends = cuts(np.frombuffer(raw, np.uint8))
            parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
            if parts and _marked([chunk_hash(p) for p in parts], bits.value).any():
                aside.append(squeeze.compress(raw))
                result.append((None,) * len(out_names))
                continue
            aside.append(None)
            result.append(per_document(repair(path, parts, [c.encode(p.decode()) for p in parts]) if parts else b"", text or ""))
        columns = [pa.array([r[i] for r in result], t) for i, t in enumerate(out_types)]
        yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *columns, pa.array(aside, pa.binary())],
                                         names=[*names, *out_names, "_c_aside"])

    empty = spark.createDataFrame([], schema)
    from pyspark.sql.pandas.types import to_arrow_type
    out_types = [to_arrow_type(f.dataType) for f in empty.schema.fields]
    done = batches(kept, first, ", ".join(x for x in (types, schema, "_c_aside binary") if x))
    done = stored(done.withColumn("_c_row", F.monotonically_increasing_id()), "bpe-pass")

    def pieces(part: pa.RecordBatch):
        open_, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        rows, at, name, text = [], [], [], []
        for row, packed in zip(part.column("_c_row").to_pylist(), part.column("_c_aside").to_pylist()):
            raw = open_.decompress(packed)
            ends = cuts(np.frombuffer(raw, np.uint8))
            own = [raw[a:b] for a, b in zip([0, *ends], ends)]
            hashes = [chunk_hash(p) for p in own]
            for k in np.flatnonzero(_marked(hashes, bits.value)).tolist():
                rows.append(row)
                at.append(k)
                name.append(hashes[k])
                text.append(squeeze.compress(own[k]))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(at, pa.int32()), pa.array(name, pa.binary()),
                                          pa.array(text, pa.binary())], names=["_c_row", "_c_at", "_c_hash", "_c_part"])

    def once(part: pa.RecordBatch):
        c, open_, squeeze = codec(path), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        ids = [squeeze.compress(c.encode(open_.decompress(t).decode())) for t in part.column("_c_part").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("_c_hash"), pa.array(ids, pa.binary())], names=["_c_hash", "_c_ids"])

    aside = done.where("_c_aside IS NOT NULL").select("_c_row", "_c_aside")
    parts = batches(aside, pieces, "_c_row long, _c_at int, _c_hash binary, _c_part binary")
    table = batches(parts.groupBy("_c_hash").agg(F.first("_c_part").alias("_c_part")), once, "_c_hash binary, _c_ids binary")
    table = stored(table, "bpe-chunks")
    thin = parts.select("_c_row", "_c_at", "_c_hash")
    joined = (thin.join(table.select("_c_hash", "_c_ids"), "_c_hash")
              .groupBy("_c_row").agg(F.sort_array(F.collect_list(F.struct("_c_at", "_c_ids"))).alias("_c_all")))

    def assemble(part: pa.RecordBatch):
        open_, c = zstandard.ZstdDecompressor(), codec(path)
        result = []
        for packed, found in zip(part.column("_c_aside").to_pylist(), part.column("_c_all").to_pylist()):
            raw = open_.decompress(packed)
            ends = cuts(np.frombuffer(raw, np.uint8))
            own = [raw[a:b] for a, b in zip([0, *ends], ends)]
            shared = {x["_c_at"]: open_.decompress(x["_c_ids"]) for x in found}
            ids = repair(path, own, [v if (v := shared.get(k)) is not None else c.encode(p.decode()) for k, p in enumerate(own)])
            result.append(per_document(ids, raw.decode()))
        columns = [pa.array([r[i] for r in result], t) for i, t in enumerate(out_types)]
        yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *columns], names=[*names, *out_names])

    late = (done.where("_c_aside IS NOT NULL").select("_c_row", "_c_aside", *names).join(joined, "_c_row").drop("_c_row"))
    late = batches(late, assemble, ", ".join(x for x in (types, schema) if x))
    both = done.where("_c_aside IS NULL").select(*names, *out_names).unionByName(late)
    return both.withColumnsRenamed({f"_c_keep_{i}": c for i, c in enumerate(keep)})
