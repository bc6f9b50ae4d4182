"""Merkle manifest of a dataset: a postorder append log built by aligned
builders, and proofs read from it by closed-form positions.

Each document is a leaf; the leaves of a source stand in doc_id order. Every
16 nodes in a row become one node above, until one is left: the source's
subroot. Subroots in source order become the root the same way.

The log lists the nodes of a tree in the order they are completed (postorder).
A builder takes an aligned range of up to 16^3 nodes of one level, which is a
whole subtree, and appends the subtree's nodes as one segment row; the segments'
top nodes are the input of the next round of builders, 4096 times fewer. The place
of a node in its log follows from subtree sizes alone: when the node (level,
index) is complete, ``done`` leaves have been appended and with them
done // 16 + done // 256 + ... nodes above; see ``position``. So a proof needs no
links between nodes: the siblings of a leaf are at computed places.

Proofs go from the top down: a segment gives each of its first nodes the siblings
inside the segment, followed by those of the segment itself, which the round
above has worked out. One row a segment moves, never one a node and sibling.

Plan: one pass hashes the texts (SQL functions); (doc_id, source, digests) are
ranged by (source, doc_id), so a hot source is spread over tasks like any other;
index = rows before the task + place in it, from one count a (task, source); a
shuffle by (source, 4096 leaves) feeds the builders. No text is shuffled.

Edge cases: null fields have a form of their own ("-"), a null source is a source
and comes first, null doc_ids come first; equal doc_ids are ordered by leaf; a
lone leaf is its source's subroot and a lone subroot the root; an empty table has
no tree and gives no rows. Texts of any length are hashed where they lie. Columns
other than doc_id, source, lang, n_chars and text are not used.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import maybe_broadcast, ship, stored

#: Children of a node; levels of a builder's subtree.
FAN, LEVELS = 16, 3
SPAN = FAN ** LEVELS
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(parts: list[bytes]) -> bytes:
    """Digest of a node, from its children's digests as hex text."""
    return hashlib.sha256("".join([p.hex() for p in parts]).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves."""
    h = 0
    while FAN ** h < leaves:
        h += 1
    return h


def width(leaves: int, level: int) -> int:
    """Nodes of a level."""
    return -(-leaves // FAN ** level)


@functools.lru_cache(maxsize=1 << 15)
def position(leaves: int, level: int, index: int) -> int:
    """Place of node (level, index) in the log of a tree of so many leaves."""
    size = FAN ** level
    if (index + 1) * size <= leaves:  # complete as soon as its last leaf is
        done, after = (index + 1) * size, 0
        while done % (size * FAN) == 0 and size * FAN <= leaves:
            size, after = size * FAN, after + 1
    else:  # the ragged node of its level, written when the leaves have ended
        done = leaves
        after = -sum(leaves % FAN ** k > 0 for k in range(1, level + 1))
    total, size = done, FAN
    while size <= done:
        total, size = total + done // size, size * FAN
    return total - 1 - after


def appended(leaves: list[bytes], levels: int) -> list[bytes]:
    """The log of a subtree: nodes up to ``levels`` levels above its leaves, in
    the order they are completed."""
    log: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def add(level: int, node: bytes) -> None:
        log.append(node)
        if level < levels:
            open_[level].append(node)
            if len(open_[level]) == FAN:
                full, open_[level] = open_[level], []
                add(level + 1, hashed(full))

    for leaf in leaves:
        add(0, leaf)
    for level in range(levels):
        if open_[level]:
            rest, open_[level] = open_[level], []
            add(level + 1, hashed(rest))
    return log


def siblings(leaves: int, levels: int, index: int) -> list[list[int]]:
    """Per level from the leaf up: the log places of the node's siblings, left
    to right."""
    out = []
    for level in range(levels):
        run = index // FAN * FAN
        out.append([position(leaves, level, k) for k in range(run, min(run + FAN, width(leaves, level))) if k != index])
        index //= FAN
    return out


def folded(node: bytes, index: int, path: list[list[bytes]]) -> bytes:
    """The digest above ``path``, from a node, its index and its siblings."""
    for others in path:
        at = index % FAN
        node = hashed([*others[:at], node, *others[at:]])
        index //= FAN
    return node


# ---------------------------------------------------------------- leaves


def field(c: Column) -> Column:
    """A field's form in a leaf: "-" for null, else byte count, ":", value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]).cast("binary"), 256))


def tampered(doc_id: Column) -> Column:
    """Documents whose text is altered to try the proofs: one in five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, altered): digests of the document, and of the
    document with its text's A-Z lower-cased where ``tampered`` says so."""
    c = {n: docs[n] for n in ("doc_id", "source", "lang", "n_chars", "text")}
    low = leaf(c["doc_id"], c["source"], c["lang"], c["n_chars"], F.translate(c["text"], _UPPER, _LOWER))
    return docs.select(c["doc_id"], c["source"], leaf(**c).alias("leaf"), F.when(tampered(c["doc_id"]), low).alias("altered"))


# ---------------------------------------------------------------- building


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx`` (0-based place in its group by ``order``, nulls
    first) and ``total`` (rows of the group); groups may be of any size."""
    placed = stored(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                    .select("*", F.monotonically_increasing_id().alias("_at"), F.spark_partition_id().alias("_part")), name)
    counts = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    own = W.partitionBy(group)
    before = own.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = stored(counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first",
                                  F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"), F.sum("_n").over(own).alias("total")), f"{name}-starts")
    side = maybe_broadcast(starts, F.lit(48) + F.coalesce(F.octet_length(F.col("_g").cast("string")), F.lit(0)))
    return (placed.join(side, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
            .select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_ahead")).alias("idx"), "total"))


def _grouped(parts: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Consecutive rows of equal keys, across batches; a group is one builder's
    range, at most SPAN rows."""
    key, held = None, {}
    for part in parts:
        table = {c: part.column(part.schema.get_field_index(c)).to_pylist() for c in [*keys, *columns]}
        names = list(zip(*[table[k] for k in keys]))
        at = 0
        while at < len(names):
            end = at
            while end < len(names) and names[end] == names[at]:
                end += 1
            if names[at] != key:
                if key is not None:
                    yield key, held
                key, held = names[at], {c: [] for c in columns}
            for c in columns:
                held[c] += table[c][at:end]
            at = end
    if key is not None:
        yield key, held


def segments(nodes: DataFrame, base: int, carry: list[str], name: str) -> DataFrame:
    """One round of builders over nodes (g, idx, digest, total) of level ``base``:
    rows (g, total, block, first nodes, log) with the ``carry`` columns of the
    first nodes as lists. ``total`` counts the leaves of the whole tree."""
    ship(nodes.sparkSession)
    kinds = dict(nodes.dtypes)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, block, total), held in _grouped(parts, ["g", "block", "total"], ["digest", *carry]):
            levels = min(LEVELS, max(0, height(total) - base))
            log = appended(held["digest"], levels)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g], kind), pa.array([block], pa.int64()), pa.array([total], pa.int64()), pa.array([len(held["digest"])], pa.int32()),
                 pa.array([b"".join(log)], pa.binary()), *[pa.array([held[c]], pa.list_(types[c])) for c in carry]],
                names=["g", "block", "total", "first_nodes", "log", *carry])

    types = {c: {"bigint": pa.int64(), "binary": pa.binary()}[kinds[c]] for c in carry}
    kind = {"string": pa.string(), "int": pa.int32()}[kinds["g"]]
    blocks = nodes.select("g", "total", "idx", "digest", *carry, F.floor(F.col("idx") / SPAN).alias("block"))
    dealt = blocks.repartition("g", "block").sortWithinPartitions("g", "block", "idx")
    schema = ", ".join([f"g {kinds['g']}", "block long", "total long", "first_nodes int", "log binary", *[f"{c} array<{kinds[c]}>" for c in carry]])
    return stored(dealt.mapInArrow(run, schema), name)


def build(nodes: DataFrame, carry: list[str], name: str) -> list[DataFrame]:
    """The whole log, one table of segments a round, lowest first. The last
    table's segments end in the top node of their tree."""
    rounds, base = [], 0
    while True:
        made = segments(nodes, base, carry, f"{name}-{base}")
        rounds.append(made)
        base += LEVELS
        nodes = made.where(F.col("total") > FAN ** base).select(
            "g", "total", F.col("block").alias("idx"), F.expr("substring(log, -32, 32)").alias("digest"))
        if nodes.isEmpty():
            return rounds
        carry = []


def tops(rounds: list[DataFrame]) -> DataFrame:
    """(g, top): the top node of every tree of a log."""
    out = None
    for k, made in enumerate(rounds):
        lone = made.where(F.col("total") <= FAN ** (LEVELS * (k + 1))).select("g", F.expr("substring(log, -32, 32)").alias("top"))
        out = lone if out is None else out.unionByName(lone)
    return out


# ---------------------------------------------------------------- proofs

#: A path: per level the sibling digests, concatenated.
_PATH = "array<binary>"


def _paths(log: bytes, first: int, total: int, base: int) -> list[list[bytes]]:
    """Path of each first node of a segment to the segment's top."""
    levels = min(LEVELS, max(0, height(total) - base))
    out = []
    for k in range(first):
        out.append([b"".join([log[32 * p:32 * p + 32] for p in places]) for places in siblings(first, levels, k)])
    return out


def above(rounds: list[DataFrame], top: DataFrame, name: str) -> list[DataFrame]:
    """Per round the path above each of its segments: (g, block, path), lowest
    round first. ``top``: (g, path) above the trees' tops."""
    spark = top.sparkSession
    ship(spark)
    out: list[DataFrame] = []
    higher = None
    for k in range(len(rounds) - 1, -1, -1):
        last = F.col("total") <= FAN ** (LEVELS * (k + 1))
        lone = rounds[k].where(last).select("g", "block")
        own = top.select(F.col("g").alias("_g"), "path")
        paths = lone.join(maybe_broadcast(own, F.lit(1024)), F.col("g").eqNullSafe(F.col("_g"))).select("g", "block", "path")
        if higher is not None:
            paths = paths.unionByName(higher)
        paths = stored(paths, f"{name}-path-{k}")
        out.insert(0, paths)
        if k:
            higher = _down(rounds[k], paths, LEVELS * k)
    return out


def _down(made: DataFrame, paths: DataFrame, base: int) -> DataFrame:
    """Paths above the segments below: (g, block, path) of every first node."""
    kind = pa.string() if dict(made.dtypes)["g"] == "string" else pa.int32()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                found = _paths(r["log"], r["first_nodes"], r["total"], base)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["g"]] * len(found), kind), pa.array([r["block"] * SPAN + k for k in range(len(found))], pa.int64()),
                     pa.array([[*p, *r["path"]] for p in found], pa.list_(pa.binary()))], names=["g", "block", "path"])
    return with_paths(made, paths).mapInArrow(run, f"g {dict(made.dtypes)['g']}, block long, path {_PATH}")


def with_paths(made: DataFrame, paths: DataFrame) -> DataFrame:
    """Segments with the path above them; both sides have a row a segment."""
    p = paths.select(F.col("g").alias("_g"), F.col("block").alias("_b"), "path")
    return made.join(p, F.col("g").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")


def digests(path: bytes) -> list[bytes]:
    return [path[i:i + 32] for i in range(0, len(path), 32)]


def proved(made: DataFrame, paths: DataFrame, subroot_index: DataFrame, root: DataFrame) -> DataFrame:
    """Per leaf of the lowest round: doc_id, leaf, subroot, root, proof_sha256,
    folded_root (hex) and verified. Proofs live one leaf at a time in a task."""
    n_subroots = root.select("subroots", "root")
    sides = with_paths(made, paths).join(
        maybe_broadcast(subroot_index, F.lit(96) + F.coalesce(F.octet_length(F.col("_s").cast("string")), F.lit(0))),
        F.col("g").eqNullSafe(F.col("_s"))).drop("_s").crossJoin(F.broadcast(n_subroots))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                yield _proofs(r)
    return sides.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _proofs(r: dict) -> pa.RecordBatch:
    """Proofs of a segment's leaves. All folds first go up the source's tree,
    then, from the subroot's index, up the tree of subroots."""
    log, first, total, root = r["log"], r["first_nodes"], r["total"], r["root"]
    in_source = height(total)
    upper = [digests(p) for p in r["path"]]
    upper_hex = "".join([p.hex() for p in r["path"]])
    rows: list[tuple] = []
    for k, own in enumerate(_paths(log, first, total, 0)):
        path = [*map(digests, own), *upper]
        node = log[32 * position(first, 0, k):][:32]
        proof = hashlib.sha256(("".join([p.hex() for p in own]) + upper_hex).encode()).hexdigest()
        shown = r["altered"][k] or node
        index = r["block"] * SPAN + k
        back = folded(folded(shown, index, path[:in_source]), r["place"], path[in_source:])
        rows.append((r["doc_id"][k], node.hex(), r["subroot"].hex(), root.hex(), proof, back.hex(), back == root))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def verify(docs: DataFrame) -> DataFrame:
    """Build the manifest of ``docs``, take the proof of every document and
    fold it again from the (partly altered) texts."""
    nodes = numbered(leaves(docs), "source", ["doc_id", "leaf"], "manifest-leaves")
    nodes = nodes.select(F.col("source").alias("g"), "idx", "total", F.col("leaf").alias("digest"), "doc_id", "altered")
    rounds = build(nodes, ["doc_id", "altered"], "manifest")
    subroots = stored(tops(rounds), "manifest-subroots")
    # the tree over the subroots: one tree, its leaves in source order
    order = numbered(subroots.select(F.lit(0).alias("t"), F.col("g").alias("s"), F.col("top").alias("digest")), "t", ["s", "digest"], "manifest-sources")
    order = stored(order, "manifest-order")
    top_rounds = build(order.select(F.col("t").alias("g"), "idx", "total", "digest"), [], "manifest-top")
    root = stored(tops(top_rounds).select(F.col("top").alias("root")).crossJoin(order.agg(F.count("*").alias("subroots"))), "manifest-root")
    empty_path = F.array().cast(_PATH)
    top_paths = above(top_rounds, root.select(F.lit(0).alias("g"), empty_path.alias("path")), "manifest-top")
    place = _down(top_rounds[0], top_paths[0], 0).select(F.col("block").alias("idx"), "path")
    by_source = stored(order.select("s", "digest", "idx").join(place, "idx").select(F.col("s").alias("g"), "path", F.col("idx").alias("place"), "digest"), "manifest-sources-paths")
    paths = above(rounds, by_source.select("g", "path"), "manifest")
    return proved(rounds[0], paths[0], by_source.select(F.col("g").alias("_s"), "place", F.col("digest").alias("subroot")), root)
