"""Exact Jaccard self-join of word-shingle sets, and its components.

Two documents link when ``100 * |A n B| >= 75 * |A u B|``. Work is done on
distinct sets (classes of equal sets), so copies cost one row each and no pair.

Tiles. Sorted in one fixed order, two linked sets must share an element among
their first ``n/4 + 1``; so a tile is the classes that have one such element in
common. The order puts elements that many documents share (found on a hash
sample, which only steers the order) last, so common lines and passages rarely
make tiles. Tiles with the same most central class (the one that shares most with
others, as the original of a group of near copies does) are one: a class lies in
many tiles but around few centres, so it moves a few times, not once a tile.

Every class carries a hashed bitmap of 4-8 bits an element. A bit set in a and
not in b stands for at least one element missing from b, so bit counts bound the
overlap from above, within a band of sizes, and only pairs whose bound reaches the
threshold go to the exact intersection of the sorted arrays.

First, each class is held against the centre of its tiles (a star). Of the tiles
that still hold several components, the bitmaps tell the classes that may link
with another component; only their sets move, and are compared where they meet:
pairs whose components have met already are not tested, the likeliest pair of two
components is tested first. What comes out of a task is one row a class, or a link
that joins two components, never the pairs: a large group of near copies costs
about one test a class, and no link between components is missed.

A tile with more than ``GROUP`` such classes (or ``ELEMENTS`` elements) is not one
task's work: only its classes outside the largest component need be tried; they
are cut into chunks by hash, and the tile's classes stream past each chunk, dealt
over tasks. Bitmaps of a large tile meet in pairs of chunks.

Sets are 64-bit shingle hashes, made in a first pass; only the elements of tiles
move. Most elements are in one class only. They are told apart by counting 32-bit
keys of elements in one thin shuffle; a bitmap of fixed size of the keys that
occur again then picks the rows that can share a tile (a false alarm makes a
row too many, never one too few). Tiles with the same members count once. Later
passes make the whole sets of one document a class where they are needed, picked
by another bitmap of fixed size.

The join gives components. Links inside a component that would join nothing
new are not tested.

Edge cases: null or blank texts have an empty set and link with nothing; a text
of fewer than five words is one shingle; a row with null doc_id takes part, and
its component_id is the smallest other id, or null; repeated rows are one
class; several rows of one doc_id are rows of their own; an empty table gives no
rows; columns other than doc_id and text are not used. A very long text is one
row of a task, at about 50 times its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, bit_map, discard, marked, maybe_broadcast, mix, repeated_keys, shingles, stored, utf8, words
from .components import components

K = 5
#: Link: OF * overlap >= PERCENT * union.
PERCENT, OF = 75, 100
#: One document in SAMPLE is looked at to find common shingles; at most COMMON
#: of them are put last in the order.
SAMPLE, COMMON = 16, 100_000
#: Most classes and elements of a group that one task works on.
GROUP, ELEMENTS = 1024, 4 << 20
#: Classes of a chunk of bitmaps.
CHUNK = 2048
#: Classes that stream past a chunk in one task.
STREAM = 1 << 14
#: Bits of the maps that pick rows in a pass (8 and 32 MB, whatever the input).
MAP_BITS, KEY_BITS = 26, 28
#: Bytes of text whose sets are made at once.
PIECE = 512 << 10


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw, off = utf8(texts)
    word, first, _, _ = words(raw, off)
    full, inside = shingles(word, first, K)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= K:
            out.append(np.unique(full[a:b - K + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                part = mix(word[a:b] * (2 * np.arange(b - a, dtype=np.uint64) + np.uint64(3)))
                out.append(mix(np.array([part.sum() + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    """Id of a set: equal sets, equal ids (64-bit)."""
    with np.errstate(over="ignore"):
        x = mix(np.array([mix(s).sum() + np.uint64(len(s))], np.uint64))
    return int(x.view(np.int64)[0])


def bitmap(s: np.ndarray) -> np.ndarray:
    """Hashed bitmap of 4 to 8 bits an element, at least 64."""
    bits = max(64, 1 << int(4 * len(s) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(m: np.ndarray, length: int) -> np.ndarray:
    """A bitmap at a smaller power of two (slots are hash modulo bits)."""
    while len(m) > length:
        m = m[: len(m) // 2] | m[len(m) // 2:]
    return m


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) < len(b):
        a, b = b, a
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = shared(a, b)
    return OF * both >= PERCENT * (len(a) + len(b) - both)


def reachable(na, nb, missing_a, missing_b):
    """Whether the overlap bounded by bit counts can still make a link."""
    most = np.minimum(na - missing_a, nb - missing_b)
    return OF * most >= PERCENT * (na + nb - most)


class Maps:
    """Bitmaps of sets, to be asked which sets may link."""

    def __init__(self, n: np.ndarray, maps: list[np.ndarray]):
        self.n = n
        length = np.array([len(m) for m in maps])
        # by length of bitmap: rows, their bitmaps, and those at half the length
        self.bands = {}
        for size in np.unique(length).tolist():
            rows = np.flatnonzero(length == size)
            table = np.stack([maps[r] for r in rows])
            half = table[:, :size // 2] | table[:, size // 2:] if size > 1 else table
            self.bands[size] = rows, table, half

    def may_link(self, m: np.ndarray, n: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows below ``upto`` that may link with a set of bitmap ``m`` and size
        ``n``, elements missing at least)."""
        rows_out, missing_out = [], []
        for size, (rows, table, half) in self.bands.items():
            if size == len(m):
                mine, other = m, table
            elif size == 2 * len(m):
                mine, other = m, half
            elif 2 * size == len(m):
                mine, other = folded(m, size), table
            else:
                continue
            stop = int(np.searchsorted(rows, upto))
            rows, other = rows[:stop], other[:stop]
            sizes = self.n[rows]
            near = OF * np.minimum(sizes, n) >= PERCENT * np.maximum(sizes, n)
            rows, other, sizes = rows[near], other[near], sizes[near]
            if not len(rows):
                continue
            missing_m = np.bitwise_count(mine & ~other).sum(1, dtype=np.int64)
            missing_o = np.bitwise_count(other & ~mine).sum(1, dtype=np.int64)
            may = reachable(n, sizes, missing_m, missing_o)
            rows_out.append(rows[may])
            missing_out.append((missing_m + missing_o)[may])
        if not rows_out:
            none = np.zeros(0, np.int64)
            return none, none
        return np.concatenate(rows_out), np.concatenate(missing_out)


class Block(Maps):
    """Sets with their bitmaps and components, to be asked for links."""

    def __init__(self, sets: list[np.ndarray], comp: np.ndarray):
        super().__init__(np.array([len(s) for s in sets], np.int64), [bitmap(s) for s in sets])
        self.sets, self.comp = sets, comp.copy()
        self.now: dict[int, int] = {}  # component that another has become

    def links(self, s: np.ndarray, comp: int, upto: int) -> list[int]:
        """Rows below ``upto`` that link the set ``s`` of component ``comp`` with
        other components, one a component; these become one, ``comp``."""
        while comp in self.now:
            comp = self.now[comp]
        if (self.comp[:upto] == comp).all():
            return []
        rows, missing = self.may_link(bitmap(s), len(s), upto)
        found = []
        for r in rows[np.argsort(missing, kind="stable")].tolist():
            if self.comp[r] != comp and linked(self.sets[r], s):
                found.append(r)
                self.now[int(self.comp[r])] = comp
                self.comp[self.comp == self.comp[r]] = comp
        return found


def group_links(sets: list[np.ndarray], comp: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the components of a group of classes (row numbers)."""
    block, out = Block(sets, comp), []
    for i in range(1, len(sets)):
        out += [(r, i) for r in block.links(sets[i], int(block.comp[i]), i)]
    return out


def may_meet(n: np.ndarray, comp: np.ndarray, maps: list[np.ndarray], side: np.ndarray) -> np.ndarray:
    """Marks the classes that may link with one of another component; of two
    chunks (``side`` 0 and 1) only pairs across count, of one all do."""
    found, asked = np.zeros(len(n), bool), Maps(n, maps)
    both = len(np.unique(side)) > 1
    for i in range(len(n)):
        rows = asked.may_link(maps[i], int(n[i]), i)[0]
        rows = rows[comp[rows] != comp[i]]
        rows = rows[side[rows] != side[i]] if both else rows
        if len(rows):
            found[rows] = found[i] = True
    return found


def _common(docs: DataFrame) -> np.ndarray:
    """Shingles that several sampled documents share, by count, bounded."""
    def emit(part: pa.RecordBatch):
        found = sets_of(part.column("text"))
        sizes = [len(s) for s in found]
        if sum(sizes):
            ids = np.repeat(np.array([set_id(s) for s in found], np.int64), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(ids)], names=["h", "sid"])
    few = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    rows = (batches(few, emit, "h long, sid long").groupBy("h")
            .agg(F.count("*").alias("c"), F.min("sid").alias("lo"), F.max("sid").alias("hi"))
            .where("c >= 4 AND lo <> hi").orderBy(F.col("c").desc(), "h").limit(COMMON).select("h").toArrow())
    return np.sort(rows["h"].to_numpy().view(np.uint64)) if rows.num_rows else np.zeros(0, np.uint64)


def row_key() -> Column:
    """A row's text and id as one number, in SQL."""
    return F.xxhash64("text", "doc_id")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, key (``row_key``), n (set size), sid (set id), prefix (first n/4
    + 1 elements), bits (bitmap)."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs))

    def run(part: pa.RecordBatch):
        ids, sizes, prefix, maps = [], [], [], []
        for s in sets_of(part.column("text")):
            ids.append(set_id(s) if len(s) else None)
            maps.append(bitmap(s).tobytes() if len(s) else None)
            sizes.append(len(s))
            p = len(s) - -(-PERCENT * len(s) // OF) + 1 if len(s) else 0
            if len(common.value):
                at = np.searchsorted(common.value, s)
                at[at == len(common.value)] = 0
                often = common.value[at] == s
                s = np.concatenate((s[~often][:p], s[often]))
            prefix.append(s[:p].view(np.int64))
        size = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(size), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), lists,
                                          pa.array(maps, pa.binary())], names=["doc_id", "key", "n", "sid", "prefix", "bits"])
    return batches(docs.select("doc_id", row_key().alias("key"), "text"), run,
                   "doc_id long, key long, n long, sid long, prefix array<long>, bits binary", PIECE)


def _members(sigs: DataFrame) -> DataFrame:
    """(h, sid, n, lo, k): classes of each tile, its smallest class and how many
    equal tiles it stands for; one class a row, tiles of two classes and more."""
    spark = sigs.sparkSession
    some = sigs.where("n > 0")
    key = F.explode(F.transform("prefix", lambda h: F.shiftright(h, 32).cast("int")))
    seen = spark.sparkContext.broadcast(repeated_keys(some.select(key.alias("key")), KEY_BITS))

    def run(part: pa.RecordBatch):
        lists = part.column("prefix")
        size = np.diff(lists.offsets.to_numpy())
        h = lists.flatten().to_numpy()
        hit = marked(seen.value, h.view(np.uint64) >> np.uint64(64 - KEY_BITS))
        row = np.repeat(np.arange(part.num_rows), size)[hit]
        sid, n = part.column("sid").to_numpy(), part.column("n").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(h[hit]), pa.array(sid[row]), pa.array(n[row])], names=["h", "sid", "n"])

    rows = batches(some.select("sid", "n", "prefix"), run, "h long, sid long, n long")
    rows = stored(rows.groupBy("h", "sid").agg(F.first("n").alias("n")), "jaccard-rows")
    x = [F.bit_xor(F.xxhash64("sid", F.lit(i))).alias(f"x{i}") for i in range(2)]
    tiles = rows.groupBy("h").agg(F.count("*").alias("m"), *x, F.min("sid").alias("lo")).where("m > 1")
    tiles = tiles.groupBy("m", "x0", "x1", "lo").agg(F.min("h").alias("h"), F.count("*").alias("k")).select("h", "m", "lo", "k")
    return rows.join(tiles, "h")


def _sets(docs: DataFrame, sigs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, elements) of the wanted classes, one row each, from one document
    a class. A bitmap of fixed size picks these in the scan; extra ones do no
    harm."""
    some = sigs.where("n > 0").join(wanted.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.min("key").alias("key"))
    sent = docs.sparkSession.sparkContext.broadcast(
        bit_map(some.select(F.shiftrightunsigned("key", 64 - MAP_BITS).alias("bit")), MAP_BITS))

    def run(part: pa.RecordBatch):
        part = part.filter(pa.array(marked(sent.value, part.column("bit").to_numpy().astype(np.uint64))))
        done = {set_id(s): s.tobytes() for s in sets_of(part.column("text")) if len(s)}
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(done), pa.int64()), pa.array(list(done.values()), pa.binary())], names=["sid", "elements"])
    rows = docs.select("text", F.shiftrightunsigned(row_key(), 64 - MAP_BITS).alias("bit"))
    return batches(rows, run, "sid long, elements binary", PIECE)


def _within(rows: DataFrame) -> DataFrame:
    """Links (a, b) that join components of a tile, of tiles that are one task's
    work; rows (pivot, sid, comp, elements)."""
    def run(parts):
        key, sids, comps, held = None, [], [], []

        def flush():
            found = group_links(held, np.array(comps, np.int64))
            return pa.RecordBatch.from_arrays([pa.array([sids[i] for i, _ in found], pa.int64()), pa.array([sids[j] for _, j in found], pa.int64())], names=["a", "b"])
        for part in parts:
            for pivot, sid, comp, own in zip(*(part.column(i).to_pylist() for i in range(4))):
                if pivot != key:
                    if held:
                        yield flush()
                    key, sids, comps, held = pivot, [], [], []
                if not sids or sids[-1] != sid:  # several documents of a class may come
                    sids.append(sid)
                    comps.append(comp)
                    held.append(np.frombuffer(own, np.uint64))
        if held:
            yield flush()
    return (rows.select("pivot", "sid", "comp", "elements").repartition("pivot").sortWithinPartitions("pivot", "sid")
            .mapInArrow(run, "a long, b long"))


def _active(open_: DataFrame, bits: DataFrame) -> DataFrame:
    """(pivot, sid): classes of open tiles (pivot, sid, comp, m) whose bitmaps
    allow a link with another component of the tile."""
    k = F.ceil(F.col("m") / CHUNK).cast("int")
    dealt = (open_.withColumn("k", k).withColumn("x", F.pmod(F.xxhash64("sid"), F.col("k")).cast("int"))
             .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .select("pivot", F.least("x", "y").alias("u"), F.greatest("x", "y").alias("w"), (F.col("x") > F.col("y")).alias("side"), "sid", "comp")
             .join(bits, "sid"))

    def run(parts):
        key, held = None, []

        def flush():
            sid, comp, n, maps, side = zip(*held)
            hit = may_meet(np.array(n), np.array(comp), [np.frombuffer(m, np.uint64) for m in maps], np.array(side))
            own = np.array(sid, np.int64)[hit]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(own), key[0], np.int64)), pa.array(own)], names=["pivot", "sid"])
        for part in parts:
            for pivot, u, w, *row in zip(*(part.column(i).to_pylist() for i in range(8))):
                if (pivot, u, w) != key:
                    if held:
                        yield flush()
                    key, held = (pivot, u, w), []
                held.append(row)
        if held:
            yield flush()
    rows = dealt.select("pivot", "u", "w", "sid", "comp", "n", "bits", "side")
    return rows.repartition("pivot", "u", "w").sortWithinPartitions("pivot", "u", "w", "n").mapInArrow(run, "pivot long, sid long").distinct()


def _past(held: DataFrame, passing: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of ``held`` (keys x, y; one task's work)
    and those of ``passing`` that have the same keys, from one component to
    another; both (x, y, sid, comp, elements)."""
    both = held.select("x", "y", F.lit(0).alias("role"), "sid", "comp", "elements").unionByName(
        passing.select("x", "y", F.lit(1).alias("role"), "sid", "comp", "elements"))

    def run(parts):
        key, own, block, out = None, [], None, []
        for part in parts:
            for x, y, role, sid, comp, elements in zip(*(part.column(i).to_pylist() for i in range(6))):
                if (x, y) != key:
                    key, own, block = (x, y), [], None
                if not role:
                    own.append((sid, comp, np.frombuffer(elements, np.uint64)))
                    continue
                if block is None:
                    block = Block([e for *_, e in own], np.array([c for _, c, _ in own], np.int64)) if own else ()
                if own:
                    out += [(own[r][0], sid) for r in block.links(np.frombuffer(elements, np.uint64), comp, len(own))]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])
            out = []
    return (both.repartition("x", "y").sortWithinPartitions("x", "y", "role", "sid").mapInArrow(run, "a long, b long"))


def _across(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Links (a, b) that join components of tiles that are more than one task's
    work: classes outside a tile's largest component, in chunks, against all of
    the tile. rows (pivot, sid, comp, elements); large (pivot, m, e)."""
    sizes = rows.groupBy("pivot", "comp").agg(F.count("*").alias("c"))
    most = sizes.groupBy("pivot").agg(F.max_by("comp", F.struct("c", "comp")).alias("most"))
    chunks = F.ceil(F.greatest(F.col("m") / GROUP, F.col("e") / ELEMENTS))
    tiles = stored(large.join(most, "pivot").select(F.col("pivot").alias("_p"), "most", chunks.alias("chunks"), F.ceil(F.col("m") / STREAM).alias("lanes")), "jaccard-large-tiles")
    rows = rows.join(maybe_broadcast(tiles, 40), F.col("pivot") == F.col("_p"))
    chunk, lane = F.pmod(F.xxhash64("sid", F.lit(1)), F.col("chunks")), F.pmod(F.xxhash64("sid", F.lit(2)), F.col("lanes"))
    outside = rows.where(F.col("comp") != F.col("most")).withColumn("x", F.xxhash64("pivot", chunk))
    held = outside.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))).select("x", "y", "sid", "comp", "elements")
    used = outside.select(F.col("pivot").alias("_u"), "x").distinct()
    passing = rows.withColumn("y", lane).join(used, F.col("pivot") == F.col("_u")).select("x", "y", "sid", "comp", "elements")
    return _past(held, passing)


def _near(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow a link."""
    def bound(part: pa.RecordBatch):
        keep = []
        for x, y, na, nb in zip(*(part.column(c).to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b"))):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            size = min(len(x), len(y))
            x, y = folded(x, size), folded(y, size)
            keep.append(bool(reachable(na, nb, int(np.bitwise_count(x & ~y).sum()), int(np.bitwise_count(y & ~x).sum()))))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], names=["a", "b"])

    def side(x):
        return bits.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    near = pairs.join(side("b"), "b").join(side("a"), "a").where(f"{OF} * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    return batches(near.select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), bound, "a long, b long")


def class_labels(sigs: DataFrame, docs: DataFrame) -> DataFrame | None:
    """(sid, label) of the classes that have links; label is the smallest sid
    of the component. ``sigs`` is the stored result of ``signatures(docs)``."""
    members = stored(_members(sigs), "jaccard-tiles")
    if members.isEmpty():
        return None
    central = stored(members.groupBy("sid").agg(F.sum(F.col("k") * F.col("m")).alias("c")), "jaccard-central")
    bits = stored(sigs.where("n > 0").select("sid", "n", "bits").join(central.select("sid"), "sid", "left_semi")
                  .groupBy("sid").agg(F.max("n").alias("n"), F.max("bits").alias("bits")), "jaccard-bits")
    ranked = members.join(maybe_broadcast(central, 16), "sid")
    pivots = ranked.groupBy("h").agg(F.max(F.struct("c", "sid")).alias("p")).select("h", F.col("p.sid").alias("pivot"))
    cover = stored(members.join(pivots, "h").groupBy("pivot", "sid").agg(F.sum("k").alias("k")), "jaccard-cover")

    discard(members, central)

    # star: each class against the centre it shares most tiles with
    tried = (cover.where(F.col("pivot") != F.col("sid")).groupBy("sid").agg(F.max(F.struct("k", "pivot"))["pivot"].alias("a"))
             .select("a", F.col("sid").alias("b")))
    near = stored(_near(tried, bits), "jaccard-near")
    sets = stored(_sets(docs, sigs, near.select(F.col("a").alias("sid")).union(near.select(F.col("b").alias("sid")))), "jaccard-sets")
    plain = sets.groupBy("sid").agg(F.max("elements").alias("elements"))
    dealt = near.withColumn("y", F.pmod(F.xxhash64("b"), F.lit(64))).withColumnRenamed("a", "x")
    passing = dealt.withColumnRenamed("b", "sid").withColumn("comp", F.col("sid")).join(plain, "sid")
    held = dealt.select("x", "y").distinct().withColumn("sid", F.col("x")).withColumn("comp", F.col("x")).join(plain, "sid")
    edges = stored(_past(held, passing), "jaccard-links")
    discard(near, sets)
    labels = components(edges)

    # tiles that still hold several components
    now = (cover.join(maybe_broadcast(labels.withColumnRenamed("v", "sid"), 16), "sid", "left")
           .select("pivot", "sid", F.coalesce("label", "sid").alias("comp")))
    spread = now.groupBy("pivot").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("m")).where("c0 <> c1").select("pivot", "m")
    open_ = stored(now.join(spread, "pivot"), "jaccard-open")
    active = stored(open_.join(_active(open_, bits), ["pivot", "sid"]).select("pivot", "sid", "comp"), "jaccard-active")
    discard(open_, bits, cover)
    if active.isEmpty():
        return labels.select(F.col("v").alias("sid"), "label")
    sets = _sets(docs, sigs, active).groupBy("sid").agg(F.max("elements").alias("elements"))
    rows = stored(active.join(sets, "sid"), "jaccard-active-sets")
    large = rows.groupBy("pivot").agg(F.count("*").alias("m"), F.sum(F.octet_length("elements") / 8).alias("e"))
    large = stored(large.where((F.col("m") > GROUP) | (F.col("e") > ELEMENTS)), "jaccard-large")
    side = maybe_broadcast(large.select("pivot"), 8)
    more = _within(rows.join(side, "pivot", "left_anti"))
    if not large.isEmpty():
        more = more.unionByName(_across(rows.join(side, "pivot", "left_semi"), large))
    more = stored(more, "jaccard-more")
    discard(rows, active)
    if not more.isEmpty():
        labels = components(edges.unionByName(more))
    return labels.select(F.col("v").alias("sid"), "label")


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, key, n, sid, label (smallest sid reachable by links; null for an
    empty set): one row per input row, stored."""
    sigs = stored(signatures(docs), "jaccard-signatures")
    labels = class_labels(sigs, docs)
    rows = sigs.select("doc_id", "key", "n", "sid")
    rows = rows.withColumn("label", F.col("sid")) if labels is None else rows.join(labels, "sid", "left").select(
        "doc_id", "key", "n", "sid", F.coalesce("label", "sid").alias("label"))
    out = stored(rows, "jaccard-labelled")
    discard(sigs)
    return out


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links);
    one row per input row."""
    rows = labelled(docs.select("doc_id", "text"))
    least = rows.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return (rows.join(least, "label", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of linked documents, with the columns of
    ``docs``: the one of smallest doc_id (of several texts of that id, the one of
    smallest set id). Of equal (doc_id, text) rows of a group one stays. Other texts
    of an id are rows of their own: they stay unless their own group has another
    document to keep. Rows with an empty set or a null doc_id stay."""
    rows = labelled(docs.select("doc_id", "text")).where("n > 0 AND doc_id IS NOT NULL")
    best = rows.groupBy("label").agg(F.min(F.struct("doc_id", "sid", "key")).alias("best"))
    each = rows.groupBy("doc_id", "sid", "key", "label").agg(F.count("*").alias("copies"))
    kept = F.struct("doc_id", "sid", "key") == F.col("best")
    touched = (each.join(best, "label").select(F.col("doc_id").alias("_j_id"), F.col("key").alias("_j_key"), (~kept).alias("_j_goes"), "copies")
               .where("_j_goes OR copies > 1").drop("copies"))
    touched = stored(touched, "jaccard-touched")
    # the table's columns under names of their own, so that none can clash
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[docs[c].alias(n) for c, n in at.items()], row_key().alias("_j_row"))
    told = plain.join(maybe_broadcast(touched, 24), (F.col(at["doc_id"]) == F.col("_j_id")) & (F.col("_j_row") == F.col("_j_key")), "left")
    same = Window.partitionBy("_j_id", "_j_key").orderBy(F.xxhash64(*[n for c, n in at.items() if c != "text"]))
    copies = told.where(~F.col("_j_goes")).withColumn("_j_n", F.row_number().over(same)).where("_j_n = 1")
    names = list(at.values())
    return told.where("_j_goes IS NULL").select(*names).unionByName(copies.select(*names)).toDF(*docs.columns)
