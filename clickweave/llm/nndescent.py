"""Near copies among embeddings: NN-descent with threshold edges.

Every distinct vector is a node (copies are counted, not compared). Each node
keeps a list of its nearest nodes found so far, ``FIRST`` of them at the start:

* Start: sign bits of random projections sort the nodes ("a tree"); nodes of
  one stretch of the order are compared with each other. The number of trees
  follows the number of nodes, so that two vectors at the threshold meet in one
  of them with probability 1 - ``MISS``.
* Refinement: all nodes that have a node in their list, or stand in its list, meet
  at it (neighbours of neighbours). Pairs with a side that is new there are
  compared; those better than a list's last entry are sent to the list.
* A list whose entries all reach the threshold is saturated: it is enlarged to
  twice its length, up to ``LONGEST``; what lies beyond is found in the last step.
* Rounds end when lists gain next to no edge that reaches the threshold.
* Only edges of the threshold and above are kept. Their components are then
  compared in full, in tiles of ``TILE`` nodes: this gives the exact number of
  links of every member however dense the group is, with one row a node and pair
  of tiles. A large group whose members all lie within half the threshold angle
  of one node needs no comparison: any two of them are linked.
* Audit: a fixed number of nodes (``AUDIT``) is compared with all nodes; while the
  share of links found is under ``RECALL``, more trees and rounds follow, and an
  error is raised when that does not help.

All cosines are taken in double precision from the vectors themselves; nothing
below the threshold is linked.

Plan: a tree or round moves each node's vector as often as it stands in a list
or tree (range shuffle by centre, so a popular centre is cut into pieces);
blocks of a few hundred rows are compared in numpy. No list, component or set of
vectors goes to the driver, but the audited ones.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own component; vectors of different length are
never linked; equal vectors are linked with each other whatever their id; rows of
one vec_id are rows of their own; the smallest id of a component ignores null, a
component of null ids has none; an empty table gives no rows. Other columns are
not used. A vector of any length is handled whole: a block holds at most a few
hundred of them.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, ship, stored
from .components import components

#: Length of a list at the start, and of the longest list.
FIRST, LONGEST = 8, 32
#: Nodes of a stretch of a tree, and most rows compared at one place.
LEAF, MOST = 64, 256
#: Chance that a pair at the threshold meets in no tree.
MISS = 0.01
TILE = 512
AUDIT, RECALL, TRIES = 1024, 0.97, 4
#: Rounds end when links grow by less than this share.
GROWTH = 0.005
_LIST = "array<struct<sim:double,node:long>>"


def units(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows in doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1))[:, None]


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vec, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors: node, dim, vec, weight (rows), low (smallest id)."""
    found = vectors.where(usable(F.col("vec"))).groupBy("vec").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"))
    return stored(found.select(F.monotonically_increasing_id().alias("node"), F.size("vec").alias("dim"), "vec", "weight", "low"), "nn-nodes")


def blocks(parts: Iterator[pa.RecordBatch], hard: list[str], soft: list[str], least: int, most: int | None) -> Iterator[pa.Table]:
    """Sorted rows in blocks: rows of equal keys stay together, small groups
    share a block until it has ``least`` rows; a change of a ``hard`` key always
    ends a block, and a group is cut into pieces of ``most`` rows."""
    rest = None
    for part in itertools.chain(parts, [None]):
        if part is not None:
            if not part.num_rows:
                continue
            t = pa.Table.from_batches([part])
            if rest is not None:
                t = pa.concat_tables([rest, t]).combine_chunks()
        else:
            t = rest
            if t is None:
                return
        n = t.num_rows
        change = np.zeros(n, bool)
        hard_change = np.zeros(n, bool)
        for keys, marks in ((hard, hard_change), (soft, change)):
            for c in keys:
                v = t.column(c).to_numpy()
                marks[1:] |= v[1:] != v[:-1]
        starts = np.concatenate(([0], np.flatnonzero(change | hard_change)))
        ends = np.concatenate((starts[1:], [n]))
        at = 0
        for s, e in zip(starts.tolist(), ends.tolist()):
            if s > at and (hard_change[s] or s - at >= least or (most and e - at > most)):
                yield t.slice(at, s - at)
                at = s
            while most and e - at > most:
                yield t.slice(at, most)
                at += most
        rest = t.slice(at) if at < n else None
        if part is None and rest is not None:
            yield rest


def _lists(v: np.ndarray, u: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    """Rows (v, nb) from entries sorted by v."""
    first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))) if len(v) else np.zeros(0, np.int64)
    offsets = np.concatenate((first, [len(v)])).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array(sim, pa.float64()), pa.array(u, pa.int64())], names=["sim", "node"])
    return pa.RecordBatch.from_arrays([pa.array(v[first], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), entries)], names=["v", "nb"])


def best(node: np.ndarray, sims: np.ndarray, allowed: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` best allowed columns of every row of a block of nodes."""
    s = np.where(allowed & (node[:, None] != node[None, :]), sims, -np.inf)
    k = min(k, s.shape[1])
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    got = np.take_along_axis(s, top, 1)
    row, col = np.nonzero(got > -np.inf)
    order = np.argsort(node[row], kind="stable")
    row, col = row[order], col[order]
    return _lists(node[row], node[top[row, col]], got[row, col])


def trees(nodes: DataFrame, n: int, threshold: float, seed: int) -> DataFrame:
    """(v, nb) of a fresh set of trees."""
    bits = max(0, math.ceil(math.log2(max(1, n / LEAF))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    count = 1 if agree > 1 - MISS else math.ceil(math.log(MISS) / math.log(1 - agree))
    spread = nodes.select("node", "dim", "vec", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("tree"))

    def codes(parts):
        for part in parts:
            dims, tree = part.column("dim").to_numpy(), part.column("tree").to_numpy()
            code, place = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                u = units(part.column("vec").take(pa.array(own)))
                for t in np.unique(tree[own]).tolist():
                    rows = np.flatnonzero(tree[own] == t)
                    p = u[rows] @ np.random.default_rng([seed, t, d]).standard_normal((d, bits + 1))
                    code[own[rows]] = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    place[own[rows]] = p[:, bits]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("node", "dim", "vec", "tree")], pa.array(code), pa.array(place)],
                                             names=["node", "dim", "vec", "tree", "code", "place"])

    def compare(parts):
        for t in blocks(parts, ["tree", "dim"], ["code"], LEAF, MOST):
            u = units(t.column("vec"))
            if len(u) > 1:
                yield best(t.column("node").to_numpy(), u @ u.T, np.ones((1, 1), bool), FIRST)

    kind = dict(nodes.dtypes)["vec"]
    coded = spread.mapInArrow(codes, f"node long, dim int, vec {kind}, tree int, code long, place double")
    return (coded.repartitionByRange("tree", "dim", "code", "place").sortWithinPartitions("tree", "dim", "code", "place")
            .mapInArrow(compare, f"v long, nb {_LIST}"))


def merged(lists: DataFrame, entries: DataFrame, threshold: float, name: str) -> DataFrame:
    """Lists (v, k, nb, was) after ``entries`` (v, nb): the k best of all, k being
    doubled where a list is saturated; ``was`` names the nodes listed before."""
    every = lists.select("v", "k", "nb", F.transform("nb", lambda x: x["node"]).alias("was")).unionByName(
        entries.select("v", F.lit(0).alias("k"), "nb", F.array().cast("array<long>").alias("was")))
    one = every.groupBy("v").agg(
        F.greatest(F.max("k"), F.lit(FIRST)).alias("k"), F.flatten(F.collect_list("was")).alias("was"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("nb"))), asc=False).alias("nb"))
    full = F.coalesce(F.get("nb", F.col("k") - 1)["sim"] >= threshold, F.lit(False))
    one = one.withColumn("k", F.when(full, F.least(2 * F.col("k"), F.lit(LONGEST))).otherwise(F.col("k")))
    return stored(one.select("v", "k", F.slice("nb", F.lit(1), F.col("k")).alias("nb"), "was"), name)


def joined(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """One refinement: (v, nb) from neighbours of neighbours."""
    pairs = lists.select("v", "was", F.explode("nb").alias("x")).select(
        "v", F.col("x.node").alias("u"), (~F.array_contains("was", F.col("x.node"))).alias("fresh"))
    both = pairs.select(F.col("v").alias("c"), "u", "fresh").unionByName(pairs.select(F.col("u").alias("c"), F.col("v").alias("u"), "fresh"))
    both = both.groupBy("c", "u").agg(F.max("fresh").alias("fresh"))
    bar = lists.select(F.col("v").alias("u"), F.when(F.size("nb") < F.col("k"), -2.0).otherwise(F.element_at("nb", -1)["sim"]).alias("bar"))
    who = nodes.select(F.col("node").alias("u"), "dim", "vec").join(bar, "u", "left").select("u", "dim", "vec", F.coalesce("bar", F.lit(-2.0)).alias("bar"))

    def meet(parts):
        for t in blocks(parts, ["dim"], ["c"], LEAF, MOST):
            fresh = t.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
            if not fresh.any() or t.num_rows < 2:
                continue
            centre, bars = t.column("c").to_numpy(), t.column("bar").to_numpy()
            u = units(t.column("vec"))
            sims = u @ u.T
            allowed = (centre[:, None] == centre[None, :]) & (fresh[:, None] | fresh[None, :]) & (sims > bars[:, None])
            yield best(t.column("u").to_numpy(), sims, allowed, FIRST)

    return (both.join(who, "u").repartitionByRange("dim", "c", "u").sortWithinPartitions("dim", "c", "u")
            .mapInArrow(meet, f"v long, nb {_LIST}"))


def links_listed(lists: DataFrame, threshold: float) -> int:
    """Entries that reach the threshold, at most FIRST a node."""
    n = F.least(F.size(F.filter("nb", lambda x: x["sim"] >= threshold)), F.lit(FIRST))
    return lists.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]


def descend(nodes: DataFrame, n: int, lists: DataFrame | None, threshold: float, seed: int) -> DataFrame:
    """Lists after fresh trees and refinement rounds."""
    if lists is None:
        lists = nodes.sparkSession.createDataFrame([], f"v long, k int, nb {_LIST}, was array<long>")
    lists = merged(lists, trees(nodes, n, threshold, seed), threshold, "nn-lists")
    have = links_listed(lists, threshold)
    while True:
        lists = merged(lists, joined(nodes, lists), threshold, "nn-lists")
        now = links_listed(lists, threshold)
        if now - have <= GROWTH * now:
            return lists
        have = now


# ---------------------------------------------------------------- links


def labelled(nodes: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """Nodes of components of two and more: node, dim, vec, weight, low, comp
    (its smallest node), size (nodes of the component)."""
    edges = stored(lists.select(F.col("v").alias("a"), F.explode(F.filter("nb", lambda x: x["sim"] >= threshold)["node"]).alias("b")), "nn-edges")
    labels = components(edges)
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    both = labels.join(sizes, "label").select("v", F.col("label").alias("comp"), "size")
    return stored(nodes.join(both, nodes["node"] == both["v"]).drop("v"), "nn-members")


def cliques(members: DataFrame, threshold: float) -> DataFrame:
    """Large components whose members all lie within half the threshold angle
    of their first node, so that any two are linked: (comp, weights)."""
    large = members.where(F.col("size") > TILE)
    pivots = large.where("node = comp").select(F.col("comp").alias("_c"), F.col("vec").alias("pivot"))
    half = math.cos(math.acos(threshold) / 2 - 1e-7)

    def near(parts):
        for part in parts:
            out = np.empty(part.num_rows, bool)
            dims = part.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                own = pa.array(np.flatnonzero(dims == d))
                out[dims == d] = (units(part.column("vec").take(own)) * units(part.column("pivot").take(own))).sum(1) >= half
            yield pa.RecordBatch.from_arrays([part.column("comp"), part.column("weight"), pa.array(out)], names=["comp", "weight", "near"])

    pivots = stored(pivots, "nn-pivots")
    side = maybe_broadcast(pivots, F.size("pivot") * 8 + 16)
    told = large.join(side, large["comp"] == F.col("_c")).select("comp", "weight", "dim", "vec", "pivot").mapInArrow(
        near, "comp long, weight long, near boolean")
    return stored(told.groupBy("comp").agg(F.sum("weight").alias("weights"), F.min("near").alias("all_near")).where("all_near").drop("all_near"), "nn-cliques")


def counted(members: DataFrame, threshold: float) -> DataFrame:
    """(node, others): rows of other nodes linked with each member."""
    whole = cliques(members, threshold)
    side = maybe_broadcast(whole, 16)
    easy = members.join(side, "comp").select("node", (F.col("weights") - F.col("weight")).alias("others"))
    hard = members.join(side, "comp", "left_anti")
    tiles = F.ceil(F.col("size") / TILE)
    hard = hard.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    dealt = hard.select("node", "dim", "vec", "weight", "comp", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select("node", "dim", "vec", "weight", "comp", "tile", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"))

    def compare(parts):
        for t in blocks(parts, ["dim"], ["comp", "p", "q"], TILE, None):
            u = units(t.column("vec"))
            c, p, q, tile, node, weight = (t.column(x).to_numpy() for x in ("comp", "p", "q", "tile", "node", "weight"))
            place = np.cumsum(np.concatenate(([0], (c[1:] != c[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]))))
            fits = (u @ u.T >= threshold) & (place[:, None] == place[None, :])
            across = p != q  # two tiles meet: pairs inside one are counted elsewhere
            fits &= ~across[:, None] | (tile[:, None] != tile[None, :])
            np.fill_diagonal(fits, False)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(fits @ weight)], names=["node", "others"])

    told = (dealt.repartition("comp", "p", "q").sortWithinPartitions("dim", "comp", "p", "q", "tile", "node")
            .mapInArrow(compare, "node long, others long").groupBy("node").agg(F.sum("others").alias("others")))
    return easy.unionByName(told)


def audit(nodes: DataFrame, found: DataFrame, n: int, threshold: float, seed: int) -> float:
    """Share of the links of ``AUDIT`` nodes, drawn by hash and compared with all
    nodes, that ``found`` (node, others) has."""
    some = nodes.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(max(1, n // AUDIT))) == 0).limit(2 * AUDIT)
    some = some.join(found, "node", "left").select("node", "dim", "vec", F.coalesce("others", F.lit(0)).alias("others")).toArrow()
    if not some.num_rows:
        return 1.0
    dims = some.column("dim").to_numpy()
    asked = {d: (np.flatnonzero(dims == d), units(some.column("vec").take(pa.array(np.flatnonzero(dims == d))))) for d in np.unique(dims).tolist()}
    sent = nodes.sparkSession.sparkContext.broadcast((asked, some.column("node").to_numpy()))

    def compare(parts):
        asked, names = sent.value
        total = np.zeros(len(names), np.int64)
        for part in parts:
            own_dims = part.column("dim").to_numpy()
            for d, (rows, q) in asked.items():
                own = np.flatnonzero(own_dims == d)
                for at in range(0, len(own), MOST):
                    piece = own[at:at + MOST]
                    fits = q @ units(part.column("vec").take(pa.array(piece))).T >= threshold
                    fits &= names[rows][:, None] != part.column("node").to_numpy()[piece][None, :]
                    total[rows] += fits @ part.column("weight").to_numpy()[piece]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names))), pa.array(total)], names=["i", "n"])

    true = np.zeros(some.num_rows, np.int64)
    rows = nodes.select("node", "dim", "vec", "weight").mapInArrow(compare, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    true[rows["i"].to_numpy()] = rows["n"].to_numpy()
    return float(np.minimum(some.column("others").to_numpy(), true).sum() / true.sum()) if true.sum() else 1.0


def near_copies(vectors: DataFrame, threshold: float = 0.95, seed: int = 1) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id,
    kept. Links are pairs of rows with a cosine of ``threshold`` and more."""
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", vectors["embedding"].alias("vec"))
    nodes = nodes_of(rows)
    n = nodes.count()
    lists = None
    for attempt in range(TRIES):
        lists = descend(nodes, n, lists, threshold, seed + attempt)
        members = labelled(nodes, lists, threshold)
        found = stored(counted(members, threshold), "nn-links")
        recall = audit(nodes, found, n, threshold, seed + attempt)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"recall of {recall:.3f} after {TRIES} sets of trees")
    least = members.groupBy("comp").agg(F.min("low").alias("component"))
    named = members.select("node", "comp").join(least, "comp").select("node", "component")
    told = (nodes.join(found, "node", "left").join(named, "node", "left")
            .select("vec", F.lit(True).alias("real"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
                    F.coalesce("component", "low").alias("component")))
    good = usable(F.col("vec"))
    linked = rows.where(good).join(told, "vec").select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
