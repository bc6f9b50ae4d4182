"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors are split into blocks; a block keeps, for every dimension, its vectors
sorted by that component. A query walks all lists of a block at once, best
contribution first (from the top for a positive query component, from the
bottom for a negative one), scores every vector that it meets exactly, and stops
when the bound - the score of a vector that would stand at the current depth
of every list - cannot reach the k-th result any more. Blocks share results: a
query first carries the k-th score of a small first look over all blocks, so
most blocks stop early, and a second reduction merges the blocks' lists.

Equal vectors are one class: only the k + 1 smallest ids of a class can be in
any result (equal scores, ties to smaller ids, the query itself left out), so a
vector that occurs a million times costs one row. This loses nothing.

Queries come in blocks too; every (query block, vector block) pair is one group
of bounded size. Components are exact integers: floor(256 * x).

Scores are exact whatever the components: in doubles below 2^53, in 64-bit
integers below 2^63, beyond that in whole numbers of any size. A component that
does not fit a long, or a result that does not, is an error, never a wrong number.

Edge cases: vectors that are null or hold null, NaN or infinite components take
no part; the lengths of vectors may differ (missing components count as 0);
null vec_id takes no part; rows of one vec_id and vector count once; ties go to
the smaller id; fewer than k candidates give all; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import ship, stored

#: Vectors of a block and queries of a block.
BLOCK, QUERIES = 8192, 512
#: Places of every list that are read between two looks at the bound.
STEP = 32


def integers(vector: Column) -> Column:
    """floor(256 * x) of every component; null where any is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fits = F.forall(x, lambda v: F.abs(v) < 2.0 ** 55)
    whole = F.when(fits, F.transform(x, lambda v: F.floor(v * 256).cast("long"))).otherwise(
        F.raise_error(F.lit("a component of 2^55 and more does not fit a 64-bit integer times 256")).cast("array<bigint>"))
    return F.when(vector.isNotNull() & F.coalesce(good, F.lit(False)), whole)


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """(v, ids): distinct vectors with their k + 1 smallest ids. Ids are
    combined per task and class before they are shuffled."""
    rows = vectors.select("vec_id", "v").where("v IS NOT NULL AND vec_id IS NOT NULL").distinct()
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    for keys in (["v", "salt"], ["v"]):
        ranked = (salted.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy("vec_id"))).where(F.col("r") <= k + 1))
        salted = ranked.drop("r")
    return salted.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


class Lists:
    """A block's vectors with one sorted list per dimension."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        self.vectors, self.ids = vectors, ids
        self.first = np.array([x[0] for x in ids], np.int64)
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(vectors.T, self.order, 1)
        # products of doubles are exact as long as every sum stays below 2**53
        self.most = max(-int(vectors.min(initial=0)), int(vectors.max(initial=0))) * vectors.shape[1]
        self.doubles = vectors.astype(np.float64)

    def search(self, q: np.ndarray, own: int, k: int, floor: int) -> tuple[list[tuple[int, int]], int]:
        """Best (score, vec_id) of the block, at most k, none under ``floor``,
        and how many vectors were scored."""
        down, up = np.flatnonzero(q < 0), np.flatnonzero(q > 0)
        n = len(self.vectors)
        if not len(down) and not len(up):
            return self._answer(np.arange(n), np.zeros(n, np.int64), own, k), n
        largest = self.most * max(-int(q.min()), int(q.max()))
        if largest >= 1 << 62:  # products of any size, one number at a time
            table, factor, kind = self.vectors.astype(object), q.astype(object), object
        else:
            table, factor = (self.doubles, q.astype(np.float64)) if largest < 1 << 53 else (self.vectors, q)
            kind = np.int64
        lists, q = (self.sorted, q) if kind is np.int64 else (self.sorted.astype(object), factor)
        seen = np.zeros(n, bool)
        scores = np.empty(n, kind)
        best = np.zeros(0, kind)  # the k + 1 best so far
        depth, step, kth = 0, STEP, floor
        while depth < n:
            upto = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.order[up, n - upto:n - depth]] = True
            met[self.order[down, depth:upto]] = True
            new = np.flatnonzero(met & ~seen)
            if len(new):
                seen[new] = True
                scores[new] = table[new] @ factor
                best = np.concatenate((best, scores[new]))
                # one of them may be the query's own row
                if len(best) > k:
                    best = np.sort(best)[len(best) - k - 1:]
                    kth = max(kth, int(best.min()))
            depth = upto
            # equal scores may still win by id: stop only below the k-th
            bound = int((lists[up, n - depth] * q[up]).sum()) + int((lists[down, depth - 1] * q[down]).sum())
            if bound < kth:
                break
            step *= 2
        got = np.flatnonzero(seen)
        got = got[scores[got] >= kth]
        return self._answer(got, scores[got], own, k), int(seen.sum())

    def _answer(self, rows: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        order = np.lexsort((self.first[rows], -scores)) if scores.dtype != object else np.array(
            sorted(range(len(rows)), key=lambda i: (-scores[i], self.first[rows[i]])), np.int64)
        for r in order.tolist():
            s = int(scores[r])
            if len(out) >= k and s < out[k - 1][0]:
                break
            out += [(s, i) for i in self.ids[rows[r]] if i != own]
            out.sort(key=lambda x: (-x[0], x[1]))
            del out[k:]
        return out


def matrix(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` (vec_id,
    embedding) for every row of ``queries`` (same columns)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select("vec_id", integers(F.col("embedding")).alias("v"))
    table = stored(classes(rows, k), "topk-classes")
    asked = stored(queries.select(F.col("vec_id").alias("query_id"), integers(F.col("embedding")).alias("q"))
                   .where("q IS NOT NULL AND query_id IS NOT NULL").distinct(), "topk-queries")
    n, dims = table.agg(F.count("*"), F.max(F.size("v"))).first()
    m, width = asked.agg(F.count("*"), F.max(F.size("q"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n or not m:
        return spark.createDataFrame([], schema)
    dims = max(dims, width)
    v_blocks, q_blocks = -(-n // BLOCK), -(-m // QUERIES)
    # even blocks by hash: a block holds BLOCK vectors on average
    v_rows = table.withColumn("vb", F.pmod(F.xxhash64("v"), F.lit(v_blocks)).cast("int"))
    q_rows = asked.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int"))

    # a first look: every query against one block gives a floor for the others
    def pairs(first: bool, floors: DataFrame | None):
        home = F.pmod(F.col("qb"), F.lit(v_blocks))
        blocks = F.array(home) if first else F.filter(F.sequence(F.lit(0), F.lit(v_blocks - 1)), lambda b: b != home)
        q = (q_rows if floors is None else q_rows.join(floors, "query_id", "left"))
        q = q.withColumn("floor", F.lit(None).cast("string") if floors is None else F.col("floor").cast("string"))
        left = (q.withColumn("vb", F.explode(blocks)).select("qb", "vb", "query_id", "q", "floor"))
        each = F.sequence(F.lit(0), F.lit(q_blocks - 1))
        if first:
            each = F.filter(each, lambda x: F.pmod(x, F.lit(v_blocks)) == F.col("vb"))
        else:
            each = F.filter(each, lambda x: F.pmod(x, F.lit(v_blocks)) != F.col("vb"))
        right = v_rows.withColumn("qb", F.explode(each)).select("qb", "vb", "v", "ids")
        return left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(run, "query_id long, vec_id long, score long")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(left) and len(right):
            lists = Lists(matrix(list(right["v"]), dims), [list(map(int, x)) for x in right["ids"]])
            q = matrix(list(left["q"]), dims)
            floors = left["floor"].fillna("").tolist()  # carried as text: a double would round it
            for i, (own, floor) in enumerate(zip(left["query_id"].tolist(), floors)):
                found, _ = lists.search(q[i], own, k, int(floor) if floor else -(1 << 200))
                if any(not -(1 << 63) <= s < 1 << 63 for s, _ in found):
                    raise ValueError("a score does not fit a 64-bit integer")
                out += [(own, v, s) for s, v in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    start = stored(pairs(True, None), "topk-first")
    floors = start.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("floor")).where(F.col("c") >= k).select("query_id", "floor")
    found = start if v_blocks == 1 else start.unionByName(pairs(False, floors))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
