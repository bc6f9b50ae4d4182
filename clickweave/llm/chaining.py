"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

A passage of a document is *repeated* when an earlier document (smaller
doc_id) holds the same words up to small edits: at least ``MIN_WORDS`` words,
of which at least ``IDENTITY`` match in order.

Plan: (1) each text is sketched by minimizers: of every ``WINDOW``
neighbouring k-mers of words the one with the smallest hash is a seed, so two
texts that agree over WINDOW + K - 1 words share one. Most seeds occur once:
their 32-bit keys are marked by range in one thin shuffle, and a second pass emits only
seeds whose key, by a bitmap of fixed size, occurs again; (2) those seeds meet
the *first* occurrence of their hash (smallest doc_id, place) in one shuffle and
one sort, so a passage in n documents makes n matches, not n^2. Runs of ``RUN`` words whose own
minimizers all occur again are seeds as well, however their lines and short seeds
are spread; of every ``APART`` neighbouring runs the one of smallest hash is kept,
so any MIN_WORDS equal words in a row hold one, the same one in both documents; (3) per pair
(document, earlier document) with a run or two seeds, matches are chained: a chain's score is the words it covers less a
gap cost linear in the distances skipped in both texts, and the best
predecessor is found with a Fenwick tree of prefix maxima over the places in
the earlier text; (4) chains are aligned on the words: ends are extended, gaps
between runs are aligned by longest common subsequence, and every piece of a
chain that is long and alike enough, and lies in no larger such piece, is
returned: a gap too wide to be part of a passage parts two passages.

Words are split at ASCII white space and compared with A-Z lower-cased.

Edge cases: null, empty and short texts hold no passage; null doc_id takes no
part; rows of equal doc_id count as one document (the text of smallest hash
speaks for it, and ``without_repeats`` leaves other texts of that id as they
are); repeats inside one document do not count; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, bit_map, marked, maybe_broadcast, mix, repeated_in, shingles, stored, utf8, words

K = 5
WINDOW = 4
MIN_WORDS = 50
#: Neighbouring runs of which one is kept (a power of two), and their words:
#: MIN_WORDS words hold APART runs.
APART = 8
RUN = MIN_WORDS - APART + 1
IDENTITY = 0.75
#: Gap cost per word skipped in either text; a chain breaks where it would go
#: below zero.
GAP = 0.1
#: Words that alignment may add on either side of a chain.
REACH = 64
#: Mismatching words in a row that end an extension.
DROP = 4


#: Multiplier of window hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_BACK = pow(BASE, -1, 2**64)


def sketch(texts: pa.Array):
    """(word hashes, first word of each text, text of each word, k-mer hash of
    each word, whether the k-mer lies in its text, place of the smallest k-mer
    of each WINDOW, whether that window lies in one text)."""
    raw, off = utf8(texts)
    word, first, _, _ = words(raw, off)
    code, inside = shingles(word, first, K)
    n = len(code)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.where(inside, mix(code ^ np.uint64(0x5851F42D4C957F2D)), np.uint64(2**64 - 1))
    if n < WINDOW:
        return word, first, row, code, inside, np.zeros(0, np.int64), np.zeros(0, bool)
    at = least_places(order, WINDOW)
    whole = row[: len(at)] == row[WINDOW - 1:]
    return word, first, row, code, inside, at, whole & inside[WINDOW - 1:][: len(at)]


def seeds_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word place, k-mer hash) of the minimizers of each text."""
    _, first, row, code, inside, at, whole = sketch(texts)
    return _minimizers(first, row, code, inside, at, whole)


def _minimizers(first, row, code, inside, at, whole):
    picked = np.unique(at[whole])
    picked = picked[inside[picked]]
    return row[picked], picked - first[row[picked]], code[picked]


def least_places(order: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest of each ``span`` neighbours (a power of two)."""
    best, at, have = order, np.arange(len(order)), 1
    while have < span:
        later = best[have:] < best[:-have]
        best = np.where(later, best[have:], best[:-have])
        at = np.where(later, at[have:], at[: len(at) - have])
        have *= 2
    return at


def runs_of(word, first, row, code, at, whole, again: np.ndarray):
    """(row, word place, hash) of the runs of RUN words that may occur again (all
    minimizers that such a run has by itself, whatever is around it, are marked
    in ``again``) and are the smallest of APART neighbours in their text."""
    n, inner = len(word), RUN - K - WINDOW + 2
    if n < MIN_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(n, BASE, np.uint64))
        back = np.multiply.accumulate(np.full(n, BASE_BACK, np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word * power, dtype=np.uint64)))
        value = mix((total[RUN:] - total[:-RUN]) * back[: n - RUN + 1])
    kept = least_places(value, APART)
    kept = np.unique(kept[row[: len(kept)] == row[MIN_WORDS - 1:]])
    ok = whole.copy()
    ok[whole] = marked(again, code[at[whole]] >> np.uint64(64 - KEY_BITS))
    count = np.concatenate(([0], np.cumsum(ok)))
    kept = kept[count[kept + inner] - count[kept] == inner]
    return row[kept], kept - first[row[kept]], value[kept]


class Fenwick:
    """Prefix maxima of (value, index) over places 0..n-1."""

    def __init__(self, n: int):
        self.value, self.index = [-1e18] * (n + 1), [-1] * (n + 1)

    def put(self, place: int, value: float, index: int) -> None:
        place += 1
        while place < len(self.value):
            if value > self.value[place]:
                self.value[place], self.index[place] = value, index
            place += place & -place

    def best(self, place: int) -> tuple[float, int]:
        """Largest value at places before ``place``."""
        top, index = -1e18, -1
        while place > 0:
            if self.value[place] > top:
                top, index = self.value[place], self.index[place]
            place -= place & -place
        return top, index


def distinct(pair: np.ndarray, at: np.ndarray, there: np.ndarray, n: np.ndarray):
    """The matches (pair, place here, place there, words) once each, sorted."""
    order = np.lexsort((n, there, pair << 32 | at))
    pair, at, there, n = (x[order] for x in (pair, at, there, n))
    new = np.ones(len(order), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (at[1:] != at[:-1]) | (there[1:] != there[:-1]) | (n[1:] != n[:-1])
    return pair[new], at[new], there[new], n[new]


def merged(pair: np.ndarray, at: np.ndarray, there: np.ndarray, n: np.ndarray):
    """Distinct matches as diagonal runs (pair, i, j, words), sorted."""
    if not len(pair):
        return pair, at, there, n
    side = (pair << 33) + (at - there + (1 << 32))
    order = np.argsort(side, kind="stable")
    pair, at, there, n, side = (x[order] for x in (pair, at, there, n, side))
    fresh = np.ones(len(order), bool)
    fresh[1:] = side[1:] != side[:-1]
    # the furthest end so far on the same diagonal
    end = np.maximum.accumulate((np.cumsum(fresh) << 33) + at + n) & ((1 << 33) - 1)
    fresh[1:] |= at[1:] > end[:-1] + WINDOW
    start = np.flatnonzero(fresh)
    pair, i, j, n = pair[start], at[start], there[start], end[np.append(start[1:], len(order)) - 1] - at[start]
    order = np.lexsort((n, j, pair << 32 | i))
    return pair[order], i[order], j[order], n[order]


def needed(pair: np.ndarray, at: np.ndarray, there: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which of the distinct matches stay: of the long matches of periodic text
    that begin at one place there, those that lie inside their neighbours here
    go, and the rest covers the same words."""
    keep = np.ones(len(at), bool)
    long = np.flatnonzero(n > K)
    long = long[np.lexsort((at[long], n[long], pair[long] << 32 | there[long]))]
    new = np.ones(len(long), bool)
    new[1:] = (pair[long][1:] != pair[long][:-1]) | (there[long][1:] != there[long][:-1]) | (n[long][1:] != n[long][:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(long)))
    for s, m in zip(start[size > 2].tolist(), size[size > 2].tolist()):
        rows = long[s:s + m]
        places, words_ = at[rows].tolist(), int(n[rows[0]])
        kept = places[0]
        for row, i, after in zip(rows[1:-1].tolist(), places[1:-1], places[2:]):
            if after > kept + words_:
                kept = i
            else:
                keep[row] = False
    return keep


def _columns(matches: list[tuple]) -> list[np.ndarray]:
    rows = np.array([(0, i, j, *(n or (K,))) for i, j, *n in matches], np.int64).reshape(-1, 4)
    return distinct(*rows.T)


def tiled(matches: list[tuple]) -> list[tuple]:
    """The matches (place here, place there, words) of one pair that are needed."""
    rows = _columns(matches)
    keep = needed(*rows)
    return list(zip(*(x[keep].tolist() for x in rows[1:])))


def chains(matches: list[tuple]) -> list[list[tuple[int, int, int]]]:
    """Best local chains of the matches (place here, place there[, words]) of one
    pair, as lists of runs; each run belongs to one chain."""
    runs = list(zip(*(x.tolist() for x in merged(*_columns(matches))[1:])))
    return [[runs[r] for r in chain] for chain in linked(runs)]


def linked(runs: list[tuple[int, int, int]]) -> list[list[int]]:
    """Best local chains of the sorted runs of one pair, as lists of indices."""
    if len(runs) == 1:
        return [[0]]
    # a run may follow one that ends before it in both texts (ends are shortened
    # by K - 1 so that overlapping seeds of neighbouring diagonals may follow)
    there = sorted({j + n - K for _, j, n in runs} | {j for _, j, _ in runs})
    place = {j: k for k, j in enumerate(there)}
    tree = Fenwick(len(there))
    score, before = [0.0] * len(runs), [-1] * len(runs)
    waiting = sorted(range(len(runs)), key=lambda r: runs[r][0] + runs[r][2] - K)
    w = 0
    for r, (i, j, n) in enumerate(runs):
        while w < len(waiting) and runs[waiting[w]][0] + runs[waiting[w]][2] - K < i:
            x = waiting[w]
            a, b, m = runs[x]
            tree.put(place[b + m - K], score[x] + GAP * (a + b + 2 * m), x)
            w += 1
        top, x = tree.best(place[j])
        gain = top - GAP * (i + j)
        score[r] = n + max(0.0, gain)
        before[r] = x if gain > 0 else -1
    used, out = [False] * len(runs), []
    for r in sorted(range(len(runs)), key=lambda r: -score[r]):
        if used[r]:
            continue
        chain = []
        while r >= 0 and not used[r]:
            used[r] = True
            chain.append(r)
            r = before[r]
        out.append(chain[::-1])
    return out


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short gaps."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        hit = np.where(b == x, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], hit))
    return int(row[-1])


#: Words that an extension looks at first.
GLANCE = 32


def extended(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words taken, words equal) walking both arrays from their start: goes on
    through single edits, ends at DROP mismatches in a row, and gives back the
    trailing mismatches."""
    n, m = min(len(a), len(b)), GLANCE
    while True:
        same = a[:min(m, n)] == b[:min(m, n)]
        hits = np.flatnonzero(same)
        # places before the first hit, between hits and after the last one
        gap = np.diff(np.concatenate(([-1], hits, [len(same)])))
        stop = np.flatnonzero(gap > DROP)
        if len(stop) or m >= n:
            hits = hits[:stop[0]] if len(stop) else hits
            return (int(hits[-1]) + 1, len(hits)) if len(hits) else (0, 0)
        m *= 4


def extensions(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, limit: np.ndarray, step: int):
    """``extended`` from all places x of a and y of b at once, by at most
    ``limit`` words forwards (step 1) or backwards (step -1)."""
    k = np.arange(GLANCE)
    inside = k < limit[:, None]
    same = inside & (a[np.where(inside, x[:, None] + step * k, 0)] == b[np.where(inside, y[:, None] + step * k, 0)])
    near = same[:, DROP - 1:].copy()
    for d in range(DROP - 1):
        near |= same[:, d:GLANCE - DROP + 1 + d]
    ended = ~near.all(axis=1)
    same &= k < np.where(ended, near.argmin(axis=1), GLANCE)[:, None]
    equal = same.sum(axis=1)
    taken = np.where(equal > 0, GLANCE - same[:, ::-1].argmax(axis=1), 0)
    for r in np.flatnonzero(~ended & (limit > GLANCE)).tolist():
        i, j, m = int(x[r]), int(y[r]), int(limit[r])
        s, t = (a[i:i + m], b[j:j + m]) if step > 0 else (a[i - m + 1:i + 1][::-1], b[j - m + 1:j + 1][::-1])
        taken[r], equal[r] = extended(s, t)
    return taken, equal


class Side:
    """One side of a batch of pairs: the 32-bit words of all windows, and each
    window's first word, number of words and place in its document."""

    def __init__(self, column: pa.Array, place: pa.Array):
        column = column.cast(pa.large_binary())
        off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        data = column.buffers()[2]
        self.words = np.frombuffer(data, np.uint8)[off[0]:off[-1]].view(np.uint32) if off[-1] > off[0] else np.zeros(1, np.uint32)
        self.at, self.size, self.place = (off[:-1] - off[0]) // 4, np.diff(off) // 4, place.to_numpy().astype(np.int64)

    def bounds(self, row: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(first word, end) of the places from REACH words before ``start`` to
        REACH words after ``end``, as far as the rows' windows hold them."""
        low, high = start - REACH - self.place[row], end + REACH - self.place[row]
        high = np.clip(high, 0, self.size[row])
        return self.at[row] + np.clip(low, 0, high), self.at[row] + high


#: Words of runs and extensions that are aligned at once.
ALIGNED = 1 << 19


def align(a: Side, b: Side, row: np.ndarray, first: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray):
    """Every maximal piece of each chain, from one run to the same or a later one,
    with MIN_WORDS and IDENTITY: (chain, start, end, first_start, first_end,
    matched), by chain. Chain c is of pair ``row[c]`` and has the runs (x, y, n)
    from ``first[c]`` up to ``first[c + 1]``. A gap counts only for pieces that
    reach over it; a piece's own ends are extended."""
    ahead = np.concatenate(([0], np.cumsum(n + 2 * GLANCE)))[first]
    c = 0
    while c < len(row):
        d = max(c + 1, int(np.searchsorted(ahead, ahead[c] + ALIGNED, "right")) - 1)
        s, e = first[c], first[d]
        for k, *piece in _aligned(a, b, row[c:d], first[c:d + 1] - s, x[s:e], y[s:e], n[s:e]):
            yield (c + k, *piece)
        c = d


def _aligned(a: Side, b: Side, row, first, x, y, n):
    head, tail = first[:-1], first[1:] - 1
    (a_low, a_high), (b_low, b_high) = (side.bounds(row, p[head], p[tail] + n[tail]) for side, p in ((a, x), (b, y)))
    chain = np.repeat(np.arange(len(row)), np.diff(first))
    # overlap with the run before, in either text; runs end K words apart at least
    over = np.zeros(len(x), np.int64)
    over[1:] = np.maximum(np.maximum(x[:-1] + n[:-1] - x[1:], y[:-1] + n[:-1] - y[1:]), 0)
    over[head] = 0
    x, y, n = x + over, y + over, n - over
    u, v = x - a.place[row[chain]] + a.at[row[chain]], y - b.place[row[chain]] + b.at[row[chain]]
    a_low, a_high, b_low, b_high = a_low[chain], a_high[chain], b_low[chain], b_high[chain]
    # words of a run that both windows hold (all, but where rows of one id differ)
    held = np.clip(np.minimum(a_high - u, b_high - v), 0, n)
    at = np.cumsum(held) - held
    k = np.arange(int(held.sum())) - np.repeat(at, held)
    same = a.words[np.repeat(u, held) + k] == b.words[np.repeat(v, held) + k]
    total = np.concatenate(([0], np.cumsum(same)))
    equal = total[at + held] - total[at]
    l, l_equal = extensions(a.words, b.words, u - 1, v - 1, np.where(held > 0, np.minimum(u - a_low, v - b_low), 0), -1)
    r, r_equal = extensions(a.words, b.words, u + n, v + n, np.minimum(a_high - u, b_high - v) - n, 1)
    ends = np.stack((x - l, y - l, x + n + r, y + n + r), axis=1)
    # gaps after each run: at most as many words in common as the shorter side has
    inside, exact = np.zeros(len(x), np.int64), np.ones(len(x), bool)
    if len(x) > 1:
        inside[:-1] = np.minimum(u[1:] - u[:-1], v[1:] - v[:-1]) - n[:-1]
        inside[tail] = 0
        exact = inside == 0
    size = (np.maximum.reduceat(ends[:, 2:], head) - np.minimum.reduceat(ends[:, :2], head)).min(axis=1)
    most = np.add.reduceat(equal + inside, head) + np.maximum.reduceat(l_equal, head) + np.maximum.reduceat(r_equal, head)
    for c in np.flatnonzero((size >= MIN_WORDS) & (most >= IDENTITY * MIN_WORDS)).tolist():
        s, e = int(first[c]), int(first[c + 1])
        if e == s + 1:
            i, j, i1, j1 = ends[s].tolist()
            if most[c] >= IDENTITY * max(i1 - i, j1 - j):
                yield c, i, i1, j, j1, int(most[c])
            continue
        common, known = inside[s:e - 1].copy(), exact[s:e - 1].copy()
        while True:
            upto = np.cumsum(equal[s:e])
            upto[1:] += np.cumsum(common)
            taken, given = upto + r_equal[s:e], upto - equal[s:e] - l_equal[s:e]
            found = pieces(ends[s:e], taken, given)
            open_ = {g for f, t in found for g in range(f, t) if not known[g]}
            if not open_:
                break
            for g in open_:
                p, q = s + g, s + g + 1
                common[g], known[g] = common_words(a.words[u[p] + n[p]:min(u[q], a_high[p])], b.words[v[p] + n[p]:min(v[q], b_high[p])]), True
        for f, t in found:
            (i, j), (i1, j1) = ends[s + f, :2].tolist(), ends[s + t, 2:].tolist()
            yield c, i, i1, j, j1, int(taken[t] - given[f])


def pieces(ends: np.ndarray, taken: np.ndarray, given: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (first run, last run) of the pieces that meet MIN_WORDS and
    IDENTITY and lie in no other such pair. A piece from s to e matches
    ``taken[e] - given[s]`` words; identity is asked of both sides."""
    top = [taken - IDENTITY * ends[:, k] for k in (2, 3)]
    low = [given - IDENTITY * ends[:, k] for k in (0, 1)]
    # the largest value from each run on, falling: where it last reaches a bound
    falling = [-np.maximum.accumulate(t[::-1])[::-1] for t in top]
    out, last = [], -1
    for s in range(len(ends)):
        stop = min(int(np.searchsorted(f, -l[s], "right")) for f, l in zip(falling, low))
        at = max(s, last + 1)
        if at >= stop:
            continue
        good = (top[0][at:stop] >= low[0][s]) & (top[1][at:stop] >= low[1][s])
        good &= (ends[at:stop, 2:] - ends[s, :2]).min(axis=1) >= MIN_WORDS
        if good.any():
            last = at + int(np.flatnonzero(good)[-1])
            out.append((s, last))
    return out


#: Bits of the maps of seeds that occur again (32 MB) and of documents with
#: chains (8 MB), whatever the input.
KEY_BITS, MAP_BITS = 28, 26
#: Bytes of text that are sketched at once.
PIECE = 512 << 10


def seeds(docs: DataFrame) -> DataFrame:
    """(h, doc, at): minimizers (even h) and runs of RUN words (odd h) that may
    occur more than once."""
    def keys(part: pa.RecordBatch) -> np.ndarray:
        return (seeds_of(part.column("text"))[2] >> np.uint64(32)).astype(np.uint32)

    again = docs.sparkSession.sparkContext.broadcast(repeated_in(docs, keys, KEY_BITS, PIECE))

    def run(part: pa.RecordBatch):
        word, first, row_, code_, inside, at, whole = sketch(part.column("text"))
        row, place, code = _minimizers(first, row_, code_, inside, at, whole)
        hit = marked(again.value, code >> np.uint64(64 - KEY_BITS))
        ids = part.column("doc_id").to_numpy()
        odd = np.uint64(1)
        for row, place, code in ((row[hit], place[hit], code[hit] & ~odd), (*(found := runs_of(word, first, row_, code_, at, whole, again.value))[:2], found[2] | odd)):
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(ids[row]), pa.array(place.astype(np.int32))], names=["h", "doc", "at"])
    return batches(docs, run, "h long, doc long, at int", PIECE)


def matches(docs: DataFrame) -> DataFrame:
    """(doc, first, at, first_at, n): each seed and run against its first
    occurrence, when that is in an earlier document."""
    return matched(seeds(docs))


def matched(rows: DataFrame) -> DataFrame:
    first = F.first(F.struct("doc", "at")).over(Window.partitionBy("h").orderBy("doc", "at"))
    n = F.when(F.col("h") % 2 == 0, K).otherwise(RUN)
    return rows.withColumn("f", first).where("doc <> f.doc").select("doc", F.col("f.doc").alias("first"), "at", F.col("f.at").alias("first_at"), n.alias("n"))


RUNS = "array<array<struct<i:int,j:int,n:int>>>"
#: Matches that are chained at once (or those of one pair).
MATCHES = 1 << 16


def chained(pairs: DataFrame) -> DataFrame:
    """(doc, first, runs, i0, i1, j0, j1): all chains of each pair that has a run
    or seeds at two places, and the words they span."""
    def flush(doc, first, at, there, n):
        """Chains of whole pairs, sorted by pair."""
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (first[1:] != first[:-1])
        start = np.flatnonzero(new)
        pair = np.cumsum(new) - 1
        good = (np.diff(np.append(start, len(doc))) > 1) | np.logical_or.reduceat(n > K, start)
        keep = good[pair]
        rows = distinct(*(x[keep].astype(np.int64) for x in (pair, at, there, n)))
        keep = needed(*rows)
        pair, i, j, n = merged(*(x[keep] for x in rows))
        head = np.flatnonzero(np.diff(pair, prepend=-1))
        order, sizes, counts = [], [], []
        runs = list(zip(i.tolist(), j.tolist(), n.tolist()))
        for s, e in zip(head.tolist(), [*head[1:].tolist(), len(runs)]):
            found = linked(runs[s:e])
            counts.append(len(found))
            for chain in found:
                sizes.append(len(chain))
                order += [s + r for r in chain]
        fields = [pa.array(x[order].astype(np.int32)) for x in (i, j, n)]
        lists = pa.StructArray.from_arrays(fields, ["i", "j", "n"])
        for size in (sizes, counts):
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), lists)
        at = start[pair[head]]
        ends = (np.minimum, i), (np.maximum, i + n), (np.minimum, j), (np.maximum, j + n)
        spans = [(f.reduceat(x, head) if len(head) else x).astype(np.int32) for f, x in ends]
        return pa.RecordBatch.from_arrays([pa.array(doc[at]), pa.array(first[at]), lists, *(pa.array(x) for x in spans)],
                                          names=["doc", "first", "runs", "i0", "i1", "j0", "j1"])

    def run(parts):
        held, count, enough = [], 0, MATCHES
        for part in parts:
            held.append([part.column(k).to_numpy() for k in range(5)])
            count += part.num_rows
            if count >= enough:
                cols = [np.concatenate(x) for x in zip(*held)]
                # the last pair may go on
                last = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield flush(*(x[:cut] for x in cols))
                held, count = [[x[cut:].copy() for x in cols]], count - cut
                enough = max(MATCHES, 2 * count)
        if count:
            yield flush(*(np.concatenate(x) for x in zip(*held)))
    return (pairs.select("doc", "first", "at", "first_at", "n").repartition("doc", "first").sortWithinPartitions("doc", "first")
            .mapInArrow(run, f"doc long, first long, runs {RUNS}, i0 int, i1 int, j0 int, j1 int"))


def _word_arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, word_hashes binary, text_hash) of the wanted documents, one row an
    id; 32 bits a word. A bitmap of fixed size of the wanted ids picks documents
    in the scan, so no text is shuffled; extra ones do no harm."""
    bit = F.shiftrightunsigned(F.xxhash64("doc"), 64 - MAP_BITS).alias("bit")
    picked = docs.sparkSession.sparkContext.broadcast(bit_map(wanted.select(bit), MAP_BITS))

    def run(part: pa.RecordBatch):
        part = part.filter(pa.array(marked(picked.value, part.column("bit").to_numpy().astype(np.uint64))))
        raw, off = utf8(part.column("text"))
        word, first, _, _ = words(raw, off)
        word = word.astype(np.uint32)
        out = [word[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("text_hash"), pa.array(out, pa.binary())], names=["doc", "text_hash", "word_hashes"])
    some = docs.select(F.col("doc_id").alias("doc"), "text", F.xxhash64("text").alias("text_hash")).select("*", bit)
    found = batches(some, run, "doc long, text_hash long, word_hashes binary")
    return found.groupBy("doc").agg(F.min(F.struct("text_hash", "word_hashes")).alias("x")).select("doc", "x.*")


#: Pairs with one earlier document from which on its words are broadcast to them.
HOT = 1 << 15


def passages(docs: DataFrame) -> DataFrame:
    """One row per repeated passage: doc_id, start_word, end_word, first_doc_id,
    first_start, first_end, matched (words in order), identity, text_hash."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    found = stored(chained(matches(docs)), "chain-chains")
    ids = found.select("doc").union(found.select(F.col("first").alias("doc"))).distinct()
    # read by both joins, from one shuffle by id
    arrays = _word_arrays(docs, ids)

    # each side gives only the words around the chains of a pair: 4 bytes a word
    def window(i0: str, i1: str):
        start = F.greatest(F.col(i0) - REACH, F.lit(0))
        return start, F.substring("word_hashes", start * 4 + 1, (F.col(i1) + REACH - start) * 4)

    def sides(found: DataFrame, other: DataFrame) -> DataFrame:
        s, cut = window("i0", "i1")
        here = found.join(arrays, "doc").select("doc", "text_hash", "first", "runs", "j0", "j1", s.alias("a0"), cut.alias("a"))
        s, cut = window("j0", "j1")
        return here.join(other, "first").select("doc", "text_hash", "first", "runs", "a0", "a", s.alias("b0"), cut.alias("b"))

    other = arrays.select(F.col("doc").alias("first"), "word_hashes")
    hot = found.groupBy("first").count().where(F.col("count") > HOT).select("first")
    if hot.isEmpty():
        both = sides(found, other)
    else:  # the pairs of a document that very many repeat stay where they are
        hot = maybe_broadcast(stored(hot, "chain-hot"), 8)
        few = stored(other.join(hot, "first", "left_semi"), "chain-hot-words")
        both = sides(found.join(hot, "first", "left_anti"), other).union(
            sides(found.join(hot, "first", "left_semi"), maybe_broadcast(few, F.octet_length("word_hashes"))))

    def run(part: pa.RecordBatch):
        out, runs = [], part.column("runs")
        lists = runs.flatten()
        flat = lists.flatten()
        row = np.repeat(np.arange(part.num_rows), runs.value_lengths().to_numpy())
        size = lists.value_lengths().to_numpy()
        here, other = Side(part.column("a"), part.column("a0")), Side(part.column("b"), part.column("b0"))
        found = {}
        for chain, *piece in align(here, other, row, np.concatenate(([0], np.cumsum(size, dtype=np.int64))), *(flat.field(k).to_numpy().astype(np.int64) for k in range(3))):
            found.setdefault(int(row[chain]), set()).add(tuple(piece))
        ids = list(zip(*(part.column(k).to_pylist() for k in ("doc", "text_hash", "first"))))
        for at, some in found.items():
            (doc, th, first), reached = ids[at], -1
            for start, end, f0, f1, matched in sorted(some, key=lambda p: (p[0], -p[1])):
                if end > reached:  # not inside another passage of this pair
                    reached = end
                    out.append((doc, start, end, first, f0, f1, matched, matched / max(end - start, f1 - f0), th))
        cols = list(zip(*out)) if out else [[]] * 9
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                         names=["doc_id", "start_word", "end_word", "first_doc_id", "first_start", "first_end", "matched", "identity", "text_hash"])
    return batches(both, run, "doc_id long, start_word int, end_word int, first_doc_id long, first_start int, first_end int, matched int, identity double, text_hash long")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; white space between what is
    left is kept as it was before the removed words."""
    raw = np.frombuffer(text.encode(), np.uint8)
    _, _, start, end = words(raw, np.array([0, len(raw)]))
    keep = np.ones(len(raw), bool)
    for a, b in spans:
        a, b = max(0, a), min(b, len(start))
        if a < b:  # up to the start of the next word
            keep[start[a]:(start[b] if b < len(start) else len(raw))] = False
    return raw[keep].tobytes().decode()


def without_repeats(docs: DataFrame) -> DataFrame:
    """Documents with every repeated passage cut out where it is not first;
    columns of ``docs``. A document of which nothing is left goes."""
    names = docs.columns
    spans = (passages(docs).groupBy(F.col("doc_id").alias("_s_doc"), F.col("text_hash").alias("_s_hash"))
             .agg(F.collect_set(F.struct("start_word", "end_word")).alias("_s_spans")))
    spans = stored(spans, "chain-spans")
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    at = {c: f"c{i}" for i, c in enumerate(names)}
    joined = plain.withColumn("_s_text_hash", F.xxhash64(at["text"])).join(
        spans, (F.col(at["doc_id"]) == F.col("_s_doc")) & (F.col("_s_text_hash") == F.col("_s_hash")), "left")
    columns = plain.columns
    joined = joined.select(*columns, "_s_spans")

    def run(part: pa.RecordBatch):
        texts = [cut_words(t, [(s["start_word"], s["end_word"]) for s in spans]) if spans else t
                 for t, spans in zip(part.column(at["text"]).to_pylist(), part.column("_s_spans").to_pylist())]
        keep = pa.array([not s or bool(t.strip()) for t, s in zip(texts, part.column("_s_spans").to_pylist())])
        cols = [pa.array(texts, pa.string()) if c == "text" else part.column(at[c]) for c in names]
        yield pa.RecordBatch.from_arrays([c.filter(keep) for c in cols], names=columns)
    out = batches(joined, run, plain.schema).withColumnsRenamed({v: k for k, v in at.items()})
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out
