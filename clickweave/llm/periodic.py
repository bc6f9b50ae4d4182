"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words that repeats with its smallest period p over at
least 4 * p words (and at least ``LEAST`` words) and that no neighbouring word
extends.

At each dyadic scale t = 1, 2, 4, ... a set S of positions is chosen by hashes
of the t words that start there: i is in S when the least hash over i..i+t is
that of i or of i+t. Membership depends on the 2t words from i alone, so equal
contexts are chosen alike, and every stretch of 3t-1 words that is not highly
periodic begins with a member among its first t positions. Positions whose t
words have a period of t/4 or less are left out of the choice: there S would be
dense, and those periods are known from the runs of smaller scales.

A run with period p in [t, 2t) has a member i with i+p+2t inside the run; then
i+p is a member too, and because p <= 2t no member between them has the same
context (two periods would leave a smaller one). So each member is paired with
the next member of equal context only - one proposal a member - and the distance
is the period. Proposals of one period that overlap are one stretch; its ends are
extended word by word, which takes less than 4t steps, and every run is
checked on the words themselves.

All documents of a batch are worked on together: words become numbers (equal
words, equal numbers), documents stand in order of falling length, and a scale
looks at the prefix of documents with 4t words and more. Plan: one narrow pass,
no shuffle, no broadcast. Work is about n log n for n words.

Edge cases: a null text has no words; words are split at ASCII white space and
compared as they are written; a text of one word has no run. Equal rows give
equal results, a null doc_id is kept; an empty table gives no rows; other
columns pass when asked for. A document is worked on in one task, at about 20
times its own bytes: a run may span all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches, mix

#: Least length of a run, and least length as a multiple of the period.
LEAST, TIMES = 6, 4
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BLOCK = 64


class _Numbers(dict):
    """Number of each distinct word, in order of first sight."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: out[i] = min(values[i:i+width])."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def same_ahead(w: np.ndarray, x: np.ndarray, y: np.ndarray, stop: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from positions x and y on (in direction ``step``),
    before y (or x, going back) reaches ``stop``."""
    got = np.zeros(len(x), np.int64)
    room = np.maximum(0, (stop - y) if step > 0 else (x - stop + 1))
    open_ = np.flatnonzero(room > 0)
    reach = np.arange(_BLOCK) * step
    top = len(w) - 1
    while len(open_):
        a = x[open_] + got[open_] * step
        b = y[open_] + got[open_] * step
        same = w[np.clip(a[:, None] + reach, 0, top)] == w[np.clip(b[:, None] + reach, 0, top)]
        run = np.where(same.all(1), _BLOCK, same.argmin(1))
        got[open_] = np.minimum(got[open_] + run, room[open_])
        open_ = open_[(run == _BLOCK) & (got[open_] < room[open_])]
    return got


def members(ids: np.ndarray, left_out: np.ndarray | None, t: int) -> np.ndarray:
    """Positions of the synchronising set of scale ``t`` (documents ignored)."""
    h = ids if left_out is None else np.where(left_out, _NONE, ids)
    least = window_least(h, t + 1)
    here, there = h[:len(least)], h[t:t + len(least)]
    return np.flatnonzero((least != _NONE) & ((least == here) | (least == there)))


def proposals(context: np.ndarray, doc: np.ndarray, at: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of members whose next member of equal context
    lies t to 2t-1 words on in the same document."""
    order = np.argsort(context, kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    gap = b - a
    fits = (gap >= t) & (gap < 2 * t) & (context[order[:-1]] == context[order[1:]])
    a, gap = a[fits], gap[fits]
    inside = doc[a] == doc[a + gap]
    return a[inside], gap[inside]


def runs(w: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least TIMES periods in the
    words ``w``; documents lie at ``bounds[d]:bounds[d+1]``, longest first.
    Runs shorter than LEAST are still among them."""
    size = np.diff(bounds)
    doc = np.repeat(np.arange(len(size)), size)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    with np.errstate(over="ignore"):
        ids = mix(w.astype(np.uint64) + np.uint64(1))
    t = 1
    while True:
        docs = int(np.searchsorted(-size, -TIMES * t, side="right"))  # documents of 4t words and more
        n = int(bounds[docs])
        if not n:
            break
        ids, own = ids[:n], doc[:n]
        end = bounds[1:][own]
        if len(ids) > t:
            with np.errstate(over="ignore"):  # hashes of 2t words; those past a document's end are not used
                double = np.zeros(n, np.uint64)
                double[:n - t] = mix(ids[:n - t] * np.uint64(0x9E3779B97F4A7C15) + ids[t:])
            at = members(ids, periodic_starts(found, n, t), t)
            at = at[at + 2 * t <= end[at]]
            if len(at) > 1:
                found += stretches(w, bounds, own, *proposals(double[at], own, at, t), t)
            ids = double
        t *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def periodic_starts(found: list, n: int, t: int) -> np.ndarray | None:
    """Marks positions whose ``t`` words have a period of t / 4 or less: those
    inside runs of smaller scales."""
    edge = None
    for start, length, period in found:
        big = (period * 4 <= t) & (length >= t) & (start < n)
        if big.any():
            edge = np.zeros(n + 1, np.int64) if edge is None else edge
            np.add.at(edge, start[big], 1)
            np.add.at(edge, start[big] + length[big] - t + 1, -1)
    return None if edge is None else np.cumsum(edge[:n]) > 0


def stretches(w: np.ndarray, bounds: np.ndarray, own: np.ndarray, at: np.ndarray, gap: np.ndarray, t: int) -> list:
    """Runs from proposals: overlapping ones of a period are joined, extended
    to both sides and checked."""
    if not len(at):
        return []
    order = np.lexsort((at, gap))
    at, gap = at[order], gap[order]
    new = np.ones(len(at), bool)
    new[1:] = (gap[1:] != gap[:-1]) | (at[1:] > at[:-1] + 2 * t) | (own[at[1:]] != own[at[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    p, lo, hi = gap[first], at[first], at[last] + 2 * t  # words lo..hi-1 equal those p later
    d = own[lo]
    # a run that ends far from its members does not exist: shorter ones need no extension
    hopeful = hi - lo + 8 * t + p >= TIMES * p
    p, lo, hi, d = p[hopeful], lo[hopeful], hi[hopeful], d[hopeful]
    hi = hi + same_ahead(w, hi, hi + p, bounds[d + 1], 1)
    lo = lo - same_ahead(w, lo - 1, lo - 1 + p, bounds[d], -1)
    whole = hi - lo + p >= TIMES * p
    out = sorted({(int(a), int(b - a + q), int(q)) for a, b, q in zip(lo[whole], hi[whole], p[whole])})
    for start, length, q in out:
        if not np.array_equal(w[start:start + length - q], w[start + q:start + length]):
            raise ValueError("a run does not stand the comparison of its words")
    return [tuple(np.array(x, np.int64) for x in zip(*out))] if out else []


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray | None:
    """Marks the words that no run holds after its first period; None: all."""
    if not found:
        return None
    keep = np.ones(n, bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return keep


def collapse(docs: DataFrame, keep: list[str] | None = None,
             rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per document: the ``keep`` columns (doc_id alone by default), n_words,
    ``runs`` array<struct<start, length, period>> by start, then period, and
    ``collapsed``, the words without the repeats of the runs, joined by one space.

    ``rewrite``: optional, gives the words to look at from (doc_id, words)."""
    keep = ["doc_id"] if keep is None else keep
    kinds = dict(docs.dtypes)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = part.column(part.schema.get_field_index("_text")).cast(pa.binary()).to_pylist()
        names = part.column(part.schema.get_field_index("_id")).to_pylist()
        words = [t.split() if t else [] for t in texts]
        if rewrite:
            words = [rewrite(d, ws) for d, ws in zip(names, words)]
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        number = _Numbers()
        bounds = np.concatenate(([0], np.cumsum([len(words[i]) for i in order]))).astype(np.int64)
        w = np.fromiter((number[x] for i in order for x in words[i]), np.int64, int(bounds[-1]))
        start, length, period = runs(w, bounds)
        long = length >= LEAST
        start, length, period = start[long], length[long], period[long]
        cut = np.searchsorted(start, bounds)
        own: list[list] = [[] for _ in words]
        for rank, i in enumerate(order):
            a, b = cut[rank], cut[rank + 1]
            if a < b:
                own[i] = list(zip((start[a:b] - bounds[rank]).tolist(), length[a:b].tolist(), period[a:b].tolist()))
        texts_out = []
        for ws, found in zip(words, own):
            marks = kept_words(len(ws), found)
            texts_out.append(b" ".join(ws if marks is None else [ws[i] for i in np.flatnonzero(marks)]))
        columns = [part.column(i) for i in range(len(keep))]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([len(ws) for ws in words], pa.int64()),
             pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in own], run_type),
             pa.array(texts_out, pa.binary()).cast(pa.string())],
            names=[*[f"k{i}" for i in range(len(keep))], "n_words", "runs", "collapsed"])

    asked = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    schema = ", ".join([*[f"k{i} {kinds[c]}" for i, c in enumerate(keep)], "n_words long",
                        "runs array<struct<start:long,length:long,period:long>>", "collapsed string"])
    out = batches(asked, run, schema)
    return out.toDF(*keep, "n_words", "runs", "collapsed")
