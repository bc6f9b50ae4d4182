"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (3-5 UTF-8
bytes of ``<word>``, lower-cased) and of the word itself; a window's vector is the mean of its
words; a linear softmax turns that into two classes. n-gram vectors and the
softmax are trained jointly in numpy, so a misspelt or inflected word that
never occurred in training still gets most of its vector from known n-grams.

Toxic words are a few among hundreds, so a document is scored by its highest
window of ``WINDOW`` words, and training alternates: fit on whole documents,
then on the highest windows under the current model.

The model is fitted on a bounded sample (``SampleBound``): the labelled rows
of smallest hash, at most so many of each class, none longer than
``max_bytes``. Everything else covers all rows: each whole text is scored in
one narrow pass, with no shuffle. What travels to the tasks is one number per
n-gram bucket (a fixed size). Only texts pass through Python, half a megabyte at
a time; a text longer than that is scored by itself, at about fifty times its bytes.

Edge cases: null, empty or blank texts get the score of an empty window (the
softmax bias); null doc_id gives held_out false; several label rows of one
doc_id count as toxic if any does; null labels are not learned from; without
both classes in the sample every score is 0. Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, mix, ship, utf8

WINDOW = 32
#: Bytes of text that are scored at once; array work takes some fifty times that.
PIECE = 512 << 10
#: Bytes of text, and words of the vocabulary, that training takes at once on the driver.
SAMPLE_PIECE, SAMPLE_WORDS = 64 << 10, 1 << 13
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)

#: Word separators: ASCII white space and common ASCII punctuation.
_SEPARATOR = SPACE.copy()
_SEPARATOR[list(b".,;:!?\"'()[]{}<>")] = True


@dataclass(frozen=True)
class SampleBound:
    """Bound of the training sample."""
    toxic: int = 1200
    clean: int = 2400
    max_bytes: int = 1 << 13


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class Words:
    """The words of a batch of texts as one padded byte array ``<word><word>``."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        low = LOWER[raw]
        if len(raw) > 1:  # two-byte capitals of Latin-1
            after = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
            low[1:][after] += 0x20
        inside = ~_SEPARATOR[raw]
        edge = inside.copy()
        edge[1:] &= ~inside[:-1]
        rows = off[:-1][off[:-1] < len(raw)]
        edge[rows] = inside[rows]
        start = np.flatnonzero(edge)
        self.first = np.searchsorted(start, off)
        kept = np.concatenate(([0], np.cumsum(inside)))
        bound = kept[start] if len(start) else np.zeros(0, np.int64)
        self.size = np.diff(np.concatenate((bound, [kept[-1]]))) + 2
        self.at = np.concatenate(([0], np.cumsum(self.size)[:-1])) if len(start) else np.zeros(0, np.int64)
        self.bytes = np.full(int(self.size.sum()), ord("<"), np.uint8)
        if len(start):
            place = np.ones(len(self.bytes), bool)
            place[self.at] = False
            place[self.at + self.size - 1] = False
            self.bytes[place] = low[inside]
            self.bytes[self.at + self.size - 1] = ord(">")

    def only(self, pick: np.ndarray) -> "Words":
        """The words at the given places, as one row."""
        out = object.__new__(Words)
        out.size = self.size[pick]
        out.at = np.concatenate(([0], np.cumsum(out.size)[:-1])).astype(np.int64)
        places = np.arange(int(out.size.sum()))
        places += np.repeat(self.at[pick] - out.at, out.size)
        out.bytes = self.bytes[places]
        out.first = np.array([0, len(pick)])
        return out

    def hashes(self) -> np.ndarray:
        """A hash of each whole word."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            place = np.arange(len(self.bytes)) - np.repeat(self.at, self.size)
            return mix(np.add.reduceat(mix(self.bytes + (place.astype(np.uint64) << np.uint64(8))), self.at))

    def grams(self):
        """For each n: bucket of the n-gram at each byte, and whether it fits
        in its word."""
        left = np.repeat(self.at + self.size, self.size) - np.arange(len(self.bytes))
        with np.errstate(over="ignore"):
            code = self.bytes.astype(np.uint64)
            for n in range(2, max(GRAMS) + 1):
                code = code[:-1] * np.uint64(257) + self.bytes[n - 1:]
                if n in GRAMS:
                    yield (mix(code + np.uint64(n << 56)) % np.uint64(BUCKETS)).astype(np.int64), left[: len(code)] >= n

    def margins(self, margin: np.ndarray) -> np.ndarray:
        """Mean margin of each word's n-grams and whole-word bucket."""
        if not len(self.at):
            return np.zeros(0, np.float32)
        total = np.zeros(len(self.bytes), np.float32)
        count = np.ones(len(self.at), np.float32)
        for bucket, fits in self.grams():
            total[: len(bucket)] += np.where(fits, margin[bucket], np.float32(0))
        for n in GRAMS:
            count += np.maximum(0, self.size - n + 1)
        whole = margin[(self.hashes() % np.uint64(BUCKETS)).astype(np.int64)]
        return (np.add.reduceat(total, self.at) + whole) / count


def joined(parts: list[Words]) -> Words:
    """The words of several batches as one row."""
    out = object.__new__(Words)
    out.size = np.concatenate([p.size for p in parts])
    out.at = np.concatenate(([0], np.cumsum(out.size)[:-1])).astype(np.int64)
    out.bytes = np.concatenate([p.bytes for p in parts])
    out.first = np.array([0, len(out.size)])
    return out


def entries(words: Words, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words themselves and of their n-grams, and the word of each
    (the first is number ``at``), in the order of words."""
    own = np.arange(at, at + len(words.at), dtype=np.int32)
    word_of = np.repeat(own, words.size)
    ids, owner = [(words.hashes() % np.uint64(BUCKETS)).astype(np.int32)], [own]
    for bucket, fits in words.grams():
        ids.append(bucket[fits].astype(np.int32))
        owner.append(word_of[: len(bucket)][fits])
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids[order], owner[order]


class Subwords:
    """Joint training of n-gram vectors and the softmax: full batch, Adam.
    n-grams in fewer than ``least`` (word, document) pairs of the sample stay at
    zero, so rare strings of single documents are not learned by heart."""

    def __init__(self, vocabulary: Words, in_class: np.ndarray, least: int = 20, dim: int = 4, seed: int = 7):
        """in_class[c, w]: documents of class c that hold word w."""
        n = len(vocabulary.at)

        def parts():
            for at in range(0, n, SAMPLE_WORDS):
                yield entries(vocabulary.only(np.arange(at, min(n, at + SAMPLE_WORDS))), at)

        # twice over the words, so that the entries of rare n-grams are never held together
        in_any, documents, total, count = in_class.sum(0), np.zeros(BUCKETS), np.zeros(BUCKETS, np.int64), np.zeros(n, np.float32)
        for ids, owner in parts():
            count += np.bincount(owner, minlength=n).astype(np.float32)
            total += np.bincount(ids, minlength=BUCKETS)
            documents += np.bincount(ids, in_any[owner], minlength=BUCKETS)
        self.count = count[:, None]
        have = (total > 0) & (documents >= least)
        self.used, place = np.flatnonzero(have), np.cumsum(have, dtype=np.int32) - 1
        # n-grams of word w: ids[at[w]:at[w + 1]]
        self.ids, size, done = np.empty(total[have].sum(), np.int32), np.zeros(n, np.int64), 0
        seen = np.zeros((2, len(self.used)))
        for ids, owner in parts():
            keep = have[ids]
            ids, owner = place[ids[keep]], owner[keep]
            self.ids[done:done + len(ids)] = ids
            done += len(ids)
            size += np.bincount(owner, minlength=n)
            for c in (0, 1):
                seen[c] += np.bincount(ids, in_class[c, owner], minlength=len(self.used))
        self.at = np.concatenate(([0], np.cumsum(size)))
        rng = np.random.default_rng(seed)
        self.V = rng.normal(0, 0.3, (dim, 2)).astype(np.float32)
        self.b = np.zeros(2, np.float32)
        # start: each vector along the softmax direction by the smoothed log odds of its n-gram
        odds = np.log((seen[1] + 5) / (seen[1].sum() + 1)) - np.log((seen[0] + 5 * seen[0].sum() / (seen[1].sum() + 1)) / (seen[0].sum() + 1))
        way = self.V[:, 1] - self.V[:, 0]
        self.E = (odds[:, None] * way / (way @ way)).astype(np.float32)
        self.moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.E, self.V, self.b)]
        self.steps = 0

    def word_vectors(self) -> np.ndarray:
        out = np.zeros((len(self.count), self.E.shape[1]), np.float32)
        for k in range(0, len(out), SAMPLE_WORDS):
            at = self.at[k:k + SAMPLE_WORDS + 1]
            some = np.flatnonzero(np.diff(at))  # words with any vector
            if len(some):
                out[k + some] = np.add.reduceat(self.E[self.ids[at[0]:at[-1]]], at[some] - at[0])
        return out / self.count

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int, rates: tuple = (0.002, 0.3, 0.3)) -> None:
        """``epochs`` steps on the mean loss of both classes over all bags."""
        size = np.array([len(x) for x in bags], np.int64)
        word = np.concatenate(bags)
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        seen, word = np.unique(word, return_inverse=True)
        order = np.argsort(word, kind="stable")
        word_at = np.searchsorted(word[order], np.arange(len(seen)))
        bag_of = np.repeat(np.arange(len(bags)), size)[order]
        share = size[:, None].astype(np.float32)
        weight = np.where(labels == 1, 0.3 / max(1, (labels == 1).sum()), 0.7 / max(1, (labels == 0).sum()))
        # only the n-grams of the words in these bags take part
        grams = self.at[seen + 1] - self.at[seen]
        owners, before = np.flatnonzero(grams), np.cumsum(grams) - grams
        owner_at, owner = before[owners], np.repeat(np.arange(len(seen)), grams)
        ids = self.ids[np.arange(len(owner)) + (self.at[seen] - before)[owner]]
        by_gram = np.argsort(ids, kind="stable")
        used, gram_at = np.unique(ids[by_gram], return_index=True)
        owner_by_gram, count = owner[by_gram], self.count[seen]
        for _ in range(epochs):
            vectors = np.zeros((len(seen), self.E.shape[1]), np.float32)
            if len(ids):
                vectors[owners] = np.add.reduceat(self.E[ids], owner_at)
            vectors /= count
            X = np.add.reduceat(vectors[word], at) / share
            z = X @ self.V + self.b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(p)), labels] -= 1
            d = (p * weight[:, None]).astype(np.float32)
            dW = np.add.reduceat(((d @ self.V.T) / share)[bag_of], word_at) / count
            dE = np.zeros_like(self.E)
            if len(ids):
                dE[used] = np.add.reduceat(dW[owner_by_gram], gram_at)
            self.steps += 1
            for value, grad, (m, v), rate in zip((self.E, self.V, self.b), (dE, X.T @ d, d.sum(0)), self.moments, rates):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                value -= rate * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(v / (1 - 0.99 ** self.steps)) + 1e-6)

    def margins(self) -> np.ndarray:
        """Per bucket: what its vector adds to the margin of class 1."""
        out = np.zeros(BUCKETS, np.float32)
        out[self.used] = self.E @ (self.V[:, 1] - self.V[:, 0])
        return out

    @property
    def bias(self) -> float:
        return float(self.b[1] - self.b[0])


def highest_window(x: np.ndarray) -> tuple[float, int]:
    """Largest mean over WINDOW consecutive values (all, if fewer), and where."""
    if len(x) <= WINDOW:
        return (float(x.mean()), 0) if len(x) else (0.0, 0)
    c = np.concatenate(([0.0], np.cumsum(x, dtype=np.float64)))
    means = (c[WINDOW:] - c[:-WINDOW]) / WINDOW
    k = int(means.argmax())
    return float(means[k]), k


def numbered(texts: list[str]) -> tuple[Words, list[np.ndarray]]:
    """The distinct words of the texts by hash, and the numbers of each text's words
    among them. In pieces, so that the driver holds the arrays of one piece, the
    vocabulary's bytes and four bytes for each word."""
    docs, new, known, number, rows, size = [], [], np.zeros(0, np.uint64), np.zeros(0, np.int32), 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size < SAMPLE_PIECE and k < len(texts) - 1:
            continue
        found = Words(*utf8(pa.array(texts[rows:k + 1], pa.string())))
        rows, size = k + 1, 0
        hashes, pick, word = np.unique(found.hashes(), return_index=True, return_inverse=True)
        place = np.searchsorted(known, hashes)
        fresh = np.append(known, np.uint64(0))[place] != hashes
        fresh |= place == len(known)
        new.append(found.only(pick[fresh]))
        # numbers as words are first met; known stays sorted
        number = np.insert(number, place[fresh], np.arange(len(known), len(known) + fresh.sum(), dtype=np.int32))
        known = np.insert(known, place[fresh], hashes[fresh])
        word = number[np.searchsorted(known, hashes)][word]
        docs += [word[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
    by_hash = np.empty(len(number), np.int32)
    by_hash[number] = np.arange(len(number))
    return joined(new).only(number) if new else Words(*utf8(pa.array([], pa.string()))), [by_hash[ids] for ids in docs]


def train(texts: list[str], labels: list[int], rounds: int = 3) -> tuple[np.ndarray, float] | None:
    """(bucket margins, bias), or None without both classes."""
    vocabulary, docs = numbered(texts)
    have = [k for k, ids in enumerate(docs) if len(ids)]
    docs, y = [docs[k] for k in have], np.array(labels, np.int64)[have]
    if len(set(y.tolist())) < 2:
        return None
    in_class = np.zeros((2, len(vocabulary.at)))
    for ids, label in zip(docs, y):
        in_class[label, np.unique(ids)] += 1
    model = Subwords(vocabulary, in_class)
    for _ in range(rounds):
        margin = model.word_vectors() @ (model.V[:, 1] - model.V[:, 0])
        bags = []
        for ids in docs:
            k = highest_window(margin[ids])[1]
            bags.append(ids[k:k + WINDOW])
        model.fit(bags, y, 30)
    return model.margins(), model.bias


def scores(texts: pa.Array, margin: np.ndarray, bias: float) -> np.ndarray:
    """Score of every whole text of a batch."""
    found = Words(*utf8(texts))
    x = found.margins(margin)
    z = np.array([highest_window(x[a:b])[0] for a, b in zip(found.first[:-1], found.first[1:])]) + bias
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def sample(docs: DataFrame, labels: DataFrame, bound: SampleBound) -> tuple[list[str], list[int]]:
    """Texts and labels of the bounded training sample, picked by id hash:
    ids are chosen on thin columns, then only their texts are fetched."""
    have = (docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") <= bound.max_bytes))
            .select(F.col("doc_id").alias("_id")).distinct())
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
             .where(F.col("_toxic").isin(0, 1) & ~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("_toxic").alias("_toxic")).join(have, "_id", "left_semi"))
    order = [F.xxhash64("_id"), F.col("_id")]
    ids = (known.where("_toxic = 1").orderBy(*order).limit(bound.toxic)
           .unionByName(known.where("_toxic = 0").orderBy(*order).limit(bound.clean)))
    rows = (docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
            .where(F.octet_length("_text") <= bound.max_bytes)
            .join(F.broadcast(ids), "_id")
            .groupBy("_id", "_toxic").agg(F.max("_text").alias("_text")).orderBy("_id").collect())
    return [r["_text"] for r in rows], [r["_toxic"] for r in rows]


def score(docs: DataFrame, labels: DataFrame, bound: SampleBound = SampleBound(),
          text_col: str = "text", score_col: str = "toxic_score") -> DataFrame:
    """All rows and columns of ``docs`` plus ``score_col`` (0 to 1). A clashing
    input column of that name is replaced."""
    spark = docs.sparkSession
    model = train(*sample(docs, labels, bound))
    base = docs.drop(score_col) if score_col in docs.columns else docs
    if model is None:
        return base.withColumn(score_col, F.lit(0.0))
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    # only texts go to Python and only scores come back; the other columns stay in the JVM
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        step = max(1, int(len(texts) * PIECE / max(1, texts.nbytes)))
        return pa.array(np.concatenate([np.zeros(0), *[scores(texts.slice(at, step), *sent.value) for at in range(0, len(texts), step)]]), pa.float64())

    return base.withColumn(score_col, scored(F.col(text_col)))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Documents scored under the threshold, with the columns of ``docs``."""
    return score(docs, labels, score_col="_toxic_score").where(F.col("_toxic_score") < threshold).drop("_toxic_score")
