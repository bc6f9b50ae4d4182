"""Operator 8: the bits themselves, from per-term hashes in plain Python."""

import random
import re
import struct

import pytest
import xxhash
from samples import SCHEMA, prose

MASK = (1 << 64) - 1


def hash_text(seed, *parts):
    """Spark's xxhash64 of texts, one after the other; nulls are skipped."""
    h = 42 if seed is None else seed
    for p in parts:
        if p is not None:
            h = xxhash.xxh64(p.encode(), seed=h).intdigest()
    return h


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    total, votes = 0, [0] * 128
    for a, b in zip(words, [*words[1:], None]):
        weight = min(len(a), 15)
        x = (hash_text(None, a, b) & ~15 & MASK) | weight
        h = xxhash.xxh64(struct.pack("<Q", x), seed=42).intdigest()
        g = xxhash.xxh64(struct.pack("<i", 1), seed=h).intdigest()
        total += weight
        for i in range(64):
            votes[i] += weight * (h >> i & 1)
            votes[64 + i] += weight * (g >> i & 1)
    bits = [2 * v > total for v in votes]
    return "".join(f"{sum(1 << i for i in range(64) if half[i]):016x}" for half in (bits[:64], bits[64:]))


def test_bits_equal_brute_force(spark, monkeypatch):
    import hashlib
    from clickweave.llm import simhash
    monkeypatch.setattr(simhash, "RANGE", 7)
    rows = [(i, prose(i, 3 + 11 * (i % 13))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, "one"), (43, "é　x A a"), (44, "w " * 900), (46, prose(3, 36)), (47, prose(3, 36))]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in simhash.edited_likeness(table).collect()}
    texts = [t or "" for _, t in rows]
    for k, (i, _) in enumerate(rows):
        own, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        r = got[i]
        marks = [brute_fingerprint(x) for x in (own, edited, after)]
        assert (r.fingerprint, r.edited_fingerprint) == tuple(marks[:2])
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        same = [1 - bin(int(marks[0], 16) ^ int(m, 16)).count("1") / 128 for m in marks[1:]]
        assert (r.near_edited, r.near_next) == (pytest.approx(same[0]), pytest.approx(same[1]))


def test_repeated_long_words(spark):
    """Terms that all vote alike with the highest weight, over several segments."""
    from clickweave.llm import simhash
    line = "Gemeinschaftsordnung und Verantwortungsbereich Zusammenarbeitsvertrag der Bundesverfassung "
    rows = [(1, "abcdefghijklmnop " * 3000), (2, line * 1300), (3, "abcdefghijklmno " * 9000), (4, "a " * 9000)]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in simhash.edited_likeness(table).collect()}
    texts = [t for _, t in rows]
    for k, (i, own) in enumerate(rows):
        half = len(own) // 2
        edited = own[:len(own) - half] + texts[(k + 1) % len(texts)][:half]
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (brute_fingerprint(own), brute_fingerprint(edited))


@pytest.mark.parametrize("many", [0, 64])
def test_block_tables_find_all_pairs(spark, monkeypatch, many):
    """With and without the keys of more bits for values that many share."""
    from clickweave.llm import simhash
    monkeypatch.setattr(simhash, "MANY", many)
    r = random.Random(2)
    prints = []
    for _ in range(25):
        base = r.getrandbits(128)
        for _ in range(8):
            p = base
            for _ in range(r.randint(0, 4)):
                p ^= 1 << r.randrange(128)
            prints.append(p)
    near = {(a, b) for a in prints for b in prints if bin(a ^ b).count("1") <= 3}

    def signed(x):
        return x - (1 << 64) if x >> 63 else x
    rows = [(signed(p >> 64), signed(p & MASK)) for p in prints]
    table = spark.createDataFrame(rows, "hi long, lo long")
    got = {((a & MASK) << 64 | b & MASK, (c & MASK) << 64 | d & MASK) for a, b, c, d in simhash.within(table, table, 3).collect()}
    assert got == near
    with pytest.raises(ValueError):
        simhash.within(table, table, 4)
