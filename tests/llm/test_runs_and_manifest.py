"""Operators 11 and 13 against brute force."""

import hashlib
import random
import zlib

import numpy as np
from samples import prose

SPACES = " \t\n\x0b\x0c\r"


def split(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(w, least=6, times=4):
    """All runs, by comparing every word with the one q places on."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            s = w[i:i + size]
            if j > i and size >= max(least, times * q) and not any(s[r:] == s[:-r] for r in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(r):
    """Words with runs inside runs, of short and long periods."""
    kind, n = r.random(), r.randint(0, 90)
    if kind < 0.5:
        return [r.randint(0, 1 + (kind < 0.2)) for _ in range(n)]
    w = []
    while len(w) < n:
        u = [r.randint(0, 3) for _ in range(r.randint(1, 12))]
        u = u[:3] * r.randint(1, 5) if r.random() < 0.4 else u
        w += u * r.randint(1, 9) + u[:r.randint(0, len(u))]
        w += [r.randint(0, 9) for _ in range(r.randint(0, 5))] if r.random() < 0.5 else []
    return w


def test_runs_equal_brute_force():
    from clickweave.llm import periodic
    r = random.Random(11)
    total = 0
    for _ in range(1500):
        docs = sorted((periodic_words(r) for _ in range(r.randint(1, 4))), key=lambda d: -len(d))
        bounds = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
        start, length, period = periodic.runs(np.array(sum(docs, []), np.int64), bounds)
        got = list(zip(start.tolist(), length.tolist(), period.tolist()))
        want = sorted(((a + int(bounds[k]), n, q) for k, d in enumerate(docs) for a, n, q in brute_runs(d, least=1)), key=lambda x: (x[0], x[2]))
        assert got == want
        total += len(want)
    assert total > 3000


def test_synchronising_set_is_consistent_and_dense():
    from clickweave.llm import periodic
    r = np.random.default_rng(2)
    w = np.concatenate([r.integers(0, 6, 400), np.tile(r.integers(0, 6, 90), 3)]).astype(np.int64)
    t = 8
    ids = np.array([hash(tuple(w[i:i + t].tolist())) & 0xFFFFFFFFFFFFFFFE for i in range(len(w) - t + 1)], np.uint64)
    at = periodic.members(ids, None, t)
    at = at[at + 2 * t <= len(w)]
    chosen = {tuple(w[i:i + 2 * t].tolist()) for i in at}
    assert all((tuple(w[i:i + 2 * t].tolist()) in chosen) == (i in set(at.tolist())) for i in range(len(w) - 2 * t + 1))
    assert np.diff(at).max() <= t and len(at) < len(w) * 0.6


def expected_runs(doc_id, text, rewrite=True):
    w = split(text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if rewrite and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if found else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def key(x):
    return tuple((v is not None, v) for v in x)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_run_query_equals_brute_force(spark, tmp_path):
    from clickweave.llm import registry
    r = random.Random(4)
    rows = [(i, r.choice(SPACES).join(f"w{x}" for x in periodic_words(r))) for i in range(150)]
    rows += [(200 + i, prose(i, 60)) for i in range(40)] + [(300, None), (301, ""), (302, " \n"), (303, "a"), (304, "a " * 3000), (305, "é " * 6),
                                                           (306, "A a " * 5), (7, "b b b b b b"), (None, "c c c c c c c"), (None, None)]
    rows.append((400, " ".join(["x y"] * 900 + [str(i) for i in range(3000)])))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns[:len(COLUMNS)] == COLUMNS
    assert sorted(map(tuple, got.select(COLUMNS).collect()), key=key) == sorted((expected_runs(*x) for x in rows), key=key)


def test_collapse_edges(docs, empty, clashing):
    from clickweave.llm import periodic
    assert periodic.collapse(empty).count() == 0
    out = periodic.collapse(clashing, keep=["doc_id", "n", "source"])
    assert out.columns == ["doc_id", "n", "source", "n_words", "runs", "collapsed"]
    want = sorted((expected_runs(r.doc_id, r.text, rewrite=False)[:2] for r in docs.collect()), key=key)
    assert sorted(((r.doc_id, len(r.runs)) for r in out.collect()), key=key) == want


# ---------------------------------------------------------------- manifest


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def form(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, low=False):
    d, text, lang, source, n = row
    if low and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return sha("".join(map(form, (d, source, lang, n, text))))


def tree(nodes):
    """Root, and the sibling digests of every leaf, level by level."""
    paths, at, levels = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(levels) > 1:
        for leaf, k in enumerate(at):
            run = k // 16 * 16
            paths[leaf].append((levels[run:k], levels[k + 1:run + 16]))
            at[leaf] = k // 16
        levels = [sha("".join(levels[i:i + 16])) for i in range(0, len(levels), 16)]
    return levels[0], paths


def brute_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf_of(r))))
        trees[s] = tree([leaf_of(r) for r in groups[s]])
    root, upper = tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, upper):
        for row, own in zip(groups[s], trees[s][1]):
            path = own + above
            again = leaf_of(row, low=row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0)
            for left, right in path:
                again = sha("".join([*left, again, *right]))
            proof = sha("".join("".join(a + b) for a, b in path))
            out.append((row[0], leaf_of(row), trees[s][0], root, proof, again, again == root))
    return out


def test_positions_are_those_of_the_log():
    from clickweave.llm import manifest
    for n in [*range(1, 40), 255, 256, 257, 300, 4095, 4096, 4097, 5000]:
        leaves = [bytes([k % 256, k // 256]) * 16 for k in range(n)]
        h = manifest.height(n)
        log = manifest.appended(leaves, h)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([manifest.hashed(levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        assert len(levels) == h + 1 and len(log) == sum(map(len, levels))
        seen = [manifest.position(n, level, k) for level, nodes in enumerate(levels) for k in range(len(nodes))]
        assert sorted(seen) == list(range(len(log)))
        assert [log[p] for p in seen] == [x for nodes in levels for x in nodes]


def manifest_rows(r):
    return [tuple(x) for x in r]


def test_manifest_equals_brute_force(spark, docs):
    from clickweave.llm import manifest
    rows = [tuple(r) for r in docs.collect()]
    rows += [(1000 + i, f"Text {i}", None if i % 7 else "en", f"s{i}" if i < 40 else "big", None if i % 3 else i) for i in range(4500)]
    rows += [(9000 + i, f"T {i}", "en", "exact", 1) for i in range(256)] + [(9999, "Ä A", "en", "ß", 3), (-5, "A", "", "", 0)]
    table = spark.createDataFrame(rows, docs.schema).repartition(5)
    got = sorted(map(tuple, manifest.verify(table).collect()), key=key)
    assert got == sorted(brute_manifest(rows), key=key)
    assert {x[-1] for x in got} == {True, False}


def test_manifest_edges(spark, empty, clashing, docs):
    from clickweave.llm import manifest
    assert manifest.verify(empty).count() == 0
    a = sorted(map(tuple, manifest.verify(clashing.drop("leaf")).collect()), key=key)
    assert a == sorted(brute_manifest([tuple(r) for r in docs.collect()]), key=key)
    one = spark.createDataFrame([(1, None, None, None, None)], docs.schema)
    (r,) = manifest.verify(one).collect()
    assert r.root == r.leaf == r.subroot and r.verified and r.proof_sha256 == sha("")
