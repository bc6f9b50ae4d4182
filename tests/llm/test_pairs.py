"""Operators 4, 5, 8 and 9 against brute force."""

import hashlib
import random

import numpy as np
import pytest
from samples import SCHEMA, prose, rows
from pyspark.sql import functions as F

AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(items):
    """(set size, smallest id) per item, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in items]
    parent = list(range(len(items)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(items)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(items)), key=str)


def near(seed, base, edits):
    r = random.Random(seed)
    w = base.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def test_jaccard_components(docs, empty, clashing):
    from clickweave.llm import jaccard_tiles
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    for table in (docs, clashing):
        assert sorted(map(tuple, jaccard_tiles.join(table).collect()), key=str) == want
    assert jaccard_tiles.join(empty).count() == 0


@pytest.mark.parametrize("group, stream", [(1024, 1 << 14), (8, 16), (2, 3)])
def test_jaccard_groups_near_the_threshold(spark, monkeypatch, group, stream):
    """Groups whose members link only to some of the others, a passage shared
    by all; in one task each, and as large groups in chunks and lanes: still every
    link between components."""
    from clickweave.llm import jaccard_tiles
    monkeypatch.setattr(jaccard_tiles, "GROUP", group)
    monkeypatch.setattr(jaccard_tiles, "STREAM", stream)
    monkeypatch.setattr(jaccard_tiles, "CHUNK", max(8, group))
    line = prose(7, 12)
    items = []
    for g in range(3):
        base = prose(100 + g, 120) + " " + line
        items += [(1000 * g + k, near(10 * g + k, base, k % 6)) for k in range(25)]
    items += [(5000 + k, prose(200 + k, 60) + " " + line) for k in range(20)]
    # a chain: each links with the next only
    words_ = prose(900, 200).split()
    items += [(7000 + k, " ".join(words_[6 * k:6 * k + 60])) for k in range(20)]
    table = spark.createDataFrame(items, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard_tiles.join(table).collect()), key=str) == brute_components(items)
    kept = {r.doc_id for r in jaccard_tiles.keep_one(table).collect()}
    assert kept == {c for _, _, c in brute_components(items)}


def test_bit_bound_loses_nothing_and_groups_equal_brute_force():
    from clickweave.llm import jaccard_tiles as J
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, rng.integers(5, 200), dtype=np.uint64)
        sets.append(np.unique(base))
        for _ in range(2):
            sets.append(np.unique(np.concatenate((base[: int(len(base) * rng.uniform(0.7, 1))], rng.integers(0, 2**63, 3, dtype=np.uint64)))))
    block = J.Block(sets, np.arange(len(sets)))
    want = {(i, j) for i in range(len(sets)) for j in range(i) if J.linked(sets[i], sets[j])}
    may = {(i, int(j)) for i in range(len(sets)) for j in block.may_link(J.bitmap(sets[i]), len(sets[i]), i)[0]}
    assert want and want <= may and len(may) < len(sets) ** 2 / 20
    assert all(J.shared(sets[i], sets[j]) == len(np.intersect1d(sets[i], sets[j])) for i, j in list(want)[:50] + [(0, 3), (5, 90)])
    assert {tuple(sorted(x, reverse=True)) for x in J.group_links(sets, np.arange(len(sets)))} <= want
    def labels(links):
        label = list(range(len(sets)))
        for i, j in links:
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
        return label
    assert labels(J.group_links(sets, np.arange(len(sets)))) == labels(want)
    hit = J.may_meet(np.array([len(s) for s in sets]), np.arange(len(sets)), [J.bitmap(s) for s in sets], np.zeros(len(sets), int))
    assert {x for pair in want for x in pair} <= set(np.flatnonzero(hit).tolist()) and not hit.all()


def test_one_of_each_group_stays_with_repeated_ids(spark):
    """Other texts of an id are rows of their own; of equal rows one stays."""
    from clickweave.llm import jaccard_tiles
    x, y = prose(1, 60), prose(2, 60)
    items = [(1, x, "a"), (2, x, "b"), (2, y, "c"), (3, y + " q", "d"), (4, prose(3, 30), "e"), (4, prose(3, 30), "e"), (4, prose(3, 30), "f"),
             (5, None, "g"), (5, None, "g"), (6, "", "h"), (None, x, "i"), (None, x, "i"), (7, prose(4, 40), "j"), (7, prose(4, 40) + "  ", "k")]
    table = spark.createDataFrame(items, "doc_id long, text string, label string").withColumn("best", F.lit(1)).repartition(3)
    out = jaccard_tiles.keep_one(table)
    assert out.columns == table.columns
    got = [(r.doc_id, r.text, r.label) for r in out.collect()]
    assert sorted((d, t) for d, t, _ in got if d in (1, 2, 3)) == [(1, x), (2, y)]
    assert sum(d == 4 for d, *_ in got) == 1 and sum(d == 7 for d, *_ in got) == 1
    assert sorted(((d, t, k) for d, t, k in got if d in (5, 6, None)), key=str) == sorted(
        [(5, None, "g"), (5, None, "g"), (6, "", "h"), (None, x, "i"), (None, x, "i")], key=str)


def test_passages(spark, docs, empty, clashing):
    from clickweave.llm import chaining
    passage = prose(500, 70)
    edited = passage.split()
    edited[20], edited[45] = "changed", "twice"
    extra = edited[:33] + ["inserted"] + edited[33:]
    items = [(1, prose(1, 90) + " " + passage + " " + prose(2, 40)), (2, prose(3, 30) + " " + " ".join(extra)),
             (3, passage.translate({c: c - 32 for c in range(97, 123)})), (4, prose(5, 200)), (5, " ".join(passage.split()[:40]) + " " + prose(6, 60)),
             (6, None), (7, ""), (None, passage)]
    table = spark.createDataFrame(items, "doc_id long, text string").withColumn("h", F.lit(1)).withColumn("first", F.lit("x"))
    got = chaining.passages(table).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(2, 1), (3, 1)}
    spans = {r.doc_id: (r.start_word, r.end_word, r.first_start, r.first_end) for r in got}
    assert spans[2] == (30, 101, 90, 160) and spans[3] == (0, 70, 90, 160)
    left = {r.doc_id: r.text for r in chaining.without_repeats(table).collect()}
    assert set(left) == {1, 2, 4, 5, 6, 7, None}  # nothing is left of 3
    assert left[1] == items[0][1] and left[2].split() == items[1][1].split()[:30] and left[None] == passage and left[6] is None
    assert chaining.passages(empty).count() == 0 and chaining.without_repeats(empty).columns == empty.columns
    assert chaining.without_repeats(clashing).columns == clashing.columns
    # whole copies: the first stays as it is
    copies = {r.doc_id for r in chaining.passages(docs).collect()}
    assert copies == set()  # the copies in this table are under 50 words


def test_passages_of_lines_that_are_first_elsewhere(spark):
    """Two documents share a passage; each of its lines occurs first in
    another, earlier document."""
    from clickweave.llm import chaining
    items, want = [], set()
    for k, (lines, size) in enumerate(((2, 25), (2, 30), (3, 30), (2, 40), (3, 20), (5, 10), (4, 45))):
        for case in range(8):
            at = 1000 * (8 * k + case)
            cut = [[f"w{at}x{i}y{j}" for j in range(size)] for i in range(lines)]
            fill = lambda d, n: [f"u{at + d}z{j}" for j in range(n)]
            items += [(at + i, " ".join(fill(i, 20) + x + fill(50 + i, 20))) for i, x in enumerate(cut)]
            items += [(at + d, " ".join(fill(d, d - 90) + sum(cut, []) + fill(d + 50, 30))) for d in (100, 200)]
            want.add((at + 200, 110, 110 + lines * size, at + 100, 10, 10 + lines * size))
    table = spark.createDataFrame(items, "doc_id long, text string").repartition(5)
    got = {tuple(r)[:6] for r in chaining.passages(table).collect()}
    assert want <= got and {g[0] for g in got} == {w[0] for w in want}


def test_passages_with_many_edits(spark):
    """Passages with a word changed in every few: at an identity of 0.83 a run
    of equal words holds one seed."""
    from clickweave.llm import chaining
    rng, items, want = random.Random(4), [], {}
    for k in range(240):
        size, identity = (50, 70, 100)[k % 3], (0.9, 0.875, 0.85, 5 / 6)[k // 3 % 4]
        p = [f"p{k}x{i}" for i in range(size)]
        n = int((1 - identity) * size + 1e-9)
        q = list(p)
        for x in rng.sample(range(1, size - 1), n) if k % 2 else [int((x + 0.5) * size / n) for x in range(n)]:
            q[x] = f"e{k}x{x}"
        items += [(2 * k, " ".join([f"a{k}x{i}" for i in range(30)] + p)), (2 * k + 1, " ".join([f"b{k}x{i}" for i in range(20)] + q + [f"c{k}x{i}" for i in range(20)]))]
        want[2 * k + 1] = identity
    table = spark.createDataFrame(items, "doc_id long, text string").repartition(4)
    got = {r.doc_id for r in chaining.passages(table).collect()}
    for identity in set(want.values()):
        asked = {d for d, x in want.items() if x == identity}
        assert len(asked & got) >= 0.9 * len(asked), (identity, len(asked & got))


def test_tiled_covers_the_same_words():
    from clickweave.llm import chaining
    long = [(i, 7, 52) for i in range(10, 400, 3)] + [(900, 7, 52), (30, 9, 60), (5, 5, 5), (6, 5, 5)]
    kept = chaining.tiled(long)
    cover = lambda runs: {(j, n, w) for i, j, n in runs for w in range(i, i + n)}
    assert cover(kept) == cover(long) and len(kept) < 15


def brute_pieces(gap):
    """Spans of P U Q that meet the definition, over all ends at passage
    borders: both passages alone, or all where the gap is part of it."""
    n = 120 + gap
    return {(0, n)} if 120 >= 0.75 * n else {(0, 60), (60 + gap, n)}


def test_passages_apart_in_one_pair(spark):
    """P U Q against P V Q: the passages are found at any distance."""
    from clickweave.llm import chaining
    items, want = [], {}
    for k, gap in enumerate((5, 30, 50, 100, 200, 260)):
        p, q = ([f"{c}{k}x{i}" for i in range(60)] for c in "pq")
        u, v = ([f"{c}{k}x{i}" for i in range(gap)] for c in "uv")
        items += [(2 * k, " ".join(p + u + q)), (2 * k + 1, " ".join(p + v + q))]
        want[2 * k + 1] = brute_pieces(gap)
    got = {d: set() for d in want}
    table = spark.createDataFrame(items, "doc_id long, text string")
    for r in chaining.passages(table).collect():
        got[r.doc_id].add((r.start_word, r.end_word))
        assert r.start_word == r.first_start and r.matched >= 0.75 * (r.end_word - r.start_word)
    assert got == want
    left = {r.doc_id: r.text for r in chaining.without_repeats(table).collect()}
    assert left[9] == " ".join(f"v4x{i}" for i in range(200)) + " "


def test_pieces_against_all_pairs():
    from clickweave.llm import chaining
    rng = np.random.default_rng(8)
    for _ in range(300):
        m = rng.integers(1, 12)
        here, there, runs = rng.integers(0, 30), rng.integers(0, 30), []
        for _ in range(m):
            n = int(rng.integers(5, 40))
            runs.append((here, there, n))
            here, there = here + n + rng.integers(0, 40), there + n + rng.integers(0, 40)
        ends = np.array([(i, j, i + n, j + n) for i, j, n in runs])
        taken = np.cumsum([n for _, _, n in runs])
        given = taken - [n for _, _, n in runs]

        def good(s, e):
            size = ends[e, 2:] - ends[s, :2]
            return size.min() >= chaining.MIN_WORDS and taken[e] - given[s] >= chaining.IDENTITY * size.max()
        all_ = [(s, e) for s in range(m) for e in range(s, m) if good(s, e)]
        want = [(s, e) for s, e in all_ if not any(x <= s and e <= y and (x, y) != (s, e) for x, y in all_)]
        assert chaining.pieces(ends, taken, given) == want


def test_many_copies_make_few_matches(spark):
    from clickweave.llm import chaining
    text = prose(9, 100)
    table = spark.createDataFrame([(k, prose(k, 20) + " " + text) for k in range(200)], "doc_id long, text string")
    assert chaining.matches(table).count() < 200 * 60
    assert chaining.passages(table).select("doc_id").distinct().count() == 199


def test_chains_prefer_collinear_matches():
    from clickweave.llm.chaining import chains
    straight = [(i, i + 100) for i in range(0, 60, 5)]
    noise = [(12, 900), (31, 3), (44, 500)]
    best = max(chains(straight + noise), key=lambda c: sum(n for _, _, n in c))
    assert best[0][:2] == (0, 100) and best[-1][0] + best[-1][2] >= 60


def test_seeds_and_words_are_shuffled_once(spark, monkeypatch):
    """No copy of the seeds or of the words is written to the work folder, and one
    shuffle of the seeds finds their first occurrences, without a join."""
    from clickweave.llm import chaining
    text = prose(9, 100)
    table = spark.createDataFrame([(k, prose(k, 20) + " " + text) for k in range(20)], "doc_id long, text string").repartition(3)
    plan = chaining.matches(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(h") == 1 and "Join" not in plan
    names, stored = [], chaining.stored
    monkeypatch.setattr(chaining, "stored", lambda df, name: names.append(name) or stored(df, name))
    assert chaining.passages(table).select("doc_id").distinct().count() == 19 and names == ["chain-chains"]


def test_rows_of_one_id_with_texts_of_different_lengths(spark):
    """The seeds of an id's longer text lie outside its text of smallest hash."""
    from clickweave.llm import chaining
    p = prose(11, 80)
    for short in ("some few words", prose(12, 55), ""):
        items = [(1, prose(13, 30) + " " + p), (2, prose(14, 200) + " " + p), (2, short), (3, p)]
        table = spark.createDataFrame(items, "doc_id long, text string")
        got = {(r.doc_id, r.first_doc_id) for r in chaining.passages(table).collect()}
        assert (3, 1) in got and got <= {(3, 1), (2, 1)}


def test_no_chain_at_all(spark):
    """Matches of which no pair has a run or two seeds."""
    from clickweave.llm import chaining
    pairs = spark.createDataFrame([(5, 1, 3, 4, 5), (6, 1, 3, 4, 5)], "doc long, first long, at int, first_at int, n int")
    assert chaining.chained(pairs).count() == 0 and chaining.chains([]) == []


def test_a_document_that_many_repeat(spark, monkeypatch):
    """Pairs of one earlier document beyond HOT meet its words by broadcast, or by
    a shuffle where the words are too many: the same rows."""
    from clickweave.llm import chaining
    text, other = prose(9, 100), prose(10, 70)
    table = spark.createDataFrame([(k, prose(20 + k, 20) + " " + (text if k % 3 else other)) for k in range(30)], "doc_id long, text string")
    want = sorted(tuple(r) for r in chaining.passages(table).collect())
    assert {r[0] for r in want} == set(range(2, 30))
    monkeypatch.setattr(chaining, "HOT", 12)
    assert sorted(tuple(r) for r in chaining.passages(table).collect()) == want
    plain = chaining.maybe_broadcast
    monkeypatch.setattr(chaining, "maybe_broadcast", lambda side, row_bytes: plain(side, row_bytes, 0))
    assert sorted(tuple(r) for r in chaining.passages(table).collect()) == want


def test_repeated_in_gives_the_map_of_repeated_keys(spark, monkeypatch):
    from clickweave.llm import common
    rng = np.random.default_rng(3)
    keys = np.concatenate((rng.integers(-2**31, 2**31, 3000), rng.integers(0, 500, 600), [2**31 - 1, -2**31, -2**31, -1, -1, -1, 0]))
    table = spark.createDataFrame([(int(k),) for k in keys], "key int").repartition(7)
    take = lambda part: part.column("key").to_numpy().view(np.uint32)
    for gathered in (common.GATHERED, 100):
        monkeypatch.setattr(common, "GATHERED", gathered)
        for bits in (28, 24):
            assert (common.repeated_in(table, take, bits) == common.repeated_keys(table, bits)).all()
    assert not common.repeated_in(table.limit(0), take, 28).any()


def plain_extension(a, b, drop):
    """(words taken, words equal) word by word."""
    miss = equal = end = end_equal = 0
    for k, (x, y) in enumerate(zip(a, b)):
        miss, equal = (0, equal + 1) if x == y else (miss + 1, equal)
        if x == y:
            end, end_equal = k + 1, equal
        if miss >= drop:
            break
    return end, end_equal


def plain_pieces(chain, a, a0, b, b0):
    """The pieces of one chain by all pairs of its runs and whole gaps."""
    from clickweave.llm import chaining
    runs, i, j = [], 0, 0
    for x, y, n in chain:
        over = max(i - x + a0, j - y + b0, 0) if runs else 0
        runs.append((x - a0 + over, y - b0 + over, n - over))
        i, j = x - a0 + n, y - b0 + n

    def common(g, h):
        row = [0] * (len(h) + 1)
        for x in g:
            old, row = row, [0]
            for k, y in enumerate(h):
                row.append(old[k] + 1 if x == y else max(old[k + 1], row[k]))
        return row[-1]
    out = []
    for s, (x, y, _) in enumerate(runs):
        l, l_equal = plain_extension(a[:x][::-1], b[:y][::-1], chaining.DROP)
        matched = l_equal
        for e in range(s, len(runs)):
            u, v, n = runs[e]
            if e > s:
                (p, q, m) = runs[e - 1]
                matched += common(a[p + m:u], b[q + m:v])
            matched += sum(g == h for g, h in zip(a[u:u + n], b[v:v + n]))
            r, r_equal = plain_extension(a[u + n:], b[v + n:], chaining.DROP)
            size = u + n + r - x + l, v + n + r - y + l
            if min(size) >= chaining.MIN_WORDS and matched + r_equal >= chaining.IDENTITY * max(size):
                out.append((s, e, (a0 + x - l, a0 + u + n + r, b0 + y - l, b0 + v + n + r, matched + r_equal)))
    return {p for s, e, p in out if not any(t <= s and e <= f and (t, f) != (s, e) for t, f, _ in out)}


def test_alignment_of_many_chains_against_each_by_itself(monkeypatch):
    """Chains of edited copies, cut out of windows, aligned all at once and word by word."""
    import pyarrow as pa
    from clickweave.llm import chaining
    rng, rows = random.Random(5), []
    for _ in range(150):
        a = [rng.randrange(1000) for _ in range(rng.choice((60, 120, 300)))]
        b, i = [rng.randrange(1000) for _ in range(rng.randrange(20))], 0
        rate = rng.choice((0.02, 0.1, 0.2))
        while i < len(a):
            x = rng.random()
            if x < rate / 2:
                b.append(rng.randrange(1000))
            elif x < rate:
                b += [rng.randrange(1000) for _ in range(rng.choice((1, 2, 30)))]
                i -= 1
            elif x < 1.1 * rate:
                i += rng.choice((1, 3, 40))
            if x >= rate and i < len(a):
                b.append(a[i])
            i += 1
        seen = {}
        for j in range(len(a) - 4):
            seen.setdefault(tuple(a[j:j + 5]), j)
        found = [(j, seen[tuple(b[j:j + 5])]) for j in range(len(b) - 4) if tuple(b[j:j + 5]) in seen]
        if found:
            rows.append((b, a, chaining.chains(found)))
    for limit in (chaining.ALIGNED, 200):
        monkeypatch.setattr(chaining, "ALIGNED", limit)
        i0 = [max(0, min(c[0][0] for c in cs) - chaining.REACH) for _, _, cs in rows]
        j0 = [max(0, min(c[0][1] for c in cs) - chaining.REACH) for _, _, cs in rows]
        sides = [chaining.Side(pa.array([np.array(r[k][at:], np.uint32).tobytes() for r, at in zip(rows, start)], pa.binary()), pa.array(start, pa.int32()))
                 for k, start in enumerate((i0, j0))]
        chains = [(r, c) for r, (_, _, cs) in enumerate(rows) for c in cs]
        first = np.cumsum([0] + [len(c) for _, c in chains])
        runs = np.array([run for _, c in chains for run in c], np.int64)
        got = {}
        for c, *piece in chaining.align(*sides, np.array([r for r, _ in chains]), first, *(np.ascontiguousarray(x) for x in runs.T)):
            got.setdefault(c, set()).add(tuple(piece))
        for c, (r, chain) in enumerate(chains):
            b, a, _ = rows[r]
            i, j = max(0, chain[0][0] - chaining.REACH), max(0, chain[0][1] - chaining.REACH)
            x, y = chain[-1][0] + chain[-1][2] + chaining.REACH, chain[-1][1] + chain[-1][2] + chaining.REACH
            assert got.get(c, set()) == plain_pieces(chain, b[i:x], i, a[j:y], j)
        assert len(got) > 50


def floors(v):
    return [int(np.floor(256 * float(x))) for x in v]


def test_top_k(spark, monkeypatch):
    from clickweave.llm import topk
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(300)]
    data += [(300 + i, data[50][1]) for i in range(60)]  # a hot vector
    data += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] + [0.0] * 7), (403, [float("inf")] * 8),
             (450, [0.0] * 8), (None, data[0][1]), data[7]]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("score", F.lit(0)).repartition(4)
    got = {tuple(r) for r in topk.search(table, table.where("vec_id % 50 = 0"), 5).collect()}
    good = {i: floors(v) for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in good if i % 50 == 0):
        best = sorted(((int(np.dot(good[q], good[c])), -c) for c in good if c != q), reverse=True)[:5]
        want |= {(q, k + 1, -c, s) for k, (s, c) in enumerate(best)}
    assert got == want
    assert topk.search(table.limit(0), table.limit(0)).count() == 0


def test_threshold_stops_early():
    from clickweave.llm.topk import Lists
    rng = np.random.default_rng(2)
    v = np.floor(256 * rng.normal(0, 1, (5000, 3)) ** 3).astype(np.int64)
    found, scored = Lists(v, [[i] for i in range(len(v))]).search(np.array([3, -2, 1]), -1, 5, -(1 << 60))
    want = sorted(((int(s), -i) for i, s in enumerate(v @ np.array([3, -2, 1]))), reverse=True)[:5]
    assert found == [(s, -i) for s, i in want] and scored < len(v) // 2


def test_fingerprints(spark, docs, empty, clashing, monkeypatch):
    from clickweave.llm import simhash
    monkeypatch.setattr(simhash, "RANGE", 5)
    plain = [r for r in rows() if r[0] is not None and r[0] != 49]
    table = spark.createDataFrame(plain, SCHEMA).repartition(3)
    got = {r.doc_id: r for r in simhash.edited_likeness(table).collect()}
    texts = [t or "" for _, t, *_ in plain]
    assert len(got) == len(plain)
    for k, (i, *_) in enumerate(sorted(plain)):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        follower = got[sorted(plain)[(k + 1) % len(plain)][0]].fingerprint
        apart = bin(int(got[i].fingerprint, 16) ^ int(follower, 16)).count("1")
        assert got[i].near_next == pytest.approx(1 - apart / 128)
        apart = bin(int(got[i].fingerprint, 16) ^ int(got[i].edited_fingerprint, 16)).count("1")
        assert got[i].near_edited == pytest.approx(1 - apart / 128)
    assert got[3].fingerprint == got[50].fingerprint and got[40].fingerprint == "0" * 32
    for t in (docs, clashing):  # null ids and repeated rows too
        assert simhash.edited_likeness(t).count() == len(rows())
    assert simhash.edited_likeness(empty).count() == 0


def test_block_tables_find_all(spark):
    from clickweave.llm import simhash
    rng = random.Random(4)
    base = [rng.getrandbits(128) for _ in range(40)]
    marks = base + [b ^ sum(1 << k for k in rng.sample(range(128), n)) for b in base for n in (1, 3, 4)]
    def half(x):
        return x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(half(m >> 64), half(m & (2**64 - 1))) for m in marks], "hi long, lo long")
    got = {tuple(r) for r in simhash.within(table, table, 3).collect()}
    want = set()
    for a in marks:
        for b in marks:
            if bin(a ^ b).count("1") <= 3:
                want.add((half(a >> 64), half(a & (2**64 - 1)), half(b >> 64), half(b & (2**64 - 1))))
    assert got == want
