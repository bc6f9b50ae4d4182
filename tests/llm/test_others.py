"""Operators 1, 6 and 7, the pipeline and the registration."""

import math
import random
from collections import defaultdict

import pytest
from samples import SCHEMA, prose
from pyspark.sql import functions as F


def brute_mix(items, quality, weights=(5, 2, 1), cap=3.0):
    """Copies of each (doc_id, source, size) by the plain full sort."""
    import hashlib
    size = defaultdict(int)
    for _, s, n in items:
        size[s] += n
    names = sorted((s for s in size if s is not None), key=lambda x: [ord(c) for c in x]) + ([None] if None in size else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(size.values())), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > cap * size[s]}
        if not above:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in above:
            target[s] = cap * size[s]
            left -= target[s]
        open_ -= above
    copies = {}
    for s in names:
        epochs = math.floor(target[s] / size[s]) if size[s] else 0
        rest, run, go = target[s] - epochs * size[s], 0, True
        def key(d):
            u = (int(hashlib.md5(str(d).encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            return -math.log(u) / quality.get(d, 1.0)
        for d, _, n in sorted((x for x in items if x[1] == s), key=lambda x: (key(x[0]), x[0])):
            run += n
            go = go and rest > 0 and run - n / 2 <= rest
            copies[d] = (epochs + (1 if go else 0), target[s])
    return copies


def test_mix_equals_the_full_sort(spark):
    from clickweave.llm import mixing
    r = random.Random(3)
    items = [(i, r.choice(["a", "a", "a", "b", "B", "é", None]), r.randint(0, 60)) for i in range(600)]
    items += [(1000 + i, "tiny", 2) for i in range(3)]
    table = spark.createDataFrame([(i, " ".join(["w"] * n) if n else ("" if i % 2 else None), "en", s, n) for i, s, n in items], SCHEMA).repartition(3)
    quality = {i: (2.0 if i % 3 else 0.5) for i in range(0, 600, 2)}
    side = spark.createDataFrame(list(quality.items()), "doc_id long, quality double")
    got = {r_.doc_id: (r_.copies, r_.target) for r_ in mixing.mix(table, side).collect()}
    want = brute_mix(items, quality)
    assert {d: c for d, (c, _) in got.items()} == {d: c for d, (c, _) in want.items()}
    for d, (_, t) in want.items():
        assert got[d][1] == pytest.approx(t)
    assert max(c for c, _ in got.values()) <= 3


def test_mix_edges(docs, empty, clashing):
    from clickweave.llm import mixing
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.mix(empty).count() == 0
    out = mixing.repeated(clashing)
    assert out.columns == clashing.columns
    assert out.select("doc_id").distinct().count() <= docs.count()


def test_lookup_table():
    from clickweave.llm import maglev
    names = [f"s{i}" for i in range(7)]
    table = maglev.filled(names, 251)
    counts = [table.count(i) for i in range(7)]
    assert max(counts) - min(counts) <= 1
    # brute force: turn by turn, each shard walks its own preference list
    walks = []
    for s in names:
        offset, skip = maglev._number(s, "offset") % 251, maglev._number(s, "skip") % 250 + 1
        walks.append(iter([(offset + k * skip) % 251 for k in range(251)]))
    want = {}
    while len(want) < 251:
        for i, walk in enumerate(walks):
            if len(want) < 251:
                want[next(x for x in walk if x not in want)] = i
    assert [want[x] for x in range(251)] == table
    fewer = maglev.filled(names[:-1], 251)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 251 // 4
    with pytest.raises(ValueError):
        maglev.filled(names, 250)


def test_placement(docs, empty, clashing, spark):
    from clickweave.llm import maglev
    from clickweave.session import scratch_path
    names = ["a", "b", "c"]
    table = maglev.filled(names, 251)
    for t in (docs, clashing):
        out = maglev.place(t, names, slots=251).collect()
        assert len(out) == docs.count()
        assert all(names[table[r.slot]] == r.shard for r in out)
    assert maglev.place(empty, names).count() == 0
    folder = scratch_path(spark, "t-shards")
    maglev.write_shards(docs, names, folder, slots=251)
    assert spark.read.parquet(folder).count() == docs.count()


def test_toxicity(spark, docs, empty, clashing):
    from clickweave.llm import toxicity
    bad = ["stupid", "idiot", "pathetic", "worthless", "moron"]
    r = random.Random(1)
    items, labels = [], []
    for i in range(400):
        w = prose(i, 80).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(bad))
        items.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    # unseen spellings in rows without labels
    items += [(1000, prose(1000, 60) + " stuppid idiott"), (1001, prose(1001, 60) + " patheticc moronn")]
    items += [(1002, None), (1003, ""), (None, prose(3, 20))]
    table = spark.createDataFrame(items, "doc_id long, text string")
    side = spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")
    got = {x.doc_id: x for x in toxicity.score(table, side, toxicity.SampleBound(200, 300)).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    assert len(got) == len(items) and all(0 <= x.toxic_score <= 1 for x in got.values())
    held = [(got[i].toxic_score >= 0.3, bool(y)) for i, y in labels if got[i].held]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    clean = sorted(got[i].toxic_score for i, y in labels if not y)
    assert min(got[1000].toxic_score, got[1001].toxic_score) > clean[int(0.97 * len(clean))]
    assert got[1002].toxic_score == got[1003].toxic_score < 0.3
    kept = {x.doc_id for x in toxicity.keep_clean(table, side, threshold=0.1).collect()}
    assert kept.isdisjoint({1000, 1001}) and kept >= {1002, 1003, None}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {x.toxic_score for x in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, side).count() == 0
    assert toxicity.keep_clean(clashing, none).columns == clashing.columns


def test_queries_are_registered():
    import __spark_entry__ as entry
    have = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in have) == 1
    assert "pipeline" in have


def test_pipeline_on_the_smallest_tables(spark):
    import corpus_pipeline
    from test_pairs import brute_components
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "substring dedup", "mixing sources", "BPE encoding"]
    clean = corpus_pipeline.drop_toxic(spark, docs, sf).cache()
    one = corpus_pipeline.drop_near_copies(spark, clean, sf).cache()
    assert clean.columns == one.columns == docs.columns
    comps = brute_components([(r.doc_id, r.text) for r in clean.collect()])
    assert {r.doc_id for r in one.collect()} == {c for _, _, c in comps}
    cut = corpus_pipeline.cut_repeats(spark, one, sf).cache()
    assert cut.columns == docs.columns and cut.count() <= one.count()
    # no 50 words stand twice any more
    seen = defaultdict(set)
    for r in cut.collect():
        w = (r.text or "").lower().split()
        for i in range(len(w) - 49):
            seen[tuple(w[i:i + 50])].add(r.doc_id)
    assert not [v for v in seen.values() if len(v) > 1]
    assert corpus_pipeline.run(spark, sf).count() > 0
