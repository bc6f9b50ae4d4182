"""Operator 12 against brute force."""

import math

import numpy as np

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_near(rows, threshold=0.95):
    """(vec_id, n_links, component_id, kept) by comparing all pairs in doubles."""
    ok, unit = [], []
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.float32(v).astype(float)
            ok.append(i)
            unit.append(u / np.linalg.norm(u))
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = [0] * len(rows)
    for d in {len(u) for u in unit}:
        own = [k for k, u in enumerate(unit) if len(u) == d]
        m = np.stack([unit[k] for k in own])
        fits = m @ m.T >= threshold
        np.fill_diagonal(fits, False)
        for a, b in zip(*np.nonzero(fits)):
            i, j = ok[own[a]], ok[own[b]]
            links[i] += 1
            parent[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(d, low.get(top(i), d))
    return [(d, links[i], low.get(top(i)), d == low.get(top(i))) for i, (d, _) in enumerate(rows)]


def around(r, centre, angle, n):
    """Vectors near ``centre``, off by about ``angle`` (radians)."""
    noise = r.standard_normal((n, len(centre)))
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    a = np.abs(r.normal(angle, angle / 10, n))[:, None]
    return np.cos(a) * centre + np.sin(a) * noise


def unit(r, d):
    v = r.standard_normal(d)
    return v / np.linalg.norm(v)


def key(x):
    return tuple((v is not None, v) for v in x)


def sample(r):
    vecs = [unit(r, 32) for _ in range(2500)]
    for c in range(60):  # pairs and small groups around the threshold
        centre = vecs[c]
        vecs += list(around(r, centre, 0.12 + 0.004 * c, 1 + c % 5))
    vecs += list(around(r, unit(r, 32), 0.05, 700))  # denser than a list: any two are linked
    vecs += list(around(r, unit(r, 32), 0.22, 650))  # large, with pairs on both sides of the threshold
    base = unit(r, 32)  # a chain of links
    side = unit(r, 32)
    side -= side @ base * base
    side /= np.linalg.norm(side)
    vecs += [math.cos(0.2 * k) * base + math.sin(0.2 * k) * side for k in range(15)]
    rows = [(i, [float(np.float32(x)) for x in v * (1 + i % 3)]) for i, v in enumerate(vecs)]
    rows += [(10000 + i, rows[7][1]) for i in range(40)] + [(7, rows[9][1]), (None, rows[11][1]), (None, [1.0] * 32)]
    rows += [(20000, None), (20001, []), (20002, [0.0] * 32), (20003, [None] + [1.0] * 31), (20004, [float("nan")] * 32),
             (20005, [float("inf")] + [0.0] * 31), (20006, [1.0, 2.0]), (20007, [2.0, 4.0]), (20008, [3.0e38] * 32), (20009, [1e-30] * 32)]
    return rows


def test_near_copies_equal_brute_force(spark):
    from clickweave.llm import nndescent
    rows = sample(np.random.default_rng(5))
    table = spark.createDataFrame([(d, v, 0) for d, v in rows], SCHEMA).repartition(4).withColumnRenamed("label", "node")
    out = nndescent.near_copies(table)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert dict(out.dtypes)["n_links"] == "bigint"
    got = sorted(map(tuple, out.collect()), key=key)
    want = sorted(brute_near(rows), key=key)
    assert len(got) == len(want)
    true = sum(w[1] for w in want)
    found = sum(g[1] for g in got)
    assert found <= true and found >= 0.99 * true
    assert sum(g == w for g, w in zip(got, want)) >= 0.99 * len(want)


def test_near_copies_edges(spark):
    from clickweave.llm import nndescent
    assert nndescent.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    bad = spark.createDataFrame([(1, None, 0), (2, [0.0], 0), (None, None, 0)], SCHEMA)
    assert sorted(map(tuple, nndescent.near_copies(bad).collect()), key=key) == [(None, 0, None, True), (1, 0, 1, True), (2, 0, 2, True)]
    two = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 0.0], 0)], SCHEMA)
    assert sorted(map(tuple, nndescent.near_copies(two).collect())) == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False)]


def test_blocks_keep_groups_and_bounds():
    import pyarrow as pa
    from clickweave.llm import nndescent
    r = np.random.default_rng(1)
    g = np.sort(r.integers(0, 60, 1000))
    g[400:900] = g[400]
    parts = [pa.RecordBatch.from_arrays([pa.array(g[a:a + 70] // 20), pa.array(g[a:a + 70])], names=["h", "s"]) for a in range(0, 1000, 70)]
    out = list(nndescent.blocks(iter(parts), ["h"], ["s"], 16, 64))
    assert sum(([*t.column("s").to_pylist()] for t in out), []) == g.tolist()
    assert all(t.num_rows <= 64 and len(set(t.column("h").to_pylist())) == 1 for t in out)
    small = [v for v in set(g.tolist()) if (g == v).sum() <= 64]
    assert all(sum(v in t.column("s").to_pylist() for t in out) == 1 for v in small)


def test_tree_alone_and_refinement(spark):
    """Refinement finds links that few trees miss."""
    from clickweave.llm import nndescent
    r = np.random.default_rng(9)
    vecs = [unit(r, 48) for _ in range(1500)] + [v for _ in range(40) for v in around(r, unit(r, 48), 0.16, 12)]
    table = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(vecs)], SCHEMA)
    nodes = nndescent.nodes_of(table.select("vec_id", table["embedding"].alias("vec")))
    start = nndescent.merged(spark.createDataFrame([], f"v long, k int, nb {nndescent._LIST}, was array<long>"),
                             nndescent.trees(nodes, len(vecs), 0.999, 3), 0.95, "t-lists")
    refined = nndescent.merged(start, nndescent.joined(nodes, start), 0.95, "t-lists")
    assert nndescent.links_listed(refined, 0.95) > nndescent.links_listed(start, 0.95)
