"""DuckDB SQL of operators 12 and 13 on tables with links, nulls and copies."""

import math
import random

import duckdb
import numpy as np


def both(spark, tmp_path, name, table, key):
    """(rows of the query, rows of its SQL), sorted by column name."""
    import __spark_entry__ as entry
    folder = f"{tmp_path}/{name}.parquet"
    table.coalesce(1).write.parquet(folder)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/*.parquet'")
    got = entry.queries()[key](spark, str(tmp_path))
    want = con.sql(entry.oracle_sql()[key])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    def rows(columns, data):
        return sorted(([r[columns.index(c)] for c in order] for r in data), key=str)
    return rows(got.columns, map(tuple, got.collect())), rows(want.columns, want.fetchall())


def test_near_copies(spark, tmp_path):
    r = np.random.default_rng(3)
    base = r.standard_normal((60, 16))
    vecs = [b + r.standard_normal(16) * s for b in base for s in (0, 0.02, 0.05, 0.1)] + [base[0]] * 3
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vecs)]
    rows += [(900, None, 0), (901, [0.0] * 16, 0), (902, [math.nan] * 16, 0), (903, [None] * 16, 0), (904, [1.0, 2.0], 0), (905, [2.0, 4.0], 0)]
    got, want = both(spark, tmp_path, "embeddings", spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), "op12_nndescent")
    assert got == want and any(x[-2] for x in got)


def test_manifest(spark, docs, tmp_path):
    r = random.Random(1)
    rows = [tuple(x) for x in docs.where("doc_id IS NOT NULL").dropDuplicates().collect()]
    rows += [(1000 + i, f"Text {i} Ä", None, r.choice(["a", "B", "é", None, *[f"s{k}" for k in range(30)]]), i) for i in range(900)]
    got, want = both(spark, tmp_path, "documents", spark.createDataFrame(rows, docs.schema), "op13_manifest")
    assert got == want and {x[-1] for x in got} == {True, False}
