import hashlib
import math
import random

import numpy as np
import pytest

from tallyline.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, v string, cluster string, distance string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, "x", "y", "z") for i, e in rows], SCHEMA)


def brute(rows, dims, k, rounds):
    usable = [(i, [math.floor(max(-2.0**27, min(2.0**27, 64 * float(np.float32(x))))) for x in e]) for i, e in rows
              if e is not None and len(e) == dims and all(x is not None and math.isfinite(np.float32(x)) for x in e)]
    key = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted((key(i), v) for i, v in usable if i is not None)[:k]]
    if not centroids:
        return []
    for step in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in usable]
        if step < rounds:
            groups = [[v for (_, v), (_, n) in zip(usable, near, strict=True) if n == m] for m in range(len(centroids))]
            centroids = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centroids, strict=True)]
    return [(i, n, s) for (i, _), (s, n) in zip(usable, near, strict=True)]


def rows(n=300, dims=5, seed=4):
    r = random.Random(seed)
    out = [(i, [r.gauss(r.choice([-1, 0, 2]), 0.2) for _ in range(dims)]) for i in range(n)]
    out += [(7, out[3][1]), (None, out[5][1]), (None, None)] + [(1000 + k, out[9][1]) for k in range(200)]     # repeated rows, hot cluster
    return out + [(2000, None), (2001, []), (2002, [0.0] * (dims + 1)), (2003, [None] + [0.0] * (dims - 1)), (2004, [math.nan] + [0.0] * (dims - 1)),
                  (2005, [math.inf] * dims), (2006, [3e38] + [0.0] * (dims - 1)), (2007, [-0.0] * dims)]


@pytest.mark.parametrize("k, rounds", [(4, 3), (16, 2), (1, 1), (5000, 1)])
def test_clusters_equal_brute_force(spark, k, rounds):
    data = rows(n=80 if k > 100 else 300)
    got, _ = C.cluster(table(spark, data), dims=5, k=k, rounds=rounds)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(data, 5, k, rounds), key=key)


def test_tables_equal_plain_distances_for_any_range():
    g = np.random.default_rng(1)
    for spread in (3, 1000, 1 << 27):
        block, centroids = g.integers(-spread, spread, (500, 7)), g.integers(-spread, spread, (3, 7))
        want = ((block[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (C.table_distances(block, centroids) == want).all()


@pytest.mark.parametrize("data", [[], [(1, None)], [(None, [0.5] * 5)]])
def test_no_start_no_rows(spark, data):
    got, centroids = C.cluster(table(spark, data), dims=5)
    assert got.collect() == [] and len(centroids) == 0 and got.columns == ["vec_id", "cluster", "distance"]


def test_query_equals_sql(spark, tmp_path):
    import duckdb

    data = [(i, e) for i, e in rows(120, 64)][:-2]
    seen = set()
    data = [(i, e) for i, e in data if i is not None and not (i in seen or seen.add(i))]     # SQL needs one row per id for equal starts
    table(spark, data).select("vec_id", "embedding").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    rel = con.execute(C.ORACLE_SQL)
    names = [d[0] for d in rel.description]
    got = C.op13_lookup_centroids(spark, str(tmp_path)).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())


def test_query_without_usable_vectors(spark, tmp_path):
    table(spark, [(1, None)]).select("vec_id", "embedding").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert C.op13_lookup_centroids(spark, str(tmp_path)).collect() == []
