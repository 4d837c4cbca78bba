import hashlib
import os
import random

import duckdb
import numpy as np
from helpers import clashing

from logweave.llm import annulus_clustering as a


def brute(rows, c):
    """(id, cluster, distance) by plain integers, and the centroids."""
    kept = [(i, [int(np.floor(np.float64(np.float32(x)) * c.scale)) for x in v]) for i, v in rows if v is not None and len(v) == c.dims and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{c.salt}{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(((name(i), v) for i, v in kept))[: c.k]]

    def put():
        for i, v in kept:
            d, k = min((sum((x - y) ** 2 for x, y in zip(v, m, strict=True)), k) for k, m in enumerate(centroids))
            yield i, k, d, v

    for _ in range(c.rounds):
        mine = list(put())
        for k in range(len(centroids)):
            if vs := [v for _, n, _, v in mine if n == k]:
                centroids[k] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return [(i, k, d) for i, k, d, _ in put()], centroids


def check(spark, rows, c, wrap=lambda df: df):
    df = wrap(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    got = a.cluster(df, c).collect()
    want, centroids = brute(rows, c)
    assert sorted([(r["vec_id"], r["cluster"], r["distance"]) for r in got], key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, k, d in want if k == r["cluster"]) and r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()
    return got


def vectors(n, dims, spread=1.0, seed=5):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0, 1) * (1 + spread * (k % 7)) for _ in range(dims)]) for k in range(n)]


def test_against_brute_force(spark):
    for c in (a.Config(), a.Config(k=5, dims=3, rounds=6, scale=4, salt="x"), a.Config(k=1, dims=2, rounds=1)):
        check(spark, vectors(200, c.dims), c)


def test_ties_and_repeated_rows(spark):
    c = a.Config(k=6, dims=2, rounds=2, scale=1)
    grid = [(k, [float(k % 3), float(k // 3 % 3)]) for k in range(60)] + [(7, [1.0, 2.0])] * 5 + [(7, [0.0, 0.0])] * 2
    check(spark, grid, c)
    same = check(spark, [(k, [1.0, 1.0]) for k in range(30)], c)
    assert {r["cluster"] for r in same} == {0} and {r["distance"] for r in same} == {0}


def test_edges(spark):
    c = a.Config(k=4, dims=3, rounds=2)
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0] * 4), (104, [1.0, None, 2.0]), (105, [nan, 1.0, 1.0]), (106, [inf, 1.0, 1.0]), (107, [1.0, -inf, 0.0])]
    some = [(None, [0.5, 0.25, -0.1]), (None, [3.0, 1.0, 2.0]), (1, [-0.01, -1.0, 5.0]), (1, [-0.01, -1.0, 5.0]), (2, [0.0, 0.0, 0.0])]
    assert len(check(spark, some + odd, c, clashing)) == 5
    assert len(check(spark, some[:2], c)) == 2
    for rows in (odd, []):
        empty = a.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), c)
        assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_huge_components_keep_their_bound(spark):
    c = a.Config(k=2, dims=2, rounds=2)
    rows = [(1, [3e38, -3e38]), (2, [1e7, 0.0]), (3, [0.0, 0.0])]
    got = {r["vec_id"]: r for r in a.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), c).collect()}
    assert sorted(got) == [1, 2, 3] and all(0 <= r["distance"] <= 4 * a.LIMIT**2 * 2 for r in got.values())


def test_annulus_is_exact_and_prunes():
    rng = np.random.default_rng(3)
    for spread in (0, 1, 20):
        centroids = rng.integers(-50, 50, (16, 8)) * (1 + spread * rng.integers(0, 5, (16, 1)))
        x = rng.integers(-50, 50, (3000, 8)) * (1 + spread * rng.integers(0, 5, (3000, 1)))
        number, least, compared = a.nearest(x, centroids)
        d = ((x[:, None] - centroids[None]) ** 2).sum(2)
        assert (number == d.argmin(1)).all() and (least == d.min(1)).all()
        assert 3000 <= compared <= 3000 * 16
        if spread == 20:
            assert compared < 3000 * 10
    # on the boundary: norms differ by just the distance, and the smaller number wins a tie
    line = np.array([[4], [2], [6], [2]])
    assert a.nearest(np.array([[3], [5], [2]]), line)[0].tolist() == [0, 0, 1]


def test_sql_twin(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame([(9001, [1.0]), (9002, None), (9003, [float("nan")] * 64), (None, [0.5] * 64), (3, [0.5] * 64)], rows.schema)
    rows.union(odd).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    d = duckdb.connect()
    d.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    r = d.sql(a.ORACLES["op13_annulus_clustering"])
    got = a.op13_annulus_clustering(spark, str(tmp_path))
    assert sorted(map(repr, r.fetchall())) == sorted(repr(tuple(x[c] for c in r.columns)) for x in got.collect())
    assert os.listdir(tmp_path)
