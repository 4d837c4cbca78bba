r"""Centroid clustering with exact integer arithmetic and annulus search.

Vectors are rounded to integers, ``floor(scale * x)``; distances, sums and centroids are integers,
so the result is the same for any partitioning and in any run. The k centroids start as the vectors with
the smallest hashes of their ids. Every round assigns each vector to the nearest centroid (ties: the
smaller number) and moves each centroid to the floor of the mean of its vectors; one without vectors stays.

*Annulus search*: by the triangle inequality a centroid is at least as far from a vector as their
norms differ. The centroids are sorted by norm. The one whose norm is nearest to the vector's gives an upper
bound u, and two binary searches give the centroids whose norms are within u of the vector's; only
those are compared exactly, from the nearest norm outwards, while the bound tightens. A candidate goes only if its norm is
strictly outside, with room for rounding, so every centroid at the least distance is compared, and ties are right.

A round reads the vectors once, and each task sends one row of sums for each centroid; what is broadcast and
what the driver sees is k * dims numbers. The vectors are never shuffled or copied, so repeated vectors cost no more than others.

:func:`cluster` returns one row per vector that has exactly ``dims`` components, none null or not finite:
its id, cluster, distance (squared), cluster_inertia, inertia (null if the sum is beyond a long) and centroid_sha256. Others, null vectors included, have no
row. Components beyond ±2**27 after scaling count as ±2**27, so that distances fit a long. Null ids take part (hashed as empty
text), as do rows that repeat an id; those of one hash start in the order of their components. With fewer vectors than k there
are as many centroids. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import read, written

LIMIT = 1 << 27


@dataclass(frozen=True)
class Config:
    k: int = 16
    dims: int = 64
    rounds: int = 3
    scale: int = 64
    #: Put before the id when the first centroids are drawn.
    salt: str = "1:"


def whole(values: np.ndarray, c: Config) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * c.scale), -LIMIT, LIMIT).astype(np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each row of ``x``; and how many exact comparisons that took."""
    norm = np.sqrt((centroids.astype(np.float64) ** 2).sum(1))
    order = np.argsort(norm, kind="stable")
    ring, own = norm[order], np.sqrt((x.astype(np.float64) ** 2).sum(1))
    k = len(order)

    after = np.searchsorted(ring, own)
    left, right = np.maximum(after - 1, 0), np.minimum(after, k - 1)
    start = np.where(np.abs(ring[left] - own) <= np.abs(ring[right] - own), left, right)
    best = order[start]
    least = squared(x, centroids[best])
    compared = len(x)
    reach = lambda: np.sqrt(least.astype(np.float64)) * (1 + 1e-9) + 1e-6 * (1 + own)  # noqa: E731  more than rounding can hide
    u = reach()
    lo, hi = np.searchsorted(ring, own - u, "left"), np.searchsorted(ring, own + u, "right")
    for step in range(1, k):
        for at in (start - step, start + step):
            live = np.flatnonzero((at >= lo) & (at < hi))
            live = live[np.abs(ring[at[live]] - own[live]) <= u[live]]
            if not len(live):
                continue
            compared += len(live)
            number = order[at[live]]
            d = squared(x[live], centroids[number])
            closer = (d < least[live]) | ((d == least[live]) & (number < best[live]))
            best[live[closer]], least[live[closer]] = number[closer], d[closer]
        u = reach()
        if not ((start - step > lo) | (start + step < hi - 1)).any():
            break
    return best, least, compared


def kept(df: DataFrame, c: Config, vector: str, key: str) -> DataFrame:
    """id, v: the vectors that count."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return df.where((F.size(vector) == c.dims) & ~odd).select(F.col(key).alias("id"), F.col(vector).alias("v"))


def matrix(batch: pa.RecordBatch, c: Config) -> np.ndarray:
    return whole(batch.column(1).flatten().to_numpy().reshape(-1, c.dims), c)


def first_centroids(vectors: DataFrame, c: Config) -> np.ndarray:
    """k rows only pass through the driver."""
    name = F.sha2(F.concat(F.lit(c.salt), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = vectors.select(name.alias("name"), F.transform("v", lambda x: F.floor(x.cast("double") * c.scale)).alias("v")).orderBy("name", "v").limit(c.k).collect()
    return np.array([[min(max(x, -LIMIT), LIMIT) for x in r["v"]] for r in drawn], np.int64).reshape(-1, c.dims)


def moved(vectors: DataFrame, centroids: np.ndarray, c: Config) -> np.ndarray:
    """Every centroid at the floor of the mean of its vectors. A task sends a row for each centroid that it has vectors of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            x = matrix(batch, c)
            number, _, _ = nearest(x, centroids)
            count += np.bincount(number, minlength=len(centroids))
            for k in np.unique(number):
                total[k] += x[number == k].sum(0)
        have = np.flatnonzero(count)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(have) + 1, dtype=np.int32) * c.dims), pa.array(total[have].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(count[have]), sums], ["cluster", "n", "sums"])

    parts = vectors.mapInArrow(run, "cluster int, n long, sums array<long>").select("cluster", "n", F.posexplode("sums").alias("dim", "x"))
    total = parts.groupBy("cluster", "dim").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in total.collect():  # at most k * dims
        out[r["cluster"], r["dim"]] = int(r["x"]) // r["n"]
    return out


def cluster(df: DataFrame, c: Config = Config(), vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector; see the module's text."""
    vectors = kept(df, c, vector, key)
    centroids = first_centroids(vectors, c)
    for _ in range(c.rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids, c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance, _ = nearest(matrix(batch, c), centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], [key, "cluster", "distance"])

    put = written(vectors.mapInArrow(run, f"{key} {vectors.schema['id'].dataType.simpleString()}, cluster int, distance long"), "clusters")
    names = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centroids.tolist()]
    sums = dict(put.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # at most k rows
    whole_sum = sum(sums.values())
    long = lambda n: int(n) if n < 1 << 63 else None
    told = [(k, long(n), long(whole_sum), names[k]) for k, n in sums.items()]
    known = df.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return put.join(F.broadcast(known), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def op13_annulus_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))


_ROUND = """a{0} AS MATERIALIZED (SELECT i, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT i, k.v, c, list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM k, m{0} m) GROUP BY i, v)"""
_MOVE = """u{0} AS (SELECT c, list(CASE WHEN n = 0 THEN 0 ELSE (s - ((s % n) + n) % n) // n END ORDER BY p) AS v FROM (SELECT c, p, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS p FROM a{0}) GROUP BY c, p) GROUP BY c),
m{1} AS MATERIALIZED (SELECT m.c, coalesce(u.v, m.v) AS v FROM m{0} m LEFT JOIN u{0} u USING (c))"""
_SQL = (
    """WITH k AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM k ORDER BY h, v LIMIT 16)),
"""
    + ",\n".join(f"{_ROUND.format(r)},\n{_MOVE.format(r, r + 1)}" for r in range(3))
    + f""",
{_ROUND.format(3)}
SELECT vec_id, a.c::INT AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256 FROM a3 a JOIN k USING (i) JOIN m3 m ON m.c = a.c"""
)

QUERIES = {"op13_annulus_clustering": op13_annulus_clustering}
ORACLES = {"op13_annulus_clustering": _SQL}
