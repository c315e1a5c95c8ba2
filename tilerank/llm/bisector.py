"""Centroid clustering by a bisector tournament, exact in whole numbers.

Vectors of exactly ``DIMS`` finite components become integers floor(256 * x). Centroids start as the vectors of smallest sha256 of ``2:<vec_id>``; each of ``ROUNDS`` rounds
assigns every vector and moves every non-empty centroid to its vectors' componentwise floor(sum / count); then vectors are assigned once more.

Method. x is nearer to centroid j than to i < j iff N . x > T with the integer normal N = 2 (c_j - c_i) and threshold T = |c_j|^2 - |c_i|^2 of the pair's bisector, computed once per
task. A knock-out tournament of k - 1 such tests leaves one centroid; a test that is zero favours the smaller number, and the survivors of a bracket stay in
ascending order, so the winner is the nearest centroid, ties to the smaller number. Only the winner's distance is computed.

Plan. The integer vectors are one materialised table; a round is one scan whose tasks keep k x 64 sums, so that a cluster of a third of all vectors is k rows per task;
sums are added as decimals and come to the driver as k x 64 numbers. Centroids (k x 64) go out with the task. No vector is shuffled or sorted, except that the first k by hash are taken.

Tests are exact: in float64 products while all of them stay below 2^53, else in int64, which holds them for components up to ``LIMIT`` (|x| below 2^19); larger ones raise
an error, as their distances would not fit the result's type.

Defined cases: vectors null, of another length or with null or non-finite components take no part; rows that repeat are rows of their own, seeds of equal hash are ordered by their components; a
null vec_id is no seed but is assigned; fewer than k vectors give fewer centroids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

DIMS, K, ROUNDS, SALT = 64, 40, 5, 2
SCALE = 256
LIMIT = 1 << 27
#: Rows of one tournament.
CHUNK = 4096


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(F.size("e") == DIMS).where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    fits = F.forall("e", lambda x: F.abs(x * SCALE) < LIMIT)
    checked = F.when(fits, F.transform("e", lambda x: F.floor(x * SCALE).cast("int"))).otherwise(F.raise_error(F.lit(f"a component is not below {LIMIT // SCALE}")).cast("array<int>"))
    return rows.select("vec_id", checked.alias("v"))


def seeds(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The first k vectors by hash (k x DIMS, fewer if there are fewer)."""
    named = vectors.where("vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit(f"{SALT}:"), F.col("vec_id").cast("string")), 256).alias("s"), "v")
    return np.array([r["v"] for r in named.orderBy("s", "v").limit(k).collect()], np.int64).reshape(-1, DIMS)


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament over them."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        self.normal = 2 * (centroids[None] - centroids[:, None])
        norm = (centroids * centroids).sum(1)
        self.limit = norm[None] - norm[:, None]
        self.largest = int(np.abs(self.normal).max(initial=0))

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row of ``x`` (int64), ties to the smaller number."""
        exact = self.largest * int(np.abs(x).max(initial=0)) * x.shape[1] < 1 << 53
        normal = self.normal.astype(np.float64) if exact else self.normal
        x = x.astype(np.float64) if exact else x
        left = [np.full(len(x), i) for i in range(len(self.c))]
        while len(left) > 1:
            won = []
            for a, b in zip(left[::2], left[1::2]):
                far = np.einsum("ij,ij->i", x, normal[a, b]) > self.limit[a, b]
                won.append(np.where(far, b, a))
            left = won + left[len(won) * 2 :]
        return left[0]

    def distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        d = x - self.c[at]
        return (d * d).sum(1)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, DIMS)


def _chunks(batches):
    for b in batches:
        for lo in range(0, b.num_rows, CHUNK):
            yield b.slice(lo, CHUNK)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k = len(centroids)

    def sums(batches):
        plane = Bisectors(centroids)
        total, count = np.zeros((k, DIMS), np.int64), np.zeros(k, np.int64)
        for b in _chunks(batches):
            x = _matrix(b.column("v"))
            at = plane.nearest(x)
            order = np.argsort(at, kind="stable")
            own, first = np.unique(at[order], return_index=True)
            total[own] += np.add.reduceat(x[order], first, axis=0)
            count += np.bincount(at, minlength=k)
        some = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * DIMS), pa.array(total[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), lists], names=["cluster", "n", "s"])

    parts = vectors.select("v").mapInArrow(sums, "cluster long, n long, s array<long>").select("cluster", "n", F.posexplode("s").alias("i", "s"))
    wide = parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = centroids.copy()
    for r in wide.collect():  # k x DIMS rows
        out[r["cluster"], r["i"]] = int(r["s"]) // int(r["n"])
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance)."""

    def place(batches):
        plane = Bisectors(centroids)
        for b in _chunks(batches):
            x = _matrix(b.column("v"))
            at = plane.nearest(x)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(at, pa.int32()), pa.array(plane.distance(x, at))], names=["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(place, "vec_id long, cluster int, distance long")


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> np.ndarray:
    """Final centroids of a materialised table of integer vectors."""
    centroids = seeds(vectors, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def cluster(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``: one row per vector that takes part."""
    vectors = stage(whole_vectors(embeddings), "bisector-vectors")
    centroids = fit(vectors, k, rounds)
    if not len(centroids):
        return vectors.limit(0).selectExpr("vec_id", *(f"CAST(NULL AS {t}) AS {c}" for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))))
    rows = stage(assigned(vectors, centroids), "bisector-assigned")
    per = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    facts = [(c, s, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(per.items())]
    table = rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, centroid_sha256 string")
    out = rows.join(F.broadcast(table), "cluster")  # k rows
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(per.values())).cast("long").alias("inertia"), "centroid_sha256")


def _oracle() -> str:
    ctes = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v AS m FROM v WHERE vec_id IS NOT NULL QUALIFY c < 40)",
    ]
    for t in range(ROUNDS + 1):
        ctes.append(
            f"a{t} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best FROM "
            f"(SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{t}) GROUP BY r)"
        )
        if t < ROUNDS:
            ctes.append(
                f"s{t} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT best.c AS c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{t}) GROUP BY c, i), "
                f"m{t} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{t} GROUP BY c), "
                f"c{t + 1} AS MATERIALIZED (SELECT c0.c, coalesce(m{t}.m, o.m) AS m FROM c0 JOIN c{t} o USING (c) LEFT JOIN m{t} USING (c))"
            )
    last = f"a{ROUNDS}"
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM {last} JOIN c{ROUNDS} z ON z.c = best.c"
    )


ORACLE = _oracle()
