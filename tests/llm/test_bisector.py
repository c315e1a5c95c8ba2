"""The bisector tournament against distances in Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilerank.llm import bisector as B


def brute(rows, k=40, rounds=5):
    """rows: (vec_id, list of floats or None) -> sorted result rows."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    c = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            own = [v for (_, v), a in zip(kept, at) if a == j]
            if own:
                c[j] = [sum(col) // len(own) for col in zip(*own)]
    best = [nearest(v) for _, v in kept]
    per = {j: sum(d for d, a in best if a == j) for j in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, a, d, per[a], sum(per.values()), sha[a]) for (i, _), (d, a) in zip(kept, best)), key=str)


def got(df):
    return sorted((tuple(r) for r in B.cluster(df).collect()), key=str)


def test_tournament_is_the_nearest_with_ties():
    rng = np.random.default_rng(1)
    for k in (1, 2, 3, 7, 40):
        for high in (2, 300, B.LIMIT):  # many ties; plain; the largest allowed
            c = rng.integers(-high + 1, high, (k, 64))
            c[k // 2] = c[0]
            x = np.concatenate([rng.integers(-high + 1, high, (50, 64)), c])
            d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m)) for m in c] for v in x]
            b = B.Bisectors(c)
            at = b.nearest(x)
            assert at.tolist() == [min(range(k), key=lambda j: (r[j], j)) for r in d]
            assert b.distance(x, at).tolist() == [min(r) for r in d]


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 64)) * rng.choice([0.01, 1, 30], (300, 1))
    x[:100] = x[0]  # a third of all rows is one vector
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(7, x[9].tolist()), (7, x[9].tolist()), (None, x[150].tolist())]
    odd = [(900, None), (901, [1.0] * 63), (902, [1.0] * 63 + [None]), (903, [float("nan")] + [1.0] * 63), (904, [float("-inf")] + [1.0] * 63), (905, []), (906, [-0.0] * 64)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(5)
    df = df.withColumns({c: F.lit("x") for c in ("v", "cluster", "distance", "e", "s", "n", "i", "inertia")})
    assert got(df) == brute(rows + odd)


def test_few_and_no_vectors(spark):
    rows = [(i, [i / 7.0] * 64) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    single = [(i, np.float32(v).astype(float).tolist()) for i, v in rows]
    assert got(df) == brute(single)
    empty = B.cluster(df.limit(0))
    assert empty.count() == 0 and empty.columns == B.cluster(df).columns
    with pytest.raises(Exception, match="not below"):
        B.cluster(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")).collect()
