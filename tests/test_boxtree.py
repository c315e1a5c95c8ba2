"""Box pyramids: nearest search and clustering equal brute force, and their work grows with the rows wherever these lie."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tilerank.operators import boxtree as B
from tilerank.operators.spatial import _split_pieces, nearest_feature
from tilerank.plans.towers import cluster_antennas


def seg_distance(px, py, x1, y1, x2, y2):
    dx, dy = x2 - x1, y2 - y1
    t = 0.0 if dx == dy == 0 else min(1.0, max(0.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
    return math.hypot(px - (x1 + t * dx), py - (y1 + t * dy))


def layouts(n, rnd):
    """name -> (points, segments)"""
    spot = lambda x, y, r: (rnd.gauss(x, r), rnd.gauss(y, r))
    line = lambda x, y, r: (x, y, x + rnd.uniform(-r, r), y + rnd.uniform(-r, r))
    yield "even", [(rnd.uniform(0, 1e5), rnd.uniform(0, 1e5)) for _ in range(n)], [line(rnd.uniform(0, 1e5), rnd.uniform(0, 1e5), 900) for _ in range(n // 2)]
    yield "far cluster", [spot(0, 0, 500) for _ in range(n)], [line(*spot(9e5, 2e5, 3000), 0) for _ in range(n // 2)]
    city = [spot(5e4, 5e4, 40) if i % 3 else (rnd.uniform(0, 1e5), rnd.uniform(0, 1e5)) for i in range(n)]
    yield "hot city", city, [line(*(spot(5e4, 5e4, 60) if i % 3 else (rnd.uniform(0, 1e5), rnd.uniform(0, 1e5))), 5) for i in range(n // 2)]


def frames(spark, points, segs):
    left = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "k long, x double, y double")
    return left, spark.createDataFrame([(j, *map(float, s)) for j, s in enumerate(segs)], "fid long, x1 double, y1 double, x2 double, y2 double")


def candidate_pairs(spark, points, segs):
    left, right = frames(spark, points, segs)
    pieces = _split_pieces(right.withColumnRenamed("fid", "_rk"), 1e9, ["_rk"])
    return B.nearest_pairs(left.toDF("_lk", "_x", "_y"), pieces).count()


def test_nearest_equals_brute_force_on_every_layout(spark):
    for name, points, segs in layouts(700, random.Random(2)):
        segs = segs + segs[:40] + [segs[5]] * 200  # equal geometries: the smallest key wins
        left, right = frames(spark, points, segs)
        got = {r["k"]: (r["distance_m"], r["fid"]) for r in nearest_feature(left, right, "k", "fid").collect()}
        assert len(got) == len(points)
        for i, (x, y) in enumerate(points):
            d, j = min((seg_distance(x, y, *s), j) for j, s in enumerate(segs))
            assert got[i][0] == pytest.approx(d, abs=1e-6), name
            assert got[i][1] == j or seg_distance(x, y, *segs[got[i][1]]) == pytest.approx(d, abs=1e-9), name


def test_candidates_grow_with_the_rows(spark):
    small = {name: candidate_pairs(spark, p, s) for name, p, s in layouts(1500, random.Random(3))}
    large = {name: candidate_pairs(spark, p, s) for name, p, s in layouts(6000, random.Random(3))}
    for name in small:  # four times the rows on both sides: sixteen times the pairs if all met
        assert large[name] <= 7 * small[name] and large[name] <= 6000 * 400, (name, small[name], large[name])


def test_box_bounds(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(300):
        a = [(rnd.uniform(0, 9), rnd.uniform(0, 9)) for _ in range(rnd.randrange(1, 4))]
        b = [(rnd.uniform(0, 9), rnd.uniform(0, 9)) for _ in range(rnd.randrange(1, 4))]
        box = lambda ps: [min(p[0] for p in ps), max(p[0] for p in ps), min(p[1] for p in ps), max(p[1] for p in ps)]
        d = [[math.dist(p, q) for q in b] for p in a]
        rows.append((*box(a), *box(b), min(map(min, d)), max(map(max, d)), max(min(x) for x in d)))
    df = spark.createDataFrame(rows, "a0 double, a1 double, a2 double, a3 double, b0 double, b1 double, b2 double, b3 double, lo double, hi double, sure double")
    a, b = [F.col(f"a{i}") for i in range(4)], [F.col(f"b{i}") for i in range(4)]
    bad = df.where((B.least_distance(a, b) > F.col("lo") + 1e-9) | (B.most_distance(a, b) < F.col("hi") - 1e-9) | (B.sure_distance(a, b) < F.col("sure") - 1e-9))
    assert bad.count() == 0


def antennas(spark, spots):
    rows = [("LTE", 502, x, y, 1) for x, y in spots]
    return spark.createDataFrame(rows, "radio string, mcc int, longitude double, latitude double, range int")


def brute_clusters(rows, eps, min_samples):
    """node -> cluster by the definition; rows: collected antennas with node, x, y."""
    place = {r["node"]: (r["x"], r["y"]) for r in rows}
    weight = {}
    for r in rows:
        weight[r["node"]] = weight.get(r["node"], 0) + 1
    near = {a: [b for b in place if math.dist(place[a], place[b]) <= eps] for a in place}
    core = {a for a in place if sum(weight[b] for b in near[a]) >= min_samples}
    label = {}
    for a in sorted(core):
        if a not in label:
            todo = [a]
            while todo:
                v = todo.pop()
                if v not in label:
                    label[v] = a
                    todo += [b for b in near[v] if b in core]
    for a in place:
        if a not in core:
            label[a] = min((label[b] for b in near[a] if b in core), default=-1)
    return label


@pytest.mark.parametrize("min_samples", [1, 4, 12])
def test_clusters_equal_brute_force(spark, min_samples):
    rnd = random.Random(6)
    spots = [(101.0 + rnd.gauss(0, 0.0006), 3.0 + rnd.gauss(0, 0.0006)) for _ in range(250)]  # one dense place
    spots += [(101.05 + rnd.uniform(0, 0.06), 3.0 + rnd.uniform(0, 0.06)) for _ in range(300)]  # around the radius
    spots += [(101.3 + 0.0044 * i, 3.2) for i in range(30)] + [(101.5, 3.3)] * 15 + [(101.5029, 3.3)] * 2
    got = cluster_antennas(antennas(spark, spots), min_samples=min_samples).collect()
    want = brute_clusters(got, 500.0, min_samples)
    assert len(got) == len(spots) and all(r["cluster_id"] == want[r["node"]] for r in got)
    assert len(set(want.values())) > 5


def test_dense_cells_are_not_compared_pair_by_pair(spark):
    """Two neighbour cells of 4,000 positions each: a handful of node pairs settle them."""
    rnd = random.Random(7)
    side = 500 / math.sqrt(2)
    pts = [(c, c * 10**6 + i, rnd.uniform(c * 2 * side, c * 2 * side + side), rnd.uniform(0, side)) for c in (0, 1) for i in range(4000)]
    df = spark.createDataFrame(pts, "rep long, node long, x double, y double")
    grouped = B.grouped_points(df, "rep", "node")
    seen = []
    keep = B.cut_lineage
    try:
        B.cut_lineage = lambda d: seen.append(keep(d)) or seen[-1]
        pairs = spark.createDataFrame([(0, 1)], "ag long, bg long")
        assert [tuple(r) for r in B.close_groups(grouped, grouped, pairs, 500.0).collect()] == [(0, 1)]
        assert B.close_groups(grouped, grouped, pairs, side * 0.999).count() == 0 or min(p[2] for p in pts if p[0]) - max(p[2] for p in pts if not p[0]) < side
    finally:
        B.cut_lineage = keep
    assert sum(d.count() for d in seen) < 20000  # all pairs: 16 million


def test_nearest_lists_of_any_length_and_on_either_side(spark):
    """Many points to few pieces, few points to many, and nodes whose lists come in parts: exact, the smallest key on ties, lists short where both sides are even."""
    rnd = random.Random(12)
    for n, m in ((3000, 5), (5, 3000), (1, 1), (64, 2000)):
        points = [(rnd.uniform(0, 1e4), rnd.uniform(0, 1e4)) for _ in range(n)]
        segs = [(x, y, x + rnd.choice((0, 900)), y) for x, y in [(rnd.uniform(4e3, 6e3), rnd.uniform(4e3, 6e3)) for _ in range(m)]]
        segs += [segs[0]]  # the same geometry again: the smaller key wins
        left, right = frames(spark, points, segs)
        got = {r["k"]: (r["distance_m"], r["fid"], r["name"]) for r in nearest_feature(left, right.withColumn("name", F.concat(F.lit("n"), "fid")), "k", "fid", ["name"]).collect()}
        for i, (x, y) in enumerate(points):
            d, j = min((seg_distance(x, y, *s), j) for j, s in enumerate(segs))
            assert got[i][0] == pytest.approx(d, abs=1e-6) and got[i][2] == f"n{got[i][1]}"
            assert got[i][1] == j or seg_distance(x, y, *segs[got[i][1]]) == pytest.approx(d, abs=1e-9)


def test_pieces_do_not_outgrow_the_segments(spark, monkeypatch):
    """Long lines, close together: cut to the mean spacing they would give n * sqrt(n) pieces."""
    from tilerank.operators import spatial as S

    rnd = random.Random(13)
    seen = []
    keep = S.nearest_of
    monkeypatch.setattr(S, "nearest_of", lambda a, b: seen.append(b.count()) or keep(a, b))
    segs = [(x, y, x + 5e4, y + 2e4) for x, y in [(rnd.uniform(0, 1e5), rnd.uniform(0, 1e5)) for _ in range(1500)]]
    points = [(rnd.uniform(0, 1e5), rnd.uniform(0, 1e5)) for _ in range(100)]
    left, right = frames(spark, points, segs)
    got = {r["k"]: r["distance_m"] for r in S.nearest_feature(left, right, "k", "fid").collect()}
    assert all(got[i] == pytest.approx(min(seg_distance(x, y, *s) for s in segs), abs=1e-6) for i, (x, y) in enumerate(points))
    assert seen[0] <= 6 * 1500
