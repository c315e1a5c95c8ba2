"""Points in polygons with slanted edges on a lattice, against exact fractions; nearest search without a cap."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tilerank.operators.spatial import join_within_polygon, nearest_feature
from tilerank.plans.matrix import clip_to_region

RINGS = {
    "triangle": [(0, 0), (1, 1), (0, 1)],
    "diamond": [(0.5, -0.5), (1.5, 0.5), (0.5, 1.5), (-0.5, 0.5)],
    "notch": [(0, 0), (2, 0), (2, 2), (1, 1), (0.5, 1.5), (0, 1)],
}


def inside(ring, px, py):
    """Strictly inside, in exact arithmetic."""
    ring = [(Fraction(x), Fraction(y)) for x, y in ring]
    px, py = Fraction(px), Fraction(py)
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (px - x1) * (y2 - y1) == (py - y1) * (x2 - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return False
        if (y1 > py) != (y2 > py) and x1 + (py - y1) * (x2 - x1) / (y2 - y1) > px:
            odd = not odd
    return odd


@pytest.mark.parametrize("cell", [0.125, 0.25, 0.5])
def test_lattice_points(spark, cell):
    edges = [(n, *map(float, a), *map(float, b)) for n, r in RINGS.items() for a, b in zip(r, r[1:] + r[:1])]
    e = spark.createDataFrame(edges, "country string, lon1 double, lat1 double, lon2 double, lat2 double")
    pts = [(f"{i}/{j}", i / 16, j / 16) for i in range(-10, 36) for j in range(-10, 36)]
    p = spark.createDataFrame(pts, "site_id string, longitude double, latitude double")
    got = {(r["site_id"], r["country"]) for r in join_within_polygon(p, e, cell_deg=cell).collect()}
    assert got == {(k, n) for k, x, y in pts for n, r in RINGS.items() if inside(r, x, y)}


def test_nearest_has_no_cap_and_takes_null_sides(spark):
    left = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 9e6)], "site_id string, x double, y double")
    right = spark.createDataFrame([(1, 1000.0, 0.0, 1000.0, 0.0), (2, None, None, None, None)], "rid int, x1 double, y1 double, x2 double, y2 double")
    got = {r["site_id"]: (r["distance_m"], r["rid"]) for r in nearest_feature(left, right, "site_id", "rid").collect()}
    assert got["a"] == (1000.0, 1) and got["b"] == (pytest.approx((9e6**2 + 1e6) ** 0.5), 1)
    none = nearest_feature(left, right.where("rid = 2"), "site_id", "rid").collect()
    assert [(r["distance_m"], r["rid"]) for r in none] == [(None, None)] * 2


def test_clip_needs_a_boundary(spark):
    tiles = spark.createDataFrame([("a", 0.1, 0.9)], "site_id string, longitude double, latitude double")
    edges = spark.createDataFrame([("x", 0.0, 0.0, 1.0, 1.0)], "country string, lon1 double, lat1 double, lon2 double, lat2 double")
    assert clip_to_region(tiles, edges, "elsewhere").count() == 1
    with pytest.raises(ValueError):
        clip_to_region(tiles, edges.where(F.lit(False)), "x")


EDGES = "country string, objectid long, lon1 double, lat1 double, lon2 double, lat2 double"


def ring_edges(name, oid, ring):
    return [(name, oid, *map(float, a), *map(float, b)) for a, b in zip(ring, ring[1:] + ring[:1])]


def test_overlapping_features_of_one_country_keep_the_point_twice(spark):
    square = lambda x: [(x, 0), (x + 2, 0), (x + 2, 2), (x, 2)]
    e = spark.createDataFrame(ring_edges("A", 1, square(0)) + ring_edges("A", None, square(1)) + ring_edges("B", 1, square(1)), EDGES)
    tiles = spark.createDataFrame([("left", 0.5, 1.1, 7), ("both", 1.5, 1.1, 8), ("right", 2.5, 1.1, 9), ("out", 5.0, 1.1, 1), ("none", None, 1.1, 2)],
                                  "site_id string, longitude double, latitude double, objectid int")
    got = sorted(map(tuple, clip_to_region(tiles, e, "A").collect()))
    assert got == [("both", 1.5, 1.1, 8), ("both", 1.5, 1.1, 8), ("left", 0.5, 1.1, 7), ("right", 2.5, 1.1, 9)]


def test_detailed_coast_goes_to_finer_cells(spark, monkeypatch):
    """A star of 6,000 edges in one cell: right everywhere, and far fewer tests than points x edges."""
    import math
    import random

    from tilerank.operators import spatial

    rnd = random.Random(5)
    n = 6000
    ring = [(0.5 + (0.3 + 0.02 * rnd.random()) * math.cos(2 * math.pi * i / n), 0.5 + (0.3 + 0.02 * rnd.random()) * math.sin(2 * math.pi * i / n))
            for i in range(n)]
    pts = []
    for i in range(400):
        a, r = rnd.random() * 2 * math.pi, (0.29 + 0.04 * rnd.random()) if i % 2 else rnd.random() * 0.7
        pts.append((str(i), 0.5 + r * math.cos(a), 0.5 + r * math.sin(a)))
    pts += [("vertex", *ring[7]), ("vertex2", *ring[3000])]
    e = spark.createDataFrame(ring_edges("A", 1, ring), EDGES)
    p = spark.createDataFrame(pts, "site_id string, longitude double, latitude double")
    sizes = []
    whole = spatial._inside

    def counted(cand, edges, ecell, keys, needed, g):
        sizes.append(cand.join(ecell, ["_f", "ci", "cj"]).count())
        return whole(cand, edges, ecell, keys, needed, g)

    monkeypatch.setattr(spatial, "_inside", counted)
    got = {r["site_id"] for r in join_within_polygon(p, e, ["country", "objectid"], cell_deg=1.0).collect()}

    def odd(px, py):
        return sum((y1 > py) != (y2 > py) and x1 + (py - y1) * (x2 - x1) / (y2 - y1) > px for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])) % 2

    assert got == {k for k, x, y in pts if not k.startswith("vertex") and odd(x, y)}
    assert len(sizes) > 1 and sum(sizes) < len(pts) * n / 50
