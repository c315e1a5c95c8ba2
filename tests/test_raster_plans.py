"""Disk sums from partial sums, halo blocks and composites against plain Python."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tilerank.operators import raster as RA
from tilerank.operators import zonal as Z


@pytest.fixture(scope="module")
def lattice(spark):
    """A fine lattice of pixels, some without a value, and sites on it, at its rim and far away."""
    px = [(10.0 * i, 10.0 * j, None if (i * 7 + j) % 11 == 0 else float((i * 31 + j * 17) % 100), i + j) for i in range(80) for j in range(80)]
    px += [(None, 1.0, 5.0, 5), (400.0, 400.0, 1.0, 1)]
    sites = [(1, 400.0, 400.0), (2, 403.7, 391.2), (3, -150.0, 20.0), (4, 5000.0, 5000.0), (5, None, 3.0), (6, 0.0, 0.0), (7, 400.0, 400.0)]
    return spark.createDataFrame(sites, "k int, x double, y double"), spark.createDataFrame(px, "rx double, ry double, a double, n int"), sites, px


def brute(sites, px, r):
    out = {}
    for k, x, y in sites:
        hit = [(a, n) for rx, ry, a, n in px if x is not None and rx is not None and math.sqrt((rx - x) ** 2 + (ry - y) ** 2) <= r]
        if hit:
            vals = [a for a, _ in hit if a is not None]
            out[k] = (sum(vals) if vals else None, len(vals), sum(n for _, n in hit), len(hit))
    return out


@pytest.mark.parametrize("level", [None, 0, 1, 3, 5])
def test_disk_sums(lattice, level):
    sites, pixels, ls, lp = lattice
    got = {r["k"]: r for r in Z.disk_sums(sites, pixels, ["a", "n"], 200.0, "k", level).collect()}
    want = brute(ls, lp, 200.0)
    assert set(got) == set(want)
    for k, (s, c, ns, nc) in want.items():
        r = got[k]
        assert r["a_sum"] == s and r["n_sum"] == ns and isinstance(r["n_sum"], int)
        assert r["a_mean"] == pytest.approx(s / c) and r["n_mean"] == pytest.approx(ns / nc)


def test_cover_grows_with_the_perimeter(lattice):
    """A level more doubles the squares of the rim, not four times as many; whole squares do not overlap them."""
    sites = lattice[0].where("k = 2")
    rows = {lv: Z.disk_cover(sites, 200.0, lv).groupBy("_whole").count().collect() for lv in (4, 5, 6)}
    rim = {lv: sum(r["count"] for r in rs if not r["_whole"]) for lv, rs in rows.items()}
    assert rim[5] < 2.3 * rim[4] and rim[6] < 2.3 * rim[5]
    area = Z.disk_cover(sites, 200.0, 6).where("_whole").select(F.sum(F.pow(F.lit(200.0) / F.pow(F.lit(2.0), "_lv"), 2)).alias("s")).first()["s"]
    assert 0.95 * math.pi * 200**2 < area <= math.pi * 200**2


@pytest.mark.parametrize("level", [None, 2])
def test_places_reached(lattice, level):
    sites, pixels, ls, lp = lattice
    got = Z.places_reached(sites.select("x", "y").distinct(), pixels, 160.0, level).collect()
    want = {(x, y) for k, x, y in ls if k in brute(ls, lp, 160.0)}
    assert sorted((r["x"], r["y"]) for r in got) == sorted(want)


def test_no_pixels(lattice):
    sites, pixels, _, _ = lattice
    assert Z.disk_sums(sites, pixels.limit(0), ["a"], 100.0, "k").count() == 0
    assert Z.disk_sums(sites.limit(0), pixels, ["a"], 100.0, "k").count() == 0


def test_halo_blocks_over_block_edges(spark):
    """Pixels on both sides of block edges, at negative places, with holes, missing values, repeats and no place at all."""
    b = RA.BLOCK
    cells = [(i, j) for i in (-3, -2, -1, 0, 1, b - 2, b - 1, b, b + 1) for j in (-2, -1, 0, 1, b - 1, b, b + 1, 2 * b - 1, 2 * b) if (i + j) % 5]
    rows = [(i, j, 50 + i / 100, None if (i * j) % 7 == 3 else float((i * 13 + j * 29) % 50), "x") for i, j in cells]
    px = spark.createDataFrame(rows + [(None, 1, 3.0, 4.0, "x")], "px_row long, px_col long, lat double, elevation double, _tag string")
    got = RA.terrain_bands(px, "elevation", 0.01, 3)
    assert got.columns == [*px.columns, "slope", "aspect", "terrain_ruggedness"]
    v = {(i, j): e for i, j, _, e, _ in rows if e is not None}
    out = {(r["px_row"], r["px_col"]): r for r in got.collect()}
    assert len(out) == len(rows) + 1
    assert out[None, 1]["slope"] is None and out[None, 1]["terrain_ruggedness"] is None
    step = math.radians(0.01) * RA.EARTH_RADIUS_M
    for i, j, lat, _, _ in rows:
        around = [v[i + a, j + c] for a in range(-3, 4) for c in range(-3, 4) if (i + a, j + c) in v]
        r = out[i, j]
        assert r["terrain_ruggedness"] == (pytest.approx(statistics.pstdev(around), abs=1e-6) if around else None)
        four = [v.get(p) for p in ((i, j + 1), (i, j - 1), (i + 1, j), (i - 1, j))]
        if None in four:
            assert r["slope"] is None and r["aspect"] is None
        else:
            gx, gy = (four[0] - four[1]) / (2 * step * math.cos(math.radians(lat))), (four[2] - four[3]) / (2 * step)
            assert r["slope"] == pytest.approx(math.degrees(math.atan(math.hypot(gx, gy))))


def test_terrain_is_one_exchange(spark):
    px = spark.range(100).selectExpr("id div 10 AS px_row", "id % 10 AS px_col", "1.0D AS lat", "CAST(id AS DOUBLE) AS elevation")
    plan = RA.terrain_bands(px)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_composites(spark):
    obs = [(1, "a", "2020-01-01", 5.0), (1, "a", "2020-02-01", 1.0), (1, "a", "2020-03-01", 2.0), (1, "a", "2021-01-01", 900.0), (1, "a", "2020-04-01", 2.0),
           (1, "b", "1990-01-01", 7.0), (2, "a", "2020-01-01", None), (2, "b", "2020-01-01", -3.0), (2, "b", "2020-01-01", 4.0), (3, "a", "2021-01-01", 1.0), (None, "b", None, 6.0)]
    images = spark.createDataFrame(obs, "p int, band string, ts string, value double")
    recipes = [("med", "a", "median", "2020-01-01", "2021-01-01"), ("avg", "a", "mean", "2020-01-01", "2021-01-01"), ("b", "b", "median", None, None)]
    df = RA.composite_bands(images, recipes, ["p"])
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # before it runs
    assert {tuple(r) for r in df.collect()} == {(1, 2.0, 2.5, 7.0), (2, None, None, 0.5), (None, None, None, 6.0)}
    with pytest.raises(ValueError, match="composite"):
        RA.composite_bands(images, [("x", "a", "mode", None, None)], ["p"])


def test_matrix_takes_one_source_of_statistics(spark):
    from tilerank.plans.matrix import build_master_matrix

    t = spark.range(1)
    with pytest.raises(ValueError, match="either"):
        build_master_matrix(t, t, None, None, "x")
