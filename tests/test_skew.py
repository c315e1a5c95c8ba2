"""A third of the rows on one key: results stay whole and exact."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tilerank.operators.spatial import join_within_polygon, join_within_radius, nearest_feature
from tilerank.operators.tables import keep_first
from tilerank.plans.towers import cluster_antennas, dissolve_sites


def test_nearest_with_hot_location(spark):
    rnd = random.Random(11)
    left = [(i, 1000.0, 1000.0) if i % 3 == 0 else (i, rnd.uniform(0, 20000), rnd.uniform(0, 20000)) for i in range(900)]
    right = [(j, rnd.uniform(0, 20000), rnd.uniform(0, 20000)) for j in range(60)] + [(1000 + j, 1000.0 + j, 1000.0) for j in range(30)]
    L = spark.createDataFrame(left, "k long, x double, y double")
    R = spark.createDataFrame([(j, x, y, x, y) for j, x, y in right], "fid long, x1 double, y1 double, x2 double, y2 double")
    got = {r["k"]: (r["distance_m"], r["fid"]) for r in nearest_feature(L, R, "k", "fid").collect()}
    assert len(got) == 900
    for k, x, y in left:
        best = min((math.hypot(x - rx, y - ry), j) for j, rx, ry in right)
        assert got[k][0] == pytest.approx(best[0], abs=1e-6) and got[k][1] == best[1]


def test_keep_first_hot_key(spark):
    rows = [("hot", float(i), i) for i in range(3000)] + [(f"k{i}", float(i), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "key string, d double, v long")
    out = {r["key"]: r["v"] for r in keep_first(df, "key", ["d", "v"]).collect()}
    assert len(out) == 6001 and out["hot"] == 0


def test_radius_join_hot_cell_keeps_all_pairs(spark):
    left = spark.createDataFrame([(i, 10.0, 10.0) for i in range(300)] + [(1000, 5000.0, 5000.0)], "i long, x double, y double")
    right = spark.createDataFrame([(j, 10.0 + j, 10.0) for j in range(20)], "j long, rx double, ry double")
    pairs = join_within_radius(left, right, 15.0)
    assert pairs.count() == 300 * 16  # offsets 0..15 are within 15 m


def test_polygon_many_points_in_one_cell(spark):
    sq = [(0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0)]
    edges = spark.createDataFrame([("P", a, b, c, d) for a, b, c, d in sq], "country string, lon1 double, lat1 double, lon2 double, lat2 double")
    pts = [(f"h{i}", 0.5, 0.5) for i in range(500)] + [(f"o{i}", 1.5, 0.5) for i in range(10)]
    got = join_within_polygon(spark.createDataFrame(pts, "site_id string, longitude double, latitude double"), edges, cell_deg=0.25)
    assert got.count() == 500


def test_coincident_antennas_one_node(spark):
    rows = [("LTE", 502, 101.0, 3.0, 100)] * 3000 + [("GSM", 502, 101.0 + i * 0.01, 3.1, 50) for i in range(6000)]
    df = spark.createDataFrame(rows, "radio string, mcc int, longitude double, latitude double, range int")
    sites = dissolve_sites(cluster_antennas(df))
    hot = [s for s in sites.collect() if s["antenna_count"] == 3000]
    assert len(hot) == 1 and hot[0]["longitude"] == pytest.approx(101.0, abs=1e-9) and hot[0]["antennas_4G"] == 3000
    assert sites.agg(F.sum("antenna_count")).first()[0] == 9000
