"""Guard rails and edge cases on hand-made frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tilerank import constants as K
from tilerank.functions import scoring as S
from tilerank.functions.geo import project_utm, with_lonlat, with_utm
from tilerank.functions.screening import spatial_block
from tilerank.operators.graph import connected_components
from tilerank.operators.quantiles import exact_quantiles
from tilerank.operators.rank import global_row_number
from tilerank.operators.spatial import join_within_polygon, nearest_feature
from tilerank.plans.ranking import apply_confidence_tier, govern_score_rank, score_matrix
from tilerank.plans.screening import stratified_screening
from tilerank.plans.towers import cluster_antennas, dissolve_sites, nearest_all_layers
from tilerank.sources.wkb import encode_linestring, encode_point, encode_polygon, wkb_to_segments

TILE = "site_id string, longitude double, latitude double, download_kbps bigint, tests bigint, devices bigint, population_total double"


def test_utm_reference_points(spark):
    df = spark.createDataFrame([(3.0, 45.0, 31), (6.0, 0.0, 31)], "lon double, lat double, zone int")
    x, y = project_utm("lon", "lat", "zone")
    r = df.select(x.alias("x"), y.alias("y")).collect()
    assert r[0]["x"] == pytest.approx(500000.0, abs=1e-3) and r[0]["y"] == pytest.approx(4982950.400, abs=1e-3)
    assert r[1]["x"] == pytest.approx(833978.557, abs=1e-3) and r[1]["y"] == pytest.approx(0.0, abs=1e-6)


def test_utm_round_trip(spark):
    rows = [(100.0 + i * 0.37, -10.0 + i * 0.9) for i in range(30)]
    df = spark.createDataFrame(rows, "longitude double, latitude double")
    back = with_lonlat(with_utm(df, F.lit(49)).select("x", "y", F.col("longitude").alias("lo"), F.col("latitude").alias("la")), F.lit(49))
    for r in back.collect():
        assert r["longitude"] == pytest.approx(r["lo"], abs=1e-9) and r["latitude"] == pytest.approx(r["la"], abs=1e-9)


def test_missing_population_is_urban_and_no_evidence_guard(spark):
    rows = [("a", 100.0, 2.0, 100, 20, 6, None), ("b", 100.0, 2.0, 50, 20, 6, 10.0), ("c", 100.0, 2.0, 10, 1, 1, 5.0)]
    out = {r["site_id"]: r for r in stratified_screening(spark.createDataFrame(rows, TILE)).collect()}
    assert out["a"]["demographic_stratum"] == "urban"
    none = stratified_screening(spark.createDataFrame([("c", 100.0, 2.0, 10, 1, 1, 5.0)], TILE)).collect()
    assert none[0]["demographic_stratum"] is None and none[0]["is_underserved_target"] is False


def test_exact_quantiles_match_pandas_with_hot_value(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000), "v": np.round(rng.normal(size=5000) * 50, 2)})
    pdf.loc[:2000, "v"] = 3.0
    got = exact_quantiles(spark.createDataFrame(pdf), "v", [0.2, 0.33, 0.66], by=["g"], accuracy=50).orderBy("g").toPandas()
    exp = pdf.groupby("g")["v"].quantile([0.2, 0.33, 0.66]).unstack()
    for i, q in enumerate([0.2, 0.33, 0.66]):
        assert np.allclose(got[f"q{i}"].to_numpy(), exp[q].to_numpy(), rtol=0, atol=1e-9)


@pytest.mark.parametrize("units", [3.0, 0.0])
@pytest.mark.parametrize("small", [0, 20000])
def test_exact_quantiles_need_no_good_bracket(spark, monkeypatch, units, small):
    """Brackets of no width miss ranks; the counts tell, and the values stay exact."""
    import numpy as np
    import pandas as pd

    from tilerank.operators import quantiles

    monkeypatch.setattr(quantiles, "BRACKET_UNITS", units)
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", small)
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 4000).astype(float), "v": rng.normal(size=4000)})
    pdf.loc[:1500, "v"] = 0.25
    df = spark.createDataFrame(pdf).selectExpr("IF(g = 2, NULL, g) AS g", "v").repartition(4)
    probs = [0.0, 0.2, 0.5, 0.77, 1.0]
    got = {r["g"]: list(r)[1:] for r in exact_quantiles(df, "v", probs, by=["g"], accuracy=50, count_name="n").collect()}
    for g in (0.0, 1.0, None):
        part = pdf[pdf["g"] == (2.0 if g is None else g)]["v"]
        assert np.allclose(got[g][:-1], part.quantile(probs), rtol=0, atol=1e-12) and got[g][-1] == len(part)
    whole, n = quantiles.global_quantiles(df, "v", probs, accuracy=50)
    assert np.allclose(whole, pdf["v"].quantile(probs), rtol=0, atol=1e-12) and n == 4000


def test_exact_quantiles_of_nothing(spark):
    from tilerank.operators.quantiles import global_quantiles

    none = spark.createDataFrame([("a", None)], "g string, v double")
    assert exact_quantiles(none, "v", [0.5], by=["g"]).collect() == []
    assert global_quantiles(none, "v", [0.5, 0.1]) == ([None, None], 0)


def test_spatial_block_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-0.7, -0.2)], "latitude double, longitude double")
    lat_b, lon_b, blk = spatial_block()
    r = df.select(lat_b.alias("a"), lon_b.alias("b"), blk.alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (-1, 0, "-1_0")


def _scored_frame(spark, rows):
    schema = ("site_id string, latitude double, aspect_degrees double, distance_to_power_m double, distance_to_road_m double, "
              "distance_to_amenity_m double, night_radiance_nw_cm2_sr double, population_total double, solar_radiation_mj double, "
              "slope_degrees double, rainfall_mm_hr double, elevation_m double, terrain_ruggedness double, cv_predicted_speed double, "
              "download_kbps bigint")
    return spark.createDataFrame(rows, schema)


def test_equal_raw_scores_give_50_and_zero_divisor_gives_inf(spark):
    base = (2.0, 180.0, 9000.0, 5000.0, 100.0, 1.0, 800.0, 10.0, 2.0, 0.1, 100.0, 5.0, 5000.0, 100)
    out = score_matrix(_scored_frame(spark, [("a",) + base, ("b",) + base])).collect()
    assert all(r["priority_score"] == 50.0 for r in out)
    rad = list(base)
    rad[5] = -0.1
    r = score_matrix(_scored_frame(spark, [("z",) + tuple(rad)])).first()
    assert math.isinf(r["off_grid_likelihood"]) and r["indicative_abatement_tco2e_yr"] == pytest.approx(34.2 * 0.65)


def test_null_aspect_scores_null_and_ranks_last_among_approved(spark):
    rows = []
    for i, asp in enumerate([180.0, None, 90.0]):
        rows.append((f"s{i}", 2.0, asp, 9000.0, 5000.0, 100.0, 1.0, 800.0 + i, 10.0, 2.0, 0.1, 100.0, 5.0, 5000.0, 100))
    df = _scored_frame(spark, rows).withColumns({"tests": F.lit(20), "devices": F.lit(9), "distance_to_nearest_tower": F.lit(100.0),
                                                "is_underserved_target": F.lit(True)})
    ranked = {r["site_id"]: r for r in govern_score_rank(df).collect()}
    assert ranked["s1"]["priority_score"] is None and ranked["s1"]["national_rank"] == 3


def test_tile_without_tower_is_thin_evidence(spark):
    df = spark.createDataFrame([(20, 9, 3000.0, True), (20, 9, None, True), (0, 0, 10.0, False)],
                               "tests int, devices int, distance_to_nearest_tower double, is_underserved_target boolean")
    tiers = [r["confidence_tier"] for r in apply_confidence_tier(df).collect()]
    assert tiers == [K.TIER_THIN, K.TIER_THIN, K.TIER_NO_DATA]


def test_rank_is_a_permutation(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("site_id"), (F.col("id") % 7).alias("s"))
    r = global_row_number(df.repartition(7), [F.col("s").desc(), F.col("site_id")], "rank")
    vals = sorted(x["rank"] for x in r.collect())
    assert vals == list(range(1, 2001))


def test_point_on_edge_and_in_hole(spark):
    square = [(0, 0.0, 0.0, 4.0, 0.0), (0, 4.0, 0.0, 4.0, 4.0), (0, 4.0, 4.0, 0.0, 4.0), (0, 0.0, 4.0, 0.0, 0.0),
              (1, 1.0, 1.0, 2.0, 1.0), (1, 2.0, 1.0, 2.0, 2.0), (1, 2.0, 2.0, 1.0, 2.0), (1, 1.0, 2.0, 1.0, 1.0)]
    edges = spark.createDataFrame([("P", r, a, b, c, d) for r, a, b, c, d in square], "country string, ring int, lon1 double, lat1 double, lon2 double, lat2 double")
    pts = spark.createDataFrame([("in", 3.0, 3.0), ("hole", 1.5, 1.5), ("edge", 4.0, 2.0), ("out", 5.0, 5.0), ("holeedge", 1.0, 1.5)],
                                "site_id string, longitude double, latitude double")
    got = {r["site_id"] for r in join_within_polygon(pts, edges, cell_deg=0.7).collect()}
    assert got == {"in"}


def test_nearest_matches_brute_force(spark):
    rnd = random.Random(3)
    left = [(i, rnd.uniform(0, 50000), rnd.uniform(0, 50000)) for i in range(300)]
    right = [(j, rnd.uniform(0, 60000), rnd.uniform(0, 60000)) for j in range(40)]
    segs = [(j, x, y, x + rnd.uniform(-900, 900), y + rnd.uniform(-900, 900)) for j, x, y in right]
    L = spark.createDataFrame(left, "k long, x double, y double")
    R = spark.createDataFrame(segs, "fid long, x1 double, y1 double, x2 double, y2 double")
    got = {r["k"]: r["distance_m"] for r in nearest_feature(L, R, "k", "fid").collect()}

    def seg(px, py, x1, y1, x2, y2):
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
        return math.hypot(px - (x1 + t * dx), py - (y1 + t * dy))

    for k, x, y in left:
        assert got[k] == pytest.approx(min(seg(x, y, *s[1:]) for s in segs), abs=1e-6)


def test_empty_layer_gives_null_distance(spark):
    sites = spark.createDataFrame([(1, 101.0, 3.0)], "cluster_id long, longitude double, latitude double")
    empty = spark.createDataFrame([], "feature_id string, lon1 double, lat1 double, lon2 double, lat2 double")
    r = nearest_all_layers(sites, {"power": empty}).first()
    assert r["distance_to_power_m"] is None


ANT = "radio string, mcc int, longitude double, latitude double, range int"


def test_clustering_edges_chain_and_coincident_points(spark):
    # antennas 499 m apart on one parallel form a chain longer than 500 m: one cluster
    zone = 49
    lat = 2.0
    df = spark.createDataFrame([(0, 500000.0, 221000.0), (1, 500499.0, 221000.0), (2, 500998.0, 221000.0), (3, 503000.0, 221000.0)],
                               "i int, x double, y double")
    pts = with_lonlat(df, F.lit(zone)).collect()
    rows = [("LTE", 502, p["longitude"], p["latitude"], 100) for p in pts]
    rows.append(("CDMA", 502, pts[0]["longitude"], pts[0]["latitude"], 300))  # coincident with the first
    c = cluster_antennas(spark.createDataFrame(rows, ANT)).collect()
    labels = {}
    for r in c:
        labels.setdefault(r["cluster_id"], set()).add(r["node"])
    assert sorted(len(v) for v in labels.values()) == [1, 3]
    sites = dissolve_sites(cluster_antennas(spark.createDataFrame(rows, ANT))).collect()
    big = [s for s in sites if s["antenna_count"] == 4][0]
    assert big["antennas_4G"] == 3  # the CDMA antenna counts only in antenna_count
    assert big["range"] == pytest.approx(150.0)
    assert lat > 0


def test_connected_components_against_union_find(spark):
    rnd = random.Random(5)
    n = 400
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(300)]
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for v in range(n):
        comp.setdefault(find(v), []).append(v)
    expect = {v: min(vs) for vs in comp.values() for v in vs}
    nodes = spark.range(n).select(F.col("id").alias("node"))
    e = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["label"] for r in connected_components(nodes, e).collect()}
    assert got == expect


def test_wkb_round_trip():
    assert wkb_to_segments(encode_point(1.5, 2.5)) == [(0, 0, 0, 1.5, 2.5, 1.5, 2.5)]
    assert wkb_to_segments(encode_point(1.5, 2.5), with_kind=True)[0][0] == "point"
    segs = wkb_to_segments(encode_linestring([(0, 0), (1, 0), (1, 1)]))
    assert [s[2:] for s in segs] == [(0, 0.0, 0.0, 1.0, 0.0), (1, 1.0, 0.0, 1.0, 1.0)]
    poly = wkb_to_segments(encode_polygon([[(0, 0), (1, 0), (1, 1), (0, 0)], [(0.2, 0.2), (0.3, 0.2), (0.2, 0.3), (0.2, 0.2)]]))
    assert {s[1] for s in poly} == {0, 1} and len(poly) == 6


def test_leading_zero_site_id_survives_csv(spark, tmp_path):
    from tilerank.sources.files import scan_zonal_csv

    p = tmp_path / "chunk.csv"
    p.write_text("site_id,elevation_mean\n0001230,12.5\n")
    r = scan_zonal_csv(spark, str(p)).first()
    assert r["site_id"] == "0001230" and r["elevation_mean"] == 12.5


def test_divide_numpy_semantics(spark):
    r = spark.range(1).select(S.divide(F.lit(1.0), F.lit(0.0)).alias("a"), S.divide(F.lit(-1.0), F.lit(0.0)).alias("b"),
                              S.divide(F.lit(0.0), F.lit(0.0)).alias("c")).first()
    assert r["a"] == float("inf") and r["b"] == float("-inf") and r["c"] is None


def test_nan_becomes_null_at_ingest(spark, tmp_path):
    import pandas as pd

    from tilerank.sources.files import scan_matrix

    p = str(tmp_path / "m.parquet")
    pd.DataFrame({"site_id": ["a", "b"], "elevation_m": [float("nan"), 3.0]}).to_parquet(p)
    r = {x["site_id"]: x["elevation_m"] for x in scan_matrix(spark, p).collect()}
    assert r["a"] is None and r["b"] == 3.0


@pytest.mark.parametrize("shape", ["path", "hub", "random_dense"])
def test_connected_components_shapes(spark, shape):
    rnd = random.Random(len(shape))
    n = 300
    if shape == "path":
        order = list(range(n))
        rnd.shuffle(order)
        edges = list(zip(order, order[1:]))
    elif shape == "hub":
        edges = [(150, v) for v in range(n) if v != 150 and v % 3] + [(rnd.randrange(n), rnd.randrange(n)) for _ in range(40)]
    else:
        edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(900)]
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for v in range(n):
        comp.setdefault(find(v), []).append(v)
    expect = {v: min(vs) for vs in comp.values() for v in vs}
    nodes = spark.range(n).select(F.col("id").alias("node"))
    got = {r["node"]: r["label"] for r in connected_components(nodes, spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == expect


def test_polygon_layer_distance_is_zero_inside(spark):
    from tilerank.sources.files import layer_segments

    ring = [(101.0, 3.0), (101.1, 3.0), (101.1, 3.1), (101.0, 3.1), (101.0, 3.0)]
    layer = spark.createDataFrame([("p1", "school", bytearray(encode_polygon([ring])))], "feature_id string, osm_type string, geom_wkb binary")
    segs = layer_segments(layer)
    sites = spark.createDataFrame([(1, 101.05, 3.05), (2, 101.2, 3.05)], "cluster_id long, longitude double, latitude double")
    got = {r["cluster_id"]: r["distance_to_amenity_m"] for r in nearest_all_layers(sites, {"amenities": segs}).collect()}
    assert got[1] == 0.0 and 10000.0 < got[2] < 12000.0


def test_boundary_layouts_read_alike_and_other_reference_systems_fail(spark, tmp_path):
    import json

    import pandas as pd

    from tilerank.functions.geo import with_utm
    from tilerank.sources.files import scan_boundaries

    ring = [[100.0, 0.5], [101.0, 0.5], [101.0, 1.5], [100.0, 0.5]]

    def feature(points=ring, name="A"):
        return {"type": "Feature", "properties": {"Country": name, "OBJECTID": 1, "Flag": "x"}, "geometry": {"type": "Polygon", "coordinates": [points]}}

    def whole(*features, crs=None):
        return {"type": "FeatureCollection", "features": list(features), **({"crs": {"type": "name", "properties": {"name": crs}}} if crs else {})}

    def mercator(p):
        return [math.radians(p[0]) * 6378137.0, math.asinh(math.tan(math.radians(p[1]))) * 6378137.0]

    flat = spark.createDataFrame(pd.DataFrame(ring, columns=["longitude", "latitude"]))
    utm = {(r["longitude"], r["latitude"]): [r["x"], r["y"]] for r in with_utm(flat, F.lit(47)).collect()}
    texts = {
        "lines": json.dumps(feature()), "spaced": "\n  \n" + json.dumps(feature()) + "\n\n", "flat": json.dumps(whole(feature())),
        "pretty": json.dumps(whole(feature()), indent=1), "lone": json.dumps(feature(), indent=1),
        "tagged": json.dumps(whole(feature(), crs="urn:ogc:def:crs:OGC:1.3:CRS84")),
        "mercator": json.dumps(whole(feature([mercator(p) for p in ring]), crs="EPSG:3857")),
        "utm": json.dumps(whole(feature([utm[tuple(p)] for p in ring]), crs="urn:ogc:def:crs:EPSG::32647"), indent=1),
        "south": json.dumps(whole(feature([[utm[tuple(p)][0], utm[tuple(p)][1] + 1e7] for p in ring]), crs="EPSG:32747")),
    }

    def edges(path):
        return sorted((r[:6], tuple(round(v, 9) for v in r[6:])) for r in scan_boundaries(spark, str(path)).collect())

    found = {}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
        found[name] = edges(tmp_path / name)
    assert len(found["lines"]) == 3 and all(x == found["lines"] for x in found.values()), found
    both = tmp_path / "folder"
    both.mkdir()
    (both / "a").write_text("\n".join(json.dumps(feature(name=n)) for n in "AB"))
    (both / "b").write_text(json.dumps(whole(feature(name="C"), feature(name="D")), indent=1))
    (both / "c").write_text(texts["mercator"])
    assert [x[0][0] for x in edges(both)] == sorted("AAABBBCCCDDDAAA")
    assert {r["country"] for r in scan_boundaries(spark, str(both), "C").collect()} == {"C"}
    bad = {"other": (json.dumps(whole(feature(), crs="EPSG:2154")), "EPSG:2154"), "no_feature": (json.dumps(whole()), "no feature"),
           "no_json": ("hello", "no feature"), "bad_line": (json.dumps(feature()) + "\n{oops", "not a feature"), "blank": (" \n", "without any feature")}
    for name, (text, message) in bad.items():
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match=message):
            scan_boundaries(spark, str(tmp_path / name)).collect()
