"""Composite flows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import constants as K
from ..operators.raster import EARTH_RADIUS_M
from ..plans import flows as FL
from ..plans.matrix import build_master_matrix as build_matrix
from ..plans.screening import stratified_screening as screening_op
from ..plans.towers import build_tower_sites, layer_tables_from_fixtures
from ..session import scratch_path
from ..sources import files as io
from ..sources.fixtures import fixture, write_tiles_parquet, write_zonal_csv
from . import chain as C
from . import register
from .common import fx_scored
from .joins import _TOWER_COLS, _within_sql

PREP = C.fx_prepared()
SCORED = PREP + C.tier("m_prep", "m_t") + [("m_a", f"SELECT * FROM m_t WHERE COALESCE(contains(confidence_tier, '{K.APPROVED_MARKER}'), false)")] \
    + C.score("m_a", "m_s")
MY = K.REGION_BOUNDS["Malaysia"]


@register("stratified_screening", C.render(["fx_tiles"], C.screening("fx_tiles", "ts"), "SELECT * FROM ts"))
def stratified_screening(spark, sf_dir):
    return screening_op(fixture(spark, sf_dir, "fx_tiles"))


@register("score_matrix", C.render(["fx_matrix"], SCORED, "SELECT * FROM m_s"))
def score_matrix(spark, sf_dir):
    return fx_scored(spark, sf_dir)


def _master_sql() -> str:
    from .joins import nearest_tower_ctes

    renames = dict(K.ZONAL_RENAMES)
    env_cols = ["elevation_mean", "slope_mean", "aspect_mean", "terrain_ruggedness_mean", "rainfall_mean", "night_radiance_mean",
                "population_sum", "tree_canopy_mean"]
    sel = ", ".join(f"e.{c} AS {renames[c]}" for c in env_cols)
    clip = f"""SELECT t.* EXCLUDE (population_total) FROM fx_tiles t JOIN ({_within_sql('fx_tiles', 'p.site_id')}) w
        ON t.site_id = w.site_id WHERE w.country = 'COUNTRY_7'"""
    tower_cols = ", ".join(f"nt.{x}" for x in ["distance_to_nearest_tower"] + _TOWER_COLS)
    return C.render(["fx_tiles", "fx_countries", "fx_antennas", "fx_towers", "fx_env"], [("clip", clip)] + nearest_tower_ctes("clip"), f"""
SELECT c.site_id, c.longitude, c.latitude, c.download_kbps, c.tests, c.devices, {tower_cols}, {sel},
       COALESCE(e.solar_radiation_mean / 1e6, 0.0::DOUBLE) AS solar_radiation_mj
FROM clip c JOIN nt USING (site_id) JOIN fx_env e USING (site_id)""")


@register("build_master_matrix", _master_sql())
def build_master_matrix(spark, sf_dir):
    """Tiles clipped to one country polygon, nearest tower (with its attributes), merged zonal statistics."""
    tiles = fixture(spark, sf_dir, "fx_tiles").drop("population_total")
    towers = fixture(spark, sf_dir, "fx_towers")
    env = fixture(spark, sf_dir, "fx_env")
    edges = fixture(spark, sf_dir, "fx_countries")
    m = build_matrix(tiles, towers, env, edges, "COUNTRY_7")
    return m.withColumn("distance_to_nearest_tower", F.round("distance_to_nearest_tower", 3)).drop("cluster_id")


_BANDS = ["night_radiance", "solar_radiation", "population", "elevation", "rainfall", "tree_canopy", "slope", "aspect", "terrain_ruggedness"]


def _environment_ctes() -> list[tuple[str, str]]:
    """CTEs ending in ``px``: the wide pixel table from ``fx_images``."""
    from .raster import _ASPECT, _OFFS, _SLOPE

    def one(out, band, how, start, end):
        days = f" AND ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}'" if start else ""
        return f"{'median' if how == 'median' else 'avg'}(value) FILTER (WHERE band = '{band}'{days}) AS {out}"

    step = math.radians(0.01) * EARTH_RADIUS_M
    return [
        ("wide", f"""SELECT px_row, px_col, {C.d(0.0)} + (px_col + 0.5::DOUBLE) * {C.d(0.01)} AS lon, {C.d(0.0)} + (px_row + 0.5::DOUBLE) * {C.d(0.01)} AS lat,
            {', '.join(one(*r) for r in K.ENVIRONMENT_RECIPES)} FROM fx_images GROUP BY px_row, px_col"""),
        ("gr", f"""SELECT p.*, (e.elevation - w.elevation) / ({C.d(2.0 * step)} * cos(radians(p.lat))) AS gx, (n.elevation - s.elevation) / {C.d(2.0 * step)} AS gy
            FROM wide p LEFT JOIN wide e ON e.px_row = p.px_row AND e.px_col = p.px_col + 1 LEFT JOIN wide w ON w.px_row = p.px_row AND w.px_col = p.px_col - 1
            LEFT JOIN wide n ON n.px_col = p.px_col AND n.px_row = p.px_row + 1 LEFT JOIN wide s ON s.px_col = p.px_col AND s.px_row = p.px_row - 1"""),
        ("rg", f"""SELECT p.px_row, p.px_col,
            sqrt(greatest((count(*) * sum(q.elevation * q.elevation) - sum(q.elevation) * sum(q.elevation)) / (count(*) * count(*)), 0.0::DOUBLE)) AS terrain_ruggedness
            FROM wide p CROSS JOIN {_OFFS} dr(o) CROSS JOIN {_OFFS} dc(o) JOIN wide q ON q.px_row = p.px_row + dr.o AND q.px_col = p.px_col + dc.o
            GROUP BY p.px_row, p.px_col"""),
        ("px", f"SELECT gr.* EXCLUDE (gx, gy), {_SLOPE} AS slope, {_ASPECT} AS aspect, rg.terrain_ruggedness FROM gr JOIN rg USING (px_row, px_col)"),
    ]


def _image_master_sql() -> str:
    from .joins import nearest_tower_ctes
    from .sqltext import utm_sql, zone_sql

    sx, sy = utm_sql("longitude", "latitude", _V1_Z)
    qx, qy = utm_sql("lon", "lat", _V1_Z)
    r = C.d(K.BUFFER_RADIUS_M)
    clip = f"""SELECT t.* EXCLUDE (population_total) FROM fx_tiles t JOIN ({_within_sql('fx_tiles', 'p.site_id')}) w
        ON t.site_id = w.site_id WHERE w.country = 'COUNTRY_7'"""
    aggs = ", ".join(f"avg(p.{b}) AS {b}_mean, sum(p.{b}) AS {b}_sum" for b in _BANDS)
    renames = dict(K.ZONAL_RENAMES)
    stats = [f"{b}_{s}" for b in _BANDS for s in ("mean", "sum")]
    kept = [c for c in stats if c not in K.ZONAL_DROPS and c != "solar_radiation_mean"]
    sel = ", ".join(f"round(e.{c}, 6) AS {renames.get(c, c)}" for c in kept)
    tower_cols = ", ".join(f"nt.{x}" for x in ["distance_to_nearest_tower"] + _TOWER_COLS)
    cell = lambda x: f"CAST(floor({x} / {r}) AS BIGINT)"
    return C.render(["fx_tiles", "fx_countries", "fx_antennas", "fx_towers", "fx_images"], [("clip", clip)] + nearest_tower_ctes("clip") + _environment_ctes() + [
        ("zz", f"SELECT {zone_sql('clip')} AS zone"),
        ("sp", f"SELECT site_id, {sx} AS x, {sy} AS y FROM clip"),
        ("pp", f"SELECT *, {qx} AS rx, {qy} AS ry FROM px"),
        ("env", f"""SELECT s.site_id, {aggs} FROM sp s CROSS JOIN (VALUES (-1), (0), (1)) a(o) CROSS JOIN (VALUES (-1), (0), (1)) b(o)
            JOIN pp p ON {cell('p.rx')} = {cell('s.x')} + a.o AND {cell('p.ry')} = {cell('s.y')} + b.o
            WHERE sqrt((p.rx - s.x) * (p.rx - s.x) + (p.ry - s.y) * (p.ry - s.y)) <= {r} GROUP BY s.site_id"""),
    ], f"""
SELECT c.site_id, c.longitude, c.latitude, c.download_kbps, c.tests, c.devices, {tower_cols}, {sel},
       round(COALESCE(e.solar_radiation_mean / 1e6, 0.0::DOUBLE), 9) AS solar_radiation_mj
FROM clip c JOIN nt USING (site_id) JOIN env e USING (site_id)""")


_V1_Z = "(SELECT zone FROM zz)"


@register("master_matrix_from_images", _image_master_sql())
def master_matrix_from_images(spark, sf_dir):
    """Clip, nearest tower, and zonal statistics taken from the images of all bands (composites, terrain, disks) around the clipped tiles."""
    tiles = fixture(spark, sf_dir, "fx_tiles").drop("population_total")
    m = build_matrix(tiles, fixture(spark, sf_dir, "fx_towers"), None, fixture(spark, sf_dir, "fx_countries"), "COUNTRY_7", images=fixture(spark, sf_dir, "fx_images"))
    known = {*tiles.columns, *_TOWER_COLS, "cluster_id", "distance_to_nearest_tower"}
    # mean joules are whole or half ones here: as megajoules, six digits would round ties by the last bit of a division
    m = m.withColumns({c: F.round(c, 9 if c == "solar_radiation_mj" else 6) for c in m.columns if c not in known})
    return m.withColumn("distance_to_nearest_tower", F.round("distance_to_nearest_tower", 3)).drop("cluster_id")


def _raw_inputs(spark, sf_dir):
    """Raw-layout inputs of the full flow: tile parquet scan, zonal CSV chunks, antennas and layers."""
    tiles = io.scan_tiles(spark, write_tiles_parquet(spark, sf_dir, scratch_path(spark, "tiles")), MY)
    env = io.scan_zonal_csv(spark, write_zonal_csv(spark, sf_dir, scratch_path(spark, "zonal_csv")))
    layers = layer_tables_from_fixtures(spark, sf_dir, ["power", "roads", "amenities", "tier1_hubs"])
    antennas = fixture(spark, sf_dir, "fx_antennas").withColumnRenamed("range_m", "range")
    towers = build_tower_sites(antennas, layers, MY)
    edges = fixture(spark, sf_dir, "fx_countries")
    return tiles, towers, env, edges


_RANK_COLS = ["site_id", "national_rank", "field_survey_triggered", "confidence_tier", "priority_score",
              "people_connected_per_tonne_co2", "cv_predicted_speed", "predicted_download_kbps", "top_shap_driver", "top_shap_value",
              "inference_status"]


@register("national_ranking")
def national_ranking(spark, sf_dir):
    """Flagship: raw inputs -> tower sites -> master matrix (region Malaysia: no polygon in the
    boundary set, so the box scan stands) -> screening -> model -> governance -> score -> rank,
    written as snappy parquet and read back."""
    tiles, towers, env, edges = _raw_inputs(spark, sf_dir)
    ranked = FL.national_ranking(tiles, towers, env, edges, "Malaysia")
    path = io.matrix_path(scratch_path(spark, "ranked"), "Malaysia")
    io.sink_matrix(ranked, path, wkb=True)
    return spark.read.parquet(path).select(*_RANK_COLS)


@register("rescore_stored_matrix")
def rescore_stored_matrix(spark, sf_dir):
    """Stored (screened) matrix -> imputation -> features -> model -> governance -> score -> rank."""
    path = io.matrix_path(scratch_path(spark, "matrix"), "Malaysia")
    screened = screening_op(fixture(spark, sf_dir, "fx_matrix").drop("cv_predicted_speed"))
    screened.write.mode("overwrite").parquet(path)
    ranked = FL.rescore_stored_matrix(io.scan_matrix(spark, path))
    out = io.matrix_path(scratch_path(spark, "scored"), "Malaysia")
    io.sink_matrix(ranked, out)
    return spark.read.parquet(out).select(*_RANK_COLS)


def _zonal_v1_sql() -> str:
    from .sqltext import utm_sql, zone_sql

    sx, sy = utm_sql("longitude", "latitude", _V1_Z)
    px, py = utm_sql("lon", "lat", _V1_Z)
    r = C.d(K.BUFFER_RADIUS_M)
    within = _within_sql("low", "p.site_id")
    return C.render(["fx_tiles", "fx_countries", "fx_pixels"], [
        ("low", f"""SELECT * EXCLUDE (population_total) FROM fx_tiles WHERE download_kbps <=
            (SELECT quantile_cont(CAST(download_kbps AS DOUBLE), {C.d(K.LOW_QUARTILE)}) FROM fx_tiles)"""),
        ("clip", f"SELECT l.* FROM low l JOIN ({within}) w ON l.site_id = w.site_id WHERE w.country = 'COUNTRY_10'"),
        ("smp", f"SELECT * FROM clip ORDER BY md5(site_id || '|{K.SEED}'), site_id LIMIT 20"),
        ("coh", f"""SELECT * REPLACE (CAST(row_number() OVER (ORDER BY md5(site_id || '|{K.SEED}'), site_id) - 1 AS VARCHAR) AS site_id) FROM smp"""),
        ("zz", f"SELECT {zone_sql('coh')} AS zone"),
        ("sp", f"SELECT site_id, {sx} AS x, {sy} AS y FROM coh"),
        ("pp", f"SELECT elevation, population, {px} AS rx, {py} AS ry FROM fx_pixels"),
        ("env", f"""SELECT s.site_id, avg(p.elevation) AS elevation_mean, sum(p.population) AS population_sum
            FROM sp s JOIN pp p ON sqrt((p.rx - s.x) * (p.rx - s.x) + (p.ry - s.y) * (p.ry - s.y)) <= {r} GROUP BY s.site_id"""),
    ], """SELECT c.longitude, c.latitude, c.download_kbps, c.tests, c.devices, round(e.elevation_mean, 6) AS elevation_m,
        round(e.population_sum, 6) AS population_total FROM coh c JOIN env e USING (site_id)""")


@register("zonal_v1", _zonal_v1_sql())
def zonal_v1(spark, sf_dir):
    tiles = fixture(spark, sf_dir, "fx_tiles").drop("population_total")
    out = FL.zonal_v1(tiles, fixture(spark, sf_dir, "fx_countries"), fixture(spark, sf_dir, "fx_pixels"), "COUNTRY_10")
    return out.select("longitude", "latitude", "download_kbps", "tests", "devices",
                      F.round("elevation_m", 6).alias("elevation_m"), F.round("population_total", 6).alias("population_total"))
