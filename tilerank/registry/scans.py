"""Scans, sources and sinks. File formats are exercised by writing the derived
fixture in the raw layout to the shared scratch folder and reading it back with the scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..session import scratch_path
from ..sources import files as io
from ..sources.fixtures import (
    fixture, with_fixtures, write_antenna_csv, write_boundaries_geojson, write_mixed_boundaries, write_layer_parquet,
    write_tiles_parquet, write_zonal_csv,
)

from . import register

MY = K.REGION_BOUNDS["Malaysia"]


@register("scan_antennas", with_fixtures(
    "SELECT radio, mcc, longitude, latitude, range_m AS range FROM fx_antennas", ["fx_antennas"]))
def scan_antennas(spark, sf_dir):
    path = write_antenna_csv(spark, sf_dir, scratch_path(spark, "antennas_csv"))
    return io.scan_antennas(spark, path)


@register("scan_tiles", with_fixtures(
    f"""SELECT site_id, longitude, latitude, download_kbps, tests, devices FROM fx_tiles
    WHERE longitude >= {MY[0]} AND longitude <= {MY[2]} AND latitude >= {MY[1]} AND latitude <= {MY[3]}""", ["fx_tiles"]))
def scan_tiles(spark, sf_dir):
    path = write_tiles_parquet(spark, sf_dir, scratch_path(spark, "tiles"))
    return io.scan_tiles(spark, path, io.region_bounds("Malaysia"))


@register("scan_boundaries", with_fixtures(
    """SELECT country, CAST(regexp_extract(country, '(\\d+)$', 1) AS BIGINT) AS objectid, CAST(NULL AS VARCHAR) AS flag,
    0 AS part, ring, seg, lon1, lat1, lon2, lat2 FROM fx_countries""", ["fx_countries"]))
def scan_boundaries(spark, sf_dir):
    path = write_boundaries_geojson(spark, sf_dir, scratch_path(spark, "boundaries_geojson"))
    return io.scan_boundaries(spark, path)


@register("scan_mixed_boundaries", with_fixtures(
    """SELECT country, CAST(regexp_extract(country, '(\\d+)$', 1) AS BIGINT) AS objectid, ring, seg,
    round(lon1, 9) AS lon1, round(lat1, 9) AS lat1, round(lon2, 9) AS lon2, round(lat2, 9) AS lat2 FROM fx_countries""", ["fx_countries"]))
def scan_mixed_boundaries(spark, sf_dir):
    """A folder of newline-delimited features, a plain collection and one in Web Mercator (degrees rounded to 1e-9)."""
    path = write_mixed_boundaries(spark, sf_dir, scratch_path(spark, "boundaries_mixed"))
    deg = [F.round(c, 9).alias(c) for c in ("lon1", "lat1", "lon2", "lat2")]
    return io.scan_boundaries(spark, path).select("country", "objectid", "ring", "seg", *deg)


def _layer_oracle(layer: str) -> str:
    w, s, e, n = MY
    if layer in ("power", "roads"):
        fx = "fx_power" if layer == "power" else "fx_roads"
        vals = ", ".join(f"'{v}'" for v in K.LAYERS[layer][2])
        return with_fixtures(f"""
SELECT '{layer}:' || CAST(feature_id AS VARCHAR) AS feature_id, class AS osm_type FROM (
  SELECT feature_id, class, min(least(lon1, lon2)) AS xmin, max(greatest(lon1, lon2)) AS xmax,
         min(least(lat1, lat2)) AS ymin, max(greatest(lat1, lat2)) AS ymax
  FROM {fx} GROUP BY feature_id, class) b
WHERE xmax >= {w} AND xmin <= {e} AND ymax >= {s} AND ymin <= {n} AND class IN ({vals})""", [fx])
    if layer == "amenities":
        return with_fixtures(f"""
SELECT 'amenities:' || CAST(feature_id AS VARCHAR) AS feature_id, category AS osm_type FROM fx_amenities
WHERE lon >= {w} AND lon <= {e} AND lat >= {s} AND lat <= {n} AND category IN ('school', 'hospital', 'clinic')""", ["fx_amenities"])
    return with_fixtures(f"""
SELECT 'tier1_hubs:' || CAST(feature_id AS VARCHAR) AS feature_id, subtype AS osm_type FROM fx_hubs
WHERE lon >= {w} AND lon <= {e} AND lat >= {s} AND lat <= {n} AND subtype = 'locality'""", ["fx_hubs"])


def _layer_query(layer: str):
    def run(spark, sf_dir):
        path = write_layer_parquet(spark, sf_dir, layer, scratch_path(spark, f"layer_{layer}"))
        return io.scan_layer(spark, path, MY, layer).select("feature_id", "osm_type")

    return run


for _key, _layer in (("layer_power", "power"), ("layer_roads", "roads"), ("layer_amenities", "amenities"), ("layer_tier1_hubs", "tier1_hubs")):
    register(_key, _layer_oracle(_layer))(_layer_query(_layer))


@register("layer_segments", with_fixtures(
    """SELECT 'roads:' || CAST(feature_id AS VARCHAR) AS feature_id, class AS osm_type, 'line' AS kind, 0 AS part, 0 AS ring, CAST(seg AS INTEGER) AS seg,
    lon1, lat1, lon2, lat2 FROM fx_roads WHERE class IN ('primary', 'secondary', 'tertiary', 'trunk')""", ["fx_roads"]))
def layer_segments(spark, sf_dir):
    path = write_layer_parquet(spark, sf_dir, "roads", scratch_path(spark, "layer_roads"))
    return io.layer_segments(io.scan_layer(spark, path, MY, "roads"))


@register("scan_zonal_csv", with_fixtures("SELECT * FROM fx_env", ["fx_env"]))
def scan_zonal_csv(spark, sf_dir):
    paths = write_zonal_csv(spark, sf_dir, scratch_path(spark, "zonal_csv"))
    return io.scan_zonal_csv(spark, paths)


@register("union_chunks", with_fixtures("SELECT * FROM fx_env", ["fx_env"]))
def union_chunks(spark, sf_dir):
    paths = write_zonal_csv(spark, sf_dir, scratch_path(spark, "zonal_csv"))
    return io.union_chunks(*[io.scan_zonal_csv(spark, p) for p in paths])


@register("scan_matrix", with_fixtures("SELECT * FROM fx_matrix", ["fx_matrix"]))
def scan_matrix(spark, sf_dir):
    path = io.matrix_path(scratch_path(spark, "matrix"), "Malaysia")
    fixture(spark, sf_dir, "fx_matrix").write.mode("overwrite").parquet(path)
    return io.scan_matrix(spark, path)


@register("sink_matrix", with_fixtures("SELECT *, 21 AS wkb_bytes FROM fx_matrix", ["fx_matrix"]))
def sink_matrix(spark, sf_dir):
    path = io.matrix_path(scratch_path(spark, "sink"), "Kuala Lumpur")
    io.sink_matrix(fixture(spark, sf_dir, "fx_matrix"), path, wkb=True)
    back = spark.read.parquet(path)
    return back.withColumn("wkb_bytes", F.octet_length("geometry")).drop("geometry")


@register("points_from_xy", with_fixtures("SELECT site_id, longitude AS x, latitude AS y FROM fx_tiles", ["fx_tiles"]))
def points_from_xy(spark, sf_dir):
    t = fixture(spark, sf_dir, "fx_tiles").select("site_id", io.points_from_xy().alias("geometry"))
    return t.select("site_id", "geometry.x", "geometry.y")


def _region_oracle() -> str:
    parts = []
    for name, (w, s, e, n) in K.REGION_BOUNDS.items():
        parts.append(f"""SELECT '{name}' AS region, {w}::DOUBLE AS west, {s}::DOUBLE AS south, {e}::DOUBLE AS east, {n}::DOUBLE AS north,
        (SELECT count(*) FROM fx_tiles WHERE longitude >= {w} AND longitude <= {e} AND latitude >= {s} AND latitude <= {n}) AS n_tiles""")
    return with_fixtures("\nUNION ALL\n".join(parts), ["fx_tiles"])


@register("region_bounds", _region_oracle())
def region_bounds(spark, sf_dir):
    """Tile count inside every configured region box: one scan, one conditional count per region."""
    tiles = fixture(spark, sf_dir, "fx_tiles")
    counts = tiles.agg(*[
        F.count_if(io.bbox_filter("longitude", "latitude", b)).alias(f"n{i}") for i, b in enumerate(K.REGION_BOUNDS.values())
    ])
    rows = F.array(*[
        F.struct(F.lit(name).alias("region"), F.lit(float(b[0])).alias("west"), F.lit(float(b[1])).alias("south"),
                 F.lit(float(b[2])).alias("east"), F.lit(float(b[3])).alias("north"), F.col(f"n{i}").alias("n_tiles"))
        for i, (name, b) in enumerate(K.REGION_BOUNDS.items())
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


