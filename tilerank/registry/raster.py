"""Raster composites, terrain derivatives, disk joins and zonal statistics (SURVEY ops 36, 38, 41,
45, 46, 60-63). Oracles use neighbour self-joins and all-pairs distance tests in DuckDB."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import raster as RA
from ..operators.tables import keep_first
from ..sources.fixtures import fixture
from . import chain as C
from . import register
from .sqltext import utm_sql, zone_sql

d = C.d
START, END = "2024-01-05", "2024-01-20"
PITCH = 0.01
STEP = math.radians(PITCH) * RA.EARTH_RADIUS_M


@register("temporal_composite", C.render(["fx_image_collection"], [], f"""SELECT pixel_id, median(value) AS median_value,
    round(avg(value), 9) AS mean_value FROM fx_image_collection
    WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}' GROUP BY pixel_id"""))
def temporal_composite(spark, sf_dir):
    imgs = fixture(spark, sf_dir, "fx_image_collection")
    out = RA.composite_bands(imgs, [(f"{how}_value", "", how, START, END) for how in ("median", "mean")], ["pixel_id"], None)
    return out.withColumn("mean_value", F.round("mean_value", 9))


_NB = """SELECT p.*, e.elevation AS ze, w.elevation AS zw, n.elevation AS zn, s.elevation AS zs FROM fx_pixels p
  LEFT JOIN fx_pixels e ON e.px_row = p.px_row AND e.px_col = p.px_col + 1
  LEFT JOIN fx_pixels w ON w.px_row = p.px_row AND w.px_col = p.px_col - 1
  LEFT JOIN fx_pixels n ON n.px_col = p.px_col AND n.px_row = p.px_row + 1
  LEFT JOIN fx_pixels s ON s.px_col = p.px_col AND s.px_row = p.px_row - 1"""
_GRAD = f"""SELECT *, (ze - zw) / ({d(2.0 * STEP)} * cos(radians(lat))) AS gx, (zn - zs) / {d(2.0 * STEP)} AS gy FROM nb"""
_SLOPE = "degrees(atan(sqrt(gx * gx + gy * gy)))"
_DEG = "degrees(atan2(-gx, -gy))"
_ASPECT = (f"CASE WHEN gx = 0 AND gy = 0 THEN NULL WHEN {_DEG} % 360.0 < 0 THEN ({_DEG} % 360.0 + 360.0) % 360.0 "
           f"ELSE {_DEG} % 360.0 END")


@register("terrain_slope", C.render(["fx_pixels"], [("nb", _NB), ("gr", _GRAD)], f"SELECT px_row, px_col, round({_SLOPE}, 6) AS slope FROM gr"))
def terrain_slope(spark, sf_dir):
    px = fixture(spark, sf_dir, "fx_pixels")
    return RA.terrain_slope(px, "elevation", PITCH).select("px_row", "px_col", F.round("slope", 6).alias("slope"))


@register("terrain_aspect", C.render(["fx_pixels"], [("nb", _NB), ("gr", _GRAD)], f"SELECT px_row, px_col, round({_ASPECT}, 6) AS aspect FROM gr"))
def terrain_aspect(spark, sf_dir):
    px = fixture(spark, sf_dir, "fx_pixels")
    return RA.terrain_aspect(px, "elevation", PITCH).select("px_row", "px_col", F.round("aspect", 6).alias("aspect"))


_OFFS = "(VALUES (-3), (-2), (-1), (0), (1), (2), (3))"


@register("neighbourhood_stddev", C.render(["fx_pixels"], [], f"""SELECT p.px_row, p.px_col,
    round(sqrt(greatest((count(*) * sum(q.elevation * q.elevation) - sum(q.elevation) * sum(q.elevation)) / (count(*) * count(*)), 0.0::DOUBLE)), 6)
      AS terrain_ruggedness
    FROM fx_pixels p CROSS JOIN {_OFFS} dr(o) CROSS JOIN {_OFFS} dc(o)
    JOIN fx_pixels q ON q.px_row = p.px_row + dr.o AND q.px_col = p.px_col + dc.o GROUP BY p.px_row, p.px_col"""))
def neighbourhood_stddev(spark, sf_dir):
    px = fixture(spark, sf_dir, "fx_pixels")
    out = RA.neighbourhood_stddev(px, "elevation", 3, out="terrain_ruggedness")
    return out.select("px_row", "px_col", F.round("terrain_ruggedness", 6).alias("terrain_ruggedness"))


@register("stack_bands", C.render(["fx_pixels"], [("nb", _NB), ("gr", _GRAD)], f"""SELECT px_row, px_col, elevation, population,
    round({_SLOPE}, 6) AS slope FROM gr"""))
def stack_bands(spark, sf_dir):
    """Elevation, population and the derived slope band (missing at the raster edge) in one table."""
    px = fixture(spark, sf_dir, "fx_pixels")
    slope = RA.terrain_slope(px, "elevation", PITCH).where(F.col("slope").isNotNull())
    bands = {
        "elevation": px.select("px_row", "px_col", F.col("elevation").alias("value")),
        "population": px.select("px_row", "px_col", F.col("population").alias("value")),
        "slope": slope.select("px_row", "px_col", F.col("slope").alias("value")),
    }
    return RA.stack_bands(bands).withColumn("slope", F.round("slope", 6))


def _disk_ctes(sites: str, zone_src: str) -> list[tuple[str, str]]:
    z = "(SELECT zone FROM zz)"
    sx, sy = utm_sql("longitude", "latitude", z)
    px, py = utm_sql("lon", "lat", z)
    r = K.BUFFER_RADIUS_M
    return [
        ("zz", f"SELECT {zone_sql(zone_src)} AS zone"),
        ("sp", f"SELECT *, {sx} AS x, {sy} AS y, CAST(floor({sx} / {d(r)}) AS BIGINT) AS ci, CAST(floor({sy} / {d(r)}) AS BIGINT) AS cj FROM {sites}"),
        ("pp", f"SELECT *, {px} AS rx, {py} AS ry, CAST(floor({px} / {d(r)}) AS BIGINT) AS ci, CAST(floor({py} / {d(r)}) AS BIGINT) AS cj FROM fx_pixels"),
        ("pairs", f"""SELECT s.*, p.px_row, p.px_col, p.elevation, p.population,
            sqrt((p.rx - s.x) * (p.rx - s.x) + (p.ry - s.y) * (p.ry - s.y)) AS distance_m
            FROM sp s CROSS JOIN (VALUES (-1), (0), (1)) a(o) CROSS JOIN (VALUES (-1), (0), (1)) b(o)
            JOIN pp p ON p.ci = s.ci + a.o AND p.cj = s.cj + b.o
            WHERE sqrt((p.rx - s.x) * (p.rx - s.x) + (p.ry - s.y) * (p.ry - s.y)) <= {d(r)}"""),
    ]


@register("join_disk_pixels", C.render(["fx_zone_sites", "fx_pixels"], _disk_ctes("fx_zone_sites", "fx_zone_sites"),
                                       "SELECT site_id, px_row, px_col, round(distance_m, 3) AS distance_m FROM pairs"))
def join_disk_pixels(spark, sf_dir):
    s = fixture(spark, sf_dir, "fx_zone_sites")
    p = fixture(spark, sf_dir, "fx_pixels")
    out = RA.join_disk_pixels(s, p, K.BUFFER_RADIUS_M)
    return out.select("site_id", "px_row", "px_col", F.round("distance_m", 3).alias("distance_m"))


@register("zonal_stats", C.render(["fx_zone_sites", "fx_pixels"], _disk_ctes("fx_zone_sites", "fx_zone_sites"), """SELECT site_id,
    round(avg(elevation), 6) AS elevation_mean, round(sum(elevation), 6) AS elevation_sum,
    round(avg(population), 6) AS population_mean, round(sum(population), 6) AS population_sum FROM pairs GROUP BY site_id"""))
def zonal_stats(spark, sf_dir):
    s = fixture(spark, sf_dir, "fx_zone_sites")
    p = fixture(spark, sf_dir, "fx_pixels")
    z = RA.zonal_stats(s, p, ["elevation", "population"], K.BUFFER_RADIUS_M)
    return z.select("site_id", *[F.round(c, 6).alias(c) for c in z.columns if c != "site_id"])


@register("keep_first_per_site", C.render(["fx_zone_sites", "fx_pixels"], _disk_ctes("fx_zone_sites", "fx_zone_sites"), """
SELECT site_id, px_row, px_col, round(distance_m, 3) AS distance_m FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY distance_m, px_row, px_col) AS rn FROM pairs) t WHERE rn = 1"""))
def keep_first_per_site(spark, sf_dir):
    """Nearest pixel centre of each site: first match per site after the disk join."""
    s = fixture(spark, sf_dir, "fx_zone_sites")
    p = fixture(spark, sf_dir, "fx_pixels")
    pairs = RA.join_disk_pixels(s, p, K.BUFFER_RADIUS_M).select("site_id", "px_row", "px_col", "distance_m")
    first = keep_first(pairs, "site_id", ["distance_m", "px_row", "px_col"])
    return first.select("site_id", "px_row", "px_col", F.round("distance_m", 3).alias("distance_m"))


@register("bounds_footprint_semi", C.render(["fx_tiles", "fx_pixels"], _disk_ctes("fx_tiles", "fx_tiles"),
                                            "SELECT * FROM fx_tiles WHERE site_id IN (SELECT site_id FROM pairs)"))
def bounds_footprint_semi(spark, sf_dir):
    """Tiles whose 2750 m disk reaches the pixel lattice."""
    t = fixture(spark, sf_dir, "fx_tiles")
    return RA.sites_in_footprint(t, fixture(spark, sf_dir, "fx_pixels"), K.BUFFER_RADIUS_M)
