"""Derived test tables.

The driver's parquet tables carry no coordinates, so coordinates, speeds and raster values are
derived from their keys with fixed arithmetic (FIXTURES.md part B). The same SQL text runs on
Spark (``spark.sql`` with DataFrame arguments) and on DuckDB (plain view names), so a query and
its oracle see identical inputs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

FIXTURE_SQL: dict[str, str] = {
    "fx_tiles": """
SELECT lpad(CAST(o_orderkey AS STRING), 16, '0') AS site_id,
       99.6e0 + ((o_orderkey * 7919) % 19700) / 1e3 AS longitude,
       0.8e0 + ((o_orderkey * 104729) % 6700) / 1e3 AS latitude,
       CAST(floor(o_totalprice) AS BIGINT) AS download_kbps,
       (o_orderkey * 31) % 40 AS tests,
       (o_orderkey * 17) % 12 AS devices,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST((o_custkey * 13) % 2500 AS DOUBLE) END AS population_total
FROM {orders}""",
    "fx_antennas": """
SELECT CASE l_partkey % 5 WHEN 0 THEN 'LTE' WHEN 1 THEN 'UMTS' WHEN 2 THEN 'GSM' WHEN 3 THEN 'NR' ELSE 'CDMA' END AS radio,
       CASE WHEN l_partkey % 7 = 0 THEN 310 ELSE 502 END AS mcc,
       99700000 + (((l_suppkey * 20 + l_partkey % 20) * 7919) % 19500) * 1000 + l_linenumber * 3000 AS lon_e6,
       900000 + (((l_suppkey * 20 + l_partkey % 20) * 104729) % 6500) * 1000 + (l_linenumber % 3) * 600 AS lat_e6,
       (99700000 + (((l_suppkey * 20 + l_partkey % 20) * 7919) % 19500) * 1000 + l_linenumber * 3000) / 1e6 AS longitude,
       (900000 + (((l_suppkey * 20 + l_partkey % 20) * 104729) % 6500) * 1000 + (l_linenumber % 3) * 600) / 1e6 AS latitude,
       CAST(l_quantity * 20 AS INT) AS range_m
FROM {lineitem}""",
    "fx_countries": """
SELECT CONCAT('COUNTRY_', CAST(n_nationkey AS STRING)) AS country, v.ring AS ring, v.seg AS seg,
       99.6005e0 + (n_nationkey % 5) * 4e0 + v.x1 AS lon1, 0.8005e0 + floor(n_nationkey / 5e0) * 1.4e0 + v.y1 AS lat1,
       99.6005e0 + (n_nationkey % 5) * 4e0 + v.x2 AS lon2, 0.8005e0 + floor(n_nationkey / 5e0) * 1.4e0 + v.y2 AS lat2
FROM {nation} CROSS JOIN (VALUES
  (0,0,0e0,0e0,3.5e0,0e0),(0,1,3.5e0,0e0,3.5e0,0.6e0),(0,2,3.5e0,0.6e0,1.7e0,0.6e0),
  (0,3,1.7e0,0.6e0,1.7e0,1.2e0),(0,4,1.7e0,1.2e0,0e0,1.2e0),(0,5,0e0,1.2e0,0e0,0e0),
  (1,0,0.5e0,0.2e0,0.9e0,0.2e0),(1,1,0.9e0,0.2e0,0.9e0,0.5e0),(1,2,0.9e0,0.5e0,0.5e0,0.5e0),(1,3,0.5e0,0.5e0,0.5e0,0.2e0)
) AS v(ring, seg, x1, y1, x2, y2)""",
    "fx_roads": """
SELECT p_partkey AS feature_id, s.k AS seg,
       CASE p_partkey % 6 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'tertiary' WHEN 3 THEN 'trunk' WHEN 4 THEN 'residential' ELSE 'service' END AS class,
       99.7e0 + ((p_partkey * 6151) % 19000) / 1e3 + s.k * 0.02e0 AS lon1,
       0.9e0 + ((p_partkey * 3571) % 6400) / 1e3 + ((p_partkey + s.k * 7) % 5) * 0.01e0 AS lat1,
       99.7e0 + ((p_partkey * 6151) % 19000) / 1e3 + (s.k + 1) * 0.02e0 AS lon2,
       0.9e0 + ((p_partkey * 3571) % 6400) / 1e3 + ((p_partkey + (s.k + 1) * 7) % 5) * 0.01e0 AS lat2
FROM {part} CROSS JOIN (VALUES (0),(1),(2)) AS s(k)""",
    "fx_power": """
SELECT s_suppkey AS feature_id, 0 AS seg, CASE WHEN s_suppkey % 4 = 3 THEN 'pipeline' ELSE 'power_line' END AS class,
       99.8e0 + ((s_suppkey * 4099) % 18000) / 1e3 AS lon1, 1.0e0 + ((s_suppkey * 2053) % 6000) / 1e3 AS lat1,
       100.3e0 + ((s_suppkey * 4099) % 18000) / 1e3 AS lon2, 1.2e0 + ((s_suppkey * 2053) % 6000) / 1e3 AS lat2
FROM {supplier}""",
    "fx_amenities": """
SELECT c_custkey AS feature_id,
       CASE c_custkey % 5 WHEN 0 THEN 'school' WHEN 1 THEN 'hospital' WHEN 2 THEN 'clinic' WHEN 3 THEN 'cafe' ELSE 'shop' END AS category,
       99.7e0 + ((c_custkey * 8191) % 19400) / 1e3 AS lon, 0.9e0 + ((c_custkey * 5821) % 6500) / 1e3 AS lat
FROM {customer}""",
    "fx_hubs": """
SELECT n_nationkey AS feature_id, CASE WHEN n_nationkey % 4 = 3 THEN 'county' ELSE 'locality' END AS subtype,
       100.1e0 + ((n_nationkey * 731) % 190) / 1e1 AS lon, 1.1e0 + ((n_nationkey * 37) % 60) / 1e1 AS lat
FROM {nation}""",
    "fx_pixels": """
SELECT CAST(floor(o_orderkey / 1e2) AS BIGINT) AS px_row, o_orderkey % 100 AS px_col,
       101.0e0 + (o_orderkey % 100) * 0.01e0 AS lon, 3.0e0 + floor(o_orderkey / 1e2) * 0.01e0 AS lat,
       CAST((o_orderkey * 7919) % 1500 AS DOUBLE) AS elevation,
       CAST((o_orderkey * 13) % 300 AS DOUBLE) AS population
FROM {orders}""",
    "fx_zone_sites": """
SELECT CAST(c_custkey AS STRING) AS site_id, 101.05e0 + ((c_custkey * 37) % 900) / 1e3 AS longitude,
       3.02e0 + ((c_custkey * 53) % 110) / 1e3 AS latitude
FROM {customer}""",
    "fx_image_collection": """
SELECT user_id AS pixel_id, ts, value FROM {events}""",
    # Images of six bands on a 0.01 degree grid, at the pixel of each tile and the eight around it; some lie outside every composite's days.
    "fx_images": """
SELECT p.px_row, p.px_col, v.band AS band, CAST(v.day AS TIMESTAMP) AS ts,
       CAST((p.px_row * 7919 + p.px_col * 104729 + v.k * 37) % v.m AS DOUBLE) AS value
FROM (SELECT DISTINCT CAST(floor((800 + (o_orderkey * 104729) % 6700) / 1e1) AS BIGINT) + a.o AS px_row,
             CAST(floor((99600 + (o_orderkey * 7919) % 19700) / 1e1) AS BIGINT) + b.o AS px_col
      FROM {orders} CROSS JOIN (VALUES (-1), (0), (1)) AS a(o) CROSS JOIN (VALUES (-1), (0), (1)) AS b(o)) p
CROSS JOIN (VALUES ('night_radiance', '2021-12-31', 5, 640), ('night_radiance', '2022-02-01', 1, 640), ('night_radiance', '2022-06-01', 2, 640),
  ('night_radiance', '2022-12-31', 3, 640), ('night_radiance', '2022-07-01', 4, 64), ('solar_radiation', '2023-01-01', 1, 20000000),
  ('solar_radiation', '2023-07-01', 2, 20000000), ('population', '2020-05-01', 1, 300), ('population', '2021-01-01', 2, 300),
  ('elevation', '2000-02-11', 1, 1500), ('rainfall', '2023-03-01', 1, 100), ('rainfall', '2023-09-01', 2, 100), ('tree_canopy', '2000-06-01', 1, 100)
) AS v(band, day, k, m)""",
    "fx_env": """
SELECT lpad(CAST(o_orderkey AS STRING), 16, '0') AS site_id,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE ((o_orderkey * 271) % 1800) / 1e0 END AS elevation_mean,
       ((o_orderkey * 271) % 1800) * 3e1 AS elevation_sum,
       ((o_orderkey * 53) % 300) / 1e1 AS slope_mean,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE ((o_orderkey * 97) % 3600) / 1e1 END AS aspect_mean,
       ((o_orderkey * 41) % 500) / 1e1 AS terrain_ruggedness_mean,
       ((o_orderkey * 19) % 100) / 1e2 AS rainfall_mean,
       ((o_orderkey * 29) % 640) / 1e1 AS night_radiance_mean,
       CAST((o_custkey * 13) % 2500 AS DOUBLE) AS population_sum,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 1.2e7 + ((o_orderkey * 61) % 8000) * 1e3 END AS solar_radiation_mean,
       ((o_orderkey * 7) % 1000) / 1e1 AS tree_canopy_mean
FROM {orders} WHERE o_orderkey % 50 <> 7""",
    "fx_matrix": """
SELECT lpad(CAST(o_orderkey AS STRING), 16, '0') AS site_id,
       99.6e0 + ((o_orderkey * 7919) % 19700) / 1e3 AS longitude, 0.8e0 + ((o_orderkey * 104729) % 6700) / 1e3 AS latitude,
       CAST(floor(o_totalprice) AS BIGINT) AS download_kbps, (o_orderkey * 31) % 40 AS tests, (o_orderkey * 17) % 12 AS devices,
       CAST((o_custkey * 13) % 2500 AS DOUBLE) AS population_total,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE ((o_orderkey * 271) % 1800) / 1e0 END AS elevation_m,
       ((o_orderkey * 53) % 300) / 1e1 AS slope_degrees,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE ((o_orderkey * 97) % 3600) / 1e1 END AS aspect_degrees,
       ((o_orderkey * 41) % 500) / 1e1 AS terrain_ruggedness, ((o_orderkey * 19) % 100) / 1e2 AS rainfall_mm_hr,
       ((o_orderkey * 29) % 640) / 1e1 AS night_radiance_nw_cm2_sr, 12e0 + ((o_orderkey * 61) % 8000) / 1e3 AS solar_radiation_mj,
       ((o_orderkey * 7) % 1000) / 1e1 AS tree_canopy,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE ((o_orderkey * 733) % 9000) / 1e0 END AS distance_to_power_m,
       ((o_orderkey * 389) % 4000) / 1e0 AS distance_to_road_m, ((o_orderkey * 577) % 6000) / 1e0 AS distance_to_amenity_m,
       ((o_orderkey * 199) % 50000) / 1e0 AS distance_to_tier1_hub_m, ((o_orderkey * 307) % 5500) / 1e0 AS distance_to_nearest_tower,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey % 9 END AS antenna_count,
       o_orderkey % 4 AS antennas_4G, o_orderkey % 3 AS antennas_3G, o_orderkey % 2 AS antennas_2G,
       CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS antennas_5G,
       CAST(floor(o_totalprice) AS DOUBLE) * (0.6e0 + ((o_orderkey * 11) % 80) / 1e2) AS cv_predicted_speed
FROM {orders}""",
    # Tower table for checking the nearest-tower join on its own: one tower per distinct antenna
    # position, with counts from the antennas there and stand-in infrastructure distances.
    "fx_towers": """
SELECT lon_e6 * 100000000 + lat_e6 AS cluster_id,
       min(longitude) AS longitude, min(latitude) AS latitude,
       CAST(count(radio) AS BIGINT) AS antenna_count, avg(range_m) AS range_m,
       CAST(sum(CASE WHEN radio = 'LTE' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_4G,
       CAST(sum(CASE WHEN radio = 'UMTS' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_3G,
       CAST(sum(CASE WHEN radio = 'GSM' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_2G,
       CAST(sum(CASE WHEN radio = 'NR' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_5G,
       ((lon_e6 + lat_e6) % 9000) / 1e0 AS distance_to_power_m,
       ((lon_e6 * 3 + lat_e6) % 4000) / 1e0 AS distance_to_road_m,
       ((lon_e6 + lat_e6 * 7) % 6000) / 1e0 AS distance_to_amenity_m,
       ((lon_e6 * 11 + lat_e6) % 50000) / 1e0 AS distance_to_tier1_hub_m
FROM (FX_ANTENNAS) a
GROUP BY lon_e6, lat_e6""",
}

_TABLE_REF = re.compile(r"\{(\w+)\}")


def _resolved(name: str) -> str:
    text = FIXTURE_SQL[name]
    if "(FX_ANTENNAS)" in text:
        text = text.replace("(FX_ANTENNAS)", "(" + FIXTURE_SQL["fx_antennas"] + ")")
    return text


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a derived fixture as a lazy DataFrame over the driver's parquet tables."""
    text = _resolved(name)
    tables = {t: read_table(spark, sf_dir, t) for t in set(_TABLE_REF.findall(text))}
    return spark.sql(text, **tables)


def fixture_sql(name: str) -> str:
    """The same fixture as plain SQL over the pre-registered DuckDB views."""
    text = _resolved(name)
    return _TABLE_REF.sub(lambda m: m.group(1), text)


def with_fixtures(query: str, names: list[str] | tuple[str, ...]) -> str:
    """Prefix an oracle query with the fixture CTEs it uses."""
    ctes = ",\n".join(f"{n} AS ({fixture_sql(n)}\n)" for n in names)
    return f"WITH {ctes}\n{query}"


# ---------------------------------------------------------------------------
# Fixture files in the raw layouts the scans read (written under the shared scratch folder).
# ---------------------------------------------------------------------------

def write_antenna_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Antenna CSV (gzip) with the raw header ``radio,mcc,net,lon,lat,range``."""
    from pyspark.sql import functions as F

    ant = fixture(spark, sf_dir, "fx_antennas")
    ant.select(
        "radio", "mcc", F.lit(1).alias("net"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"),
        F.col("range_m").alias("range"),
    ).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
    return path


def write_tiles_parquet(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Tiles in the raw speed-test layout ``quadkey, tile_x, tile_y, avg_d_kbps, tests, devices``."""
    from pyspark.sql import functions as F

    fixture(spark, sf_dir, "fx_tiles").select(
        F.col("site_id").alias("quadkey"), F.col("longitude").alias("tile_x"), F.col("latitude").alias("tile_y"),
        F.col("download_kbps").alias("avg_d_kbps"), "tests", "devices",
    ).write.mode("overwrite").parquet(path)
    return path


def countries_geojson_lines(spark: SparkSession, sf_dir: str, edges: DataFrame | None = None) -> DataFrame:
    """One GeoJSON Feature per country (outer ring + hole), as text lines."""
    from pyspark.sql import functions as F

    e = fixture(spark, sf_dir, "fx_countries") if edges is None else edges
    # per ring: ordered start points, closed with the last segment's end point
    rings = e.groupBy("country", "ring").agg(
        F.sort_array(F.collect_list(F.struct("seg", "lon1", "lat1", "lon2", "lat2"))).alias("s")
    )
    pts = F.transform("s", lambda r: F.array(r["lon1"], r["lat1"]))
    closed = F.concat(pts, F.array(F.array(F.element_at("s", -1)["lon2"], F.element_at("s", -1)["lat2"])))
    rings = rings.select("country", "ring", closed.alias("pts"))
    feats = rings.groupBy("country").agg(F.sort_array(F.collect_list(F.struct("ring", "pts"))).alias("r"))
    geom = F.struct(F.lit("Polygon").alias("type"), F.transform("r", lambda x: x["pts"]).alias("coordinates"))
    props = F.struct(
        F.col("country").alias("Country"),
        F.regexp_extract("country", r"(\d+)$", 1).cast("bigint").alias("OBJECTID"),
        F.lit(None).cast("string").alias("Flag"),
    )
    feature = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), geom.alias("geometry"))
    return feats.select(F.to_json(feature).alias("value"))


def write_boundaries_geojson(spark: SparkSession, sf_dir: str, path: str) -> str:
    countries_geojson_lines(spark, sf_dir).write.mode("overwrite").text(path)
    return path


def write_mixed_boundaries(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The countries in three kinds of files in one folder: lines, a collection, a collection in Web Mercator metres."""
    from pyspark.sql import functions as F

    e = fixture(spark, sf_dir, "fx_countries")
    kind = F.regexp_extract("country", r"(\d+)$", 1).cast("int") % 3
    radius = 6378137.0
    metres = {f"lon{i}": F.radians(f"lon{i}") * radius for i in (1, 2)} | {f"lat{i}": F.asinh(F.tan(F.radians(f"lat{i}"))) * radius for i in (1, 2)}

    def document(edges, tag):
        one = countries_geojson_lines(spark, sf_dir, edges).agg(F.concat_ws(",", F.collect_list("value")).alias("f"))
        return one.select(F.concat(F.lit('{"type": "FeatureCollection", ' + tag + '"features": ['), "f", F.lit("]}")).alias("value"))

    countries_geojson_lines(spark, sf_dir, e.where(kind == 0)).write.mode("overwrite").text(path)
    document(e.where(kind == 1), "").write.mode("append").text(path)
    tag = '"crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, '
    document(e.where(kind == 2).withColumns(metres), tag).write.mode("append").text(path)
    return path


def layer_frame(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """Infrastructure layer rows: ``id, geometry (WKB), class, subtype, categories, bbox``."""
    from pyspark.sql import functions as F

    from .wkb import linestring_wkb, point_wkb

    def rows(src, kind):
        if kind == "line":
            g = src.groupBy("feature_id", "class").agg(
                F.sort_array(F.collect_list(F.struct("seg", "lon1", "lat1", "lon2", "lat2"))).alias("s")
            )
            pts = F.concat(
                F.transform("s", lambda r: F.struct(r["lon1"].alias("x"), r["lat1"].alias("y"))),
                F.array(F.struct(F.element_at("s", -1)["lon2"].alias("x"), F.element_at("s", -1)["lat2"].alias("y"))),
            )
            g = g.select("feature_id", "class", pts.alias("pts"))
            xs, ys = F.transform("pts", lambda p: p["x"]), F.transform("pts", lambda p: p["y"])
            return g.select(
                "feature_id", linestring_wkb(F.col("pts")).alias("geometry"), "class",
                F.lit(None).cast("string").alias("subtype"), F.lit(None).cast("string").alias("category"),
                F.array_min(xs).alias("xmin"), F.array_max(xs).alias("xmax"), F.array_min(ys).alias("ymin"), F.array_max(ys).alias("ymax"),
            )
        return src.select(
            "feature_id", point_wkb("lon", "lat").alias("geometry"), F.lit(None).cast("string").alias("class"),
            "subtype", "category", F.col("lon").alias("xmin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymin"), F.col("lat").alias("ymax"),
        )

    if layer == "power":
        r = rows(fixture(spark, sf_dir, "fx_power"), "line")
    elif layer == "roads":
        r = rows(fixture(spark, sf_dir, "fx_roads"), "line")
    elif layer == "amenities":
        r = rows(fixture(spark, sf_dir, "fx_amenities").withColumn("subtype", F.lit(None).cast("string")), "point")
    elif layer == "tier1_hubs":
        r = rows(fixture(spark, sf_dir, "fx_hubs").withColumn("category", F.lit(None).cast("string")), "point")
    else:
        raise ValueError(layer)
    return r.select(
        F.concat(F.lit(layer + ":"), F.col("feature_id").cast("string")).alias("id"),
        "geometry", "class", "subtype",
        F.struct(F.col("category").alias("primary")).alias("categories"),
        F.struct("xmin", "xmax", "ymin", "ymax").alias("bbox"),
    )


def write_layer_parquet(spark: SparkSession, sf_dir: str, layer: str, path: str) -> str:
    layer_frame(spark, sf_dir, layer).write.mode("overwrite").parquet(path)
    return path


def write_zonal_csv(spark: SparkSession, sf_dir: str, path: str, chunks: int = 3) -> list[str]:
    """The per-site zonal table as ``chunks`` CSV chunk folders (site_id keeps its leading zeros)."""
    from pyspark.sql import functions as F

    env = fixture(spark, sf_dir, "fx_env").withColumn("_chunk", F.abs(F.xxhash64("site_id")) % chunks)
    paths = []
    for i in range(chunks):
        p = f"{path}/part{i + 1}"
        env.where(F.col("_chunk") == i).drop("_chunk").write.mode("overwrite").option("header", True).csv(p)
        paths.append(p)
    return paths
