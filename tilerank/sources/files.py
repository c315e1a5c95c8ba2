"""Scans and sinks: antenna CSV, tile parquet, boundary GeoJSON, infrastructure layers,
zonal-statistics CSV chunks and the feature matrix."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.geo import unproject_utm
from .wkb import SEGMENT_SCHEMA, decode_segments, point_wkb


def region_bounds(name: str) -> tuple[float, float, float, float]:
    """Region name -> ``(west, south, east, north)``; an unknown name raises."""
    try:
        return K.REGION_BOUNDS[name]
    except KeyError:
        raise ValueError(f"Region {name} not found in config.") from None


def _num(c: str, typ: str) -> Column:
    """Cast text to a number; unparsable text and NaN become NULL."""
    v = F.col(c).try_cast(typ)
    return F.nanvl(v, F.lit(None).cast(typ)) if typ in ("double", "float") else v


def scan_antennas(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Antenna CSV (gzip allowed), columns picked by header name; ``lon/lat`` renamed.

    Gzip files are not splittable, so each file is one read task; the rows are spread
    over ``partitions`` (default: the shuffle partition count) right after the read.
    """
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    df = raw.select(
        F.col("radio").cast("string").alias("radio"),
        _num("mcc", "int").alias("mcc"),
        _num("lon", "double").alias("longitude"),
        _num("lat", "double").alias("latitude"),
        _num("range", "int").alias("range"),
    )
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)


def bbox_filter(lon: Column | str, lat: Column | str, bounds) -> Column:
    """Inclusive point-in-box predicate (pushed down to parquet row groups)."""
    w, s, e, n = bounds
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    return (lon >= w) & (lon <= e) & (lat >= s) & (lat <= n)


def scan_tiles(spark: SparkSession, path: str, bounds) -> DataFrame:
    """Speed-test tiles inside an inclusive box, renamed to the matrix vocabulary."""
    return nan_to_null(
        spark.read.parquet(path)
        .where(bbox_filter("tile_x", "tile_y", bounds))
        .select(
            F.col("quadkey").cast("string").alias("site_id"),
            F.col("tile_x").alias("longitude"),
            F.col("tile_y").alias("latitude"),
            F.col("avg_d_kbps").alias("download_kbps"),
            F.col("tests"),
            F.col("devices"),
        )
    )


_COORDS = {
    "Polygon": "array<array<array<double>>>",
    "MultiPolygon": "array<array<array<array<double>>>>",
}


_PROPERTIES, _GEOMETRY = "struct<Country: string, OBJECTID: bigint, Flag: string>", "struct<type: string, coordinates: string>"
_FEATURE = f"type: string, properties: {_PROPERTIES}, geometry: {_GEOMETRY}"
_LINE = f"type string, properties {_PROPERTIES}, geometry {_GEOMETRY}"
_WEB_MERCATOR_RADIUS_M = 6378137.0


def _boundary_layouts(spark: SparkSession, path: str | Sequence[str]) -> tuple[list[str], list[str]]:
    """``(files of newline-delimited features, files that are one document)``, told by each file's first line
    (one row per file reaches the driver, which lists the files anyway). A file without any text is an error."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    first = lines.where(F.trim("value") != "").groupBy("file").agg(F.min_by("value", "at").alias("head"))
    kind = {r["file"]: r["type"] for r in first.select("file", F.from_json("head", "type string")["type"].alias("type")).collect()}
    listed = spark.read.format("binaryFile").load(path).where(F.col("_metadata.file_size") > 0)  # writers leave files of no length
    every = {r["file"] for r in listed.select(F.col("_metadata.file_path").alias("file")).collect()}
    if every - set(kind) or not kind:
        raise ValueError(f"boundary files without any feature: {sorted(every - set(kind)) or path}")
    # a lone feature written over several lines starts like a document: its first line does not parse to a type
    return sorted(f for f, t in kind.items() if t == "Feature"), sorted(f for f, t in kind.items() if t != "Feature")


def _to_wgs84(pts: Column, name: Column) -> Column:
    """Ring points in the reference system ``name`` (NULL: WGS84) as ``[longitude, latitude]`` arrays.

    Known: WGS84, Web Mercator (EPSG:3857), and the UTM zones of WGS84 (EPSG:326zz north, 327zz south);
    any other name is an error.
    """
    code = F.regexp_extract(name, r"EPSG:+(?:[0-9.]*:)?([0-9]+)$", 1)
    same = name.isNull() | name.rlike("CRS84$") | (code == "4326")

    def mercator(p):
        return F.array(F.degrees(p[0] / _WEB_MERCATOR_RADIUS_M), F.degrees(F.atan(F.sinh(p[1] / _WEB_MERCATOR_RADIUS_M))))

    def utm(p):
        south = code.startswith("327")
        return F.array(*unproject_utm(p[0], p[1] - F.when(south, F.lit(10000000.0)).otherwise(0.0), F.substring(code, 4, 2).cast("int")))

    unknown = F.raise_error(F.concat(F.lit("boundaries are in an unknown reference system: "), name)).cast("array<array<double>>")
    return (F.when(same, pts).when(code == "3857", F.transform(pts, mercator))
            .when(code.rlike("^32[67](0[1-9]|[1-5][0-9]|60)$"), F.transform(pts, utm)).otherwise(unknown))


def scan_boundaries(spark: SparkSession, path: str | Sequence[str], region: str | None = None) -> DataFrame:
    """GeoJSON polygons -> edge table ``(country, objectid, flag, part, ring, seg, lon1, lat1, lon2, lat2)``.

    A path may hold files of newline-delimited features (one per line, splittable) and files that are one
    document (a FeatureCollection or a lone Feature; one task per file), mixed: each file's first line tells.
    Coordinates come out as WGS84 longitude/latitude; a document tagged with Web Mercator or a UTM zone of WGS84
    is projected back, any other tag is an error. A file without a feature, or with a line that is
    none, is an error too; a feature without a polygon has no edges. ``region`` keeps only ``Country == region``.
    """
    by_line, whole = _boundary_layouts(spark, path)
    reader = spark.read.option("primitivesAsString", False)
    parts = []
    if by_line:
        rows = reader.schema(_LINE).json(by_line)
        ok = F.when(F.col("type") == "Feature", F.lit(None).cast("string")).otherwise(
            F.raise_error(F.lit("a line of a boundary file is not a feature")).cast("string"))
        parts.append(rows.select(ok.alias("crs"), "properties", "geometry"))
    if whole:
        docs = reader.option("multiLine", True).schema(
            f"{_LINE}, crs struct<properties: struct<name: string>>, features array<struct<{_FEATURE}>>").json(whole)
        lone = F.when(F.col("type") == "Feature", F.array(F.struct("type", "properties", "geometry")))
        listed = F.coalesce(lone, F.when(F.size("features") > 0, F.col("features")), F.raise_error(F.concat(
            F.lit("a boundary file holds no feature: "), F.col("_metadata.file_path"))).cast(f"array<struct<{_FEATURE}>>"))
        parts.append(docs.select(F.col("crs.properties.name").alias("crs"), F.explode(listed).alias("f")).select("crs", "f.properties", "f.geometry"))
    feats = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if region is not None:
        feats = feats.where(F.col("properties.Country") == region)
    poly = F.from_json("geometry.coordinates", _COORDS["Polygon"])
    multi = F.from_json("geometry.coordinates", _COORDS["MultiPolygon"])
    polygons = F.when(F.col("geometry.type") == "Polygon", F.array(poly)).when(F.col("geometry.type") == "MultiPolygon", multi)
    rings = (
        feats.select(
            F.col("properties.Country").alias("country"),
            F.col("properties.OBJECTID").alias("objectid"),
            F.col("properties.Flag").alias("flag"),
            "crs", F.posexplode(polygons).alias("part", "rings"),
        )
        .select("country", "objectid", "flag", "part", "crs", F.posexplode("rings").alias("ring", "pts"))
        .withColumn("pts", _to_wgs84(F.col("pts"), F.col("crs")))
    )
    n = F.size("pts")
    edges = rings.select(
        "country", "objectid", "flag", "part", "ring",
        F.posexplode(F.arrays_zip(F.slice("pts", 1, n - 1).alias("a"), F.slice("pts", 2, n - 1).alias("b"))).alias("seg", "e"),
    )
    return edges.select(
        "country", "objectid", "flag",
        F.col("part").cast("int").alias("part"), F.col("ring").cast("int").alias("ring"), F.col("seg").cast("int").alias("seg"),
        F.col("e.a")[0].alias("lon1"), F.col("e.a")[1].alias("lat1"),
        F.col("e.b")[0].alias("lon2"), F.col("e.b")[1].alias("lat2"),
    )


def bbox_overlaps(bbox: str, bounds) -> Column:
    """Feature box overlaps the region box (inclusive), on the struct fields of ``bbox``."""
    w, s, e, n = bounds
    return (
        (F.col(f"{bbox}.xmax") >= w) & (F.col(f"{bbox}.xmin") <= e)
        & (F.col(f"{bbox}.ymax") >= s) & (F.col(f"{bbox}.ymin") <= n)
    )


def scan_layer(spark: SparkSession, path: str, bounds, layer: str) -> DataFrame:
    """One infrastructure layer: rows whose box overlaps the region and whose class matches.

    Output ``(feature_id, geom_wkb, osm_type)``. An unknown layer name raises. The box and class
    predicates reach the parquet scan (nested-field pushdown).
    """
    return select_layer(spark.read.parquet(path), bounds, layer)


def select_layer(df: DataFrame, bounds, layer: str) -> DataFrame:
    """The layer predicates and projection of :func:`scan_layer` on an existing DataFrame."""
    if layer not in K.LAYERS:
        raise ValueError("Invalid layer name requested.")
    _, field, values = K.LAYERS[layer]
    sel = F.col(field)
    pred = bbox_overlaps("bbox", bounds) & (sel == values[0] if len(values) == 1 else sel.isin(*values))
    return df.where(pred).select(
        F.col("id").cast("string").alias("feature_id"), F.col("geometry").alias("geom_wkb"), sel.alias("osm_type")
    )


def layer_segments(layer_df: DataFrame, wkb_col: str = "geom_wkb", id_col: str = "feature_id", type_col: str = "osm_type") -> DataFrame:
    """Decode WKB geometries into the segment table (points become zero-length segments).

    An empty layer gives an empty, typed segment table.
    """
    src = layer_df.select(F.col(id_col).cast("string").alias(id_col), F.col(type_col).alias(type_col), F.col(wkb_col).alias(wkb_col))
    return src.mapInPandas(lambda it: decode_segments(it, id_col, type_col, wkb_col), SEGMENT_SCHEMA)


def scan_zonal_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per-chunk zonal CSV files; ``site_id`` stays text (leading zeros kept), bands become doubles."""
    raw = spark.read.option("header", True).csv(paths if isinstance(paths, str) else list(paths))
    return raw.select(
        F.col("site_id").cast("string").alias("site_id"),
        *[_num(c, "double").alias(c) for c in raw.columns if c != "site_id"],
    )


def union_chunks(*dfs: DataFrame) -> DataFrame:
    """Concatenate chunk results by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def matrix_path(directory: str, region: str, stem: str = "priority_matrix") -> str:
    """Region-suffixed file name: lower case, spaces to underscores."""
    return os.path.join(directory, f"{stem}_{region.lower().replace(' ', '_')}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating columns: NaN -> NULL (NULL is the only missing marker inside the library; Spark
    orders NaN above every number, which would corrupt maxima and threshold comparisons)."""
    fl = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in fl}) if fl else df


def scan_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored feature or scored matrix (missing file -> error raised by the reader); NaN -> NULL."""
    return nan_to_null(spark.read.parquet(path))


def points_from_xy(lon: str = "longitude", lat: str = "latitude") -> Column:
    """Point geometry as a struct of WGS84 coordinates."""
    return F.struct(F.col(lon).alias("x"), F.col(lat).alias("y"))


def sink_matrix(df: DataFrame, path: str, wkb: bool = False, mode: str = "overwrite") -> str:
    """Snappy parquet; with ``wkb=True`` a WKB point column ``geometry`` is added at egress."""
    out = df.withColumn("geometry", point_wkb("longitude", "latitude")) if wkb else df
    out.write.mode(mode).option("compression", "snappy").parquet(path)
    return path
