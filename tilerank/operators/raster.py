"""Raster work on pixel tables ``(px_row, px_col, lon, lat, band columns...)``.

Rows grow northward and columns eastward. Neighbourhood operators deal the raster in square blocks of ``BLOCK`` pixels a side; a pixel near an edge also goes, as halo, to
the blocks beside it. That is one exchange, whatever the neighbourhood; inside a block, dense arrays hold the bands.
Composites count the values of each pixel first and then walk them in order: one scan and two exchanges for medians and means of any number of bands.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.geo import mean_longitude_zone, with_utm
from .spatial import join_within_radius
from .zonal import disk_sums, places_reached

EARTH_RADIUS_M = 6378137.0
#: Side of a raster block in pixels.
BLOCK = 128


def composite_bands(images: DataFrame, recipes: Sequence[tuple[str, str, str, str | None, str | None]], keys: Sequence[str] = ("px_row", "px_col"),
                    band: str | None = "band", value: str = "value", ts: str = "ts") -> DataFrame:
    """One row per pixel with a column per recipe ``(out, band, how, start, end)``: the median or mean of the band's values with ``start <= ts < end``.

    A recipe without ``start`` takes every value of its band; ``band=None`` means that the images have a single band. Values are counted per pixel before they are
    sorted, so repeated values travel once; missing values are skipped, a recipe without values gives NULL, and a pixel without any value is absent.
    """
    keys = list(keys)
    t = images.schema[ts].dataType
    uses = []
    for i, (_, name, how, start, end) in enumerate(recipes):
        if how not in ("median", "mean"):
            raise ValueError(f"unknown composite {how}")
        here = F.lit(True) if band is None else F.col(band) == F.lit(name)
        if start is not None:
            here = here & (F.col(ts) >= F.lit(start).cast(t)) & (F.col(ts) < F.lit(end).cast(t))
        uses.append((i, here))
    any_use = functools.reduce(lambda a, b: a | b, [u for _, u in uses])
    taken = F.filter(F.array(*[F.when(u, F.lit(i)) for i, u in uses]), lambda x: x.isNotNull())
    rows = images.where(any_use & F.col(value).isNotNull()).select(*keys, F.explode(taken).alias("_i"), F.col(value).cast("double").alias("_v"))
    counted = rows.groupBy(*keys, "_i", "_v").agg(F.count(F.lit(1)).alias("_c")).repartition(*[F.col(k) for k in keys])
    group = Window.partitionBy(*keys, "_i")
    upto = F.sum("_c").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumns({"_end": upto, "_total": F.sum("_c").over(group)})
    r0, r1 = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    at = lambda r: F.max(F.when((F.col("_end") > r) & (F.col("_end") - F.col("_c") <= r), F.col("_v")))
    per = placed.groupBy(*keys, "_i").agg(at(r0).alias("_lo"), at(r1).alias("_hi"), F.sum(F.col("_v") * F.col("_c")).alias("_s"), F.max("_total").alias("_n"))
    per = per.select(*keys, "_i", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.lit(0.5)).alias("median"), (F.col("_s") / F.col("_n")).alias("mean"))
    return per.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col(r[2]))).alias(r[0]) for i, r in enumerate(recipes)])


def temporal_composite(images: DataFrame, start: str, end: str, how: str = "median", key: str = "pixel_id",
                       value: str = "value", ts: str = "ts", out: str = "value") -> DataFrame:
    """Per-pixel median or mean over observations with ``start <= ts < end``."""
    return composite_bands(images, [(out, "", how, start, end)], [key], None, value, ts)


def stack_bands(bands: Mapping[str, DataFrame], keys: Sequence[str] = ("px_row", "px_col"), value: str = "value") -> DataFrame:
    """One multi-band table from single-band tables: a pixel present in any band is kept, with
    NULL for bands that lack it. One shuffle for any number of bands (union + pivot by name)."""
    keys = list(keys)
    names = list(bands)
    long = None
    for name, df in bands.items():
        part = df.select(*keys, F.lit(name).alias("_band"), F.col(value).cast("double").alias("_v"))
        long = part if long is None else long.unionByName(part)
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("_band") == n, F.col("_v"))).alias(n) for n in names])


def _halo_blocks(px: DataFrame, band: str, reach: int) -> DataFrame:
    """The pixels with ``_v`` (the band), each in its block ``(_br, _bc)`` and as halo in the blocks within ``reach``; pixels without a place have no block."""
    blocks = lambda c: F.explode_outer(F.sequence(F.floor((F.col(c) - reach) / BLOCK), F.floor((F.col(c) + reach) / BLOCK)))
    return px.withColumn("_v", F.col(band).cast("double")).withColumn("_br", blocks("px_row")).withColumn("_bc", blocks("px_col"))


def _neighbour_values(px: DataFrame, band: str, sides: bool = False, radius: int = 0) -> DataFrame:
    """Adds, per pixel, ``_e, _w, _n, _s`` (the band east, west, north and south of it) if ``sides``, and with a ``radius`` ``_cnt, _sum, _sq`` (count, sum and sum of
    squares of the band in the square around it). Missing values are skipped. One exchange."""
    reach = max(radius, 1 if sides else 0)
    names = (["_e", "_w", "_n", "_s"] if sides else []) + (["_cnt", "_sum", "_sq"] if radius else [])
    own = px.columns

    def work(t: pa.Table) -> pa.Table:
        row, col = t.column("px_row").combine_chunks(), t.column("px_col").combine_chunks()
        br, bc = t.column("_br")[0].as_py(), t.column("_bc")[0].as_py()
        if br is None or bc is None:  # no place in the raster
            nulls = pa.nulls(t.num_rows, pa.float64())
            return pa.table([*(t.column(c) for c in own), *(nulls for _ in names)], names=[*own, *names])
        i = row.to_numpy(zero_copy_only=False).astype(np.int64) - (br * BLOCK - reach)
        j = col.to_numpy(zero_copy_only=False).astype(np.int64) - (bc * BLOCK - reach)
        v = t.column("_v").combine_chunks()
        there = v.is_valid().to_numpy(zero_copy_only=False)
        v = v.fill_null(0.0).to_numpy(zero_copy_only=False)
        size = BLOCK + 2 * reach
        mine = (i >= reach) & (i < reach + BLOCK) & (j >= reach) & (j < reach + BLOCK)
        oi, oj = i[mine], j[mine]
        out = []
        if sides:
            known, dense = np.zeros((size, size), bool), np.zeros((size, size))
            known[i[there], j[there]], dense[i[there], j[there]] = True, v[there]
            for di, dj in ((0, 1), (0, -1), (1, 0), (-1, 0)):
                out.append(pa.array(dense[oi + di, oj + dj], mask=~known[oi + di, oj + dj]))
        if radius:
            lo = reach - radius
            for x in (np.ones(int(there.sum())), v[there], v[there] * v[there]):
                a = np.zeros((size, size))
                np.add.at(a, (i[there], j[there]), x)
                across = sum(a[:, lo + k : lo + k + BLOCK] for k in range(2 * radius + 1))
                square = sum(across[lo + k : lo + k + BLOCK] for k in range(2 * radius + 1))
                out.append(pa.array(square[oi - reach, oj - reach]))
        kept = t.filter(pa.array(mine))
        return pa.table([*(kept.column(c) for c in own), *out], names=[*own, *names])

    schema = StructType([*px.schema.fields, *(StructField(n, DoubleType()) for n in names)])
    return _halo_blocks(px, band, reach).groupBy("_br", "_bc").applyInArrow(work, schema)


def _stddev(out: str) -> dict[str, Column]:
    n, s, q = F.col("_cnt"), F.col("_sum"), F.col("_sq")
    return {out: F.when(n > 0, F.sqrt(F.greatest((n * q - s * s) / (n * n), F.lit(0.0))))}


def _gradients(pitch_deg: float) -> dict[str, Column]:
    """East-west and north-south gradients (per metre) from the four direct neighbours."""
    step = math.radians(pitch_deg) * EARTH_RADIUS_M
    return {"_gx": (F.col("_e") - F.col("_w")) / (F.lit(2.0 * step) * F.cos(F.radians("lat"))), "_gy": (F.col("_n") - F.col("_s")) / F.lit(2.0 * step)}


def _slope() -> Column:
    return F.degrees(F.atan(F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy"))))


def _aspect() -> Column:
    flat = (F.col("_gx") == 0) & (F.col("_gy") == 0)
    return F.when(~flat, F.pmod(F.degrees(F.atan2(-F.col("_gx"), -F.col("_gy"))), F.lit(360.0)))


_TEMP = ("_e", "_w", "_n", "_s", "_gx", "_gy", "_cnt", "_sum", "_sq")


def neighbourhood_stddev(px: DataFrame, band: str, radius: int = 3, out: str | None = None) -> DataFrame:
    """Population standard deviation of ``band`` over the (2r+1) x (2r+1) square around each pixel
    (pixels outside the raster or missing are skipped; NULL where none is left). The variance is ``(n*q - s*s) / n^2``.
    """
    return _neighbour_values(px, band, radius=int(radius)).withColumns(_stddev(out or f"{band}_stddev")).drop(*_TEMP)


def terrain_bands(px: DataFrame, band: str = "elevation", pitch_deg: float = 0.01, radius: int = 3) -> DataFrame:
    """``slope``, ``aspect`` and ``terrain_ruggedness`` of each pixel from one pass over the blocks."""
    g = _neighbour_values(px, band, True, int(radius)).withColumns(_gradients(pitch_deg))
    return g.withColumns({"slope": _slope(), "aspect": _aspect(), **_stddev("terrain_ruggedness")}).drop(*_TEMP)


def terrain_slope(px: DataFrame, band: str = "elevation", pitch_deg: float = 0.01, out: str = "slope") -> DataFrame:
    """Slope in degrees from the 4-neighbour gradient; pixels missing a neighbour get NULL."""
    return _neighbour_values(px, band, True).withColumns(_gradients(pitch_deg)).withColumn(out, _slope()).drop(*_TEMP)


def terrain_aspect(px: DataFrame, band: str = "elevation", pitch_deg: float = 0.01, out: str = "aspect") -> DataFrame:
    """Compass direction (0 = north, 90 = east) the slope faces; flat pixels and edges get NULL."""
    return _neighbour_values(px, band, True).withColumns(_gradients(pitch_deg)).withColumn(out, _aspect()).drop(*_TEMP)


def join_disk_pixels(sites: DataFrame, pixels: DataFrame, radius_m: float, zone=None, key: str = "site_id") -> DataFrame:
    """Pairs (site, pixel) with the pixel centre within ``radius_m`` of the site (UTM metres in the
    zone of the sites' mean longitude). Output: site columns, pixel columns, ``distance_m``."""
    if zone is None:
        zone = mean_longitude_zone(sites)
    s = with_utm(sites, zone)
    p = with_utm(pixels, zone, "lon", "lat", "rx", "ry")
    return join_within_radius(s, p, radius_m)


def sites_in_footprint(sites: DataFrame, pixels: DataFrame, radius_m: float, zone=None) -> DataFrame:
    """Sites whose disk reaches at least one pixel centre (left semi join): decided once per place, by occupied squares and exact tests on the rim."""
    if zone is None:
        zone = mean_longitude_zone(sites)
    places = with_utm(sites.select(F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat")).distinct(), zone, "_lon", "_lat", "x", "y")
    p = with_utm(pixels.select("lon", "lat"), zone, "lon", "lat", "rx", "ry").select("rx", "ry")
    hit = places_reached(places, p, radius_m).select("_lon", "_lat")
    return sites.join(hit, (F.col("longitude") == F.col("_lon")) & (F.col("latitude") == F.col("_lat")), "left_semi")


def zonal_stats(sites: DataFrame, pixels: DataFrame, bands: Sequence[str], radius_m: float, key: str = "site_id", zone=None,
                level: int | None = None) -> DataFrame:
    """Mean and sum of each band over the pixels within ``radius_m`` of each site (unweighted), from partial sums (see ``zonal``)."""
    if zone is None:
        zone = mean_longitude_zone(sites)
    s = with_utm(sites.select(key, "longitude", "latitude"), zone).select(key, "x", "y")
    p = with_utm(pixels.select("lon", "lat", *bands), zone, "lon", "lat", "rx", "ry").select("rx", "ry", *bands)
    return disk_sums(s, p, bands, radius_m, key, level)
