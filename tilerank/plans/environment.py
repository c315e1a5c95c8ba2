"""Environment of sites from images: composites per band, terrain bands, zonal statistics.

Images are rows ``(px_row, px_col, band, ts, value)`` on one grid; a band that never changes (elevation, tree cover) has images too, of any time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.raster import composite_bands, terrain_bands, zonal_stats


@dataclass(frozen=True)
class Grid:
    """Pixel ``(px_row, px_col)`` is centred at ``(lon0 + (px_col + 0.5) * pitch, lat0 + (px_row + 0.5) * pitch)`` degrees."""

    lon0: float = 0.0
    lat0: float = 0.0
    pitch: float = 0.01


def environment_bands(images: DataFrame, grid: Grid = Grid(), recipes: Sequence = K.ENVIRONMENT_RECIPES, radius: int = 3) -> DataFrame:
    """``px_row, px_col, lon, lat`` and a column per band: the composites of ``recipes`` and slope, aspect and ruggedness of their ``elevation``.

    Three exchanges in all: two for the composites of all bands, one for the three terrain bands. A pixel that has no image at all is absent; a band without
    images there is NULL.
    """
    px = composite_bands(images, recipes)
    px = px.withColumns({"lon": F.lit(grid.lon0) + (F.col("px_col") + F.lit(0.5)) * F.lit(grid.pitch), "lat": F.lit(grid.lat0) + (F.col("px_row") + F.lit(0.5)) * F.lit(grid.pitch)})
    return terrain_bands(px, "elevation", grid.pitch, radius)


def environment_of(sites: DataFrame, images: DataFrame, grid: Grid = Grid(), radius_m: float = K.BUFFER_RADIUS_M, key: str = "site_id") -> DataFrame:
    """``key`` and ``{band}_mean, {band}_sum`` of every band around each site; sites without a pixel centre in reach are absent."""
    bands = environment_bands(images, grid)
    names = [c for c in bands.columns if c not in ("px_row", "px_col", "lon", "lat")]
    return zonal_stats(sites, bands, names, radius_m, key)
