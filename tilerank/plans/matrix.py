"""Master matrix: tiles clipped to a country, nearest tower, zonal statistics, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import mean_longitude_zone, with_utm
from ..operators.spatial import join_within_polygon, nearest_feature
from ..operators.tables import dedupe_rows, merge_env, rename_scale_zonal
from ..session import cut_lineage, store
from .environment import Grid, environment_of

TOWER_CARRY = ("distance_to_power_m", "distance_to_road_m", "distance_to_amenity_m", "distance_to_tier1_hub_m",
               "antenna_count", "antennas_4G", "antennas_3G", "antennas_2G", "antennas_5G")


def inside_region(tiles: DataFrame, edges: DataFrame, region: str, feature: str = "country", identity: str = "objectid") -> DataFrame:
    """Tiles strictly inside the region's features, told apart by name and ``identity`` (where the table has it):
    a tile in two features of the region comes twice."""
    # names of their own, so a tile column called like a feature column keeps its values
    keys = {c: f"_feature_{c}" for c in (feature, identity) if c in edges.columns}
    own = edges.where(F.col(feature) == region).withColumnsRenamed(keys)
    return join_within_polygon(tiles, own, feature=list(keys.values())).drop(*keys.values())


def clip_to_region(tiles: DataFrame, edges: DataFrame, region: str, feature: str = "country", identity: str = "objectid") -> DataFrame:
    """:func:`inside_region`; a region with no polygon in a table that has some keeps the box result.

    A boundary table without any edge is an error: clipping to nothing would silently keep every tile.
    """
    if edges.where(F.col(feature) == region).isEmpty():
        if edges.isEmpty():
            raise ValueError("the boundary table holds no edge")
        return tiles
    return inside_region(tiles, edges, region, feature, identity)


def nearest_tower(tiles: DataFrame, towers: DataFrame, carry: Sequence[str] = TOWER_CARRY, key: str = "site_id") -> DataFrame:
    """Every (de-duplicated) tile with the distance to its nearest tower and that tower's columns.

    Distances are UTM metres in the zone of the tiles' mean longitude; ties go to the smallest
    ``cluster_id``.
    """
    carry = [c for c in carry if c in towers.columns]
    tiles = store(dedupe_rows(tiles))
    zone = mean_longitude_zone(tiles)
    tp = with_utm(tiles.select(key, "longitude", "latitude"), zone)
    wp = with_utm(towers, zone, x="x1", y="y1").withColumns({"x2": F.col("x1"), "y2": F.col("y1")})
    near = nearest_feature(tp.select(key, "x", "y"), wp.select("cluster_id", "x1", "y1", "x2", "y2", *carry), key, "cluster_id",
                           carry, dist_col="distance_to_nearest_tower")
    return tiles.join(near, key, "left")


def build_master_matrix(tiles: DataFrame, towers: DataFrame, env: DataFrame | None, edges: DataFrame | None, region: str,
                        images: DataFrame | None = None, grid: Grid = Grid()) -> DataFrame:
    """Clip -> nearest tower -> zonal statistics -> merge -> renames and unit scaling.

    The statistics are a finished table ``env``, or are computed from ``images`` around the clipped tiles.
    """
    if (env is None) == (images is None):
        raise ValueError("give either the zonal statistics or the images")
    clipped = clip_to_region(tiles, edges, region) if edges is not None else tiles
    prox = nearest_tower(clipped, towers)
    if images is not None:
        env = cut_lineage(environment_of(prox.select("site_id", "longitude", "latitude").distinct(), images, grid))
    return rename_scale_zonal(merge_env(prox, env))
