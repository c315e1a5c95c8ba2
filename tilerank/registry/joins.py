"""Joins: spatial joins as cell equi-joins, equi, left and semi joins.
Oracles are brute force over all pairs (DuckDB), which is what the cell joins must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import spatial as SP
from ..operators.tables import merge_env as merge_op
from ..plans.screening import stratified_screening, threshold_lookup as lookup
from ..plans.screening import stratum_thresholds
from ..functions.screening import has_evidence
from ..sources.fixtures import fixture
from . import chain as C
from . import register
from .sqltext import utm_sql, zone_sql


def _within_sql(points: str, key_cols: str) -> str:
    return f"""
SELECT {key_cols}, e.country FROM {points} p JOIN fx_countries e ON true
GROUP BY {key_cols}, e.country
HAVING sum(CASE WHEN (e.lat1 > p.latitude) <> (e.lat2 > p.latitude)
                 AND e.lon1 + (p.latitude - e.lat1) * (e.lon2 - e.lon1) / (e.lat2 - e.lat1) > p.longitude THEN 1 ELSE 0 END) % 2 = 1
   AND max(CASE WHEN (p.longitude - e.lon1) * (e.lat2 - e.lat1) = (p.latitude - e.lat1) * (e.lon2 - e.lon1)
                 AND p.longitude BETWEEN least(e.lon1, e.lon2) AND greatest(e.lon1, e.lon2)
                 AND p.latitude BETWEEN least(e.lat1, e.lat2) AND greatest(e.lat1, e.lat2) THEN 1 ELSE 0 END) = 0"""


@register("join_within_polygon", C.render(["fx_tiles", "fx_countries"], [], _within_sql("fx_tiles", "p.site_id")))
def join_within_polygon(spark, sf_dir):
    t = fixture(spark, sf_dir, "fx_tiles")
    e = fixture(spark, sf_dir, "fx_countries")
    return SP.join_within_polygon(t, e).select("site_id", "country")


@register("clip_within", C.render(["fx_tiles", "fx_countries"], [], f"""
SELECT t.* FROM fx_tiles t JOIN ({_within_sql("fx_tiles", "p.site_id")}) w ON t.site_id = w.site_id WHERE w.country = 'COUNTRY_7'"""))
def clip_within(spark, sf_dir):
    from ..plans.matrix import clip_to_region

    return clip_to_region(fixture(spark, sf_dir, "fx_tiles"), fixture(spark, sf_dir, "fx_countries"), "COUNTRY_7")


_TWO = """SELECT country, CAST(1 AS BIGINT) AS objectid, lon1, lat1, lon2, lat2 FROM fx_countries
UNION ALL SELECT country, CAST(2 AS BIGINT) AS objectid, lon1 + 0.25e0, lat1 + 0.125e0, lon2 + 0.25e0, lat2 + 0.125e0 FROM fx_countries"""


@register("clip_overlapping_features", C.render(["fx_tiles", "fx_countries"], [("two", _TWO)], f"""
SELECT t.* FROM fx_tiles t JOIN (
{_within_sql("fx_tiles", "p.site_id").replace("fx_countries", "two").replace("e.country", "e.country, e.objectid")}) w
ON t.site_id = w.site_id WHERE w.country = 'COUNTRY_7'"""))
def clip_overlapping_features(spark, sf_dir):
    """The clip with two overlapping features per country: a tile in both comes twice."""
    from ..plans.matrix import clip_to_region

    e = fixture(spark, sf_dir, "fx_countries").select("country", "lon1", "lat1", "lon2", "lat2")
    moved = e.withColumns({"lon1": F.col("lon1") + 0.25, "lat1": F.col("lat1") + 0.125, "lon2": F.col("lon2") + 0.25, "lat2": F.col("lat2") + 0.125})
    two = e.withColumn("objectid", F.lit(1)).unionByName(moved.withColumn("objectid", F.lit(2)))
    return clip_to_region(fixture(spark, sf_dir, "fx_tiles"), two, "COUNTRY_7")


# --- nearest tower -----------------------------------------------------------
_TOWER_COLS = ["distance_to_power_m", "distance_to_road_m", "distance_to_amenity_m", "distance_to_tier1_hub_m",
               "antenna_count", "antennas_4G", "antennas_3G", "antennas_2G", "antennas_5G"]
_TX, _TY = utm_sql("longitude", "latitude", "(SELECT zone FROM z)")


def nearest_tower_ctes(tiles: str = "fx_tiles") -> list[tuple[str, str]]:
    """CTEs ending in ``nt(site_id, distance_to_nearest_tower, cluster_id, tower columns...)`` (brute force)."""
    carry = ", ".join(f"w.{c} AS {c}" for c in _TOWER_COLS)
    return [
        ("z", f"SELECT {zone_sql(tiles)} AS zone"),
        ("tp", f"SELECT site_id, {_TX} AS x, {_TY} AS y FROM {tiles}"),
        ("wp", f"SELECT *, {_TX} AS x, {_TY} AS y FROM fx_towers"),
        ("best", f"""SELECT t.site_id, min({{'d': sqrt((w.x - t.x) * (w.x - t.x) + (w.y - t.y) * (w.y - t.y)), 'k': w.cluster_id}}) AS b
            FROM tp t, wp w GROUP BY t.site_id"""),
        ("nt", f"""SELECT b.site_id, round(b.b.d, 3) AS distance_to_nearest_tower, b.b.k AS cluster_id, {carry}
            FROM best b JOIN fx_towers w ON w.cluster_id = b.b.k"""),
    ]


def _nearest_tower_sql() -> str:
    return C.render(["fx_tiles", "fx_antennas", "fx_towers"], nearest_tower_ctes(), "SELECT * FROM nt")


@register("nearest_tower", _nearest_tower_sql())
def nearest_tower(spark, sf_dir):
    """Nearest tower of every tile (exact, multi-level grid), with the tower's attributes."""
    from ..plans.matrix import nearest_tower as nt

    t = fixture(spark, sf_dir, "fx_tiles").select("site_id", "longitude", "latitude")
    w = fixture(spark, sf_dir, "fx_towers")
    out = nt(t, w, carry=_TOWER_COLS)
    return out.select("site_id", F.round("distance_to_nearest_tower", 3).alias("distance_to_nearest_tower"), "cluster_id", *_TOWER_COLS)


# --- nearest infrastructure per layer ---------------------------------------
def _layer_sql(fx: str, kind: str, where: str) -> tuple[str, str]:
    if kind == "seg":
        x1, y1 = utm_sql("lon1", "lat1", "(SELECT zone FROM z)")
        x2, y2 = utm_sql("lon2", "lat2", "(SELECT zone FROM z)")
        return f"SELECT feature_id, {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM {fx} WHERE {where}", "seg"
    x, y = utm_sql("lon", "lat", "(SELECT zone FROM z)")
    return f"SELECT feature_id, {x} AS x1, {y} AS y1, {x} AS x2, {y} AS y2 FROM {fx} WHERE {where}", "pt"


_LAYER_SPECS = {
    "power": ("fx_power", "seg", "class = 'power_line'"),
    "roads": ("fx_roads", "seg", "class IN ('primary', 'secondary', 'tertiary', 'trunk')"),
    "amenities": ("fx_amenities", "pt", "category IN ('school', 'hospital', 'clinic')"),
    "tier1_hubs": ("fx_hubs", "pt", "subtype = 'locality'"),
}


def _nearest_feature_sql(layers: list[str]) -> str:
    from .sqltext import seg_dist_sql

    ctes = [("z", f"SELECT {zone_sql('fx_towers')} AS zone"),
            ("sp", f"SELECT cluster_id, {_TX} AS x, {_TY} AS y FROM fx_towers")]
    cols = []
    joins = []
    for lay in layers:
        fx, kind, where = _LAYER_SPECS[lay]
        body, _ = _layer_sql(fx, kind, where)
        ctes.append((f"l_{lay}", body))
        name = K.LAYERS[lay][0]
        ctes.append((f"d_{lay}", f"""SELECT s.cluster_id, min({seg_dist_sql('s.x', 's.y', 'l.x1', 'l.y1', 'l.x2', 'l.y2')}) AS d
            FROM sp s, l_{lay} l GROUP BY s.cluster_id"""))
        cols.append(f"round(d_{lay}.d, 3) AS distance_to_{name}_m")
        joins.append(f"LEFT JOIN d_{lay} ON d_{lay}.cluster_id = sp.cluster_id")
    fixtures = ["fx_antennas", "fx_towers"] + sorted({_LAYER_SPECS[lay][0] for lay in layers})
    return C.render(fixtures, ctes, f"SELECT sp.cluster_id, {', '.join(cols)} FROM sp {' '.join(joins)}")


@register("nearest_feature", _nearest_feature_sql(["roads"]))
def nearest_feature(spark, sf_dir):
    """Distance from every tower to the nearest major-road segment."""
    from ..plans.towers import nearest_all_layers
    from ..plans.towers import layer_tables_from_fixtures

    w = fixture(spark, sf_dir, "fx_towers").select("cluster_id", "longitude", "latitude")
    out = nearest_all_layers(w, layer_tables_from_fixtures(spark, sf_dir, ["roads"]))
    return out.select("cluster_id", F.round("distance_to_road_m", 3).alias("distance_to_road_m"))


@register("nearest_all_layers", _nearest_feature_sql(["power", "roads", "amenities", "tier1_hubs"]))
def nearest_all_layers(spark, sf_dir):
    from ..plans.towers import layer_tables_from_fixtures
    from ..plans.towers import nearest_all_layers as nal

    w = fixture(spark, sf_dir, "fx_towers").select("cluster_id", "longitude", "latitude")
    out = nal(w, layer_tables_from_fixtures(spark, sf_dir, ["power", "roads", "amenities", "tier1_hubs"]))
    return out.select("cluster_id", *[F.round(f"distance_to_{K.LAYERS[l][0]}_m", 3).alias(f"distance_to_{K.LAYERS[l][0]}_m")
                                      for l in ("power", "roads", "amenities", "tier1_hubs")])


@register("merge_env", C.render(["fx_tiles", "fx_env"], [], "SELECT * FROM fx_tiles t JOIN fx_env e USING (site_id)"))
def merge_env(spark, sf_dir):
    return merge_op(fixture(spark, sf_dir, "fx_tiles"), fixture(spark, sf_dir, "fx_env"))


@register("threshold_lookup", C.render(["fx_tiles"], C.screening("fx_tiles", "ts"), """SELECT s.site_id, s.demographic_stratum,
    COALESCE(h.thr, 0.0::DOUBLE) AS threshold FROM ts_strat s LEFT JOIN ts_thr h ON s.demographic_stratum = h.demographic_stratum"""))
def threshold_lookup(spark, sf_dir):
    s = stratified_screening(fixture(spark, sf_dir, "fx_tiles"))
    thr = stratum_thresholds(s.where(has_evidence()))
    return lookup(s.select("site_id", "demographic_stratum"), thr)
