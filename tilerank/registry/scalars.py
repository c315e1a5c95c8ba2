"""Scalar and row functions; geometry outputs are rounded (metres to 1e-3,
degrees to 1e-7) because transcendental functions differ in the last digits between engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import geo as G
from ..functions import scoring as S
from ..functions.screening import spatial_block as block_cols
from ..plans.screening import stratified_screening
from ..sources.fixtures import fixture, read_table
from . import chain as C
from . import register
from .common import fx_scored, fx_tiered
from .sqltext import seg_dist_sql, unutm_sql, utm_sql, zone_sql

PREP = C.fx_prepared()
SCORED = PREP + C.tier("m_prep", "m_t") + [("m_a", f"SELECT * FROM m_t WHERE COALESCE(contains(confidence_tier, '{K.APPROVED_MARKER}'), false)")] \
    + C.score("m_a", "m_s")

X, Y = utm_sql("longitude", "latitude", "z.zone")


@register("project_utm", C.render(["fx_tiles"], [("z", f"SELECT {zone_sql('fx_tiles')} AS zone")],
                                  f"SELECT site_id, round({X}, 3) AS x, round({Y}, 3) AS y FROM fx_tiles CROSS JOIN z"))
def project_utm(spark, sf_dir):
    t = fixture(spark, sf_dir, "fx_tiles")
    p = G.with_utm(t, G.mean_longitude_zone(t))
    return p.select("site_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


_LON, _LAT = unutm_sql(f"({X})", f"({Y})", "z.zone")


@register("unproject_utm", C.render(["fx_tiles"], [("z", f"SELECT {zone_sql('fx_tiles')} AS zone")],
                                    f"SELECT site_id, round({_LON}, 7) AS longitude, round({_LAT}, 7) AS latitude FROM fx_tiles CROSS JOIN z"))
def unproject_utm(spark, sf_dir):
    t = fixture(spark, sf_dir, "fx_tiles")
    zone = G.mean_longitude_zone(t)
    back = G.with_lonlat(G.with_utm(t, zone).select("site_id", "x", "y"), zone)
    return back.select("site_id", F.round("longitude", 7).alias("longitude"), F.round("latitude", 7).alias("latitude"))


_AX, _AY = utm_sql("a.lon", "a.lat", "z.zone")
_TX, _TY = utm_sql("t.longitude", "t.latitude", "z.zone")


@register("point_distance", C.render(["fx_tiles", "fx_amenities"], [("z", f"SELECT {zone_sql('fx_tiles')} AS zone")], f"""
SELECT t.site_id, a.feature_id, round(sqrt((({_AX}) - ({_TX})) * (({_AX}) - ({_TX})) + (({_AY}) - ({_TY})) * (({_AY}) - ({_TY}))), 3) AS distance_m
FROM fx_tiles t JOIN orders o ON t.site_id = lpad(CAST(o.o_orderkey AS VARCHAR), 16, '0')
JOIN fx_amenities a ON a.feature_id = o.o_custkey CROSS JOIN z"""))
def point_distance(spark, sf_dir):
    """Distance (UTM metres) from each order's tile to its customer's amenity point."""
    t = fixture(spark, sf_dir, "fx_tiles")
    o = read_table(spark, sf_dir, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 16, "0").alias("site_id"), "o_custkey")
    a = fixture(spark, sf_dir, "fx_amenities")
    zone = G.mean_longitude_zone(t)
    t = G.with_utm(t, zone, x="tx", y="ty")
    a = G.with_utm(a, zone, "lon", "lat", "ax", "ay")
    j = t.join(o, "site_id").join(a, F.col("o_custkey") == F.col("feature_id"))
    return j.select("site_id", "feature_id", F.round(G.point_distance("tx", "ty", "ax", "ay"), 3).alias("distance_m"))


_R1X, _R1Y = utm_sql("r.lon1", "r.lat1", "z.zone")
_R2X, _R2Y = utm_sql("r.lon2", "r.lat2", "z.zone")


@register("point_segment_distance", C.render(["fx_tiles", "fx_roads"], [("z", f"SELECT {zone_sql('fx_tiles')} AS zone")], f"""
SELECT l.l_orderkey, l.l_linenumber, t.site_id, r.feature_id, r.seg,
       round({seg_dist_sql(f'({_TX})', f'({_TY})', f'({_R1X})', f'({_R1Y})', f'({_R2X})', f'({_R2Y})')}, 3) AS distance_m
FROM lineitem l JOIN fx_tiles t ON t.site_id = lpad(CAST(l.l_orderkey AS VARCHAR), 16, '0')
JOIN fx_roads r ON r.feature_id = l.l_partkey AND r.seg = l.l_linenumber % 3 CROSS JOIN z"""))
def point_segment_distance(spark, sf_dir):
    """Distance (UTM metres) from each line item's order tile to one segment of its part's road."""
    t = fixture(spark, sf_dir, "fx_tiles")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lpad(F.col("l_orderkey").cast("string"), 16, "0").alias("site_id"))
    r = fixture(spark, sf_dir, "fx_roads")
    zone = G.mean_longitude_zone(t)
    t = G.with_utm(t, zone, x="tx", y="ty")
    r = G.with_utm(G.with_utm(r, zone, "lon1", "lat1", "x1", "y1"), zone, "lon2", "lat2", "x2", "y2")
    j = li.join(t, "site_id").join(r, (F.col("feature_id") == F.col("l_partkey")) & (F.col("seg") == F.col("l_linenumber") % 3))
    return j.select("l_orderkey", "l_linenumber", "site_id", "feature_id", "seg",
                    F.round(G.point_segment_distance("tx", "ty", "x1", "y1", "x2", "y2"), 3).alias("distance_m"))


_TS = C.screening("fx_tiles", "ts")


@register("assign_stratum", C.render(["fx_tiles"], _TS, "SELECT site_id, demographic_stratum FROM ts"))
def assign_stratum(spark, sf_dir):
    return stratified_screening(fixture(spark, sf_dir, "fx_tiles")).select("site_id", "demographic_stratum")


@register("flag_underserved", C.render(["fx_tiles"], _TS, "SELECT site_id, is_underserved_target FROM ts"))
def flag_underserved(spark, sf_dir):
    return stratified_screening(fixture(spark, sf_dir, "fx_tiles")).select("site_id", "is_underserved_target")


@register("spatial_block", C.render(["fx_tiles"], C.spatial_block("fx_tiles", "b"), "SELECT site_id, lat_block, lon_block, spatial_block FROM b"))
def spatial_block(spark, sf_dir):
    lat_b, lon_b, blk = block_cols()
    return fixture(spark, sf_dir, "fx_tiles").select("site_id", lat_b.alias("lat_block"), lon_b.alias("lon_block"), blk.alias("spatial_block"))


def _score_key(key: str, cols: list[str]):
    register(key, C.render(["fx_matrix"], SCORED, f"SELECT site_id, {', '.join(cols)} FROM m_s"))(
        lambda spark, sf_dir: fx_scored(spark, sf_dir).select("site_id", *cols))


_score_key("off_grid_likelihood", ["off_grid_likelihood"])
_score_key("solar_viability", ["solar_viability"])
_score_key("logistics_difficulty", ["logistics_difficulty"])
_score_key("abatement_tco2e", ["indicative_abatement_tco2e_yr"])
_score_key("opex_saving", ["indicative_opex_saving_usd"])
_score_key("underperformance_residual", ["underperformance_residual"])
_score_key("essential_service_weight", ["essential_service_weight"])
_score_key("priority_score", ["priority_score"])
_score_key("people_per_tonne", ["people_connected_per_tonne_co2"])


@register("aspect_score", C.render(["fx_matrix"], SCORED, f"SELECT site_id, {C.aspect_sql()} AS aspect_score FROM m_s"))
def aspect_score(spark, sf_dir):
    return fx_scored(spark, sf_dir).select("site_id", S.aspect_score().alias("aspect_score"))


@register("confidence_tier", C.render(["fx_matrix"], PREP + C.tier("m_prep", "m_t"), "SELECT site_id, confidence_tier FROM m_t"))
def confidence_tier(spark, sf_dir):
    return fx_tiered(spark, sf_dir).select("site_id", "confidence_tier")


@register("rescore_weights", C.render(["fx_matrix"], SCORED, f"""SELECT site_id,
    {C.raw_sql(C.logistics_sql(K.LOGISTICS_WEIGHTS))} AS baseline_score,
    {C.raw_sql(C.logistics_sql(K.ALT_LOGISTICS_WEIGHTS))} AS scenario_b_score FROM m_s"""))
def rescore_weights(spark, sf_dir):
    s = fx_scored(spark, sf_dir)
    return s.select("site_id", S.rescore_weights(*K.LOGISTICS_WEIGHTS).alias("baseline_score"),
                    S.rescore_weights(*K.ALT_LOGISTICS_WEIGHTS).alias("scenario_b_score"))
