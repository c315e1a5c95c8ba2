"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.screening import has_evidence
from ..operators import tables as T
from ..plans import ranking as R
from ..plans.screening import filter_low_quantile, stratified_screening
from ..sources.files import bbox_filter, bbox_overlaps
from ..sources.fixtures import fixture, layer_frame
from . import chain as C
from . import register
from .common import fx_prepared, fx_tiered

MY = K.REGION_BOUNDS["Malaysia"]
SG = K.REGION_BOUNDS["Singapore"]
PREP = C.fx_prepared()
APPROVED = f"COALESCE(contains(confidence_tier, '{K.APPROVED_MARKER}'), false)"


@register("filter_mcc_bbox", C.render(["fx_antennas"], [], f"""SELECT * FROM fx_antennas
    WHERE mcc IN {tuple(K.MCC_CODES)} AND longitude >= {MY[0]} AND longitude <= {MY[2]} AND latitude >= {MY[1]} AND latitude <= {MY[3]}"""))
def filter_mcc_bbox(spark, sf_dir):
    a = fixture(spark, sf_dir, "fx_antennas")
    return a.where(F.col("mcc").isin(*K.MCC_CODES) & bbox_filter("longitude", "latitude", MY))


@register("filter_bbox_overlap", C.render(["fx_roads"], [], f"""SELECT 'roads:' || CAST(feature_id AS VARCHAR) AS id, class FROM (
  SELECT feature_id, class, min(least(lon1, lon2)) AS xmin, max(greatest(lon1, lon2)) AS xmax,
         min(least(lat1, lat2)) AS ymin, max(greatest(lat1, lat2)) AS ymax FROM fx_roads GROUP BY feature_id, class) b
WHERE xmax >= {SG[0]} AND xmin <= {SG[2]} AND ymax >= {SG[1]} AND ymin <= {SG[3]}"""))
def filter_bbox_overlap(spark, sf_dir):
    return layer_frame(spark, sf_dir, "roads").where(bbox_overlaps("bbox", SG)).select("id", "class")


@register("evidence_filter", C.render(["fx_tiles"], [], f"SELECT * FROM fx_tiles WHERE {C.EVIDENCE}"))
def evidence_filter(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_tiles").where(has_evidence())


@register("evidence_guard", C.render(["fx_tiles"], [("thin", "SELECT * FROM fx_tiles WHERE tests < 15")] + C.screening("thin", "g"),
                                     "SELECT * FROM g"))
def evidence_guard(spark, sf_dir):
    """Screening of tiles that all lack evidence: NULL stratum, nothing flagged."""
    return stratified_screening(fixture(spark, sf_dir, "fx_tiles").where(F.col("tests") < K.MIN_TESTS))


@register("target_filter", C.render(["fx_matrix"], PREP, "SELECT * FROM m_prep WHERE is_underserved_target"))
def target_filter(spark, sf_dir):
    return fx_prepared(spark, sf_dir).where(F.col("is_underserved_target"))


@register("split_by_tier", C.render(["fx_matrix"], PREP + C.tier("m_prep", "m_t"),
                                    f"SELECT *, CASE WHEN {APPROVED} THEN 'approved' ELSE 'rest' END AS part FROM m_t"))
def split_by_tier(spark, sf_dir):
    a, b = R.split_by_tier(fx_tiered(spark, sf_dir))
    return a.withColumn("part", F.lit("approved")).unionByName(b.withColumn("part", F.lit("rest")))


@register("filter_approved_exact", C.render(["fx_matrix"], PREP + C.tier("m_prep", "m_t"),
                                            f"SELECT * FROM m_t WHERE confidence_tier = '{K.TIER_APPROVED}'"))
def filter_approved_exact(spark, sf_dir):
    return R.approved_sites(fx_tiered(spark, sf_dir))


def _rename_sql(renames, drops, fill_solar):
    src_cols = ["site_id", "elevation_mean", "elevation_sum", "slope_mean", "aspect_mean", "terrain_ruggedness_mean", "rainfall_mean",
                "night_radiance_mean", "population_sum", "solar_radiation_mean", "tree_canopy_mean"]
    ren = dict(renames)
    sel = []
    for c in src_cols:
        n = ren.get(c, c)
        if n in drops:
            continue
        sel.append(f"{c} AS {n}")
    raw = "solar_radiation_mean"
    solar = f"{raw} / {C.d(K.J_PER_MJ)}"
    if fill_solar:
        solar = f"COALESCE({solar}, 0.0::DOUBLE)"
    sel.append(f"{solar} AS solar_radiation_mj")
    return C.render(["fx_env"], [], f"SELECT {', '.join(sel)} FROM fx_env")


@register("rename_scale_zonal", _rename_sql(K.ZONAL_RENAMES, K.ZONAL_DROPS, True))
def rename_scale_zonal(spark, sf_dir):
    return T.rename_scale_zonal(fixture(spark, sf_dir, "fx_env"))


@register("rename_zonal_v1", _rename_sql(K.ZONAL_RENAMES_V1, K.ZONAL_DROPS_V1, False))
def rename_zonal_v1(spark, sf_dir):
    return T.rename_zonal_v1(fixture(spark, sf_dir, "fx_env"))


_IMP = C.impute("fx_matrix", "imp", C.FX_MATRIX_COLUMNS)


@register("impute_domain", C.render(["fx_matrix"], _IMP, "SELECT * FROM imp"))
def impute_domain(spark, sf_dir):
    return T.impute_domain(fixture(spark, sf_dir, "fx_matrix"))


@register("engineer_features", C.render(["fx_matrix"], _IMP + C.engineer("imp", "eng"), "SELECT * FROM eng"))
def engineer_features(spark, sf_dir):
    return T.engineer_features(T.impute_domain(fixture(spark, sf_dir, "fx_matrix")))


@register("select_features", C.render(["fx_matrix"], _IMP + C.engineer("imp", "eng"),
                                      f"SELECT site_id, {', '.join(K.MODEL_FEATURES)}, {K.TARGET} FROM eng"))
def select_features(spark, sf_dir):
    df = T.engineer_features(T.impute_domain(fixture(spark, sf_dir, "fx_matrix")))
    feats, target = T.select_features(df)
    return df.select("site_id", *feats, target)


_DRIVER = "'distance_to_road_m' AS top_shap_driver, distance_to_road_m AS top_shap_value"


@register("mask_drivers", C.render(["fx_matrix"], PREP + C.tier("m_prep", "m_t"), f"""SELECT site_id, confidence_tier,
    CASE WHEN COALESCE(contains(confidence_tier, 'Sufficient'), false) THEN 'distance_to_road_m' END AS top_shap_driver,
    CASE WHEN COALESCE(contains(confidence_tier, 'Sufficient'), false) THEN distance_to_road_m END AS top_shap_value FROM m_t"""))
def mask_drivers(spark, sf_dir):
    """Driver columns here are a stand-in (road distance) so the mask can be checked without a model."""
    t = fx_tiered(spark, sf_dir).select("site_id", "confidence_tier", F.lit("distance_to_road_m").alias("top_shap_driver"),
                                        F.col("distance_to_road_m").alias("top_shap_value"))
    return R.mask_drivers(t)


@register("status_columns", C.render(["fx_matrix"], PREP + C.tier("m_prep", "m_t"), f"""SELECT site_id, confidence_tier,
    '{K.INFERENCE_STATUS}' AS inference_status, {APPROVED} AS field_survey_triggered FROM m_t"""))
def status_columns(spark, sf_dir):
    return R.status_columns(fx_tiered(spark, sf_dir).select("site_id", "confidence_tier"))


@register("cast_key_string", "SELECT CAST(c_custkey AS VARCHAR) AS site_id, c_name FROM customer")
def cast_key_string(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("site_id"), "c_name")
    return T.cast_key_string(c)


@register("filter_low_quartile", C.render(["fx_tiles"], [], f"""SELECT * FROM fx_tiles
    WHERE download_kbps <= (SELECT quantile_cont(CAST(download_kbps AS DOUBLE), {C.d(K.LOW_QUARTILE)}) FROM fx_tiles)"""))
def filter_low_quartile(spark, sf_dir):
    return filter_low_quantile(fixture(spark, sf_dir, "fx_tiles"))
