"""Window-like operators, sorts, limits, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scoring as S
from ..operators.rank import global_row_number, sample_rows
from ..operators.tables import union_scored_unscored as union_op
from ..plans import ranking as R
from ..sources.fixtures import fixture
from . import chain as C
from . import register
from .common import fx_prepared, fx_scored, fx_tiered

PREP = C.fx_prepared()
RANKED = PREP + C.govern_score_rank("m_prep", "rk")
SCORED = PREP + C.tier("m_prep", "m_t") + [("m_a", f"SELECT * FROM m_t WHERE COALESCE(contains(confidence_tier, '{K.APPROVED_MARKER}'), false)")] \
    + C.score("m_a", "m_s")


def fx_ranked(spark, sf_dir):
    return R.govern_score_rank(fx_prepared(spark, sf_dir))


@register("national_rank", C.render(["fx_matrix"], RANKED,
                                    "SELECT site_id, field_survey_triggered, priority_score, confidence_tier, national_rank FROM rk"))
def national_rank(spark, sf_dir):
    return fx_ranked(spark, sf_dir).select("site_id", "field_survey_triggered", "priority_score", "confidence_tier", "national_rank")


_BASE = C.raw_sql(C.logistics_sql(K.LOGISTICS_WEIGHTS))
_ALT = C.raw_sql(C.logistics_sql(K.ALT_LOGISTICS_WEIGHTS))


@register("top_k_sites", C.render(["fx_matrix"], SCORED, f"""SELECT site_id, baseline_score FROM (SELECT site_id, {_BASE} AS baseline_score FROM m_s) s
    WHERE baseline_score IS NOT NULL ORDER BY baseline_score DESC, site_id LIMIT {K.TOP_K}"""))
def top_k_sites(spark, sf_dir):
    s = fx_scored(spark, sf_dir).withColumn("baseline_score", S.rescore_weights(*K.LOGISTICS_WEIGHTS))
    return R.top_k(s, "baseline_score", K.TOP_K).select("site_id", "baseline_score")


@register("top5_preview", C.render(["fx_matrix"], RANKED, """SELECT national_rank, priority_score, people_connected_per_tonne_co2, confidence_tier
    FROM rk ORDER BY national_rank LIMIT 5"""))
def top5_preview(spark, sf_dir):
    r = fx_ranked(spark, sf_dir)
    cols = [c for c in ("national_rank", "priority_score", "people_connected_per_tonne_co2", "confidence_tier") if c in r.columns]
    return r.orderBy("national_rank").limit(5).select(*cols)


_SAMPLE = C.render(["fx_tiles"], [], f"SELECT * FROM fx_tiles ORDER BY md5(site_id || '|{K.SEED}'), site_id LIMIT 20")


@register("sample_sites", _SAMPLE)
def sample_sites(spark, sf_dir):
    return sample_rows(fixture(spark, sf_dir, "fx_tiles"), 20, K.SEED)


@register("synthetic_row_id", C.render(["fx_tiles"], [], f"""SELECT site_id, CAST(row_number() OVER (ORDER BY md5(site_id || '|{K.SEED}'), site_id) - 1 AS BIGINT) AS row_id
    FROM (SELECT * FROM fx_tiles ORDER BY md5(site_id || '|{K.SEED}'), site_id LIMIT 20) s"""))
def synthetic_row_id(spark, sf_dir):
    """Sequential 0-based id over the seeded sample, in sample order."""
    s = sample_rows(fixture(spark, sf_dir, "fx_tiles"), 20, K.SEED).withColumn("_h", F.md5(F.concat("site_id", F.lit(f"|{K.SEED}"))))
    n = global_row_number(s, [F.col("_h"), F.col("site_id")], "row_id")
    return n.select("site_id", (F.col("row_id") - 1).alias("row_id"))


@register("union_scored_unscored", C.render(["fx_matrix"], SCORED, f"""SELECT site_id, confidence_tier, priority_score, off_grid_likelihood FROM (
    SELECT * FROM m_s UNION ALL BY NAME SELECT * FROM m_t WHERE NOT COALESCE(contains(confidence_tier, '{K.APPROVED_MARKER}'), false)) u"""))
def union_scored_unscored(spark, sf_dir):
    t = fx_tiered(spark, sf_dir)
    _, rest = R.split_by_tier(t)
    return union_op(fx_scored(spark, sf_dir), rest).select("site_id", "confidence_tier", "priority_score", "off_grid_likelihood")


def _overlap_sql(src_ctes, src):
    return C.render(["fx_matrix"], src_ctes + [
        ("b1", f"SELECT site_id FROM (SELECT site_id, {_BASE} AS s FROM {src}) x WHERE s IS NOT NULL ORDER BY s DESC, site_id LIMIT {K.TOP_K}"),
        ("b2", f"SELECT site_id FROM (SELECT site_id, {_ALT} AS s FROM {src}) x WHERE s IS NOT NULL ORDER BY s DESC, site_id LIMIT {K.TOP_K}"),
    ], f"""SELECT CAST(count(*) AS BIGINT) AS overlap, count(*) / {C.d(float(K.TOP_K))} * 100.0::DOUBLE AS overlap_pct,
        count(*) / {C.d(float(K.TOP_K))} * 100.0::DOUBLE >= {C.d(K.STABLE_OVERLAP_PCT)} AS stable FROM (SELECT * FROM b1 INTERSECT SELECT * FROM b2) i""")


@register("topk_overlap", _overlap_sql(SCORED, "m_s"))
def topk_overlap(spark, sf_dir):
    s = fx_scored(spark, sf_dir)
    a = R.top_k_sites(s.withColumn("b", S.rescore_weights(*K.LOGISTICS_WEIGHTS)), "b")
    b = R.top_k_sites(s.withColumn("b", S.rescore_weights(*K.ALT_LOGISTICS_WEIGHTS)), "b")
    return R.topk_overlap(a, b)


@register("sensitivity_report", _overlap_sql(RANKED + [("appr", f"SELECT * FROM rk WHERE confidence_tier = '{K.TIER_APPROVED}'")], "appr"))
def sensitivity_report(spark, sf_dir):
    return R.sensitivity_report(fx_ranked(spark, sf_dir))
