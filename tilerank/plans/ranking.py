"""Governance, scoring and national ranking of a modelled matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scoring as S
from ..functions.screening import confidence_tier, is_approved
from ..operators.quantiles import scalar_row
from ..operators.rank import global_row_number, top_k
from ..operators.tables import union_scored_unscored


def apply_confidence_tier(df: DataFrame, max_tower_m: float = K.TOWER_DISTANCE_LIMIT_M) -> DataFrame:
    cols = set(df.columns)
    tier = confidence_tier(
        tower_distance="distance_to_nearest_tower" if "distance_to_nearest_tower" in cols else None,
        underserved="is_underserved_target" if "is_underserved_target" in cols else None,
        max_tower_m=max_tower_m,
    )
    return df.withColumn("confidence_tier", tier)


def split_by_tier(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(approved, rest) on ``confidence_tier`` containing the approval marker."""
    ok = is_approved()
    return df.where(ok), df.where(~ok)


def approved_sites(df: DataFrame) -> DataFrame:
    """Exact equality on the full approved tier text."""
    return df.where(F.col("confidence_tier") == K.TIER_APPROVED)


def score_matrix(df: DataFrame) -> DataFrame:
    """Energy-burden indices and the 0-100 priority score over the rows given (the approved set)."""
    d = df.withColumns({c: F.coalesce(F.col(c), F.lit(K.MISSING_DISTANCE_FILL_M))
                        for c in ("distance_to_power_m", "distance_to_road_m", "distance_to_amenity_m")})
    d = d.withColumn("off_grid_likelihood", S.off_grid_likelihood())
    max_solar = F.lit(scalar_row(d.select(F.max("solar_radiation_mj").alias("m")))["m"]).cast("double")
    d = d.withColumns({
        "solar_viability": S.solar_viability(max_solar),
        "logistics_difficulty": S.logistics_difficulty(),
    })
    d = d.withColumns({
        "indicative_abatement_tco2e_yr": S.abatement_tco2e(),
        "indicative_opex_saving_usd": S.opex_saving(),
        "underperformance_residual": S.underperformance_residual(),
        "essential_service_weight": S.essential_service_weight(),
    })
    d = d.withColumn("_raw", S.raw_priority())
    b = scalar_row(d.select(F.min("_raw").alias("lo"), F.max("_raw").alias("hi")))
    lo, hi = F.lit(b["lo"]).cast("double"), F.lit(b["hi"]).cast("double")
    d = d.withColumn("priority_score", S.minmax_score(F.col("_raw"), lo, hi))
    return d.withColumn("people_connected_per_tonne_co2", S.people_per_tonne()).drop("_raw")


def mask_drivers(df: DataFrame) -> DataFrame:
    """Driver name and value become NULL where the tier lacks the 'Sufficient' marker."""
    keep = F.coalesce(F.col("confidence_tier").contains(K.SUFFICIENT_MARKER), F.lit(False))
    return df.withColumns({
        "top_shap_driver": F.when(keep, F.col("top_shap_driver")),
        "top_shap_value": F.when(keep, F.col("top_shap_value")),
    })


def status_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "inference_status": F.lit(K.INFERENCE_STATUS),
        "field_survey_triggered": is_approved(),
    })


def national_rank(df: DataFrame) -> DataFrame:
    """Rank 1..n: survey-triggered first, then priority score descending (missing last), ties by site id."""
    order = [F.col("field_survey_triggered").desc(), F.col("priority_score").desc_nulls_last(), F.col("site_id").asc()]
    return global_row_number(df, order, "national_rank")


def govern_score_rank(modeled: DataFrame, mask: bool = True) -> DataFrame:
    """Tier -> split -> score the approved rows -> union -> (mask drivers) -> status -> rank."""
    governed = apply_confidence_tier(modeled)
    approved, rest = split_by_tier(governed)
    out = union_scored_unscored(score_matrix(approved), rest)
    if mask and "top_shap_driver" in out.columns:
        out = mask_drivers(out)
    return national_rank(status_columns(out))


def top_k_sites(df: DataFrame, score: str, k: int = K.TOP_K) -> DataFrame:
    return top_k(df, score, k).select("site_id")


def topk_overlap(a: DataFrame, b: DataFrame, k: int = K.TOP_K) -> DataFrame:
    """One row: ids in both top-k sets, percentage of the fixed denominator k, and the stability verdict."""
    both = a.select("site_id").intersect(b.select("site_id"))
    n = both.select(F.count(F.lit(1)).cast("bigint").alias("overlap"))
    return n.select(
        "overlap",
        (F.col("overlap") / F.lit(float(k)) * 100.0).alias("overlap_pct"),
        (F.col("overlap") / F.lit(float(k)) * 100.0 >= K.STABLE_OVERLAP_PCT).alias("stable"),
    )


def sensitivity_report(scored: DataFrame, base=K.LOGISTICS_WEIGHTS, alt=K.ALT_LOGISTICS_WEIGHTS, k: int = K.TOP_K) -> DataFrame:
    """Top-k overlap of the approved sites under two logistics weightings."""
    approved = approved_sites(scored)
    s1 = approved.withColumn("baseline_score", S.rescore_weights(*base))
    s2 = approved.withColumn("scenario_b_score", S.rescore_weights(*alt))
    return topk_overlap(top_k_sites(s1, "baseline_score", k), top_k_sites(s2, "scenario_b_score", k), k)
