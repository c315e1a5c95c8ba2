"""End-to-end flows: the national ranking from raw inputs, the re-scoring of a stored matrix,
and the earlier zonal-extraction flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.raster import zonal_stats
from ..operators.rank import global_row_number, sample_rows
from ..operators.tables import engineer_features, impute_domain, rename_zonal_v1, select_features
from ..session import store
from .environment import Grid
from .matrix import build_master_matrix, inside_region
from .model import model_and_drivers
from .ranking import govern_score_rank
from .screening import filter_low_quantile, stratified_screening


def prepare_matrix(master: DataFrame) -> DataFrame:
    """Screening, domain imputation and engineered features."""
    return engineer_features(impute_domain(stratified_screening(master)))


def rank_sites(master: DataFrame, mask: bool = True, **model_params) -> DataFrame:
    """Master matrix -> screening -> imputation -> features -> blocked-CV model with top drivers ->
    governance -> scoring of approved sites -> union -> (driver mask) -> status -> national rank.

    An empty matrix stops with an error, like the original flow. A training pool without rows
    leaves predictions and drivers NULL.
    """
    # stored once: screening, medians and models read it some ten times, and all columns added to it are row by row
    master = store(master)
    if master.isEmpty():
        raise ValueError("insufficient valid data to train the model")
    prepared = prepare_matrix(master)
    feats, target = select_features(prepared)
    if prepared.where(F.col("is_underserved_target")).isEmpty():
        modeled = prepared.withColumns({
            "cv_predicted_speed": F.lit(None).cast("double"), "predicted_download_kbps": F.lit(None).cast("double"),
            "top_shap_driver": F.lit(None).cast("string"), "top_shap_value": F.lit(None).cast("double")})
    else:
        modeled = model_and_drivers(prepared, feats, target, **model_params)
    return govern_score_rank(store(modeled), mask=mask)


def national_ranking(tiles: DataFrame, towers: DataFrame, env: DataFrame | None, edges: DataFrame | None, region: str,
                     images: DataFrame | None = None, grid: Grid = Grid(), **model_params) -> DataFrame:
    """Tiles, tower sites and zonal statistics (or the images to take them from) to the ranked, scored matrix."""
    master = build_master_matrix(tiles, towers, env, edges, region, images, grid)
    return rank_sites(master, mask=True, **model_params)


def rescore_stored_matrix(matrix: DataFrame, **model_params) -> DataFrame:
    """The same ranking from a stored matrix (no driver mask).

    A stored matrix normally carries the screening result (stratum and flag) and is only imputed
    and extended with the engineered features; one without it is screened first.
    """
    if "is_underserved_target" in matrix.columns:
        prepared = engineer_features(impute_domain(matrix))
    else:
        prepared = prepare_matrix(matrix)
    feats, target = select_features(prepared)
    modeled = model_and_drivers(prepared, feats, target, **model_params)
    return govern_score_rank(store(modeled), mask=False)


def zonal_v1(tiles: DataFrame, edges: DataFrame, pixels: DataFrame, region: str, bands=("elevation", "population"),
             n: int = 20, seed: int = K.SEED, radius_m: float = K.BUFFER_RADIUS_M) -> DataFrame:
    """Earlier flow: global lower-quartile screen -> polygon clip -> seeded sample -> sequential
    ids -> zonal statistics around the sample -> merge -> v1 renames."""
    low = filter_low_quantile(tiles)
    clipped = inside_region(low, edges, region)
    sample = sample_rows(clipped, n, seed).withColumn("_h", F.md5(F.concat(F.col("site_id"), F.lit(f"|{seed}"))))
    cohort = global_row_number(sample, [F.col("_h"), F.col("site_id")], "_rn").drop("_h")
    cohort = cohort.withColumn("site_id", (F.col("_rn") - 1).cast("string")).drop("_rn")
    env = zonal_stats(cohort, pixels, list(bands), radius_m)
    # the earlier flow merges whatever came back (possibly nothing) instead of raising
    return rename_zonal_v1(cohort.join(env, "site_id", "inner"))
