"""Population-stratified screening of speed-test tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.screening import assign_stratum, flag_underserved, has_evidence
from ..operators.quantiles import exact_quantiles, global_quantiles


def population_cutoffs(valid: DataFrame, qs=K.POPULATION_QUANTILES, col: str = "population_total") -> DataFrame:
    """One row ``(c0, c1)``: exact linear quantiles of population over the valid tiles."""
    return exact_quantiles(valid, col, list(qs), names=["c0", "c1"])


def stratum_thresholds(valid: DataFrame, q: float = K.SPEED_QUANTILE, col: str = "download_kbps",
                       stratum: str = "demographic_stratum") -> DataFrame:
    """Per stratum, the exact ``q`` quantile of speed (``threshold``)."""
    return exact_quantiles(valid, col, [q], by=[stratum], names=["threshold"])


def threshold_lookup(df: DataFrame, thresholds: DataFrame, key: str = "demographic_stratum", default: float = 0.0) -> DataFrame:
    """Left join of a per-stratum threshold; a missing stratum gets ``default``.

    ``key`` may be any column, so the threshold table has no bound and the join is left to Spark.
    """
    return df.join(thresholds, key, "left").withColumn(
        "threshold", F.coalesce(F.col("threshold"), F.lit(float(default)))
    )


def stratified_screening(df: DataFrame) -> DataFrame:
    """Adds ``demographic_stratum`` and ``is_underserved_target`` to every tile.

    Cut-offs and thresholds come from evidence tiles only (``tests >= 15 AND devices >= 5``);
    all tiles are kept. With no evidence tile at all, the stratum is NULL and no tile is flagged.
    """
    valid = df.where(has_evidence())
    (c0, c1), n_pop = global_quantiles(valid, "population_total", list(K.POPULATION_QUANTILES))
    if n_pop == 0 and valid.isEmpty():  # no evidence tile at all
        stratum = F.lit(None).cast("string")
    else:
        stratum = assign_stratum("population_total", F.lit(c0).cast("double"), F.lit(c1).cast("double"))
    stratified = df.withColumn("demographic_stratum", stratum)
    # at most three strata: fetch their thresholds and apply them as a CASE expression, so the
    # final plan is one narrow pass over the tiles (no join, no re-scan inside the plan)
    thr = {r["demographic_stratum"]: r["threshold"] for r in stratum_thresholds(stratified.where(has_evidence())).collect()}
    threshold = None
    for name, value in thr.items():
        if name is None:
            continue
        cond = F.col("demographic_stratum") == name
        threshold = F.when(cond, F.lit(value).cast("double")) if threshold is None else threshold.when(cond, F.lit(value).cast("double"))
    threshold = F.lit(None).cast("double") if threshold is None else threshold
    return stratified.withColumn("is_underserved_target", flag_underserved(threshold=threshold)).select(
        *df.columns, "demographic_stratum", "is_underserved_target"
    )


def filter_low_quantile(df: DataFrame, col: str = "download_kbps", q: float = K.LOW_QUARTILE) -> DataFrame:
    """Keep rows with ``col <=`` the global ``q`` quantile (earlier screening variant)."""
    (cut,), _ = global_quantiles(df, col, [q])
    return df.where(F.col(col) <= F.lit(cut).cast("double"))
