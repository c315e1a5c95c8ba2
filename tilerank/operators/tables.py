"""Table-level operators: imputation, feature engineering, zonal renames, merges, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .quantiles import exact_quantiles


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column (NULLs skipped).

    The columns are stacked into ``(name, value)`` rows so a single two-pass quantile job
    serves all of them.
    """
    cols = list(cols)
    if not cols:
        raise ValueError("no columns")
    stacked = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])).alias("s")
    ).select("s.name", "s.value")
    med = exact_quantiles(stacked, "value", [0.5], by=["name"], names=["median"])
    return med.agg(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(c) for c in cols])


def impute_domain(df: DataFrame) -> DataFrame:
    """Missing antennas -> 0, missing distances -> 10000 m, missing geography -> column median.

    Only columns present in ``df`` are touched. Medians are computed on the input (before
    the other fills, which do not touch those columns).
    """
    present = set(df.columns)
    fills: dict[str, Column] = {}
    for c in K.ANTENNA_COLUMNS:
        if c in present:
            fills[c] = F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
    for c in K.DISTANCE_COLUMNS:
        if c in present:
            fills[c] = F.coalesce(F.col(c), F.lit(K.MISSING_DISTANCE_FILL_M))
    geo = [c for c in K.GEOGRAPHY_COLUMNS if c in present]
    if geo:
        med = column_medians(df, geo).first()
        for c in geo:
            fills[c] = F.coalesce(F.col(c), F.lit(med[c]).cast("double"))
    return df.withColumns(fills)


def engineer_features(df: DataFrame) -> DataFrame:
    """``congestion_proxy`` and ``pct_4g_5g`` per tower-antenna count."""
    denom = F.col("antenna_count") + 1
    return df.withColumns({
        "congestion_proxy": F.coalesce(F.col("population_total"), F.lit(0.0)) / denom,
        "pct_4g_5g": (F.col("antennas_4G") + F.col("antennas_5G")) / denom,
    })


def select_features(df: DataFrame, features: Sequence[str] = K.MODEL_FEATURES, target: str = K.TARGET) -> tuple[list[str], str]:
    """Features that exist in ``df``; the target falls back to the first alternative name present."""
    cols = set(df.columns)
    feats = [f for f in features if f in cols]
    if target not in cols:
        for alt in K.TARGET_ALTERNATIVES:
            if alt in cols:
                target = alt
                break
    return feats, target


def cast_key_string(df: DataFrame, key: str = "site_id") -> DataFrame:
    return df.withColumn(key, F.col(key).cast("string"))


def merge_env(tiles: DataFrame, env: DataFrame, key: str = "site_id") -> DataFrame:
    """Inner equi-join of tiles and zonal statistics on the text key (duplicates multiply).

    An empty statistics table raises, as it means the extraction returned nothing.
    """
    if env.isEmpty():
        raise ValueError("zonal statistics table is empty; no features were returned")
    return cast_key_string(tiles, key).join(cast_key_string(env, key), key, "inner")


def rename_scale_zonal(df: DataFrame, renames=K.ZONAL_RENAMES, drops=K.ZONAL_DROPS, fill_solar: bool = True) -> DataFrame:
    """Reducer output names -> matrix names, J -> MJ, drop unused statistics, solar NULL -> 0.

    Absent columns are ignored.
    """
    present = set(df.columns)
    out = df.withColumnsRenamed({a: b for a, b in renames if a in present})
    raw = "solar_radiation_raw" if "solar_radiation_raw" in out.columns else None
    if raw is None and "solar_radiation_mean" in out.columns and "solar_radiation_mj" not in out.columns:
        raw = "solar_radiation_mean"
    if raw is not None:
        out = out.withColumn("solar_radiation_mj", F.col(raw) / K.J_PER_MJ)
    out = out.drop(*[c for c in drops if c in out.columns])
    if fill_solar and "solar_radiation_mj" in out.columns:
        out = out.withColumn("solar_radiation_mj", F.coalesce(F.col("solar_radiation_mj"), F.lit(0.0)))
    return out


def rename_zonal_v1(df: DataFrame) -> DataFrame:
    """Earlier variant: five renames, MJ conversion, no solar fill, synthetic id dropped."""
    return rename_scale_zonal(df, K.ZONAL_RENAMES_V1, K.ZONAL_DROPS_V1, fill_solar=False)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Merge fully identical rows (``GROUP BY ALL``)."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the smallest by ``order``.

    Uses ``min_by`` over a struct, a partial (map-side) aggregate, so a hot key is reduced
    before the shuffle instead of being sorted in one task.
    """
    others = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*others), F.struct(*order))
    return df.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def union_scored_unscored(a: DataFrame, b: DataFrame) -> DataFrame:
    """Concatenate by name; a column missing on one side becomes NULL there."""
    return a.unionByName(b, allowMissingColumns=True)
