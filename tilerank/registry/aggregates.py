"""Aggregations except clustering and raster statistics (in joins/windows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scoring as S
from ..functions.geo import utm_zone
from ..functions.screening import has_evidence
from ..operators.tables import column_medians as medians
from ..operators.tables import dedupe_rows
from ..plans import model_stats as M
from ..plans.screening import population_cutoffs as cutoffs
from ..plans.screening import stratified_screening
from ..plans.screening import stratum_thresholds as thresholds
from ..sources.fixtures import fixture
from . import chain as C
from . import register
from .common import fx_prepared, fx_scored

d = C.d
PREP = C.fx_prepared()
SCORED = PREP + C.tier("m_prep", "m_t") + [("m_a", f"SELECT * FROM m_t WHERE COALESCE(contains(confidence_tier, '{K.APPROVED_MARKER}'), false)")] \
    + C.score("m_a", "m_s")


@register("population_cutoffs", C.render(["fx_tiles"], [], f"""SELECT quantile_cont(population_total, {d(0.33)}) AS c0,
    quantile_cont(population_total, {d(0.66)}) AS c1 FROM fx_tiles WHERE {C.EVIDENCE}"""))
def population_cutoffs(spark, sf_dir):
    return cutoffs(fixture(spark, sf_dir, "fx_tiles").where(has_evidence()))


@register("stratum_thresholds", C.render(["fx_tiles"], C.screening("fx_tiles", "ts"), f"""SELECT demographic_stratum,
    quantile_cont(CAST(download_kbps AS DOUBLE), {d(0.2)}) AS threshold FROM ts WHERE {C.EVIDENCE} GROUP BY demographic_stratum"""))
def stratum_thresholds(spark, sf_dir):
    s = stratified_screening(fixture(spark, sf_dir, "fx_tiles"))
    return thresholds(s.where(has_evidence()))


@register("column_medians", C.render(["fx_matrix"], [], "SELECT " + ", ".join(f"median({c}) AS {c}" for c in K.GEOGRAPHY_COLUMNS) + " FROM fx_matrix"))
def column_medians(spark, sf_dir):
    return medians(fixture(spark, sf_dir, "fx_matrix"), K.GEOGRAPHY_COLUMNS)


@register("minmax_scalars", C.render(["fx_matrix"], SCORED, f"""SELECT max(solar_radiation_mj) AS max_solar,
    min({C.raw_sql('logistics_difficulty')}) AS raw_min, max({C.raw_sql('logistics_difficulty')}) AS raw_max FROM m_s"""))
def minmax_scalars(spark, sf_dir):
    s = fx_scored(spark, sf_dir).withColumn("_raw", S.raw_priority())
    return s.agg(F.max("solar_radiation_mj").alias("max_solar"), F.min("_raw").alias("raw_min"), F.max("_raw").alias("raw_max"))


_PROFILE = f"""SELECT demographic_stratum, CAST(count(download_kbps) AS BIGINT) AS count, avg(CAST(download_kbps AS DOUBLE)) AS mean,
    round(stddev_samp(CAST(download_kbps AS DOUBLE)), 6) AS std, min(CAST(download_kbps AS DOUBLE)) AS min,
    quantile_cont(CAST(download_kbps AS DOUBLE), {d(0.25)}) AS p25, quantile_cont(CAST(download_kbps AS DOUBLE), {d(0.5)}) AS p50,
    quantile_cont(CAST(download_kbps AS DOUBLE), {d(0.75)}) AS p75, max(CAST(download_kbps AS DOUBLE)) AS max
    FROM m_prep WHERE is_underserved_target"""


@register("profile_matrix", C.render(["fx_matrix"], PREP, _PROFILE + " GROUP BY demographic_stratum UNION ALL " +
                                     _PROFILE.replace("SELECT demographic_stratum,", "SELECT 'ALL' AS demographic_stratum,")))
def profile_matrix(spark, sf_dir):
    """Speed distribution of the training pool per stratum and overall (std rounded to 1e-6)."""
    pool = fx_prepared(spark, sf_dir).where(F.col("is_underserved_target"))
    per = M.describe_by(pool, "download_kbps", "demographic_stratum")
    allr = M.describe_by(pool, "download_kbps").withColumn("demographic_stratum", F.lit("ALL"))
    cols = ["demographic_stratum", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    return per.select(*cols).unionByName(allr.select(*cols)).withColumn("std", F.round("std", 6))


@register("mean_longitude_zone", C.render(["fx_tiles", "fx_antennas", "fx_matrix"], [], " UNION ALL ".join(
    f"SELECT '{t}' AS source, round(avg(longitude), 9) AS mean_longitude, CAST(floor((avg(longitude) + 180) / 6) + 1 AS INTEGER) AS zone FROM {t}"
    for t in ("fx_tiles", "fx_antennas", "fx_matrix"))))
def mean_longitude_zone(spark, sf_dir):
    parts = []
    for t in ("fx_tiles", "fx_antennas", "fx_matrix"):
        m = fixture(spark, sf_dir, t).agg(F.avg("longitude").alias("m"))
        parts.append(m.select(F.lit(t).alias("source"), F.round("m", 9).alias("mean_longitude"), utm_zone(F.col("m")).alias("zone")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_R2 = """CASE WHEN ss_tot = 0 THEN (CASE WHEN ss_res = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) ELSE 1.0::DOUBLE - ss_res / ss_tot END"""


def _r2_sql(by: str | None) -> str:
    g = f"{by}, " if by else ""
    join = f"JOIN (SELECT {g}avg(CAST(download_kbps AS DOUBLE)) AS m FROM pool GROUP BY ALL) mm " + (f"USING ({by})" if by else "ON true")
    return C.render(["fx_matrix"], PREP + [("pool", "SELECT * FROM m_prep WHERE is_underserved_target AND cv_predicted_speed IS NOT NULL")], f"""
SELECT {g}n, round({_R2}, 9) AS r2 FROM (
  SELECT {g}CAST(count(*) AS BIGINT) AS n,
         sum((CAST(download_kbps AS DOUBLE) - cv_predicted_speed) * (CAST(download_kbps AS DOUBLE) - cv_predicted_speed)) AS ss_res,
         sum((CAST(download_kbps AS DOUBLE) - m) * (CAST(download_kbps AS DOUBLE) - m)) AS ss_tot
  FROM pool {join} GROUP BY ALL) s {'WHERE n > 1' if by else ''}""")


@register("r2_score", _r2_sql(None))
def r2_score(spark, sf_dir):
    """Out-of-block R² of the stand-in prediction over the training pool (rounded to 1e-9)."""
    pool = fx_prepared(spark, sf_dir).where(F.col("is_underserved_target"))
    return M.r2_score(pool, "download_kbps", "cv_predicted_speed").withColumn("r2", F.round("r2", 9))


@register("r2_by_stratum", _r2_sql("demographic_stratum"))
def r2_by_stratum(spark, sf_dir):
    pool = fx_prepared(spark, sf_dir).where(F.col("is_underserved_target"))
    return M.r2_by_stratum(pool, "download_kbps", "cv_predicted_speed").withColumn("r2", F.round("r2", 9))


@register("count_blocks", C.render(["fx_matrix"], PREP, """SELECT spatial_block, CAST(row_number() OVER (ORDER BY spatial_block) AS BIGINT) AS block_index,
    CAST(count(*) OVER () AS BIGINT) AS n_blocks FROM (SELECT DISTINCT spatial_block FROM m_prep WHERE is_underserved_target) b"""))
def count_blocks(spark, sf_dir):
    return M.count_blocks(fx_prepared(spark, sf_dir).where(F.col("is_underserved_target")))


@register("count_flags", C.render(["fx_matrix"], PREP, """SELECT CAST(count(*) AS BIGINT) AS n_tiles,
    CAST(count_if(COALESCE(is_underserved_target, false)) AS BIGINT) AS n_flagged FROM m_prep"""))
def count_flags(spark, sf_dir):
    return M.count_flags(fx_prepared(spark, sf_dir))


@register("dedupe_group_all", C.render(["fx_tiles"], [], "SELECT DISTINCT * FROM (SELECT * FROM fx_tiles UNION ALL SELECT * FROM fx_tiles) u"))
def dedupe_group_all(spark, sf_dir):
    t = fixture(spark, sf_dir, "fx_tiles")
    return dedupe_rows(t.unionByName(t))


_PREP_COLS = C.FX_MATRIX_COLUMNS + ["demographic_stratum", "is_underserved_target", "congestion_proxy", "pct_4g_5g",
                                    "lat_block", "lon_block", "spatial_block"]


@register("profile_columns", C.render(["fx_matrix"], PREP, " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null FROM m_prep" for c in _PREP_COLS)))
def profile_columns(spark, sf_dir):
    """Per-column non-NULL counts of the prepared matrix (the column part of the matrix profile)."""
    prof = M.column_profile(fx_prepared(spark, sf_dir).select(*_PREP_COLS))
    return prof.select("column_name", "non_null")
