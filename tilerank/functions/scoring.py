"""Scoring formulas as native column expressions (no UDF).

NULL plays the role of pandas NaN. Two pandas behaviours are kept on purpose because they
change results: a clip keeps a missing value missing (Spark's ``least/greatest`` would skip
it), and a division by zero gives +/-inf (ANSI Spark would raise).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

INF = float("inf")


def _c(x) -> Column:
    if isinstance(x, str):
        return F.col(x)
    if isinstance(x, (int, float)):
        return F.lit(float(x))
    return x


def clip_upper(x, hi: float) -> Column:
    x = _c(x)
    return F.when(x > hi, F.lit(float(hi))).otherwise(x)


def clip_lower(x, lo: float) -> Column:
    x = _c(x)
    return F.when(x < lo, F.lit(float(lo))).otherwise(x)


def divide(a, b) -> Column:
    """``a / b`` with numpy semantics for a zero divisor: +inf, -inf, or NULL for 0/0."""
    a, b = _c(a), _c(b)
    return F.when(b == 0, F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))).otherwise(a / b)


def off_grid_likelihood(power="distance_to_power_m", road="distance_to_road_m",
                        radiance="night_radiance_nw_cm2_sr", pop="population_total") -> Column:
    """Weighted mix of power and road remoteness, darkness and population (radiance term unclipped)."""
    wp, wr, wn, wq = K.OFF_GRID_WEIGHTS
    return (
        clip_upper(_c(power) / K.POWER_SCALE_M, 1.0) * wp
        + clip_upper(_c(road) / K.ROAD_SCALE_M, 1.0) * wr
        + divide(1.0, _c(radiance) + K.RADIANCE_OFFSET) * wn
        + clip_upper(_c(pop) / K.POPULATION_SCALE, 1.0) * wq
    )


def aspect_score(aspect="aspect_degrees", lat="latitude") -> Column:
    """1 for the ideal orientation (south-facing north of the equator, north-facing otherwise), 0 for the opposite."""
    opt = F.when(_c(lat) > 0, F.lit(180.0)).otherwise(F.lit(0.0))
    d = F.abs(_c(aspect) - opt)
    d = F.when(d.isNull(), F.lit(None).cast("double")).otherwise(F.least(d, F.lit(360.0) - d))
    return F.lit(1.0) - d / 180.0


def solar_viability(max_solar: Column, solar="solar_radiation_mj", slope="slope_degrees",
                    aspect="aspect_degrees", lat="latitude", rain="rainfall_mm_hr") -> Column:
    """Radiation share of the maximum, flatness, orientation, minus a rainfall penalty; floor 0.1."""
    w_rad, w_slope, w_aspect, w_rain = K.SOLAR_WEIGHTS
    v = (
        divide(_c(solar), max_solar) * w_rad
        + divide(1.0, _c(slope) + 1.0) * w_slope
        + aspect_score(aspect, lat) * w_aspect
    ) - _c(rain) * w_rain
    return clip_lower(v, K.FLOOR_VALUE)


def logistics_difficulty(weights=K.LOGISTICS_WEIGHTS, slope="slope_degrees", elev="elevation_m",
                         road="distance_to_road_m", rugged="terrain_ruggedness") -> Column:
    """Weighted slope, elevation, road distance and ruggedness; floor 0.1 (weights are not normalised)."""
    ws, we, wr, wg = weights
    ss, se, sr, sg = K.LOGISTICS_SCALES
    v = (_c(slope) / ss) * ws + (_c(elev) / se) * we + (_c(road) / sr) * wr + (_c(rugged) / sg) * wg
    return clip_lower(v, K.FLOOR_VALUE)


def abatement_tco2e(likelihood="off_grid_likelihood") -> Column:
    lk = _c(likelihood)
    return F.when(lk < K.MIN_LIKELIHOOD, F.lit(0.0)).otherwise(
        F.lit(K.DIESEL_BASELINE_TCO2E) * K.ABATEMENT_FACTOR * clip_upper(lk, 1.0)
    )


def opex_saving(likelihood="off_grid_likelihood") -> Column:
    lk = _c(likelihood)
    return F.when(lk < K.MIN_LIKELIHOOD, F.lit(0.0)).otherwise(F.lit(K.OPEX_BASELINE_USD) * clip_upper(lk, 1.0))


def underperformance_residual(pred="cv_predicted_speed", actual="download_kbps") -> Column:
    """``max(pred - actual, 1.0)``; a missing difference stays missing."""
    d = _c(pred) - _c(actual)
    return F.when(F.lit(K.MIN_RESIDUAL) > d, F.lit(K.MIN_RESIDUAL)).otherwise(d)


def essential_service_weight(amenity="distance_to_amenity_m") -> Column:
    return F.when(_c(amenity) <= K.ESSENTIAL_SERVICE_RADIUS_M, F.lit(K.ESSENTIAL_SERVICE_WEIGHT)).otherwise(F.lit(0.0))


def raw_priority(logistics: Column | str = "logistics_difficulty", abatement="indicative_abatement_tco2e_yr",
                 solar="solar_viability", pop="population_total", essential="essential_service_weight",
                 residual="underperformance_residual") -> Column:
    """``abatement * solar * (pop + essential) * residual / logistics``."""
    num = ((_c(abatement) * _c(solar)) * (_c(pop) + _c(essential))) * _c(residual)
    return divide(num, _c(logistics))


def minmax_score(raw: Column, lo: Column, hi: Column) -> Column:
    """0-100 min-max scale rounded to 2 decimals; 50 for every row when min equals max."""
    return F.when(hi == lo, F.lit(50.0)).otherwise(F.round((raw - lo) / (hi - lo) * 100.0, 2))


def people_per_tonne(pop="population_total", abatement="indicative_abatement_tco2e_yr") -> Column:
    return F.when(_c(abatement) > 0, _c(pop) / _c(abatement)).otherwise(F.lit(0.0))


def rescore_weights(w_slope: float, w_elev: float, w_road: float, w_rugged: float) -> Column:
    """Raw priority with caller-supplied logistics weights (no normalisation)."""
    return raw_priority(logistics_difficulty((w_slope, w_elev, w_road, w_rugged)))
