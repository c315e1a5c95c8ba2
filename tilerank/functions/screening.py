"""Column functions of the screening and governance rules (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_evidence(tests="tests", devices="devices", min_tests: int = K.MIN_TESTS, min_devices: int = K.MIN_DEVICES) -> Column:
    """``tests >= 15 AND devices >= 5``."""
    return (_c(tests) >= min_tests) & (_c(devices) >= min_devices)


def assign_stratum(pop="population_total", c0=None, c1=None) -> Column:
    """``<= c0`` rural, ``<= c1`` peri-urban, otherwise urban.

    Missing population (or missing cut-offs) makes both comparisons false, so the row is urban.
    """
    p = _c(pop)
    return (
        F.when(p <= _c(c0), F.lit(K.STRATUM_RURAL))
        .when(p <= _c(c1), F.lit(K.STRATUM_PERI_URBAN))
        .otherwise(F.lit(K.STRATUM_URBAN))
    )


def flag_underserved(tests="tests", devices="devices", download="download_kbps", threshold="threshold") -> Column:
    """Evidence AND ``download < threshold`` (strict); missing threshold counts as 0; NULL → false."""
    cond = has_evidence(tests, devices) & (_c(download) < F.coalesce(_c(threshold), F.lit(0.0)))
    return F.coalesce(cond, F.lit(False))


def spatial_block(lat="latitude", lon="longitude", size: float = K.BLOCK_SIZE_DEG) -> tuple[Column, Column, Column]:
    """``(lat_block, lon_block, spatial_block)``: truncation toward zero of ``coord / size``."""
    lat_b = (_c(lat) / F.lit(size)).cast("int")
    lon_b = (_c(lon) / F.lit(size)).cast("int")
    return lat_b, lon_b, F.concat(lat_b.cast("string"), F.lit("_"), lon_b.cast("string"))


def confidence_tier(
    tests="tests",
    devices="devices",
    tower_distance: Column | str | None = "distance_to_nearest_tower",
    underserved: Column | str | None = "is_underserved_target",
    max_tower_m: float = K.TOWER_DISTANCE_LIMIT_M,
) -> Column:
    """Four governance outcomes. A missing tower-distance column counts as 99999 m, a missing flag as false."""
    dist = F.lit(K.MISSING_TOWER_DISTANCE_M) if tower_distance is None else _c(tower_distance)
    flag = F.lit(False) if underserved is None else F.coalesce(_c(underserved), F.lit(False))
    tower_near = F.coalesce(dist <= max_tower_m, F.lit(False))
    evidence = F.coalesce(has_evidence(tests, devices), F.lit(False))
    return (
        F.when(evidence & tower_near & flag, F.lit(K.TIER_APPROVED))
        .when(evidence & tower_near, F.lit(K.TIER_ABOVE_BASELINE))
        .when(F.coalesce(_c(tests) > 0, F.lit(False)), F.lit(K.TIER_THIN))
        .otherwise(F.lit(K.TIER_NO_DATA))
    )


def is_approved(tier="confidence_tier") -> Column:
    return F.coalesce(_c(tier).contains(K.APPROVED_MARKER), F.lit(False))
