"""Geometry as native column expressions: WGS84 <-> UTM (Krüger series), planar distances.

The formulas are written once against a tiny math backend (``m``): the default backend
builds Spark ``Column`` expressions, and the oracle module passes a backend that prints
the same formula as SQL text for DuckDB.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

# Series coefficients derived from the flattening (third flattening n), WGS84.
_n = K.WGS84_F / (2.0 - K.WGS84_F)
_A = K.WGS84_A / (1.0 + _n) * (1.0 + _n**2 / 4.0 + _n**4 / 64.0)
_E = 2.0 * math.sqrt(_n) / (1.0 + _n)
_ALPHA = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180,
    13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440,
    61 * _n**3 / 240 - 103 * _n**4 / 140,
    49561 * _n**4 / 161280,
)
_BETA = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360,
    _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440,
    17 * _n**3 / 480 - 37 * _n**4 / 840,
    4397 * _n**4 / 161280,
)
_DELTA = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3 + 116 * _n**4 / 45,
    7 * _n**2 / 3 - 8 * _n**3 / 5 - 227 * _n**4 / 45,
    56 * _n**3 / 15 - 136 * _n**4 / 35,
    4279 * _n**4 / 630,
)
_KA = K.UTM_K0 * _A


def _col(x):
    if isinstance(x, str):
        return F.col(x)
    if isinstance(x, (int, float)):
        return F.lit(float(x))
    return x


COLUMN_MATH = SimpleNamespace(
    lit=F.lit, sin=F.sin, cos=F.cos, sinh=F.sinh, cosh=F.cosh, atanh=F.atanh, asinh=F.asinh,
    asin=F.asin, atan2=F.atan2, sqrt=F.sqrt, radians=F.radians, degrees=F.degrees, col=_col,
)


def utm_zone(lon) -> Column:
    """Zone number of a longitude: ``floor((lon + 180) / 6) + 1``."""
    return (F.floor((_col(lon) + 180.0) / 6.0) + 1).cast("int")


def mean_longitude_zone(df: DataFrame, lon: str = "longitude") -> Column:
    """UTM zone of the mean longitude of a table (one aggregate, returned as a literal column)."""
    z = df.select((F.floor((F.avg(lon) + 180.0) / 6.0) + 1).cast("int").alias("zone")).first()["zone"]
    return F.lit(z).cast("int")


def _fwd_t(lat, m):
    sphi = m.sin(m.radians(m.col(lat)))
    return m.sinh(m.atanh(sphi) - m.atanh(sphi * _E) * _E)


def _fwd_l(lon, zone, m):
    return m.radians(m.col(lon)) - m.radians(m.col(zone) * 6.0 - 183.0)


def _fwd_primes(t, lam, m):
    cl = m.cos(lam)
    return m.atan2(t, cl), m.asinh(m.sin(lam) / m.sqrt(t * t + cl * cl))


def _fwd_series(xi_p, eta_p, m):
    xi, eta = xi_p, eta_p
    for j, a in enumerate(_ALPHA, start=1):
        xi = xi + m.sin(xi_p * (2.0 * j)) * m.cosh(eta_p * (2.0 * j)) * a
        eta = eta + m.cos(xi_p * (2.0 * j)) * m.sinh(eta_p * (2.0 * j)) * a
    return eta * _KA + K.UTM_FALSE_EASTING, xi * _KA


def project_utm(lon, lat, zone, m=COLUMN_MATH):
    """WGS84 degrees -> (easting, northing) metres in a northern-hemisphere UTM zone."""
    xi_p, eta_p = _fwd_primes(_fwd_t(lat, m), _fwd_l(lon, zone, m), m)
    return _fwd_series(xi_p, eta_p, m)


def _inv_primes(x, y, m):
    X = m.col(y) / _KA
    Y = (m.col(x) - K.UTM_FALSE_EASTING) / _KA
    xi_p, eta_p = X, Y
    for j, b in enumerate(_BETA, start=1):
        xi_p = xi_p - m.sin(X * (2.0 * j)) * m.cosh(Y * (2.0 * j)) * b
        eta_p = eta_p - m.cos(X * (2.0 * j)) * m.sinh(Y * (2.0 * j)) * b
    return xi_p, eta_p


def _inv_chi(xi_p, eta_p, m):
    return m.asin(m.sin(xi_p) / m.cosh(eta_p))


def _inv_lonlat(xi_p, eta_p, chi, zone, m):
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + m.sin(chi * (2.0 * j)) * d
    lon = m.degrees(m.atan2(m.sinh(eta_p), m.cos(xi_p))) + (m.col(zone) * 6.0 - 183.0)
    return lon, m.degrees(phi)


def unproject_utm(x, y, zone, m=COLUMN_MATH):
    """UTM metres (northern zone) -> WGS84 (longitude, latitude) degrees."""
    xi_p, eta_p = _inv_primes(x, y, m)
    return _inv_lonlat(xi_p, eta_p, _inv_chi(xi_p, eta_p, m), zone, m)


def with_utm(df: DataFrame, zone, lon: str = "longitude", lat: str = "latitude", x: str = "x", y: str = "y") -> DataFrame:
    """Add projected ``x, y``; intermediate terms are columns so each is evaluated once per row."""
    m = COLUMN_MATH
    d = df.withColumns({"_uz": _col(zone), "_ut": _fwd_t(lat, m)})
    d = d.withColumn("_ul", _fwd_l(lon, "_uz", m))
    xi_p, eta_p = _fwd_primes(F.col("_ut"), F.col("_ul"), m)
    d = d.withColumns({"_uxi": xi_p, "_ueta": eta_p})
    ex, ny = _fwd_series(F.col("_uxi"), F.col("_ueta"), m)
    return d.withColumns({x: ex, y: ny}).drop("_uz", "_ut", "_ul", "_uxi", "_ueta")


def with_lonlat(df: DataFrame, zone, x: str = "x", y: str = "y", lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Add WGS84 ``lon, lat`` from UTM ``x, y`` (stepwise, like :func:`with_utm`)."""
    m = COLUMN_MATH
    d = df.withColumn("_uz", _col(zone))
    xi_p, eta_p = _inv_primes(x, y, m)
    d = d.withColumns({"_uxi": xi_p, "_ueta": eta_p})
    d = d.withColumn("_uchi", _inv_chi(F.col("_uxi"), F.col("_ueta"), m))
    lo, la = _inv_lonlat(F.col("_uxi"), F.col("_ueta"), F.col("_uchi"), "_uz", m)
    return d.withColumns({lon: lo, lat: la}).drop("_uz", "_uxi", "_ueta", "_uchi")


def point_distance(x1, y1, x2, y2, m=COLUMN_MATH):
    """Planar distance."""
    dx = m.col(x2) - m.col(x1)
    dy = m.col(y2) - m.col(y1)
    return m.sqrt(dx * dx + dy * dy)


def point_segment_distance(px, py, x1, y1, x2, y2) -> Column:
    """Planar distance from a point to a segment (a zero-length segment is a point)."""
    px, py, x1, y1, x2, y2 = map(_col, (px, py, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    t = F.when(len2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / len2))).otherwise(0.0)
    qx, qy = x1 + t * dx, y1 + t * dy
    return F.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))
