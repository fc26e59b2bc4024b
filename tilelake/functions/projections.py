"""Lon/lat to metric coordinates and back, as closed-form Column expressions.

EPSG:3763 is a transverse Mercator on GRS80, evaluated with the Krueger series in the third
flattening (Karney 2011). EPSG:6933 is the Lambert cylindrical equal-area projection on WGS84.
ETRS89 and WGS84 are taken as the same datum.

Each projection is a chain of small steps, so the same steps serve scalar columns (where
codegen shares common parts) and ``transform`` over ring vertices (one transform per step).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of EPSG:3763.
_A = 6378137.0
_F_GRS80 = 1 / 298.257222101
_LAT0 = math.radians(39.66825833333333)
_LON0_DEG = -8.133108333333334

_E = math.sqrt(_F_GRS80 * (2 - _F_GRS80))
_N = _F_GRS80 / (2 - _F_GRS80)
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def _origin_northing() -> float:
    t = math.sinh(math.atanh(math.sin(_LAT0)) - _E * math.atanh(_E * math.sin(_LAT0)))
    xi = math.atan(t)
    return _RECT * (xi + sum(a * math.sin(2 * j * xi) for j, a in enumerate(_ALPHA, 1)))


_N0 = _origin_northing()

# Fixed values of EPSG:6933.
_E2_WGS84 = (1 / 298.257223563) * (2 - 1 / 298.257223563)
_E_WGS84 = math.sqrt(_E2_WGS84)
_K0 = math.cos(math.radians(30)) / math.sqrt(1 - _E2_WGS84 * math.sin(math.radians(30)) ** 2)
_AUTHALIC = (
    _E2_WGS84 / 3 + 31 * _E2_WGS84**2 / 180 + 517 * _E2_WGS84**3 / 5040,
    23 * _E2_WGS84**2 / 360 + 251 * _E2_WGS84**3 / 3780,
    761 * _E2_WGS84**3 / 45360,
)


def _authalic_q(sin_lat: float) -> float:
    return (1 - _E2_WGS84) * (
        sin_lat / (1 - _E2_WGS84 * sin_lat**2) + math.atanh(_E_WGS84 * sin_lat) / _E_WGS84
    )


_QP = _authalic_q(1.0)

# The area of use of EPSG:3763 (west, south, east, north).
MAINLAND = (-9.56, 36.95, -6.19, 42.16)

Step = Callable[[Column], Column]


def _pair(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _tm06_conformal(p: Column) -> Column:
    phi = F.radians(p["y"])
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(_E) * F.atanh(F.lit(_E) * F.sin(phi)))
    return _pair(F.radians(p["x"] - F.lit(_LON0_DEG)), t)


def _tm06_spherical(p: Column) -> Column:
    lam, t = p["x"], p["y"]
    return _pair(F.atanh(F.sin(lam) / F.sqrt(1 + t * t)), F.atan2(t, F.cos(lam)))


def _tm06_metric(p: Column) -> Column:
    eta, xi = p["x"], p["y"]
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + F.lit(a) * F.cos(xi * 2 * j) * F.sinh(eta * 2 * j)
        north = north + F.lit(a) * F.sin(xi * 2 * j) * F.cosh(eta * 2 * j)
    return _pair(F.lit(_RECT) * east, F.lit(_RECT) * north - F.lit(_N0))


def _tm06_unscale(p: Column) -> Column:
    return _pair(p["x"] / F.lit(_RECT), (p["y"] + F.lit(_N0)) / F.lit(_RECT))


def _tm06_unseries(p: Column) -> Column:
    eta, xi = p["x"], p["y"]
    h, x = eta, xi
    for j, b in enumerate(_BETA, 1):
        h = h - F.lit(b) * F.cos(xi * 2 * j) * F.sinh(eta * 2 * j)
        x = x - F.lit(b) * F.sin(xi * 2 * j) * F.cosh(eta * 2 * j)
    return _pair(h, x)


def _tm06_unspherical(p: Column) -> Column:
    h, x = p["x"], p["y"]
    return _pair(F.atan2(F.sinh(h), F.cos(x)), F.asin(F.sin(x) / F.cosh(h)))


def _tm06_unconformal(p: Column) -> Column:
    chi = p["y"]
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + F.lit(d) * F.sin(chi * 2 * j)
    return _pair(F.degrees(p["x"]) + F.lit(_LON0_DEG), F.degrees(phi))


def _ea_forward(p: Column) -> Column:
    s = F.sin(F.radians(p["y"]))
    q = F.lit(1 - _E2_WGS84) * (
        s / (1 - F.lit(_E2_WGS84) * s * s) + F.atanh(F.lit(_E_WGS84) * s) / F.lit(_E_WGS84)
    )
    return _pair(F.lit(_A * _K0) * F.radians(p["x"]), F.lit(_A / (2 * _K0)) * q)


def _ea_inverse(p: Column) -> Column:
    beta = F.asin(p["y"] * F.lit(2 * _K0 / (_A * _QP)))
    phi = beta
    for j, c in enumerate(_AUTHALIC, 1):
        phi = phi + F.lit(c) * F.sin(beta * 2 * j)
    q = p["y"] * F.lit(2 * _K0 / _A)
    return F.struct(p["x"].alias("x"), phi.alias("y"), q.alias("q"))


def _ea_newton(p: Column) -> Column:
    """One Newton step on the authalic function takes the series to full precision."""
    s = F.sin(p["y"])
    w = 1 - F.lit(_E2_WGS84) * s * s
    q = F.lit(1 - _E2_WGS84) * (s / w + F.atanh(F.lit(_E_WGS84) * s) / F.lit(_E_WGS84))
    phi = p["y"] + (p["q"] - q) * w * w / (F.lit(2 * (1 - _E2_WGS84)) * F.cos(p["y"]))
    return _pair(F.degrees(p["x"] / F.lit(_A * _K0)), F.degrees(phi))


_TO_TM06: Sequence[Step] = (_tm06_conformal, _tm06_spherical, _tm06_metric)
_FROM_TM06: Sequence[Step] = (_tm06_unscale, _tm06_unseries, _tm06_unspherical, _tm06_unconformal)
_TO_EA: Sequence[Step] = (_ea_forward,)
_FROM_EA: Sequence[Step] = (_ea_inverse, _ea_newton)


def _scalar(steps: Sequence[Step], x: Column, y: Column) -> Column:
    point = _pair(x.cast("double"), y.cast("double"))
    for step in steps:
        point = step(point)
    return point


def _over_rings(steps: Sequence[Step], rings: Column) -> Column:
    def ring(vertices: Column) -> Column:
        for step in steps:
            vertices = F.transform(vertices, step)
        return vertices

    return F.transform(rings, ring)


def to_tm06(lon: Column, lat: Column) -> Column:
    return _scalar(_TO_TM06, lon, lat)


def from_tm06(x: Column, y: Column) -> Column:
    return _scalar(_FROM_TM06, x, y)


def to_equal_area(lon: Column, lat: Column) -> Column:
    return _scalar(_TO_EA, lon, lat)


def from_equal_area(x: Column, y: Column) -> Column:
    return _scalar(_FROM_EA, x, y)


def metric_crs(bounds: Column) -> Column:
    """EPSG:3763 for bounds inside its area of use, else the equal-area fallback."""
    west, south, east, north = (F.lit(v) for v in MAINLAND)
    inside = (
        (bounds["minx"] >= west) & (bounds["miny"] >= south)
        & (bounds["maxx"] <= east) & (bounds["maxy"] <= north)
    )
    return F.when(inside, F.lit("EPSG:3763")).otherwise(F.lit("EPSG:6933"))


def rings_to_metric(rings: Column, crs: Column) -> Column:
    return F.when(crs == "EPSG:3763", _over_rings(_TO_TM06, rings)).otherwise(
        _over_rings(_TO_EA, rings)
    )


def rings_to_lonlat(rings: Column, crs: Column) -> Column:
    """Lon/lat rings from EPSG:4326, 3763 or 6933; NULL for any other CRS."""
    return (
        F.when(crs == "EPSG:4326", rings)
        .when(crs == "EPSG:3763", _over_rings(_FROM_TM06, rings))
        .when(crs == "EPSG:6933", _over_rings(_FROM_EA, rings))
    )
