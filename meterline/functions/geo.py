"""Inverse Lambert conformal conic (2 standard parallels, ellipsoidal; Snyder 1987, eqs. 15-5..15-11,
7-9) as native Column arithmetic: US-survey-foot state-plane coordinates → longitude / latitude degrees.

Projection constants (n, F, rho0) are computed once on the driver from the fixed parameters; the per-point
work is plain column math with a fixed number of unrolled fixed-point steps for the latitude.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LCC_2263

LAT_ITERATIONS = 6


@dataclass(frozen=True)
class LccConstants:
    e: float
    n: float
    aF: float
    rho0: float
    lon0: float
    x0: float
    y0: float
    to_meter: float


def lcc_constants(p: dict = LCC_2263) -> LccConstants:
    f = 1.0 / p["rf"]
    e = math.sqrt(2 * f - f * f)
    rad = math.radians
    phi1, phi2, phi0 = rad(p["lat_1"]), rad(p["lat_2"]), rad(p["lat_0"])

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        es = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (e / 2)

    n = (math.log(m(phi1)) - math.log(m(phi2))) / (math.log(t(phi1)) - math.log(t(phi2)))
    big_f = m(phi1) / (n * t(phi1) ** n)
    a_f = p["a"] * big_f
    rho0 = a_f * t(phi0) ** n
    return LccConstants(e, n, a_f, rho0, rad(p["lon_0"]), p["x_0"], p["y_0"], p["to_meter"])


LCC = lcc_constants()


def lcc_inverse(x_ft: Column, y_ft: Column, k: LccConstants = LCC):
    """(lon_deg, lat_deg) Columns for projected coordinates in US survey feet."""
    lit = F.lit
    x = x_ft * lit(k.to_meter) - lit(k.x0)
    y = lit(k.rho0) - (y_ft * lit(k.to_meter) - lit(k.y0))
    sgn = 1.0 if k.n > 0 else -1.0
    rho = lit(sgn) * F.sqrt(x * x + y * y)
    theta = F.atan2(lit(sgn) * x, lit(sgn) * y)
    t = F.pow(rho / lit(k.aF), lit(1.0 / k.n))
    phi = lit(math.pi / 2) - lit(2.0) * F.atan(t)
    for _ in range(LAT_ITERATIONS):
        # (1 - es) / (1 + es) written as 2 / (1 + es) - 1: the previous latitude appears once, so the
        # expression grows linearly with the number of steps instead of doubling per step
        es = lit(k.e) * F.sin(phi)
        phi = lit(math.pi / 2) - lit(2.0) * F.atan(t * F.pow(lit(2.0) / (lit(1.0) + es) - lit(1.0), lit(k.e / 2)))
    lon = F.degrees(theta / lit(k.n) + lit(k.lon0))
    return lon, F.degrees(phi)


def reproject_point(pt: Column) -> Column:
    lon, lat = lcc_inverse(pt.getItem(0), pt.getItem(1))
    return F.array(lon, lat)


def reproject_multipolygon(coords: Column) -> Column:
    """Every position of a MultiPolygon (array<polygon<ring<[x, y]>>>) mapped to [lon, lat]."""
    return F.transform(coords, lambda poly: F.transform(
        poly, lambda ring: F.transform(ring, reproject_point)))
