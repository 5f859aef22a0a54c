"""Map projections of regional model grids: lon/lat <-> grid coordinates, as column expressions.

Standard spherical formulas (Lambert conformal, polar stereographic, Mercator, regular lat-lon).
Everything that depends on the grid alone is a Python number folded into the expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

EARTH_M = 6370000.0
LATLON, LAMBERT, POLAR, MERCATOR, CASSINI = 0, 1, 2, 3, 6


@dataclass(frozen=True)
class Domain:
    """A regional grid of ``nx`` x ``ny`` cells.

    For projected grids (lon, lat) is the grid centre and dx the spacing in metres.  For lat-lon
    grids it is the first cell centre and dlon / dlat are the spacings in degrees.
    """

    code: int
    nx: int
    ny: int
    lon: float
    lat: float
    stand_lon: float = 0.0
    truelat1: float = 0.0
    truelat2: float = 0.0
    dx: float = 0.0
    dlon: float = 0.0
    dlat: float = 0.0

    def __post_init__(self):
        if self.code not in (LATLON, LAMBERT, POLAR, MERCATOR, CASSINI):
            raise ValueError(f"unknown projection code {self.code}")

    @property
    def is_latlon(self) -> bool:
        return self.code in (LATLON, CASSINI)

    @property
    def centre(self) -> tuple[float, float]:
        return (self.nx + 1) / 2.0, (self.ny + 1) / 2.0

    @property
    def hemi(self) -> float:
        return -1.0 if self.truelat1 < 0 else 1.0

    @property
    def scale(self) -> float:
        return EARTH_M / self.dx

    @property
    def second_truelat(self) -> float:
        return self.truelat1 if abs(self.truelat2) > 90 else self.truelat2

    @property
    def cone(self) -> float:
        a, b = self.truelat1, self.second_truelat
        if abs(a - b) <= 0.1:
            return math.sin(math.radians(abs(a)))
        num = math.log10(math.cos(math.radians(a))) - math.log10(math.cos(math.radians(b)))
        den = math.log10(math.tan(math.radians(45 - abs(a) / 2))) - math.log10(math.tan(math.radians(45 - abs(b) / 2)))
        return num / den


def domain_of(attributes: dict) -> Domain:
    """A domain from the usual grid attributes (MAP_PROJ, CEN_LON, CEN_LAT, STAND_LON, TRUELAT1/2, DX and the size)."""
    a = {k.lower(): v for k, v in attributes.items()}
    return Domain(a["map_proj"], a["nx"], a["ny"], a["cen_lon"], a["cen_lat"], a["stand_lon"], a["truelat1"], a["truelat2"], a["dx"])


def latlon_domain(lons: list[float], lats: list[float], nx: int, ny: int) -> Domain:
    """A lat-lon domain from the first two cell centres in each direction."""
    return Domain(LATLON, nx, ny, lons[0], lats[0], dlon=lons[1] - lons[0], dlat=lats[1] - lats[0])


def _turn(deg: Column) -> Column:
    """Angle brought into (-180, 180] by one turn."""
    return F.when(deg > 180, deg - 360.0).when(deg < -180, deg + 360.0).otherwise(deg)


def _lambert(g: Domain) -> tuple[float, float, float]:
    """(radius factor, pole i, pole j)."""
    k = g.scale * math.cos(math.radians(g.truelat1)) / g.cone
    ref = math.tan(math.radians((90 * g.hemi - g.truelat1) / 2))
    r = k * (math.tan(math.radians((90 * g.hemi - g.lat) / 2)) / ref) ** g.cone
    d = (g.lon - g.stand_lon + 180) % 360 - 180
    arg = g.cone * math.radians(d)
    ki, kj = g.centre
    return k, g.hemi * ki - g.hemi * r * math.sin(arg), g.hemi * kj + r * math.cos(arg)


def _polar(g: Domain) -> tuple[float, float, float]:
    top = 1 + g.hemi * math.sin(math.radians(g.truelat1))
    r = g.scale * math.cos(math.radians(g.lat)) * top / (1 + g.hemi * math.sin(math.radians(g.lat)))
    a = math.radians(g.lon - (g.stand_lon + 90))
    ki, kj = g.centre
    return top, ki - r * math.cos(a), kj - g.hemi * r * math.sin(a)


def _mercator(g: Domain) -> tuple[float, float]:
    step = g.dx / (EARTH_M * math.cos(math.radians(g.truelat1)))
    return step, (math.log(math.tan(math.radians((g.lat + 90) / 2))) / step if g.lat else 0.0)


def llij(g: Domain, lat: Column, lon: Column) -> tuple[Column, Column]:
    """Grid coordinates (i, j) of a point; cell (1, 1) is centred on (1.0, 1.0)."""
    if g.is_latlon:
        return (lon - g.lon) / g.dlon + 1.0, (lat - g.lat) / g.dlat + 1.0
    if g.code == LAMBERT:
        k, pi, pj = _lambert(g)
        ref = math.tan(math.radians((90 * g.hemi - g.truelat1) / 2))
        r = k * F.pow(F.tan(F.radians(90.0 * g.hemi - lat) / 2.0) / ref, F.lit(g.cone))
        arg = g.cone * F.radians(_turn(lon - g.stand_lon))
        return g.hemi * (pi + g.hemi * r * F.sin(arg)), g.hemi * (pj - r * F.cos(arg))
    if g.code == POLAR:
        top, pi, pj = _polar(g)
        r = g.scale * F.cos(F.radians(lat)) * top / (1.0 + g.hemi * F.sin(F.radians(lat)))
        a = F.radians(lon - (g.stand_lon + 90.0))
        return pi + r * F.cos(a), pj + g.hemi * r * F.sin(a)
    step, rsw = _mercator(g)
    ki, kj = g.centre
    i = ki + _turn(lon - g.lon) / math.degrees(step)
    return i, kj + F.log(F.tan(F.radians(lat + 90.0) / 2.0)) / step - rsw


def ijll(g: Domain, i: Column, j: Column) -> tuple[Column, Column]:
    """(lat, lon) of grid coordinates."""
    if g.is_latlon:
        return g.lat + (j - 1.0) * g.dlat, g.lon + (i - 1.0) * g.dlon
    if g.code == LAMBERT:
        _, pi, pj = _lambert(g)
        x, y = g.hemi * i - pi, pj - g.hemi * j
        r2 = x * x + y * y
        r = F.sqrt(r2) / g.scale
        chi1 = math.radians(90 - g.hemi * g.truelat1)
        same = g.truelat1 == g.second_truelat
        ratio = r / math.tan(chi1) if same else r * g.cone / math.sin(chi1)
        chi = 2.0 * F.atan(F.pow(ratio, F.lit(1 / g.cone)) * math.tan(chi1 / 2))
        lat = F.when(r2 == 0, g.hemi * 90.0).otherwise((90.0 - F.degrees(chi)) * g.hemi)
        lon = F.when(r2 == 0, g.stand_lon).otherwise(
            F.pmod(g.stand_lon + F.degrees(F.atan2(g.hemi * x, y)) / g.cone + 360.0, F.lit(360.0))
        )
        return lat, _turn(lon)
    if g.code == POLAR:
        top, pi, pj = _polar(g)
        x, y = i - pi, (j - pj) * g.hemi
        r2, big = x * x + y * y, (g.scale * top) ** 2
        lat = F.when(r2 == 0, g.hemi * 90.0).otherwise(g.hemi * F.degrees(F.asin((big - r2) / (big + r2))))
        turn = F.degrees(F.acos(x / F.sqrt(r2)))
        lon = F.when(r2 == 0, F.lit(0.0)).when(y > 0, turn).otherwise(-turn) + (g.stand_lon + 90.0)
        return lat, _turn(lon)
    step, rsw = _mercator(g)
    ki, kj = g.centre
    lat = 2.0 * F.degrees(F.atan(F.exp(step * (rsw + j - kj)))) - 90.0
    return lat, _turn((i - ki) * math.degrees(step) + g.lon)
