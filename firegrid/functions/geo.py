"""Column functions on longitude/latitude geometry."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Sphere radius used for pixel sizes (km), pixel scale, nominal fire sizes (km).
EARTH_KM = 6370.997
GREAT_CIRCLE_KM = 2.0 * math.pi * EARTH_KM
PIXEL_SCALE = 1.1
FIRE_KM = {"MODIS": 1.0, "VIIRS": 0.375}
# Radius of the sinusoidal tile grid (m), WGS84 axes.
SINUSOIDAL_R = 6371007.181
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
WGS84_B = WGS84_A * (1.0 - WGS84_F)
WGS84_E = math.sqrt(WGS84_F * (2.0 - WGS84_F))


def nint(x: Column) -> Column:
    """Nearest whole number, halves away from zero."""
    return F.round(x).cast("int")


def wrap_lon(lon: Column) -> Column:
    """Longitude in [0, 360)."""
    return F.when(lon < 0, F.pmod(lon + 360.0, F.lit(360.0))).otherwise(lon)


def half_width_deg(size_km: Column) -> Column:
    return size_km * (0.5 * 360.0 / GREAT_CIRCLE_KM)


def authalic_q(lat_deg: Column) -> Column:
    """The latitude factor whose difference gives the area of an ellipsoidal zone."""
    s = F.sin(F.radians(lat_deg))
    e = WGS84_E
    return s / (1.0 - (e * e) * s * s) + F.log((1.0 + e * s) / (1.0 - e * s)) / (2.0 * e)


def zone_area_km2(width_deg: Column, south: Column, north: Column) -> Column:
    """Ellipsoidal area between two parallels over a longitude width."""
    k = WGS84_B * WGS84_B / 2.0 / 1.0e6
    return k * F.radians(width_deg) * (authalic_q(north) - authalic_q(south))


def box_area_km2(lat: Column, dx: Column, dy: Column) -> Column:
    """Ellipsoidal area of a box given its centre latitude and half widths."""
    return zone_area_km2(2.0 * dx, lat - dy, lat + dy)


def polsby_popper(area: Column, perimeter: Column) -> Column:
    """Compactness 4 pi A / P^2; 0 for degenerate shapes."""
    return F.when((area > 0) & (perimeter > 0), 4.0 * math.pi * area / (perimeter * perimeter)).otherwise(0.0)


def modis_tile(lon: Column, lat: Column) -> Column:
    """Name of the 10-degree sinusoidal tile holding a point."""
    h = F.floor(lon * F.cos(F.radians(lat)) / 10.0 + 18.0).cast("int")
    v = F.floor(9.0 - lat / 10.0).cast("int")
    return F.format_string("h%02dv%02d", h, v)


def tile_boundary(h: Column, v: Column, steps: int = 20) -> Column:
    """Boundary of a tile as an array of lon/lat vertices, censored at the edge of the globe."""
    n = F.sequence(F.lit(0), F.lit(steps))
    down = F.transform(n, lambda i: 90.0 - (v + i / steps) * 10.0)
    up = F.reverse(down)

    def side(lats: Column, edge: Column) -> Column:
        return F.transform(
            lats,
            lambda y: F.struct(
                F.greatest(F.lit(-180.0), F.least(
                    F.lit(180.0), (edge - 18.0) * 10.0 / F.greatest(F.cos(F.radians(y)), F.lit(1e-9))
                )).alias("x"),
                y.alias("y"),
            ),
        )

    return F.concat(side(down, h.cast("double")), side(up, h + 1.0))


def _next(ring: Column) -> Column:
    """The ring shifted by one vertex, closing on the first."""
    return F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))


def ring_area(ring: Column) -> Column:
    """Signed planar area of an array of struct(x, y): positive when counter-clockwise."""
    terms = F.zip_with(ring, _next(ring), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t) / 2.0


def point_in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd test; vertices and points on an edge count as inside."""
    nxt = _next(ring)
    crossings = F.zip_with(
        ring, nxt,
        lambda p, q: F.when(
            ((p["y"] > y) != (q["y"] > y))
            & (x < F.try_divide((q["x"] - p["x"]) * (y - p["y"]), q["y"] - p["y"]) + p["x"]), 1
        ).otherwise(0),
    )
    on_edge = F.zip_with(
        ring, nxt,
        lambda p, q: ((q["x"] - p["x"]) * (y - p["y"]) == (q["y"] - p["y"]) * (x - p["x"]))
        & (x >= F.least(p["x"], q["x"])) & (x <= F.greatest(p["x"], q["x"]))
        & (y >= F.least(p["y"], q["y"])) & (y <= F.greatest(p["y"], q["y"])),
    )
    odd = F.aggregate(crossings, F.lit(0), lambda acc, c: acc + c) % 2 == 1
    return odd | F.exists(on_edge, lambda t: t)
