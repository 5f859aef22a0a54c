"""Hourly emissions on regional model grids, with surface-type fractions and fire sizes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from firegrid.functions.geo import nint
from firegrid.functions.projection import EARTH_M, Domain, ijll, llij
from firegrid.operators.speciesmap import check_species, targets

# Relative burning by local hour 0-23.
HOURLY = [.43, .43, .43, .43, .43, .43, .43, .43, .43, 3., 6., 10., 14., 17., 14., 12., 9., 6., 3., .43, .43, .43, .43, .43]
HOURLY_FACTOR = [x / sum(HOURLY) * 24.0 for x in HOURLY]
# mol/m2/day -> mol/km2/h, kg/m2/day -> ug/m2/s, largest fire size (m2).
GAS_FACTOR = 1.0e6 / 24.0
AEROSOL_FACTOR = 1.0e5 / 8.64
MAX_FIRE_M2 = 2.0e6
SURFACE_TYPES = ["tempfor", "tropfor", "shrub", "grass"]


def in_domain(df: DataFrame, domain: Domain, lon: str = "cen_lon", lat: str = "cen_lat") -> DataFrame:
    """Add the cell (i, j) and drop points outside the domain."""
    x, y = llij(domain, F.col(lat), F.col(lon))
    return (
        df.withColumn("_x", x).withColumn("_y", y)
        .where((F.col("_x") >= 0.5) & (F.col("_x") < domain.nx + 0.5) & (F.col("_y") >= 0.5) & (F.col("_y") < domain.ny + 0.5))
        .withColumn("i", nint(F.col("_x"))).withColumn("j", nint(F.col("_y"))).drop("_x", "_y")
    )


def per_m2(domain: Domain, i: Column, j: Column, legacy_area: bool = False) -> Column:
    """1 / cell area (1/m2); ``legacy_area`` takes the latitude step for the longitude step of lat-lon domains."""
    if not domain.is_latlon:
        return F.lit(1.0 / domain.dx ** 2)
    south, _ = ijll(domain, i, j - 0.5)
    north, _ = ijll(domain, i, j + 0.5)
    width = EARTH_M * math.radians(domain.dlat if legacy_area else domain.dlon)
    return 1.0 / (EARTH_M * width * (F.sin(F.radians(north)) - F.sin(F.radians(south))))


def grid_wrf(emissions: DataFrame, domain: Domain, species_map: DataFrame, size: str = "area_m2",
             date: str = "acq_date_utc", lon: str = "cen_lon", lat: str = "cen_lat", legacy_area: bool = False) -> DataFrame:
    """(date, hour, i, j, fire_size, one ebu_in_* column per species).

    Gases in mol/km2/h, aerosols in ug/m2/s.  The hour only enters through the whole-hour offset of
    the longitude, so fires are summed per (day, cell, offset) before the 24 hours are made.
    """
    ts = targets(species_map)
    check_species(species_map, emissions.columns)
    sources = sorted({s for t in ts for s, _ in t.terms})
    offset = F.floor(F.pmod(F.col(lon) + 360.0, F.lit(360.0)) / 15.0).cast("int")
    cells = (
        in_domain(emissions, domain, lon, lat).withColumn("_offset", offset)
        .groupBy(F.col(date).alias("date"), "i", "j", "_offset")
        .agg(F.sum(size).alias("_size"), *[F.sum(s).alias(s) for s in sources])
    )
    profile = F.array(*[F.lit(x) for x in HOURLY_FACTOR])
    hours = cells.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    hours = hours.withColumn("_f", F.element_at(profile, (F.col("hour") + F.col("_offset")) % 24 + 1))

    def flux(t) -> Column:
        return t.total() * F.col("_f") * per_m2(domain, F.col("i"), F.col("j"), legacy_area) * (AEROSOL_FACTOR if t.is_aerosol else GAS_FACTOR)

    return hours.groupBy("date", "hour", "i", "j").agg(
        F.least(F.sum("_size"), F.lit(MAX_FIRE_M2)).alias("fire_size"),
        *[F.sum(flux(t)).alias(f"ebu_in_{t.name}") for t in ts],
    )


def surface_fractions(pixels: DataFrame, domain: Domain) -> DataFrame:
    """Share of each surface type among the flagged pixels of a cell: (i, j, frac_<type>..., n_flagged, n_pixels).

    ``pixels``: (lon, lat, one 0/1 column per surface type).
    """
    inside = in_domain(pixels, domain, "lon", "lat")
    counts = inside.groupBy("i", "j").agg(
        F.count("*").alias("n_pixels"), *[F.count_if(F.col(t) == 1).alias(f"_n_{t}") for t in SURFACE_TYPES]
    )
    total = sum((F.col(f"_n_{t}") for t in SURFACE_TYPES), F.lit(0))
    return counts.select(
        "i", "j", *[F.when(F.col(f"_n_{t}") != 0, F.col(f"_n_{t}") / total).otherwise(0.0).alias(f"frac_{t}") for t in SURFACE_TYPES],
        total.alias("n_flagged"), "n_pixels",
    )


def surface_conflicts(fractions: DataFrame) -> DataFrame:
    """Cells where pixels carry more than one surface type (bad input)."""
    return fractions.where("n_flagged > n_pixels")


def fire_size_by_type(hourly: DataFrame, fractions: DataFrame) -> DataFrame:
    """Split the fire size of each cell and hour by surface type."""
    out = hourly.join(fractions, ["i", "j"], "left")
    return out.select(*hourly.columns, *[
        (F.coalesce(F.col(f"frac_{t}"), F.lit(0.0)) * F.col("fire_size")).alias(f"fire_size_{t}") for t in SURFACE_TYPES
    ])
