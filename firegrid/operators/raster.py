"""Operations on pixel tables: regridding, burn dates, point sampling, tiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from firegrid.functions.geo import SINUSOIDAL_R
from firegrid.operators.components import connected_components

WATER = 200
PIXELS_PER_TILE = 2400


def sinusoidal_lonlat(h: Column, v: Column, row: Column, col: Column, size: int = PIXELS_PER_TILE) -> tuple[Column, Column]:
    """Centre (lon, lat) of a pixel of a sinusoidal tile; beyond the globe's edge lon exceeds 180."""
    tile = 2 * math.pi * SINUSOIDAL_R / 36.0
    x = ((h - 18) + (col + 0.5) / size) * tile
    y = ((9 - v) - (row + 0.5) / size) * tile
    lat = F.degrees(y / SINUSOIDAL_R)
    return F.degrees(x / (SINUSOIDAL_R * F.cos(F.radians(lat)))), lat


def lonlat_cell(lon: Column, lat: Column, res: float) -> tuple[Column, Column]:
    return F.floor(lon / res).alias("ix"), F.floor(lat / res).alias("iy")


def regrid_pixels(pixels: DataFrame, res: float, how: str, bands: list[str], water_is_bare: bool = False) -> DataFrame:
    """Pixels (lon, lat, bands...) -> regular cells (iy, ix, bands...).

    ``mode``: most frequent value, the smaller one on ties (classes).  ``average``: mean (cover
    fractions); with ``water_is_bare`` a water pixel counts as tree 0, herb 0, bare 100.
    ``nearest``: the pixel closest to the cell centre.  All of them aggregate map-side first.
    """
    ix, iy = lonlat_cell(F.col("lon"), F.col("lat"), res)
    if water_is_bare:
        wet = F.col(bands[0]) == WATER
        pixels = pixels.select("lon", "lat", *[
            F.when(wet, F.lit(100 if b == "bare" else 0)).otherwise(F.col(b)).alias(b) for b in bands
        ])
    df = pixels.select("lon", "lat", iy, ix, *bands)
    if how == "average":
        return df.groupBy("iy", "ix").agg(*[F.avg(b).alias(b) for b in bands])
    if how == "mode":
        (band,) = bands
        counted = df.groupBy("iy", "ix", band).agg(F.count("*").alias("_n"))
        best = F.max(F.struct(F.col("_n"), (-F.col(band)).alias("_neg"), F.col(band).alias("v")))
        return counted.groupBy("iy", "ix").agg(best["v"].alias(band))
    if how == "nearest":
        dx, dy = F.col("lon") - (F.col("ix") + 0.5) * res, F.col("lat") - (F.col("iy") + 0.5) * res
        first = F.min(F.struct((dx * dx + dy * dy).alias("d2"), "lat", "lon", F.struct(*bands).alias("v")))
        return df.groupBy("iy", "ix").agg(first["v"].alias("v")).select("iy", "ix", "v.*")
    raise ValueError(f"how must be 'mode', 'average' or 'nearest', got {how!r}")


def burn_date_points(pixels: DataFrame, year: int) -> DataFrame:
    """Burned pixels (value = day of year > 0) as dated points at the pixel centre."""
    first = F.lit(f"{year}-01-01").cast("date")
    return pixels.where("value > 0").select(
        "iy", "ix", "lon", "lat", F.lit(year).alias("burn_year"), F.date_add(first, F.col("value").cast("int") - 1).alias("burn_date")
    )


def burn_date_regions(pixels: DataFrame) -> DataFrame:
    """Burned pixels with the region of equal, edge-connected values they belong to.

    A pixel looks right and up only, so every link is found once; ``region`` is the smallest pixel id.
    """
    burned = pixels.where("value > 0").select("iy", "ix", "value").withColumn("pixel", F.struct("iy", "ix"))
    here = burned.select(F.col("pixel").alias("src"), "value", F.explode(F.array(
        F.struct(F.col("iy").alias("ny"), (F.col("ix") + 1).alias("nx")), F.struct((F.col("iy") + 1).alias("ny"), F.col("ix").alias("nx"))
    )).alias("n")).select("src", "value", F.col("n.ny").alias("iy"), F.col("n.nx").alias("ix"))
    links = here.join(burned, ["iy", "ix", "value"]).select("src", F.col("pixel").alias("dst"))
    labels = connected_components(links, burned, "src", "dst", "pixel")
    return burned.join(labels.withColumnRenamed("node", "pixel"), "pixel").select(
        "iy", "ix", "value", F.col("component").alias("region"), "n_nodes"
    )


def nearest_cell(points: DataFrame, grid: DataFrame, x0: float, y0: float, dx: float, dy: float, nx: int, ny: int,
                 lon: str = "cen_lon", lat: str = "cen_lat") -> DataFrame:
    """Add ``value`` of the regular-grid cell holding the point; points outside take the edge cell; -1 counts as 0.

    (x0, y0) is the centre of cell (1, 1).
    """
    def cell(c: str, origin: float, step: float, n: int) -> Column:
        return F.greatest(F.lit(1), F.least(F.lit(n), F.floor((F.col(c) - origin) / step + 0.5).cast("int") + 1))

    at = points.withColumn("gi", cell(lon, x0, dx, nx)).withColumn("gj", cell(lat, y0, dy, ny))
    values = grid.select("gi", "gj", F.when(F.col("value") == -1, 0).otherwise(F.col("value")).alias("value"))
    return at.join(values, ["gi", "gj"], "left")


def average_2x2(points: DataFrame, grid: DataFrame, row_id: str, x0: float, y0: float, dx: float, dy: float, nx: int, ny: int,
                lon: str = "cen_lon", lat: str = "cen_lat") -> DataFrame:
    """Add ``average``: whole-number mean of the 2 x 2 cells around the point.

    The pair in each direction is the point's cell and the neighbour on its side of the centre; at
    the grid edge the pair has one cell.  The divisor is the number of cells; division truncates.
    """
    def span(c: str, origin: float, step: float, n: int) -> Column:
        at = F.greatest(F.lit(1), F.least(F.lit(n), F.floor((F.col(c) - origin) / step + 0.5).cast("int") + 1))
        low = F.greatest(F.lit(1), F.when(F.col(c) >= origin + (at - 1) * step, at).otherwise(at - 1))
        return F.sequence(low, F.least(F.lit(n), low + 1))

    cells = points.select(row_id, F.explode(span(lon, x0, dx, nx)).alias("gi"), span(lat, y0, dy, ny).alias("_js"))
    cells = cells.withColumn("gj", F.explode("_js")).drop("_js")
    values = grid.select("gi", "gj", F.when(F.col("value") == -1, 0).otherwise(F.col("value")).alias("value"))
    mean = cells.join(values, ["gi", "gj"], "left").groupBy(row_id).agg(
        F.expr("sum(coalesce(value, 0)) div count(*)").alias("average")
    )
    return points.join(mean, row_id, "left")
