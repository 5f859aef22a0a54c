"""Emissions on global grids: regular, Gaussian-like and unstructured."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from firegrid.functions.geo import nint, point_in_ring, wrap_lon
from firegrid.operators.joins import hot_lookup, split_hot_bins
from firegrid.operators.speciesmap import Target, check_species, targets
from firegrid.session import cut

# Earth radius (m), Avogadro's number, seconds per day.
EARTH_M = 6.37122e6
AVOGADRO = 6.022e23
DAY_S = 86400.0
PER_DAY = AVOGADRO / DAY_S

# Supported grids (name -> longitudes, latitudes, first centre at the pole).
GRIDS = {
    "0.1x0.1": (3600, 1800, False),
    "0.25x0.25": (1440, 720, False),
    "0.5x0.5": (720, 360, False),
    "1x1": (360, 180, False),
    "T42LR": (128, 64, True),
    "T63LR": (192, 96, True),
    "T85LR": (256, 128, True),
    "T106LR": (320, 160, True),
    "T170LR": (512, 256, True),
    "1.9x2.5": (144, 96, True),
    "0.9x1.25": (288, 192, True),
}


@dataclass(frozen=True)
class Grid:
    name: str
    nlon: int
    nlat: int
    polar: bool

    @property
    def dlon(self) -> float:
        return 360.0 / self.nlon

    @property
    def dlat(self) -> float:
        return 180.0 / (self.nlat - 1) if self.polar else 180.0 / self.nlat

    @property
    def lon0(self) -> float:
        return 0.0 if self.polar else self.dlon / 2

    @property
    def lat0(self) -> float:
        return -90.0 if self.polar else -90.0 + self.dlat / 2


def grid(name: str) -> Grid:
    if name not in GRIDS:
        raise ValueError(f"unknown grid {name!r}; one of {sorted(GRIDS)}")
    return Grid(name, *GRIDS[name])


def cell_cm2(g: Grid, j: Column, legacy_pole_area: bool = False) -> Column:
    """Area of a cell of row j (1-based) in cm2.

    Rows on the poles are half cells.  ``legacy_pole_area`` gives them the much larger value some
    published grids were made with.
    """
    ring = 4.0e4 * math.pi * EARTH_M ** 2 / g.nlon
    half = math.radians(g.dlat / 2)
    body = ring * math.sin(half) * F.cos(F.radians(g.lat0 + (j - 1) * g.dlat))
    if not g.polar:
        return body
    pole = ring * math.sin(half) * math.cos(half / 2) if legacy_pole_area else ring * math.sin(half / 2) ** 2
    return F.when((j == 1) | (j == g.nlat), pole).otherwise(body)


def regular_grid(spark: SparkSession, name: str, legacy_pole_area: bool = False) -> DataFrame:
    """All cells: (i, j, lon, lat, area_cm2)."""
    g = grid(name)
    cells = spark.range(g.nlon * g.nlat).select(
        (F.col("id") % g.nlon + 1).cast("int").alias("i"), (F.floor(F.col("id") / g.nlon) + 1).cast("int").alias("j")
    )
    return cells.select(
        "i", "j", (g.lon0 + (F.col("i") - 1) * g.dlon).alias("lon"), (g.lat0 + (F.col("j") - 1) * g.dlat).alias("lat"),
        cell_cm2(g, F.col("j"), legacy_pole_area).alias("area_cm2"),
    )


def cell_index(g: Grid, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Cell (i, j) of a point: nearest centre, wrapping eastward, kept inside at the poles."""
    x = (wrap_lon(lon) - g.lon0) / g.dlon + 1.0
    x = F.when(x > g.nlon + 0.5, x - g.nlon).otherwise(x)
    i = (nint(x) - 1) % g.nlon + 1
    j = F.least(nint((lat - g.lat0) / g.dlat + 1.0), F.lit(g.nlat))
    return i.cast("int"), j.cast("int")


def _sources(ts: list[Target]) -> list[str]:
    return sorted({s for t in ts for s, _ in t.terms})


def _density(t: Target, per_cell: Column) -> Column:
    value = t.total() * per_cell
    return value * 1e3 / t.mw if t.is_aerosol else value


def _melt(df: DataFrame, keys: list[str], ts: list[Target]) -> DataFrame:
    return df.unpivot(keys, [t.name for t in ts], "species", "value")


def grid_daily(emissions: DataFrame, species_map: DataFrame, name: str, date: str = "acq_date_utc",
               lon: str = "cen_lon", lat: str = "cen_lat", legacy_pole_area: bool = False) -> DataFrame:
    """Molecules/cm2/s per species, day and cell (sparse): (species, date, i, j, value).

    The inventory columns are summed per (day, cell) first; the map is linear, so it is applied to
    the few summed rows.  One shuffle.
    """
    ts = targets(species_map)
    check_species(species_map, emissions.columns)
    g = grid(name)
    i, j = cell_index(g, F.col(lon), F.col(lat))
    sums = (
        emissions.select(F.col(date).alias("date"), i.alias("i"), j.alias("j"), *_sources(ts))
        .groupBy("date", "i", "j").agg(*[F.sum(s).alias(s) for s in _sources(ts)])
    )
    per_cell = PER_DAY / cell_cm2(g, F.col("j"), legacy_pole_area)
    wide = sums.select("date", "i", "j", *[_density(t, per_cell).alias(t.name) for t in ts])
    return _melt(wide, ["date", "i", "j"], ts).select("species", "date", "i", "j", "value")


def grid_monthly(emissions: DataFrame, species_map: DataFrame, name: str, date: str = "acq_date_utc",
                 lon: str = "cen_lon", lat: str = "cen_lat", legacy_pole_area: bool = False) -> DataFrame:
    """Mean over all days of each month, days without fires counting as zero: (species, month, i, j, value).

    Fires are summed per (month, cell) directly; no daily table is made.
    """
    by_month = emissions.withColumn("_month", F.trunc(date, "month"))
    sums = grid_daily(by_month, species_map, name, "_month", lon, lat, legacy_pole_area)
    days = F.dayofmonth(F.last_day("date"))
    return sums.select("species", F.col("date").alias("month"), "i", "j", (F.col("value") / days).alias("value"))


def monthly_mean(daily: DataFrame, keys: tuple[str, ...] = ("i", "j")) -> DataFrame:
    """The same from stored daily values: (species, month, ..., value)."""
    sums = daily.groupBy("species", F.trunc("date", "month").alias("month"), *keys).agg(F.sum("value").alias("total"))
    return sums.withColumn("value", F.col("total") / F.dayofmonth(F.last_day("month"))).drop("total")


def dense(sparse: DataFrame, name: str, date: str = "date") -> DataFrame:
    """Fill cells without fires with zero, for every (species, date) present.

    Each key makes its own rows of cells, and the rows are spread before the cells are made.
    """
    g = grid(name)
    rows = sparse.select("species", date).distinct().withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(g.nlat))))
    cells = rows.repartition("species", date, "j").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(g.nlon))))
    return cells.join(sparse, ["species", date, "i", "j"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


# -- unstructured grids ---------------------------------------------------------------------------

def trim_corners(cells: DataFrame) -> DataFrame:
    """Build rings from corner arrays, dropping repeats of the last vertex; fewer than 3 is an error.

    ``cells``: (cell, lon, lat, area_sr, corner_lon array, corner_lat array).
    """
    pts = F.zip_with("corner_lon", "corner_lat", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    last = F.element_at("_all", -1)
    # Count the run of equal vertices at the end; an equal vertex earlier in the ring stays.
    same = lambda p: (p["x"] == last["x"]) & (p["y"] == last["y"])
    repeats = F.aggregate(
        F.reverse("_all"), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda acc, p: F.struct(
            (acc["n"] + (acc["on"] & same(p)).cast("int")).alias("n"), (acc["on"] & same(p)).alias("on")
        ),
        lambda acc: acc["n"],
    )
    run = F.size("_all") - repeats + 1
    ringed = cells.withColumn("_all", pts).withColumn("ring", F.slice("_all", F.lit(1), run))
    checked = F.when(F.size("ring") < 3, F.raise_error(F.concat(F.lit("cell with fewer than 3 corners: "), F.col("cell")))).otherwise(F.col("ring"))
    return ringed.withColumn("ring", checked).drop("_all")


def mark_grid_cells(cells: DataFrame) -> DataFrame:
    """Bring longitudes to [-180, 180]; flag polar caps (inactive) and cells crossing 180 degrees.

    A cell whose vertices lie in more than two longitude quadrants surrounds a pole.  A cell with
    vertices in the two quadrants next to 180 degrees crosses it; its negative longitudes move by 360.
    """
    ring = F.transform("ring", lambda p: F.struct(F.when(p["x"] > 180, p["x"] - 360.0).otherwise(p["x"]).alias("x"), p["y"].alias("y")))
    quad = F.transform(
        "ring", lambda p: F.when(p["x"].between(0, 90) & (p["x"] < 90), 1).when((p["x"] >= 90) & (p["x"] < 180), 2)
        .when((p["x"] >= -180) & (p["x"] < -90), 3).when((p["x"] >= -90) & (p["x"] < 0), 4).otherwise(0)
    )
    out = cells.withColumn("ring", ring).withColumn("_q", F.array_remove(F.array_distinct(quad), 0))
    out = out.withColumn("active", F.size("_q") <= 2)
    out = out.withColumn("x180", F.col("active") & F.array_contains("_q", 2) & F.array_contains("_q", 3))
    shifted = F.transform("ring", lambda p: F.struct(F.when(F.col("x180") & (p["x"] < 0), p["x"] + 360.0).otherwise(p["x"]).alias("x"), p["y"].alias("y")))
    return out.withColumn("ring", shifted).drop("_q")


def locate_cells(points: DataFrame, cells: DataFrame, row_id: str, lon: str = "cen_lon", lat: str = "cen_lat",
                 bin_deg: float = 2.0) -> DataFrame:
    """Add ``cell``: first active cell (in index order) holding the point, null if none.

    Cells are listed in the bins of their envelope; a point meets the cells of its bin only, and
    bins crowded with points are split.  Longitudes above 180 count as negative.
    """
    x = F.when(F.col(lon) > 180, F.col(lon) - 360.0).otherwise(F.col(lon))
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    shapes = cells.where("active").select(
        F.col("cell").alias("_cell"), "ring",
        F.array_min(xs).alias("bx0"), F.array_max(xs).alias("bx1"), F.array_min(ys).alias("by0"), F.array_max(ys).alias("by1"),
    )
    listed = shapes.withColumn("_bx", F.explode(F.sequence(F.floor(F.col("bx0") / bin_deg), F.floor(F.col("bx1") / bin_deg)))).withColumn(
        "_by", F.explode(F.sequence(F.floor(F.col("by0") / bin_deg), F.floor(F.col("by1") / bin_deg)))
    )
    here = points.select(row_id, x.alias("_x"), F.col(lat).alias("_y"))
    # A cell across 180 degrees has longitudes up to 360: points west of it look there as well.
    here = here.withColumn("_x", F.explode(F.when(F.col("_x") < 0, F.array("_x", F.col("_x") + 360.0)).otherwise(F.array("_x"))))
    here = here.withColumn("_bx", F.floor(F.col("_x") / bin_deg)).withColumn("_by", F.floor(F.col("_y") / bin_deg))
    a, b = split_hot_bins(here, listed, ["_bx", "_by"], row_id, 50_000)
    hits = (
        a.join(b, ["_bx", "_by", "_salt"])
        .where(F.col("_x").between(F.col("bx0"), F.col("bx1")) & F.col("_y").between(F.col("by0"), F.col("by1")))
        .where(point_in_ring(F.col("ring"), F.col("_x"), F.col("_y")))
        .groupBy(row_id).agg(F.min("_cell").alias("cell"))
    )
    return points.join(hits, row_id, "left")


def locate_fires(fires: DataFrame, cells: DataFrame, lon: str = "cen_lon", lat: str = "cen_lat", bin_deg: float = 2.0) -> DataFrame:
    """Add ``cell`` to every row of ``fires``: each distinct place is looked up once, without the fires' columns.

    Rows without a place have no cell, as ``locate_cells`` has it.
    """
    places = fires.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).groupBy(lon, lat).agg(F.count(F.lit(1)).alias("_n"))
    named = cut(places.withColumn("_place", F.struct(lon, lat)))
    found = cut(locate_cells(named, cells, "_place", lon, lat, bin_deg).select(lon, lat, "cell", "_n"))
    spread_ = fires.withColumn("_spread", F.xxhash64(*[F.col(c) for c in fires.columns]))
    return hot_lookup(spread_, found, [lon, lat], "_n", "_spread").drop("_n", "_spread")


def unlocated(located: DataFrame, sums: list[str], date: str = "acq_date_utc") -> DataFrame:
    """(date, n_fires, sums...): what lies in no active cell and so is missing from the unstructured grid, per day.

    Days without such fires have no row; with these rows the grid's sums add up to those of the fires.
    """
    outside = located.where("cell is null").groupBy(F.col(date).alias("date"))
    return outside.agg(F.count(F.lit(1)).alias("n_fires"), *[F.sum(c).alias(c) for c in sums])


def grid_unstructured(located: DataFrame, cells: DataFrame, species_map: DataFrame, date: str = "acq_date_utc") -> DataFrame:
    """Molecules/cm2/s per species, day and cell of an unstructured grid.  Fires without a cell are left out and counted by ``unlocated``."""
    ts = targets(species_map)
    check_species(species_map, located.columns)
    sums = (
        located.where("cell is not null").groupBy(F.col(date).alias("date"), "cell")
        .agg(*[F.sum(s).alias(s) for s in _sources(ts)])
    )
    per_cell = PER_DAY / (1.0e4 * EARTH_M ** 2) / F.col("area_sr")
    wide = sums.join(cells.select("cell", "area_sr"), "cell").select("date", "cell", *[_density(t, per_cell).alias(t.name) for t in ts])
    return _melt(wide, ["date", "cell"], ts).select("species", "date", "cell", "value")


def day_islands(days: DataFrame, file: str = "file", year: str = "year", day: str = "day") -> DataFrame:
    """Runs of covered days: (file, first, last, n_days, missing), and one row with null days per file for bad numbers.

    ``days``: one row per record, with the file it stems from, the year and the day of the year.  ``missing``
    are the days up to the next run of the file (0 for the last), over the turn of the year and with leap
    days.  The row without ``first`` counts in ``n_days`` the records whose day is below 1 or beyond the
    year's end, or null.  Days are made distinct before they are put in order, so a file's window holds days, not records.
    """
    last = F.dayofyear(F.make_date(F.col(year), F.lit(12), F.lit(31)))
    good = F.coalesce(F.col(day).between(1, last), F.lit(False))
    at = F.date_add(F.make_date(F.col(year), F.lit(1), F.lit(1)), F.col(day).cast("int") - 1)
    bad = days.where(~good).groupBy(F.col(file).alias("file")).agg(F.count(F.lit(1)).alias("n_days"))
    seen = days.where(good).select(F.col(file).alias("file"), at.alias("at")).distinct()
    return _islands(seen, ["file"]).unionByName(bad.select(
        "file", F.lit(None).cast("date").alias("first"), F.lit(None).cast("date").alias("last"), "n_days", F.lit(0).cast("long").alias("missing")))


def _islands(days: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of following days of distinct (keys, at)."""
    line = Window.partitionBy(*keys).orderBy("at")
    run = F.date_sub("at", F.row_number().over(line))
    runs = days.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n_days"))
    following = F.lead("first").over(Window.partitionBy(*keys).orderBy("first"))
    gap = F.coalesce(F.date_diff(following, "last") - 1, F.lit(0)).cast("long")
    return runs.select(*keys, "first", "last", "n_days", gap.alias("missing"))


def period_gaps(dates: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """(first, last, n_days): the days of a period without any record, as runs; no row if all are covered.

    Whole-span checks (``validate_period``) do not see days missing inside.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = dates.select(F.col(date).cast("date").alias("at")).where(F.col("at").between(lo, hi)).distinct()
    # The days around the period close it on both sides.
    ends = dates.sparkSession.range(1).select(F.explode(F.array(F.date_sub(lo, 1), F.date_add(hi, 1))).alias("at"))
    following = F.lead("at").over(Window.orderBy("at"))
    gaps = inside.unionByName(ends).select(F.date_add("at", 1).alias("first"), F.date_sub(following, 1).alias("last"))
    return gaps.where("first <= last").select("first", "last", (F.date_diff("last", "first") + 1).cast("long").alias("n_days"))


def validate_period(dates: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """Check rows (check, ok) for a requested period against the dates of an inventory."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    seen = dates.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    return seen.select(F.explode(F.array(
        F.struct(F.lit("start not after end").alias("check"), (lo <= hi).alias("ok")),
        F.struct(F.lit("start covered").alias("check"), F.coalesce(F.col("first") <= lo, F.lit(False)).alias("ok")),
        F.struct(F.lit("end covered").alias("check"), F.coalesce(F.col("last") >= hi, F.lit(False)).alias("ok")),
    )).alias("c")).select("c.*")
