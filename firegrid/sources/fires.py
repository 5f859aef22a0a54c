"""Readers of processed-fire and emission tables, pixel tables and polygon layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from firegrid.operators.grid import mark_grid_cells, trim_corners

# Columns of a processed-fire file.
FIRE_COLUMNS = [
    ("polyid", "long"), ("fireid", "long"), ("cen_lon", "double"), ("cen_lat", "double"), ("acq_date_utc", "date"),
    ("area_sqkm", "double"), ("alg_agg", "int"), ("v_lct", "int"), ("f_lct", "double"), ("v_tree", "double"),
    ("v_herb", "double"), ("v_bare", "double"), ("v_regnum", "int"), ("v_frp", "double"),
]
MIN_TOKENS = 13
DEFAULT_FIRE_M2 = 2.5e5
SHORT_FORM = ("alg_agg", "v_frp")


def read_processed_fires(spark: SparkSession, path: str, short: bool = False) -> DataFrame:
    """Processed fires from CSV.  Rows with too few tokens are dropped; empty numbers count as 0.

    ``short`` reads the 12-column layout without algorithm flag and radiative power; there every
    token must be present.
    """
    cols = [(n, t) for n, t in FIRE_COLUMNS if not (short and n in SHORT_FORM)]
    need = len(cols) if short else MIN_TOKENS
    parts = spark.read.text(path).where(~F.lower("value").startswith("polyid")).select(F.split("value", ",").alias("p"))
    good = parts.where(F.size("p") == need if short else F.size("p") >= need)

    def token(i: int, kind: str):
        text = F.trim(F.regexp_replace(F.get("p", F.lit(i)), "\r", ""))
        if kind == "date":
            return text.try_cast("date")
        # Whole numbers may be written with a fraction ("12.0").
        value = F.coalesce(text.try_cast("double"), F.lit(0.0))
        return value if kind == "double" else F.when(text.rlike(r"^-?\d+$"), text.try_cast(kind)).otherwise(value.cast(kind))

    return good.select(*[token(i, t).alias(n) for i, (n, t) in enumerate(cols)])


def read_emissions(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Emission text of either generation, detected from its header.

    The files carry a day of year only; the year is given or stands as four digits in the file name.
    Returns day, acq_date_utc (null without a year), polyid, fireid, genveg, lat, lon, area (default size where the file has none) and
    the species columns under their own names.
    """
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    names = [c.strip() for c in raw.columns]
    while names[-1] and not names[-1][-1].isalnum():
        names[-1] = names[-1][:-1]
    raw = raw.toDF(*names)
    second = {"POLYID", "FIREID"} <= set(names)
    lead = ["DAY", "POLYID", "FIREID", "GENVEG", "LATI", "LONGI"] if second else ["DAY", "TIME", "GENVEG", "LATI", "LONGI"]
    species = [n for n in names if n not in lead and n not in ("AREA", "BMASS", "FRP")]

    def num(c: str, kind: str = "double"):
        return F.col(f"`{c}`").try_cast(kind)

    ids = [num("POLYID", "long").alias("polyid"), num("FIREID", "long").alias("fireid")] if second else []
    area = num("AREA") if "AREA" in names else F.lit(DEFAULT_FIRE_M2)
    rest = [num(c).alias(c.lower()) for c in ("BMASS", "FRP") if c in names]
    named = F.regexp_extract(F.element_at(F.split(F.input_file_name(), "/"), -1), r"(?<!\d)((?:19|20)\d\d)(?!\d)", 1).try_cast("int")
    of = F.lit(year) if year is not None else named
    date = F.date_add(F.make_date(of, F.lit(1), F.lit(1)), num("DAY", "int") - 1)
    return raw.select(
        num("DAY", "int").alias("day"), date.alias("acq_date_utc"), *ids, num("GENVEG", "int").alias("genveg"), num("LATI").alias("cen_lat"),
        num("LONGI").alias("cen_lon"), area.alias("area_m2"), *rest, *[num(s).alias(s) for s in species],
    )


def emissions_long(df: DataFrame, species: list[str]) -> DataFrame:
    keys = [c for c in df.columns if c not in species]
    return df.unpivot(keys, species, "species", "emission")


def read_pixels(spark: SparkSession, path: str, bands: list[str], valid_range: tuple[float, float] | None = None, nodata: int | None = None) -> DataFrame:
    """Pixel table (iy, ix, bands...[, tile]) from Parquet; invalid values become null, filters reach the scan.

    The ``tile`` a table is partitioned by (``sinks.write_pixels``) stays, for joins to read only theirs.
    """
    df = spark.read.parquet(path)
    tile = [c for c in ("tile",) if c in df.columns]
    df = df.select("iy", "ix", *bands, *tile)

    def clean(b: str):
        ok = F.lit(True)
        if nodata is not None:
            ok = ok & (F.col(b) != nodata)
        if valid_range is not None:
            ok = ok & F.col(b).between(*valid_range)
        return F.when(ok, F.col(b)).alias(b)

    return df.select("iy", "ix", *[clean(b) for b in bands], *tile)


def read_surface_types(spark: SparkSession, path: str, window: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Surface-type flags (lon, lat, tempfor, tropfor, shrub, grass); only a lon/lat window is read."""
    df = spark.read.parquet(path)
    if window is not None:
        x0, y0, x1, y1 = window
        df = df.where(F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1))
    return df.select("lon", "lat", "tempfor", "tropfor", "shrub", "grass")


def read_regions(spark: SparkSession, path: str, variable_in: str = "Region_num") -> DataFrame:
    """Region rings (region_num, ring array<struct<x,y>>) from Parquet; the number column must exist."""
    df = spark.read.parquet(path)
    if variable_in not in df.columns:
        raise ValueError(f"{path}: no column {variable_in}; found {df.columns}")
    return df.select(F.col(variable_in).cast("int").alias("region_num"), "ring")


def read_model_polygons(spark: SparkSession, path: str) -> DataFrame:
    """Unstructured grid (cell, lon, lat, area_sr, ring): corners trimmed, caps and 180-degree cells marked."""
    return mark_grid_cells(trim_corners(spark.read.parquet(path)))
