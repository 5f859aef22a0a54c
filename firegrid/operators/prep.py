"""Cleaning of detections: instruments, dates, confidence, anomaly types, tropics, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from firegrid.functions.dates import local_solar_ts
from firegrid.functions.geo import FIRE_KM, PIXEL_SCALE, half_width_deg
from firegrid.functions.text import derive_instrument, is_confident, normalize_hhmm
from firegrid.session import cut

TROPICS_LAT = 23.5
PERSISTENT_TYPES = (1, 2)


def normalize_instrument(df: DataFrame) -> DataFrame:
    """Set ``instrument`` to MODIS or VIIRS and drop rows of unknown origin."""
    given = F.col("instrument") if "instrument" in df.columns else None
    return df.withColumn("instrument", derive_instrument(F.col("satellite"), given)).where("instrument is not null")


def use_date(df: DataFrame, date_definition: str = "UTC") -> DataFrame:
    """Add UTC and local-solar dates and the date the run groups by."""
    if date_definition not in ("UTC", "LST"):
        raise ValueError(f"date_definition must be 'UTC' or 'LST', got {date_definition!r}")
    return (
        df.withColumn("acq_date_utc", F.col("acq_date").cast("date"))
        .withColumn("acq_time_utc", normalize_hhmm(F.col("acq_time")))
        .withColumn("acq_datetime_lst", local_solar_ts(F.col("acq_date_utc"), F.col("acq_time_utc"), F.col("lon")))
        .withColumn("acq_date_lst", F.col("acq_datetime_lst").cast("date"))
        .withColumn("acq_date_use", F.col("acq_date_utc" if date_definition == "UTC" else "acq_date_lst"))
    )


def duplicate_tropics(df: DataFrame, lat: float = TROPICS_LAT) -> DataFrame:
    """Repeat tropical MODIS rows on the next day; ``copy`` is 1 on the repeats.  No shuffle."""
    tropical = (F.col("instrument") == "MODIS") & (F.abs("lat") <= lat)
    day = F.col("copy")
    return (
        df.withColumn("copy", F.explode(F.when(tropical, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .withColumn("acq_date_utc", F.date_add("acq_date_utc", day))
        .withColumn("acq_date_lst", F.date_add("acq_date_lst", day))
        .withColumn("acq_date_use", F.date_add("acq_date_use", day))
        .withColumn("acq_datetime_lst", F.col("acq_datetime_lst") + F.make_dt_interval(day))
    )


def date_range(df: DataFrame, first=None, last=None) -> DataFrame:
    """Inclusive range on the run date; either end may be open.  Applies after the tropics copies."""
    if first is not None:
        df = df.where(F.col("acq_date_use") >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col("acq_date_use") <= F.lit(last).cast("date"))
    return df


def has_type(df: DataFrame, column: str = "anomtype") -> DataFrame:
    """One row: does any detection carry an anomaly type?"""
    return df.agg(F.coalesce(F.bool_or(F.col(column).isNotNull()), F.lit(False)).alias("has_type"))


def drop_persistent(df: DataFrame, types: tuple[int, ...] = PERSISTENT_TYPES) -> DataFrame:
    """Drop volcano and other static sources; rows without a type survive.

    The filter is row-local: when no row carries a type, no row can match one.
    """
    return df.where(F.col("anomtype").isNull() | ~F.col("anomtype").isin(*types))


def only_year(df: DataFrame, year: int, column: str = "acq_date_utc") -> DataFrame:
    """Keep one year; written as a range so that partition and row-group pruning apply."""
    lo, hi = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")
    return df.where(F.col(column).between(lo, hi))


def doy_window(df: DataFrame, start: int, end: int, column: str = "acq_date_utc") -> DataFrame:
    return df.where(F.dayofyear(column).between(start, end))


def pixel_extent(df: DataFrame, mode: str = "aggressive", pixfac: float = PIXEL_SCALE) -> DataFrame:
    """Half widths in degrees of the fire box (fire_dx, fire_dy) and the neighbourhood box (pix_dx, pix_dy)."""
    cos_lat = F.cos(F.radians("lat"))
    size = F.when(F.col("instrument") == "MODIS", FIRE_KM["MODIS"]).otherwise(FIRE_KM["VIIRS"])
    df = df.withColumn("fire_dx", half_width_deg(size) / cos_lat).withColumn("fire_dy", half_width_deg(size))
    if mode == "aggressive":
        return df.withColumn("pix_dx", pixfac * half_width_deg(F.col("scan")) / cos_lat).withColumn(
            "pix_dy", pixfac * half_width_deg(F.col("track"))
        )
    if mode == "conservative":
        return df.withColumn("pix_dx", F.col("fire_dx")).withColumn("pix_dy", F.col("fire_dy"))
    raise ValueError(f"mode must be 'aggressive' or 'conservative', got {mode!r}")


def box(lon: Column, lat: Column, dx: Column, dy: Column) -> Column:
    """A lon/lat rectangle as struct(x0, y0, x1, y1)."""
    return F.struct((lon - dx).alias("x0"), (lat - dy).alias("y0"), (lon + dx).alias("x1"), (lat + dy).alias("y1"))


def prepare(
    df: DataFrame, date_definition: str = "UTC", first=None, last=None, filter_persistent: bool = True
) -> DataFrame:
    """Raw detections -> cleaned points (``work_pnt``).  One pass, no shuffle, valid on streams too.

    ``cleanid`` = 2 * rawid + copy is unique and stable under any partitioning; use ``serial_key``
    when consecutive numbers are wanted.
    """
    df = normalize_instrument(df)
    if "lon" not in df.columns:
        df = df.withColumnRenamed("longitude", "lon").withColumnRenamed("latitude", "lat")
    confidence = F.col("confidence")
    if isinstance(df.schema["confidence"].dataType, (T.FractionalType,)):
        confidence = confidence.cast("int")  # 85.0 of a numeric column is 85; "85.0" of a text column is no whole number
    df = df.withColumn("confident", is_confident(F.col("instrument"), confidence.cast("string")))
    df = duplicate_tropics(use_date(df, date_definition))
    df = date_range(df, first, last).where("confident")
    df = df.withColumn("anomtype", F.col("type").cast("int") if "type" in df.columns else F.lit(0))
    if filter_persistent:
        df = drop_persistent(df)
    df = df.withColumn("cleanid", F.col("rawid") * 2 + F.col("copy"))
    keep = [
        "cleanid", "rawid", "src_file", "lon", "lat", "scan", "track", "acq_date_utc", "acq_time_utc",
        "acq_date_lst", "acq_datetime_lst", "acq_date_use", "instrument", "confident", "anomtype", "frp",
    ]
    return project_output(df, keep)


def project_output(df: DataFrame, fields: list[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in fields if c in df.columns])


def drop_degenerate(df: DataFrame, area: str = "area_sqkm") -> DataFrame:
    """Rows with an area, and with a compactness above zero where that is known (``outline.perimeters``)."""
    kept = df.where(F.col(area) > 0)
    return kept.where(F.col("compactness") > 0) if "compactness" in df.columns else kept


def serial_key(df: DataFrame, order: list[str], name: str = "serial", start: int = 0) -> DataFrame:
    """Consecutive numbers in the given order, without sorting everything in one task.

    Rows are range-partitioned and the sorted partitions written once; each partition then starts
    at the number of rows before it.  The offset table has one row per partition.  ``order`` must
    be unique for the numbering to be deterministic.
    """
    staged = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = staged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos") + start)
        .drop("_part", "_pos", "_offset")
    )
