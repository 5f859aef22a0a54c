"""Writers.  Every table is written by its own tasks, partitioned for the readers that follow."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from firegrid import lookups
from firegrid.operators import legacy
from firegrid.operators.joins import spread
from firegrid.operators.zonal import pixel_tile
from firegrid.session import observed

FIRE_FIELDS = ["v_lct", "f_lct", "v_tree", "v_herb", "v_bare", "v_regnum", "v_frp"]


def fire_columns(df: DataFrame, date_definition: str = "UTC") -> DataFrame:
    """Deliverable columns in order; those that are missing are left out."""
    date = f"acq_date_{date_definition.lower()}"
    if "acq_date_use" in df.columns:
        df = df.withColumn(date, F.col("acq_date_use"))
    wanted = ["polyid", "fireid", "cen_lon", "cen_lat", date, "area_sqkm", "alg_agg", *FIRE_FIELDS]
    return df.select(*[c for c in wanted if c in df.columns])


def write_fires(df: DataFrame, path: str, date_definition: str = "UTC") -> None:
    """Processed fires as CSV, one folder per day (the date column is also kept in the rows)."""
    out = fire_columns(df, date_definition)
    day = f"acq_date_{date_definition.lower()}"
    out.withColumn("run_day", F.col(day)).write.mode("overwrite").partitionBy("run_day").option("header", True).csv(path)


def hull_wkt() -> Column:
    """A hull row as a WKT multipoint of its eight box corners; their convex hull is the outline."""
    corners = []
    for p in ("a", "b"):
        for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1)):
            x, y = F.col(f"{p}x") + sx * F.col(f"{p}dx"), F.col(f"{p}y") + sy * F.col(f"{p}dy")
            corners.append(F.concat(x.cast("string"), F.lit(" "), y.cast("string")))
    return F.concat(F.lit("MULTIPOINT ("), F.concat_ws(", ", *corners), F.lit(")"))


def write_polygons(df: DataFrame, members: DataFrame, path: str, date_definition: str = "UTC", outlines: DataFrame | None = None) -> None:
    """Two tables: ``polygons`` with one row per fire row, ``members`` with one row per detection (polyid, cleanid).

    ``outlines`` (polyid, geom[, compactness]) puts the geometry beside the rows, as WKT.
    """
    rows = fire_columns(df, date_definition)
    if outlines is not None:
        rows = rows.join(outlines.select("polyid", *[c for c in ("compactness", "geom") if c in outlines.columns]), "polyid", "left")
    rows.write.mode("overwrite").parquet(f"{path}/polygons")
    members.select("polyid", "cleanid").write.mode("overwrite").parquet(f"{path}/members")


def write_hulls(hulls: DataFrame, path: str) -> None:
    """Outlines of burned areas, one hull per row."""
    hulls.select("fireid", "acq_date_use", hull_wkt().alias("geom")).write.mode("overwrite").parquet(path)


MANIFEST = "_manifest.json"


def fingerprint(inputs: tuple[DataFrame, ...] = (), params: dict | None = None) -> str:
    """A hash that changes with the schema, plan or files (names, sizes, times) of the inputs, or with a parameter."""
    told: list = [json.dumps(params or {}, sort_keys=True, default=str)]
    for df in inputs:
        spark = df.sparkSession
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        files = []
        for name in sorted(df.inputFiles()):
            at = spark._jvm.org.apache.hadoop.fs.Path(name)
            status = at.getFileSystem(conf).getFileStatus(at)
            files.append([name, status.getLen(), status.getModificationTime()])
        told.append([df.schema.json(), files or df._jdf.queryExecution().analyzed().canonicalized().hashCode()])
    return hashlib.sha256(json.dumps(told).encode()).hexdigest()


def _manifest(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """What a finished stage left: ``fingerprint`` and ``rows``; None if there is none, or its write was interrupted."""
    at, fs = _manifest(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _write_manifest(spark: SparkSession, path: str, told: dict) -> None:
    at, fs = _manifest(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(json.dumps(told).encode())
    finally:
        stream.close()
    # A rename is all or nothing: a manifest that can be read belongs to a finished write.
    fs.rename(draft, at)


def stage(
    spark: SparkSession, path: str, build, run: bool = True, inputs: tuple[DataFrame, ...] = (), params: dict | None = None,
) -> DataFrame:
    """A pipeline stage: compute and store when ``run``, else read what an earlier run stored.

    Stored rows are read again only if their write came to its end and had the same ``inputs`` and
    ``params``; else the stage is computed after all.  An overwrite takes the old manifest away first, and
    the new one is written last, with the number of rows counted during the write (``stage_rows``).
    """
    mark = fingerprint(inputs, params)
    told = None if run else read_manifest(spark, path)
    if told is None or told["fingerprint"] != mark:
        seen = Observation(f"rows of {path.rstrip('/').rsplit('/', 1)[-1]}")
        df = build()
        at, fs = _manifest(spark, path)
        if fs.exists(at):
            fs.delete(at, False)
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        _write_manifest(spark, path, {"fingerprint": mark, "rows": observed(seen, spark.read.schema(df.schema).parquet(path))})
    return spark.read.parquet(path)


def stage_rows(spark: SparkSession, path: str) -> int:
    """Rows of a finished stage, as counted when it was written."""
    return read_manifest(spark, path)["rows"]


def emission_columns(df: DataFrame, mechanism: str | None, species: list[str] | None = None, legacy_id_swap: bool = False) -> DataFrame:
    """Columns of an emission file: ids, place, area, biomass[, FRP], base species[, VOCs].

    The base file carries FRP, mechanism files do not.  ``legacy_id_swap`` writes the fire id under
    POLYID and the polygon id under FIREID, as older files have it.
    """
    base = species or lookups.base_species()
    poly, fire = ("fireid", "polyid") if legacy_id_swap else ("polyid", "fireid")
    frp = [] if mechanism else [F.col("v_frp").alias("FRP")]
    vocs = lookups.voc_species(mechanism) if mechanism else []
    return df.select(
        F.dayofyear("acq_date_utc").alias("DAY"), F.col(poly).alias("POLYID"), F.col(fire).alias("FIREID"),
        F.col("genveg").alias("GENVEG"), F.round("cen_lat", 3).alias("LATI"), F.round("cen_lon", 3).alias("LONGI"),
        F.col("area_m2").alias("AREA"), F.col("bmass").alias("BMASS"), *frp,
        *[F.col(s) for s in base], *[F.col(f"voc_{s}").alias(s if s not in base else f"{s}_voc") for s in vocs],
    )


def write_emissions(df: DataFrame, path: str, mechanism: str | None = None, legacy_id_swap: bool = False) -> None:
    """Numbers with four significant digits (E10.3 style); one folder per day."""
    out = emission_columns(df, mechanism, legacy_id_swap=legacy_id_swap)
    plain = {"DAY", "POLYID", "FIREID", "GENVEG", "LATI", "LONGI", "FRP"}
    text = out.select(*[F.col(f"`{c}`") if c in plain else F.format_string("%.3E", F.col(f"`{c}`")).alias(c) for c in out.columns])
    text.withColumn("run_day", F.col("DAY")).write.mode("overwrite").partitionBy("run_day").option("header", True).csv(path)


def write_v1(df: DataFrame, path: str, first_day: int = 1, last_day: int = 366) -> None:
    """First-generation rows inside the day window, by day within each file; ``tod`` (time of day) and the area in m2 where known."""
    days = df.where(F.col("jday").between(first_day, last_day))
    if "area_km2" in days.columns and "area_m2" not in days.columns:
        days = days.withColumn("area_m2", F.col("area_km2") * 1e6).drop("area_km2")
    days.sortWithinPartitions("jday").write.mode("overwrite").option("header", True).csv(path)


def v1_intermediate(df: DataFrame) -> DataFrame:
    """First-generation intermediate columns, with whole-number covers and the copy weight."""
    cover = [F.col(c).cast("int").alias(c) for c in ("tree", "herb", "bare")]
    return df.select(
        "cen_lon", "cen_lat", "jday", *[c for c in ("tod",) if c in df.columns], "lct", "genveg", "region", *cover,
        (F.col("area_km2") * 1e6).alias("area_m2"), "bmass", *legacy.SPECIES, "factor",
    )


def write_grid(df: DataFrame, path: str, units: str = "molecules/cm^2/s", files_per_species: int = 8, long_names: dict[str, str] | None = None) -> None:
    """Gridded emissions, one folder per species and date (or month); units and long names travel as column metadata.

    Regular grids have columns i and j, unstructured ones a cell.  Rows of a (species, date) are
    spread over a few tasks so that no writer holds a whole day.
    """
    place = [c for c in ("i", "j", "cell") if c in df.columns]
    day = "date" if "date" in df.columns else "month"
    value = F.col("value").alias("value", metadata={"units": units, "long_names": long_names or {}})
    keyed = df.withColumn("value", value).withColumn("_s", spread(place, F.lit(files_per_species)))
    keyed.repartition("species", day, "_s").drop("_s").write.mode("overwrite").partitionBy("species", day).parquet(path)


def write_pixels(pixels: DataFrame, path: str, res: float) -> None:
    """A pixel table, one folder per one-degree tile; a tile's pixels are written by one task."""
    tiled = pixels.withColumn("tile", pixel_tile(F.col("iy"), F.col("ix"), res))
    tiled.repartition("tile").write.mode("overwrite").partitionBy("tile").parquet(path)


def write_wrf(df: DataFrame, path: str, domain: int = 1) -> None:
    """Hourly regional emissions, one folder per domain, date and hour."""
    df.withColumn("domain", F.lit(domain)).write.mode("overwrite").partitionBy("domain", "date", "hour").parquet(path)


def write_summary(log: DataFrame, path: str) -> None:
    """Append readable lines ``event: before -> after (delta), seconds`` and the JSON events beside them."""
    line = F.format_string("%s: %d -> %d (%+d), %.1f s", "event", "n_before", "n_after", F.col("n_after") - F.col("n_before"), "elapsed_s")
    log.select(line.alias("value")).write.mode("append").text(f"{path}/text")
    log.write.mode("append").json(f"{path}/json")


def write_audit(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def overwrite_days(df: DataFrame, path: str, day: str = "acq_date_use") -> None:
    """Replace only the date partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
