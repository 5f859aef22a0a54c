"""Readers of detection files."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from firegrid.functions.text import instrument_from_path
from firegrid.operators.prep import serial_key

# The columns of a detection file and their types.
DETECTION_SCHEMA = T.StructType([
    T.StructField(name, kind, True) for name, kind in [
        ("longitude", T.DoubleType()), ("latitude", T.DoubleType()), ("scan", T.DoubleType()), ("track", T.DoubleType()),
        ("acq_date", T.DateType()), ("acq_time", T.StringType()), ("satellite", T.StringType()),
        ("instrument", T.StringType()), ("confidence", T.StringType()), ("version", T.StringType()),
        ("brightness", T.DoubleType()), ("bright_t31", T.DoubleType()), ("bright_ti4", T.DoubleType()),
        ("bright_ti5", T.DoubleType()), ("frp", T.DoubleType()), ("daynight", T.StringType()), ("type", T.IntegerType()),
    ]
])


def conform(df: DataFrame) -> DataFrame:
    """Lower-case names, require a position, add missing columns, set the types."""
    df = df.toDF(*[c.lower() for c in df.columns])
    missing = {"longitude", "latitude"} - set(df.columns)
    if missing:
        raise ValueError(f"detection files need the columns {sorted(missing)}")
    cols = [
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in DETECTION_SCHEMA
    ]
    extra = [c for c in ("src_file", "_path") if c in df.columns]
    return df.select(*cols, *extra)


def with_instrument(df: DataFrame, path_col: str = "_path") -> DataFrame:
    """The file name decides the instrument where it names one."""
    return df.withColumn("instrument", F.coalesce(instrument_from_path(F.col(path_col)), F.col("instrument")))


def read_one(spark: SparkSession, path: str) -> DataFrame:
    """One file, or a folder of files with the same columns; only the header is read at plan time."""
    raw = spark.read.option("header", True).csv(path).withColumn("_path", F.col("_metadata.file_path"))
    return with_instrument(conform(raw)).drop("_path")


def _plain(path):
    """A file's full name with one slash after the scheme, as text or as a column."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/") if not isinstance(path, str) else re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def _look_at(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(full name, header line) of a plain file, read without a job; None for folders, patterns and compressed files."""
    jvm = spark._jvm
    name = jvm.org.apache.hadoop.fs.Path(path)
    fs = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if path.endswith((".gz", ".bz2", ".zst")) or not fs.exists(name) or not fs.getFileStatus(name).isFile():
        return None
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(name), "UTF-8"))
    try:
        return _plain(fs.makeQualified(name).toString()), reader.readLine() or ""
    finally:
        reader.close()


def read_detections(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files in order -> detections with ``src_file`` (1-based) and a unique ``rawid``.

    Files may differ in columns.  Those with the same header are one scan, so a year of daily files
    is a plan of a few branches; a path table tells their numbers.
    """
    if not paths:
        raise ValueError("no detection files")
    by_header: dict[str, list[tuple[str, str, int]]] = {}
    parts = []
    for i, path in enumerate(paths, start=1):
        seen = _look_at(spark, path)
        if seen is None:
            parts.append(read_one(spark, path).withColumn("src_file", F.lit(i)))
        else:
            by_header.setdefault(seen[1], []).append((path, seen[0], i))
    for files in by_header.values():
        if len({full for _, full, _ in files}) < len(files) or len(files) == 1:  # a file named twice counts twice
            parts += [read_one(spark, path).withColumn("src_file", F.lit(i)) for path, _, i in files]
            continue
        numbers = spark.createDataFrame([(full, i) for _, full, i in files], "_full string, src_file int")
        raw = spark.read.option("header", True).csv([path for path, _, _ in files]).withColumn("_path", F.col("_metadata.file_path"))
        known = with_instrument(conform(raw)).join(F.broadcast(numbers), _plain(F.url_decode("_path")) == F.col("_full"), "left")
        number = F.when(F.col("src_file").isNull(), F.raise_error(F.concat(F.lit("unknown file "), "_path")).cast("int")).otherwise(F.col("src_file"))
        parts.append(known.withColumn("src_file", number).drop("_path", "_full"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return add_rawid(out)


def add_rawid(df: DataFrame) -> DataFrame:
    """Consecutive row numbers (from 0) by file, time and place, then the remaining columns.

    Equal rows are interchangeable, so the result does not depend on how the files were split; the
    tie-breaker only lets many equal rows spread over several sort partitions.
    """
    first = [c for c in ("src_file", "acq_date", "acq_time", "latitude", "longitude") if c in df.columns]
    order = [*first, *[c for c in df.columns if c not in first], "_tie"]
    numbered = serial_key(df.withColumn("_tie", F.monotonically_increasing_id()), order, "rawid")
    return numbered.select("rawid", *df.columns)


def with_carryover(df: DataFrame, previous: DataFrame, to_date: dt.date, lat_bounds: tuple[float, float] = (-23.5, 23.5)) -> DataFrame:
    """Add yesterday's tropical rows, dated ``to_date`` and marked ``src_file`` = 0 (bounds included)."""
    carried = previous.where(F.col("latitude").between(*lat_bounds)).withColumn("acq_date", F.lit(to_date)).withColumn("src_file", F.lit(0))
    return df.unionByName(carried, allowMissingColumns=True)


def discover(spark: SparkSession, root: str, pattern: str, dates: list[dt.date]) -> tuple[list[str], list[str]]:
    """Files named by a ``{yyyyjjj}`` pattern for the given days: (found, missing); none at all is an error.

    One listing of the folder with file-name filters; no file content is read.
    """
    wanted = {pattern.replace("{yyyyjjj}", d.strftime("%Y%j")): d for d in dates}
    names = spark.read.format("binaryFile").option("pathGlobFilter", pattern.replace("{yyyyjjj}", "*")).load(root).select("path")
    found = {r.path.rsplit("/", 1)[1]: r.path for r in names.where(F.substring_index("path", "/", -1).isin(*wanted)).collect()}
    if not found:
        raise FileNotFoundError(f"no file under {root} matches {pattern} for {dates}")
    return [found[n] for n in sorted(found)], sorted(n for n in wanted if n not in found)


def read_rawfires_v1(spark: SparkSession, path: str) -> DataFrame:
    """First-generation fire lists: 12 comma-separated tokens, no header."""
    names = ["lat", "lon", "t3", "spix", "tpix", "date", "time", "t8", "confidence", "t10", "t11", "t12"]
    schema = ", ".join(f"{n} string" for n in names)
    raw = spark.read.schema(schema).option("ignoreTrailingWhiteSpace", True).csv(path)
    hhmm = F.regexp_replace("time", "[^0-9]", "")
    return raw.select(
        F.col("lat").try_cast("double").alias("cen_lat"), F.col("lon").try_cast("double").alias("cen_lon"),
        F.col("spix").try_cast("double").alias("spix"), F.col("tpix").try_cast("double").alias("tpix"),
        F.to_date("date").alias("acq_date_utc"), hhmm.try_cast("int").alias("tod"),
        F.regexp_replace("confidence", r"[\r,]", "").try_cast("double").alias("confidence"),
    ).where("cen_lat is not null and cen_lon is not null")


def read_tile_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct hXXvYY tiles named in a product listing."""
    tile = F.regexp_extract("value", r"(h\d{2}v\d{2})", 1)
    return spark.read.text(path).select(tile.alias("tile")).where("tile <> ''").distinct()
