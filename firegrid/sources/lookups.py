"""Readers of user-supplied lookup tables (title lines, byte-order marks and unit rows handled)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def _table(spark: SparkSession, path: str, first_column: str) -> DataFrame:
    """A small CSV whose header is the line starting with ``first_column``; title lines are skipped.

    Lookup tables have tens of rows; the header line is needed to name the columns.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "[\uFEFF\r]", "").alias("value"))
    header = lines.where(F.col("value").startswith(first_column)).limit(1).collect()
    if not header:
        raise ValueError(f"{path}: no header line starting with {first_column}")
    names = [c.strip() for c in header[0].value.split(",")]
    body = lines.where(F.col("value").rlike(r"^\s*-?\d")).select(F.split("value", ",").alias("p"))
    return body.select(*[F.trim(F.get("p", F.lit(i))).alias(n) for i, n in enumerate(names) if n])


def read_fuel_loads(spark: SparkSession, path: str) -> DataFrame:
    t = _table(spark, path, "GlobalRegion")
    wanted = ["TropicalForest", "TemperateForest", "BorealForest", "WoodySavanna", "SavannaGrasslands"]
    if t.columns != ["GlobalRegion", *wanted]:
        raise ValueError(f"{path}: unexpected columns {t.columns}")
    short = ["f_tropical", "f_temperate", "f_boreal", "f_woody", "f_grass"]
    return t.select(F.col("GlobalRegion").cast("int").alias("fuel_region"), *[F.col(a).cast("double").alias(b) for a, b in zip(wanted, short)])


def read_lct_fuel(spark: SparkSession, path: str) -> DataFrame:
    t = _table(spark, path, "Code")
    if t.columns != ["Code", "TREE", "HERB"]:
        raise ValueError(f"{path}: unexpected columns {t.columns}")
    return t.select(F.col("Code").cast("int").alias("fuel_lct"), F.col("TREE").cast("double").alias("lct_tree"), F.col("HERB").cast("double").alias("lct_herb"))


def _long(t: DataFrame, key: str, skip: int, value: str) -> DataFrame:
    names = t.columns[skip:]
    typed = t.select(F.col(key).cast("int").alias("genveg"), *[F.col(f"`{n}`").cast("double").alias(n) for n in names])
    return typed.unpivot("genveg", names, "species", value)


def read_emission_factors(spark: SparkSession, path: str) -> DataFrame:
    """Any number of species; the row of type 0 carries molecular weights."""
    rows = _long(_table(spark, path, "GenVegType"), "GenVegType", 2, "ef")
    weights = rows.where("genveg = 0").select("species", F.col("ef").alias("mw"))
    return rows.where("genveg <> 0").join(F.broadcast(weights), "species").select("genveg", "species", "mw", "ef")


def read_voc_split(spark: SparkSession, path: str) -> DataFrame:
    return _long(_table(spark, path, "GenVegIndex"), "GenVegIndex", 2, "frac")


def read_ef_v1(spark: SparkSession, path: str) -> DataFrame:
    """First-generation factors: one row per land cover, species by column position."""
    # Meaning of the 20 columns.
    names = ["row", "veg", "description", "CO2", "CO", "CH4", "NMOC", "H2", "NOX", "SO2", "PM25", "TPM", "TPC", "OC", "BC", "NH3", "NO", "NO2", "NMHC", "PM10"]
    t = spark.read.schema(", ".join(f"{n} string" for n in names)).option("header", True).option("enforceSchema", True).csv(path).where(F.col("row").try_cast("int").isNotNull())
    species = [n for n in names if n not in ("row", "veg", "description")]
    typed = t.select(F.col("row").cast("int").alias("factor_row"), *[F.col(s).cast("double").alias(s) for s in species])
    return typed.unpivot("factor_row", species, "species", "ef")


def read_speciation_v1(spark: SparkSession, path: str) -> DataFrame:
    """First-generation speciation: species name and six vegetation columns (crops sixth)."""
    kinds = [str(k) for k in range(1, 7)]
    schema = "species string, " + ", ".join(f"`{k}` string" for k in kinds)
    t = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path).withColumn("_at", F.monotonically_increasing_id())
    t = t.where(F.col("`1`").try_cast("double").isNotNull())
    # The table has a few dozen rows: numbering them is a one-task sort of a fixed-size input.
    t = t.withColumn("slot", F.row_number().over(Window.orderBy("_at")))
    typed = t.select("slot", F.trim("species").alias("species"), *[F.col(f"`{k}`").cast("double").alias(k) for k in kinds])
    return typed.unpivot(["slot", "species"], kinds, "type", "frac").withColumn("type", F.col("type").cast("int"))
