"""Species maps: which model species is made of which inventory species.

A map entry reads ``name[(units)] -> [weight*]SOURCE[+...][;aerosol[(molar weight)]]`` or
``name = constant``; brackets around a source are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DEFAULT_UNITS = "molecules/cm^2/s"
DEFAULT_WEIGHT = 12.0


def parse_species_map(spark: SparkSession, entries: list[str], units: str = DEFAULT_UNITS) -> DataFrame:
    """One row per (target, source): entry, target, units, map, is_aerosol, mw, conc, source, weight.

    The table has one row per term of the configured map, so its size does not depend on the data.
    """
    text = spark.createDataFrame(list(enumerate(entries)), "entry int, raw string").select(
        "entry", F.replace("raw", F.lit(" ")).alias("m")
    )
    arrow = F.instr("m", "->") > 1
    left = F.substring_index("m", "->", 1)
    right = F.regexp_extract("m", "->(.*)$", 1)
    tail = F.regexp_extract(right, ";(.*)$", 1)
    has_units = left.rlike(r"\(.*\)")
    aerosol = tail.startswith("aerosol")
    weight_text = F.regexp_extract(tail, r"^aerosol\((.+)\)", 1)
    head = text.select(
        "entry", "m", arrow.alias("mapped"),
        F.when(arrow, F.when(has_units, F.substring_index(left, "(", 1)).otherwise(left))
        .otherwise(F.substring_index("m", "=", 1)).alias("target"),
        F.when(has_units, F.regexp_extract(left, r"\((.*)\)", 1)).otherwise(units).alias("units"),
        F.when(arrow & has_units, F.concat(F.substring_index(left, "(", 1), F.lit("->"), right)).otherwise(F.col("m")).alias("map"),
        (arrow & aerosol).alias("is_aerosol"),
        F.when(weight_text != "", weight_text.try_cast("double")).otherwise(DEFAULT_WEIGHT).alias("mw"),
        F.when(~arrow, F.regexp_extract("m", "=(.*)$", 1).try_cast("double")).alias("conc"),
        F.when(arrow, F.split(F.substring_index(right, ";", 1), r"\+")).otherwise(F.array(F.lit(None).cast("string"))).alias("terms"),
    )
    rows = head.select("*", F.explode("terms").alias("term")).drop("terms")
    factor = F.regexp_extract("term", r"^(.+)\*", 1)
    rows = rows.withColumn("weight", F.when(factor != "", factor.try_cast("double")).otherwise(1.0)).withColumn(
        "source", F.regexp_replace(F.regexp_replace("term", r"^.*\*", ""), r"[\[\]]", "")
    )
    bad = rows.where(
        (F.col("target") == "") | (F.col("mapped") & (F.col("weight").isNull() | F.col("mw").isNull() | (F.col("source") == "")))
        | (~F.col("mapped") & F.col("conc").isNull())
    )
    wrong = [r.m for r in bad.select("m").distinct().collect()]
    if wrong:
        raise ValueError(f"invalid species map entries: {wrong}")
    return rows.select("entry", "target", "units", "map", "is_aerosol", "mw", "conc", "source", "weight")


def check_species(species_map: DataFrame, available: list[str]) -> None:
    """Raise if the map asks for a species the inventory does not have."""
    missing = [
        r.source for r in species_map.where(F.col("source").isNotNull() & ~F.col("source").isin(*available))
        .select("source").distinct().collect()
    ]
    if missing:
        raise ValueError(f"species not in the inventory: {sorted(missing)}")


class Target:
    """One model species of a parsed map: how to build it from summed inventory columns."""

    def __init__(self, name: str, is_aerosol: bool, mw: float, terms: list[tuple[str, float]]):
        self.name, self.is_aerosol, self.mw, self.terms = name, is_aerosol, mw, terms

    def total(self, value_of=F.col):
        total = F.lit(0.0)
        for source, weight in self.terms:
            total = total + weight * value_of(source)
        return total


def targets(species_map: DataFrame) -> list[Target]:
    """The mapped species as plan-time objects (rows of the configuration, not of the data)."""
    out: dict[int, Target] = {}
    for r in species_map.where("source is not null").orderBy("entry").collect():
        out.setdefault(r.entry, Target(r.target, r.is_aerosol, r.mw, [])).terms.append((r.source, r.weight))
    return list(out.values())
