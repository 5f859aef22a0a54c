"""Comparing two outputs: aggregates, row-level differences, matching inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from firegrid.operators.report import area_totals

# Not more than Spark writes to one file per partition without sorting them in memory first.
KEY_PARTS = 200

# Decimals kept when two outputs are compared.
DIGITS = {"cen_lon": 5, "cen_lat": 5, "area_sqkm": 5, "f_lct": 3, "v_tree": 3, "v_herb": 3, "v_bare": 3}


def round_for_compare(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    digits = digits or DIGITS
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def diff_outputs(a: DataFrame, b: DataFrame, digits: dict[str, int] | None = None, ids: tuple[str, ...] = ("fireid", "polyid"),
                 only_different: bool = True) -> DataFrame:
    """Full outer comparison on all columns except the ids, which may be numbered differently.

    Both sides are summarised per value row first (smallest ids, number of rows), so repeated rows
    compare by count instead of multiplying.
    """
    keys = [c for c in a.columns if c not in ids]

    def side(df: DataFrame, tag: str) -> DataFrame:
        rounded = round_for_compare(df.select(*a.columns), digits)
        return rounded.groupBy(*keys).agg(*[F.min(i).alias(f"{i}_{tag}") for i in ids], F.count("*").alias(f"n_{tag}"))

    left, right = side(a, "l"), side(b, "r")
    out = left.join(right, [left[k].eqNullSafe(right[k]) for k in keys], "full_outer").select(
        *[F.coalesce(left[k], right[k]).alias(k) for k in keys], *[f"{i}_{t}" for i in ids for t in ("l", "r")],
        F.coalesce("n_l", F.lit(0)).alias("n_l"), F.coalesce("n_r", F.lit(0)).alias("n_r"),
    )
    return out.where("n_l <> n_r") if only_different else out


def filter_matching(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of ``a`` whose key values occur in ``b``."""
    keys = keys or ["lon", "lat", "brightness", "frp"]
    return a.join(b.select(*keys).distinct(), keys, "left_semi")


def compare_outputs(tables: dict[str, DataFrame]) -> DataFrame:
    """Area totals of several outputs side by side: (kind, class, one column per output, n fires)."""
    parts = None
    for name, t in tables.items():
        one = area_totals(t).unionByName(
            t.agg(F.count_distinct("fireid").cast("double").alias("area")).select(F.lit("fires").alias("kind"), F.lit("n").alias("class"), "area")
        ).withColumn("output", F.lit(name))
        parts = one if parts is None else parts.unionByName(one)
    return parts.groupBy("kind", "class").pivot("output", list(tables)).agg(F.first("area"))


def compare_by_fire(tables: dict[str, DataFrame]) -> DataFrame:
    """Area by (fireid, land cover), two decimals, one column per output.

    Nearly every row has a key of its own, so rows go to their key's partition before any are added up: a task
    that reads much of the input keeps no table of its keys.
    """
    parts = None
    for name, t in tables.items():
        one = t.select("fireid", "v_lct", (F.col("area_sqkm") * F.col("f_lct")).alias("_area"), F.lit(name).alias("_output"))
        parts = one if parts is None else parts.unionByName(one)
    sums = [F.round(F.sum(F.when(F.col("_output") == name, F.col("_area"))), 2).alias(name) for name in tables]
    return parts.repartition(KEY_PARTS, "fireid", "v_lct").groupBy("fireid", "v_lct").agg(*sums)
