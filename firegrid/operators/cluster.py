"""Clustering of detections into burned areas.

Detections with the same footprint on a day are one *site*: they always belong together and add
nothing to the shape, so only sites are paired.  A place seen a million times costs one site.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from firegrid.operators.components import connected_components
from firegrid.operators.joins import hot_lookup, overlap_pairs
from firegrid.operators.prep import pixel_extent
from firegrid.session import cut

FOOTPRINT = ["acq_date_use", "lon", "lat", "pix_dx", "pix_dy", "fire_dx", "fire_dy"]


class Clusters(NamedTuple):
    """points: detections + fireid, ndetect.  hulls: the shape of each fire (see ``shapes``)."""

    points: DataFrame
    hulls: DataFrame


def sites(points: DataFrame) -> DataFrame:
    """Distinct footprints per day: ``site`` = smallest cleanid, ``n_det`` detections."""
    return points.groupBy(*FOOTPRINT).agg(F.min("cleanid").alias("site"), F.count("*").alias("n_det"))


def site_pairs(site_table: DataFrame, bin_deg: float = 0.05) -> DataFrame:
    """Overlapping sites of a day (a_site < b_site) with their centres and neighbourhood boxes."""
    boxes = site_table.select(
        "acq_date_use", "site", "lon", "lat", F.col("pix_dx").alias("dx"), F.col("pix_dy").alias("dy")
    )
    return overlap_pairs(boxes, ["acq_date_use"], "site", bin_deg)


def cluster(points: DataFrame, mode: str = "aggressive", bin_deg: float = 0.05) -> Clusters:
    """Group detections whose neighbourhood boxes overlap on the same day.

    ``fireid`` = smallest cleanid of the group, ``ndetect`` = number of detections.  The shape is the
    union over overlapping pairs of the convex hull of the two fire boxes; a lone site is its box.
    """
    extended = pixel_extent(points, mode)
    site_table = cut(sites(extended))
    pairs = cut(site_pairs(site_table, bin_deg).select("a_site", "b_site"))
    labels = connected_components(pairs, site_table, "a_site", "b_site", "site", weight="n_det", canonical=True)
    about = labels.select(
        F.col("node").alias("site"), F.col("component").alias("fireid"), F.col("n_nodes").alias("n_sites"), F.col("n_det").alias("ndetect")
    )
    full = cut(site_table.join(about, "site"))
    by_point = hot_lookup(extended, full.select(*FOOTPRINT, "n_det", "fireid", "ndetect"), FOOTPRINT, "n_det", "cleanid")
    out_points = by_point.select(*[c for c in points.columns if c not in ("fireid", "ndetect")], "fireid", "ndetect")

    def side(prefix: str) -> DataFrame:
        return full.select(
            F.col("site").alias(f"{prefix}_site"),
            F.col("lon").alias(f"{prefix}x"), F.col("lat").alias(f"{prefix}y"),
            F.col("fire_dx").alias(f"{prefix}dx"), F.col("fire_dy").alias(f"{prefix}dy"),
            *([F.col("fireid"), F.col("acq_date_use")] if prefix == "a" else []),
        )

    paired = (
        pairs.join(side("a"), "a_site").join(side("b"), "b_site")
        .withColumn("lone", F.lit(False))
    )
    lone = full.where("n_sites = 1").select(
        "fireid", "acq_date_use", F.col("lon").alias("ax"), F.col("lat").alias("ay"),
        F.col("fire_dx").alias("adx"), F.col("fire_dy").alias("ady"),
        F.col("lon").alias("bx"), F.col("lat").alias("by"),
        F.col("fire_dx").alias("bdx"), F.col("fire_dy").alias("bdy"), F.lit(True).alias("lone"),
    )
    # Sites that differ in scan and track only give the same hull: keep one.
    return Clusters(out_points, cut(paired.select(*lone.columns).distinct().unionByName(lone)))


def merge_algorithm(points: DataFrame, tree_cover: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Add ``alg_agg`` to aggressively clustered points: 1 where the fire's tree cover reaches the threshold, else 2.

    ``tree_cover``: (fireid, v_tree).  Fires without valid pixels count as 2.
    """
    flag = tree_cover.select("fireid", F.when(F.col("v_tree") >= threshold, 1).otherwise(2).alias("alg_agg"))
    sized = points.groupBy("fireid").agg(F.count("*").alias("_n")).join(flag, "fireid", "left")
    sized = cut(sized.withColumn("alg_agg", F.coalesce("alg_agg", F.lit(2))))
    return hot_lookup(points, sized, ["fireid"], "_n", "cleanid").drop("_n")


def replace_merge(aggressive: Clusters, conservative: Clusters, tree_cover: DataFrame, threshold: float = 50.0) -> Clusters:
    """The burned areas that are subdivided: aggressive ones where tree cover is high, else conservative ones."""
    flagged = cut(merge_algorithm(aggressive.points, tree_cover, threshold))
    both = flagged.withColumnsRenamed({"fireid": "fireid1", "ndetect": "ndetect1"}).join(
        conservative.points.select("cleanid", F.col("fireid").alias("fireid2"), F.col("ndetect").alias("ndetect2")),
        "cleanid",
    )
    first = F.col("alg_agg") == 1
    points = cut(
        both.withColumn("fireid", F.when(first, F.col("fireid1")).otherwise(F.col("fireid2")))
        .withColumn("ndetect", F.when(first, F.col("ndetect1")).otherwise(F.col("ndetect2")))
    )
    def kept(hulls: DataFrame, alg: int) -> DataFrame:
        ids = points.where(F.col("alg_agg") == alg).select("fireid").distinct()
        return hulls.join(ids, "fireid", "left_semi").withColumn("alg_agg", F.lit(alg))

    return Clusters(points, kept(aggressive.hulls, 1).unionByName(kept(conservative.hulls, 2)))
