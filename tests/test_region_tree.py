"""The region tree against ray casting over whole rings."""

import math
import random

from pyspark.sql import functions as F

from firegrid.functions.geo import point_in_ring
from firegrid.operators import zonal as Z

RINGS = "region_num int, ring array<struct<x:double,y:double>>"


def wobbly(rng, num, cx, cy, radius, n):
    """A ring with spikes: many edges, some of them long, some cells crowded."""
    return num, [(cx + radius * (0.6 + 0.4 * rng.random()) * math.cos(2 * math.pi * k / n), cy + radius * (0.6 + 0.4 * rng.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def brute(points, regions):
    met = points.join(regions, point_in_ring(F.col("ring"), F.col("cen_lon"), F.col("cen_lat")), "left")
    return {r.polyid: r.v for r in met.groupBy("polyid").agg(F.min("region_num").alias("v")).collect()}


def test_against_whole_rings(spark):
    rng = random.Random(6)
    rings = [wobbly(rng, 1, 0, 0, 60, 400), wobbly(rng, 2, 20, 10, 30, 900), wobbly(rng, 3, -100, 40, 8, 300), wobbly(rng, 7, 20, 10, 0.5, 200),
             (5, [(-150.0, -60.0), (-120.0, -60.0), (-120.0, 60.0), (-150.0, 60.0)]), (4, [(200.0, -80.0), (340.0, -80.0), (340.0, 80.0), (200.0, 80.0)])]
    regions = spark.createDataFrame(rings, RINGS)
    places = [(k, rng.uniform(-180, 360), rng.uniform(-90, 90)) for k in range(1500)]
    places += [(2000 + k, rng.gauss(20, 0.6), rng.gauss(10, 0.6)) for k in range(800)] + [(4000 + k, rng.gauss(-100, 6), rng.gauss(40, 6)) for k in range(500)]
    points = spark.createDataFrame(places, "polyid long, cen_lon double, cen_lat double").repartition(4)
    want = brute(points, regions)
    for leaf in (8, 10_000):
        got = {r.polyid: r.v_regnum for r in Z.region_of(points, regions, leaf_edges=leaf).collect()}
        assert got == want


def test_leaves_cover_the_globe_once(spark):
    rng = random.Random(2)
    tree = Z.region_tree(spark.createDataFrame([wobbly(rng, 1, 30, 20, 25, 2000)], RINGS), leaf_edges=20)
    area = tree.select(F.sum(F.pow(F.lit(0.25), F.col("level"))).alias("a")).first().a
    assert area == Z.ROOT_NX * Z.ROOT_NY
    assert tree.where((F.size("edges") > 20) & (F.col("level") < Z.DEEPEST)).isEmpty() and tree.where("level > 2").count() > 10


def test_no_place_and_no_regions(spark):
    regions = spark.createDataFrame([(1, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])], RINGS)
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, None, 5.0), (3, 5.0, 200.0), (4, float("nan"), 1.0), (5, -5.0, 5.0)], "polyid long, cen_lon double, cen_lat double")
    assert sorted((r.polyid, r.v_regnum) for r in Z.region_of(points, regions).collect()) == [(1, 1), (2, None), (3, None), (4, None), (5, None)]
    none = Z.region_of(points, spark.createDataFrame([], RINGS))
    assert [r.v_regnum for r in none.collect()] == [None] * 5
