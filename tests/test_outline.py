"""Outlines and compactness of areas made of intervals on strips, against point tests and closed forms."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from firegrid.functions.geo import WGS84_B, WGS84_E
from firegrid.operators import outline as O

SCHEMA = "fireid bigint, strip int, y double, h double, x0 double, x1 double"
H = 0.25


def table(spark, areas):
    """{fireid: {strip: [(x0, x1), ...]}}"""
    rows = [(f, k, 10 + (k + 0.5) * H, H, float(a), float(b)) for f, strips in areas.items() for k, line in strips.items() for a, b in line]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def random_area(rng, n=12):
    out = {}
    for k in range(n):
        cuts = sorted(rng.sample(range(0, 40), 2 * rng.randrange(0, 5)))
        out[k] = [(a / 4, b / 4) for a, b in zip(cuts[::2], cuts[1::2])]
    return out


def parse(wkt):
    """Polygons of a WKT multipolygon, each a list of closed rings."""
    assert wkt.startswith("MULTIPOLYGON (((") and wkt.endswith(")))")
    polygons = re.split(r"\)\), \(\(", wkt[len("MULTIPOLYGON (("):-2].removeprefix("(").removesuffix(")"))
    return [[[tuple(map(float, p.split())) for p in ring.strip("()").split(", ")] for ring in poly.split("), (")] for poly in polygons]


def shoelace(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def zone(width, south, north):
    def q(lat):
        s = math.sin(math.radians(lat))
        return s / (1 - (WGS84_E * s) ** 2) + math.log((1 + WGS84_E * s) / (1 - WGS84_E * s)) / (2 * WGS84_E)
    return WGS84_B**2 / 2e6 * math.radians(width) * (q(north) - q(south))


def regions(strips):
    """Connected parts of an area, intervals on neighbouring strips being connected when they overlap."""
    nodes = [(k, a, b) for k, line in strips.items() for a, b in line]
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    overlaps = 0
    for n in nodes:
        for m in nodes:
            if m[0] == n[0] + 1 and n[1] < m[2] and m[1] < n[2]:
                overlaps += 1
                parent[find(n)] = find(m)
    parts = len({find(n) for n in nodes})
    return parts, parts - (len(nodes) - overlaps)


def test_random_areas(spark):
    """Every ring's side of every place, the number of parts and holes, and the area agree with the intervals."""
    rng = random.Random(5)
    areas = {f: random_area(rng) for f in range(40)}
    areas = {f: a for f, a in areas.items() if any(a.values())}
    got = {r.fireid: r for r in O.outlines(table(spark, areas), ["fireid"]).collect()}
    assert set(got) == set(areas)
    for f, strips in areas.items():
        polygons = parse(got[f].geom)
        assert (got[f].n_polygons, got[f].n_holes) == regions(strips)
        assert len(polygons) == got[f].n_polygons and sum(map(len, polygons)) == got[f].n_polygons + got[f].n_holes
        for poly in polygons:
            assert all(ring[0] == ring[-1] for ring in poly)
            assert shoelace(poly[0]) > 0 and all(shoelace(hole) < 0 for hole in poly[1:])
        rings = [ring for poly in polygons for ring in poly]
        assert sum(map(shoelace, rings)) == pytest.approx(sum((b - a) * H for line in strips.values() for a, b in line))
        want = sum(zone(b - a, 10 + k * H, 10 + (k + 1) * H) for k, line in strips.items() for a, b in line)
        assert got[f].area_sqkm == pytest.approx(want, rel=1e-9)
        for k in range(12):
            for x in [j / 4 + 0.125 for j in range(-1, 41)]:
                y = 10 + (k + 0.5) * H
                # One polygon holds each place inside, and none the others.
                assert sum(inside(poly, x, y) for poly in polygons) == any(a < x < b for a, b in strips[k])


def test_hole_in_island_in_hole(spark):
    """A ring around a hole, in which an island lies with a hole of its own."""
    strips = {0: [(0, 9)], 1: [(0, 1), (8, 9)], 2: [(0, 1), (3, 6), (8, 9)], 3: [(0, 1), (3, 4), (5, 6), (8, 9)],
              4: [(0, 1), (3, 6), (8, 9)], 5: [(0, 1), (8, 9)], 6: [(0, 9)]}
    r = O.outlines(table(spark, {1: strips}), ["fireid"]).first()
    assert (r.n_polygons, r.n_holes) == (2, 2)
    polygons = parse(r.geom)
    assert sorted(len(p) for p in polygons) == [2, 2]
    assert all(len(ring) == 5 for p in polygons for ring in p)  # straight sides have no corners between
    assert sorted(round(abs(shoelace(ring)), 9) for p in polygons for ring in p) == [round(v * H, 9) for v in (1, 9, 35, 63)]


def test_two_holes_side_by_side(spark):
    """The left-most side of the second hole belongs to an interval that starts at the first one."""
    strips = {0: [(0, 9)], 1: [(0, 1), (2, 5), (6, 9)], 2: [(0, 9)]}
    r = O.outlines(table(spark, {1: strips}), ["fireid"]).first()
    assert (r.n_polygons, r.n_holes) == (1, 2) and len(parse(r.geom)[0]) == 3


def test_long_spiral(spark):
    """One ring through thousands of ends is put in order in a few rounds."""
    strips = {k: [(0, 1)] if k % 4 == 1 else [(9, 10)] if k % 4 == 3 else [(0, 10)] for k in range(1501)}
    r = O.outlines(table(spark, {7: strips}), ["fireid"]).first()
    assert (r.n_polygons, r.n_holes) == (1, 0)
    assert shoelace(parse(r.geom)[0][0]) == pytest.approx(sum((b - a) * H for line in strips.values() for a, b in line))


def test_compactness(spark):
    """A square, a bar, a triangle with a slope, and two squares apart."""
    n = 64
    areas = {
        1: {k: [(0, n * H)] for k in range(n)}, 2: {0: [(0, 10)]},
        3: {k: [(0, (n - k - 0.5) * H)] for k in range(n)}, 4: {0: [(0, H), (5, 5 + H)]}}
    got = {r.fireid: r for r in O.perimeters(table(spark, areas), ["fireid"]).collect()}
    side = n * H
    assert got[1].compactness == pytest.approx(math.pi / 4) and got[1].perimeter_deg == pytest.approx(4 * side)
    assert got[2].perimeter_deg == pytest.approx(20 + 2 * H)
    assert got[3].perimeter_deg == pytest.approx((2 + math.sqrt(2)) * side, rel=0.01) and got[3].area_deg2 == pytest.approx(side * side / 2, rel=1e-9)
    assert got[4].perimeter_deg == pytest.approx(8 * H)
    assert all(0 < r.compactness <= 1 for r in got.values())


def test_no_extent(spark):
    flat = spark.createDataFrame([(1, 0, 0.0, 0.25, 2.0, 2.0), (2, 0, 0.0, 0.25, 0.0, 1.0)], SCHEMA)
    got = {r.fireid: r.compactness for r in O.perimeters(flat, ["fireid"]).collect()}
    assert got[1] == 0 and got[2] > 0
    assert [r.fireid for r in O.outlines(flat, ["fireid"]).collect()] == [2]
    assert O.outlines(spark.createDataFrame([], SCHEMA), ["fireid"]).collect() == []


def test_touching_pieces_are_one(spark):
    df = table(spark, {1: {0: [(0, 1), (1 + 1e-13, 2), (3, 4)]}})
    assert sorted((r.x0, r.x1) for r in O.join_touching(df, ["fireid"]).collect()) == [(0, 2), (3, 4)]


def test_pixel_runs_are_the_pixels(spark):
    """Runs of pixels hold the same pixels as the pixel-by-pixel test, for hulls, filled holes and sub-polygons."""
    from firegrid.operators import shapes, subdivide
    from tests.test_clusters import C, as_points, ring_of_sites

    rng = random.Random(4)
    sites = ring_of_sites(0.0035) + [(100 + i, 20 + rng.random() * 0.1, 5 + rng.random() * 0.1, 1.0 + rng.random(), 1.0, "MODIS", "2024-01-01") for i in range(60)]
    c = C.cluster(as_points(spark, sites))
    shape = shapes.Shape(shapes.multi_hulls(c.hulls))
    listed = lambda df, key: sorted((r[0], r[1], i) for r in df.select(key, "iy", "i0", "i1").collect() for i in range(r.i0, r.i1 + 1))
    for res in (0.0007, 0.004):
        runs = shapes.pixel_ranges(c.hulls, res, shape.filled)
        want = sorted(tuple(r) for r in shapes.pixel_cells(c.hulls, res, shape.filled).select("fireid", "iy", "ix").collect())
        assert listed(runs, "fireid") == want
        seeds = c.points.where("cleanid % 5 = 0").groupBy("fireid", "lon", "lat").agg(F.min("cleanid").alias("seed"))
        cells = subdivide.cells_of(c.hulls, seeds, res, shape).select("polyid", "iy", "ix")
        assert listed(subdivide.ranges_of(c.hulls, seeds, res, shape), "polyid") == sorted(tuple(r) for r in cells.collect())


def test_sums_of_runs_are_sums_of_pixels(spark):
    """Classes and bands of several rasters in one join, with gaps, nulls, nodata, ranges and rows over several degrees."""
    from firegrid.operators import zonal as Z

    rng = random.Random(9)
    res = 0.1
    px = spark.createDataFrame(
        [(iy, ix, rng.choice([None, 1, 2, 3, 255]), rng.choice([None, -5.0, 300.0, *map(float, range(0, 100, 7))]), float(rng.randrange(100)))
         for iy in range(-8, 8) for ix in range(-40, 40) if rng.random() < 0.8],
        "iy long, ix long, lct int, tree double, herb double")
    runs, cells = [], []
    for key in range(25):
        for iy in range(-9, 9):
            x = -45
            while (x := x + rng.randrange(1, 30)) < 45:
                end = x + rng.randrange(0, 25)
                runs.append((key, iy, x, end))
                cells += [(key, iy, i) for i in range(x, end + 1)]
                x = end + 1
    runs = spark.createDataFrame(runs, "polyid long, iy long, i0 long, i1 long").repartition(3)
    cells = spark.createDataFrame(cells, "polyid long, iy long, ix long")
    rasters = [Z.Raster(px.select("iy", "ix", "lct"), nodata=255), Z.Raster(px.where("ix < 20"), ("tree", "herb"))]
    classes, means = Z.sums_of_runs(runs, Z.row_sums(rasters, res), rasters, "polyid", res)
    order = ["polyid", "r_lct", "v_lct", "cv_lct", "ct_lct", "f_lct"]
    pick = lambda df: sorted(tuple(r) for r in df.select(*order).collect())
    assert pick(classes) == pick(Z.class_histogram(cells, px, nodata=255))
    want = {r.polyid: r for r in Z.band_means(cells, px.where("ix < 20"), ["tree", "herb"]).collect()}
    got = {r.polyid: r for r in means.collect()}
    assert set(got) == set(want)
    for k, r in want.items():
        assert (got[k].v_tree, got[k].v_herb) == (pytest.approx(r.v_tree), pytest.approx(r.v_herb))
