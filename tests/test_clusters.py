"""Clustering, shapes, skimming and subdivision against brute force on small random fixtures."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from firegrid.functions.geo import box_area_km2
from firegrid.operators import cluster as C, components, shapes, skim, subdivide
from firegrid.operators.joins import hot_lookup, near_pairs, overlap_pairs
from firegrid.session import cut as session_cut


def random_points(n, seed=1, span=0.15, days=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lon, lat = 10 + rng.random() * span, 40 + rng.random() * span
        if i % 7 == 0 and rows:  # a repeated place
            lon, lat = rows[rng.randrange(len(rows))][1:3]
        rows.append((i * 3 + 5, lon, lat, 1.0 + rng.random(), 1.0 + 0.3 * rng.random(), rng.choice(["MODIS", "VIIRS"]),
                     f"2024-01-0{1 + i % days}"))
    return rows


def as_points(spark, rows):
    schema = "cleanid long, lon double, lat double, scan double, track double, instrument string, d string"
    return spark.createDataFrame(rows, schema).withColumn("acq_date_use", F.col("d").cast("date")).drop("d")


def widths(row, mode):
    _, _, lat, scan, track, inst, _ = row
    gc, size = 2 * math.pi * 6370.997, 1.0 if inst == "MODIS" else 0.375
    fx, fy = 180 * size / gc / math.cos(math.radians(lat)), 180 * size / gc
    if mode == "conservative":
        return fx, fy, fx, fy
    return 1.1 * 180 * scan / gc / math.cos(math.radians(lat)), 1.1 * 180 * track / gc, fx, fy


def brute_clusters(rows, mode):
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    w = {r[0]: widths(r, mode) for r in rows}
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[6] == b[6] and abs(a[1] - b[1]) < w[a[0]][0] + w[b[0]][0] and abs(a[2] - b[2]) < w[a[0]][1] + w[b[0]][1]:
                x, y = root(a[0]), root(b[0])
                parent[max(x, y)] = min(x, y)
    return {r[0]: root(r[0]) for r in rows}


@pytest.mark.parametrize("mode", ["aggressive", "conservative"])
def test_cluster_labels(spark, mode):
    rows = random_points(160)
    want = brute_clusters(rows, mode)
    got = {r.cleanid: (r.fireid, r.ndetect) for r in C.cluster(as_points(spark, rows), mode).points.collect()}
    sizes = pd.Series(want).value_counts()
    assert got == {k: (v, sizes[v]) for k, v in want.items()}


def test_cluster_is_independent_of_order_and_partitions(spark):
    rows = random_points(120, seed=4)
    a = C.cluster(as_points(spark, rows)).points.select("cleanid", "fireid", "ndetect").collect()
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    b = C.cluster(as_points(spark, shuffled).repartition(5)).points.select("cleanid", "fireid", "ndetect").collect()
    assert sorted(a) == sorted(b)


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(5)
    if kind == "chain":
        edges = [(i, i + 1) for i in range(300)]
    elif kind == "star":
        edges = [(7, i) for i in range(8, 300)]
    else:
        edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    parent = {n: n for e in edges for n in e}
    parent.update({999: 999})

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        x, y = root(u), root(v)
        parent[max(x, y)] = min(x, y)
    nodes = spark.createDataFrame([(n,) for n in parent], "node long")
    got = components.connected_components(spark.createDataFrame(edges, "src long, dst long"), nodes).collect()
    assert {r.node: r.component for r in got} == {n: root(n) for n in parent}
    sizes = pd.Series([root(n) for n in parent]).value_counts()
    assert all(r.n_nodes == sizes[r.component] for r in got)


def test_pairs_with_crowded_bins_match_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, 5 + rng.random() * 0.1, -3 + rng.random() * 0.1, 0.003 + 0.01 * rng.random(), 0.004) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, lon double, lat double, dx double, dy double").withColumn("g", F.lit(1))
    for hot in (2000, 7):
        got = sorted((r.a_id, r.b_id) for r in overlap_pairs(df, ["g"], "id", 0.05, hot).collect())
        want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0]
                      and abs(a[1] - b[1]) < a[3] + b[3] and abs(a[2] - b[2]) < a[4] + b[4])
        assert got == want
        near = sorted((r.a_id, r.b_id) for r in near_pairs(df, ["g"], "id", 0.01, hot).collect())
        assert near == sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and math.dist(a[1:3], b[1:3]) < 0.01)


def test_hot_lookup_is_a_left_join(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 50 + 10).alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m")).where("k <> 12")
    want = sorted(left.join(right, "k", "left").select("id", "k", "n", "m").collect())
    for hot in (10, 100, 10_000):
        got = sorted(hot_lookup(left, right, ["k"], "n", "id", hot).select("id", "k", "n", "m").collect())
        assert [tuple(r) for r in got] == [tuple(r) for r in want]


def hull_polygon(h):
    """Monotone chain over the eight corners."""
    pts = sorted({(c + s * d, e + t * f) for c, e, d, f in ((h.ax, h.ay, h.adx, h.ady), (h.bx, h.by, h.bdx, h.bdy))
                  for s in (-1, 1) for t in (-1, 1)})

    def half(seq):
        out = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return half(pts) + half(pts[::-1])


def inside_convex(poly, x, y, eps=1e-12):
    return all((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) >= -eps for a, b in zip(poly, poly[1:] + poly[:1]))


def test_pixels_match_convex_hulls(spark):
    rows = random_points(60, seed=2, span=0.06, days=1)
    hulls = C.cluster(as_points(spark, rows)).hulls
    res = 0.0021
    got = {tuple(r) for r in shapes.pixel_cells(hulls, res).collect()}
    want = set()
    for h in hulls.collect():
        poly = hull_polygon(h)
        xs, ys = [p[0] for p in poly], [p[1] for p in poly]
        for iy in range(int(min(ys) / res) - 1, int(max(ys) / res) + 2):
            for ix in range(int(min(xs) / res) - 1, int(max(xs) / res) + 2):
                if inside_convex(poly, (ix + 0.5) * res, (iy + 0.5) * res):
                    want.add((h.fireid, iy, ix))
    assert got == want


def test_strip_area_of_two_box_hull_matches_polygon(spark):
    rows = [(1, 20.0, 30.0, 1.5, 1.2, "MODIS", "2024-01-01"), (2, 20.011, 30.006, 1.5, 1.2, "MODIS", "2024-01-01")]
    hulls = C.cluster(as_points(spark, rows)).hulls
    h = hulls.collect()[0]
    poly = hull_polygon(h)
    planar = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(poly, poly[1:] + poly[:1])) / 2
    got = shapes.area_centroid(shapes.Shape(hulls).intervals, ["fireid"]).first()
    per_deg2 = spark.range(1).select((box_area_km2(F.lit(30.003), F.lit(0.01), F.lit(0.01)) / 0.0004).alias("k")).first().k
    assert got.area_sqkm == pytest.approx(planar * per_deg2, rel=5e-3)
    assert got.cen_lon == pytest.approx(20.0055, abs=1e-4) and got.cen_lat == pytest.approx(30.003, abs=1e-4)


def ring_of_sites(radius, n=40):
    """Sites around a circle: their hulls enclose a hole when the circle is large."""
    return [(i + 1, 50 + radius * math.cos(2 * math.pi * i / n), 0.5 + radius * math.sin(2 * math.pi * i / n), 1.0, 1.0,
             "VIIRS", "2024-01-01") for i in range(n)]


def test_small_holes_are_filled_and_large_ones_stay(spark):
    for radius, is_filled in ((0.0035, True), (0.02, False)):
        hulls = C.cluster(as_points(spark, ring_of_sites(radius))).hulls
        shape = shapes.Shape(hulls)
        middle = shape.intervals.where("x0 < 50.0 and x1 > 50.0 and abs(y - 0.5) < 0.0005").count()
        assert (middle > 0) == is_filled
        cells = shapes.pixel_cells(hulls, 0.0007, shape.filled)
        ix, iy = math.floor(50.0 / 0.0007), math.floor(0.5 / 0.0007)
        assert (cells.where(f"ix = {ix} and iy = {iy}").count() > 0) == is_filled


def sequential_skim(points, radius):
    """One strongest score at a time over all detections, coinciding ones included."""
    w = {}
    ids = list(points)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            d = math.sqrt((points[a][0] - points[b][0]) ** 2 + (points[a][1] - points[b][1]) ** 2)
            if d < radius:
                w.setdefault(a, {})[b] = w.setdefault(b, {})[a] = math.floor(min(1 / d if d else 3600.0, 1e12) * 1e6 + 0.5)
    members, alive, serial = {i: [i] for i in ids}, set(ids), 0
    while any(w.get(n) for n in alive):
        score = {n: sum(w[n].values()) for n in alive if w.get(n)}
        top = max(score.values())
        tied = {n for n in score if score[n] == top}
        while tied:
            group, todo = set(), [tied.pop()]
            while todo:
                n = todo.pop()
                group.add(n)
                near = tied.intersection(w[n])
                todo.extend(near)
                tied -= near
            outer = {}
            for n in group:
                for m, x in w[n].items():
                    if m not in group:
                        outer[m] = max(outer.get(m, 0), x)
                        del w[m][n]
            if len(group) > 1:
                serial -= 1
                members[serial] = [x for n in group for x in members[n]]
                w[serial] = outer
                for m, x in outer.items():
                    w[m][serial] = x
                alive.add(serial)
            for n in group:
                alive.discard(n)
                del w[n], members[n]
    return {min(m): (np.mean([points[x][0] for x in m]), np.mean([points[x][1] for x in m]), len(m)) for m in members.values()}


@pytest.mark.parametrize("group_edges", [20_000, 25, 0])
def test_skim_matches_one_at_a_time(spark, group_edges):
    rng = random.Random(12)
    points = {}
    for i in range(55):
        lattice = i < 30  # a lattice has many ties
        x = 3 + (0.005 * (i % 6) if lattice else 0.2 + 0.02 * rng.random())
        y = 4 + (0.005 * (i // 6) if lattice else 0.02 * rng.random())
        points[i + 1] = (x, y)
    for i in range(56, 61):
        points[i] = points[rng.randrange(1, 55)]
    want = sequential_skim(points, 0.5 / 60)
    df = spark.createDataFrame([(k, 1, x, y) for k, (x, y) in points.items()], "cleanid long, fireid long, lon double, lat double")
    got = {r.seed: (r.lon, r.lat, r.n_members) for r in skim.skim(df, max_group_edges=group_edges).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-9)


def test_skim_is_the_same_on_both_sides_of_the_limit(spark):
    """Thousands of places, most of them tied: kernel, rounds, and a limit that splits the groups between them."""
    rng = random.Random(4)
    rows, i = [], 0
    for fire in range(12):  # lattices of several sizes, with holes, doubled places and some jitter
        side = rng.randrange(6, 22)
        for k in range(side * side):
            if rng.random() < 0.85:
                jitter = rng.choice([0.0, 0.0, 0.0, 1e-4 * rng.random()])
                for _ in range(2 if rng.random() < 0.05 else 1):
                    i += 1
                    rows.append((i, fire, 0.005 * (k % side) + jitter, 10 + 0.005 * (k // side)))
    df = session_cut(spark.createDataFrame(rows, "cleanid long, fireid long, lon double, lat double"))
    assert i > 1500
    results = [sorted((r.fireid, r.seed, round(r.lon, 9), round(r.lat, 9), r.n_places, r.n_members) for r in skim.skim(df, max_group_edges=limit).collect())
               for limit in (10**9, 300, 0)]
    assert results[0] == results[1] == results[2]


def fires_and_seeds(spark, n=140, seed=9):
    rows = random_points(n, seed=seed, span=0.08, days=1)
    c = C.cluster(as_points(spark, rows))
    return c, skim.skim(c.points)


def test_points_go_to_the_nearest_seed(spark):
    c, seeds = fires_and_seeds(spark)
    table = {}
    for s in seeds.collect():
        table.setdefault(s.fireid, []).append((s.lon, s.lat, s.seed))
    got = subdivide.assign_points(c.points, seeds).collect()
    assert len(got) == 140
    for p in got:
        best = min(((p.lon - x) ** 2 + (p.lat - y) ** 2, sid) for x, y, sid in table[p.fireid])
        assert p.polyid == best[1]
    ids = subdivide.member_ids(subdivide.assign_points(c.points, seeds)).collect()
    assert sorted(r.cleanid for r in ids) == sorted(p.cleanid for p in got)


def test_points_of_a_fire_without_seed_stay(spark):
    points = spark.createDataFrame([(1, 1, 0.0, 0.0), (2, 7, 3.0, 1.0)], "cleanid long, fireid long, lon double, lat double")
    seeds = spark.createDataFrame([(1, 5, 0.001, 0.0)], "fireid long, seed long, lon double, lat double")
    got = {r.cleanid: r.polyid for r in subdivide.assign_points(points, seeds).collect()}
    assert got == {1: 5, 2: None}


def test_nearest_seed_far_away(spark):
    items = spark.createDataFrame([(1, 0.0, 0.0), (1, 3.0, 1.0), (1, 0.4, 0.0)], "fireid long, px double, py double")
    seeds = spark.createDataFrame([(1, 5, 0.001, 0.0), (1, 6, 9.0, 9.0)], "fireid long, seed long, lon double, lat double")
    got = {r.px: r.polyid for r in subdivide.nearest_seed(items, seeds).collect()}
    assert got == {0.0: 5, 3.0: 5, 0.4: 5}


def test_sub_areas_add_up_and_match_pixels(spark):
    c, seeds = fires_and_seeds(spark)
    shape = shapes.Shape(shapes.multi_hulls(c.hulls))
    parents = {r.fireid: r.area_sqkm for r in shapes.fire_areas(c.hulls, shape).collect()}
    subs = subdivide.sub_polygons(c.hulls, seeds, shape).collect()
    total = {}
    for r in subs:
        total[r.fireid] = total.get(r.fireid, 0.0) + r.area_sqkm
    assert total == pytest.approx(parents, rel=1e-9)
    # Fine pixels give the same cell sizes up to their own resolution.
    res = 0.0003
    cells = subdivide.cells_of(c.hulls, seeds, res, shape).groupBy("polyid").count().collect()
    count = {r.polyid: r["count"] for r in cells}
    per_pixel = 0.0003 ** 2 * 111.32 * 111.04 * math.cos(math.radians(40.04))
    for r in subs:
        if r.area_sqkm > 0.3:
            assert count[r.polyid] * per_pixel == pytest.approx(r.area_sqkm, rel=0.04)
