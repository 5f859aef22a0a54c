"""Steps whose stored and exchanged rows must not outgrow their input."""

import contextlib
import io
import math
import random

import pytest
from pyspark.sql import functions as F

from firegrid.operators import cluster as C, compare, outline as O, shapes, subdivide
from firegrid.operators.joins import near_pairs
from firegrid.plans import queries
from firegrid.session import cut


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().split("== Initial Plan ==")[-1]  # of a plan that has run, the part before is the final one


def boxes(spark, n=30, seed=5):
    rng = random.Random(seed)
    rows = [(i % 3, 2 + rng.random() * 0.05, 1 + rng.random() * 0.05, 0.005, 0.005, 2 + rng.random() * 0.05, 1 + rng.random() * 0.05, 0.005, 0.005) for i in range(n)]
    return spark.createDataFrame(rows, "fireid long, ax double, ay double, adx double, ady double, bx double, by double, bdx double, bdy double").withColumn("lone", F.lit(False))


def test_areas_by_fire_are_added_up_behind_one_exchange(spark):
    cols = "fireid long, v_lct int, area_sqkm double, f_lct double"
    a = spark.createDataFrame([(1, 5, 2.0, 0.5), (1, 5, 1.0, 1.0), (2, None, 3.0, 1.0), (None, 4, 1.0, 1.0), (3, 1, None, 1.0)], cols)
    b = spark.createDataFrame([(1, 5, 4.0, 0.5), (4, 2, 1.234, 1.0), (None, 4, 2.0, 1.0)], cols)
    out = compare.compare_by_fire({"x": a, "y": b})
    got = {(r.fireid, r.v_lct): (r.x, r.y) for r in out.collect()}
    assert out.columns == ["fireid", "v_lct", "x", "y"]
    assert got == {(1, 5): (2.0, 2.0), (2, None): (3.0, None), (None, 4): (1.0, 2.0), (3, 1): (None, None), (4, 2): (None, 1.23)}
    assert plan(out).count("Exchange ") == 1


def test_hulls_are_exchanged_not_their_strips(spark):
    rows = shapes.merge_intervals(shapes.strips(boxes(spark)))
    assert ", strip#" not in "".join(line for line in plan(rows).splitlines() if "Exchange " in line)
    assert rows.count() == rows.select("fireid", "strip", "x0").distinct().count() > 300  # several bands


def test_links_take_one_exchange_and_cross_bands(spark):
    inside = spark.createDataFrame([(7, s, 0.5 + s, 1.0, 0.0 if s % 2 else 1.0, 3.0) for s in range(3 * shapes.BAND_STRIPS)], "k long, strip int, y double, h double, x0 double, x1 double")
    found = O.links(inside, ["k"])
    assert plan(found).count("Exchange ") == 1
    ends = [r.end for r in found.collect()]
    assert len(ends) == len(set(ends)) == 6 * shapes.BAND_STRIPS


KEYS = ["fireid", "polyid"]


def shares(spark, max_pairs=O.MAX_FIRE_PAIRS):
    """Shares of three areas with holes (one has a single seed), of one without seeds and of a lone site."""
    hulls = boxes(spark, 48).withColumn("fireid", F.expr("if(ax < 2.005, 9, fireid)"))
    rng = random.Random(8)
    seeds = [(f, 100 * f + i, 2 + rng.random() * 0.05, 1 + rng.random() * 0.05) for f, n in ((0, 12), (1, 25), (2, 1), (5, 3)) for i in range(n)]
    seeds += [(1, 199, 2.01, 1.02), (1, 198, 2.01, 1.02), (1, 197, 2.01, 1.04), (7, 700, 3.0, 1.0)]
    lone = spark.createDataFrame([(7, 3.0, 1.0, 0.01, 0.02, 3.0, 1.0, 0.01, 0.02, True), (8, 3.0, 1.0, 0.01, 0.02, 3.0, 1.0, 0.01, 0.02, True)], hulls.schema)
    hulls = hulls.unionByName(lone)
    shape = shapes.Shape(shapes.multi_hulls(hulls), fill=False)
    return cut(O.sub_intervals(hulls, spark.createDataFrame(seeds, "fireid long, seed long, lon double, lat double"), shape, max_pairs))


def test_shares_are_one_row_each_and_measured_without_an_exchange(spark):
    inside = shares(spark)
    assert inside.count() == inside.select(*KEYS).distinct().count() == 12 + 27 - 1 + 1 + 1  # of the coinciding seeds one
    assert "Exchange" not in plan(O.perimeters(inside, KEYS)) and "Exchange" not in plan(O.rings(inside, KEYS))
    assert inside.where("fireid IN (5, 8, 9)").isEmpty()


def test_shares_are_the_same_on_both_sides_of_the_limit(spark):
    def flat(df):
        return sorted((r.fireid, r.polyid, r.strip, r.x0, r.x1, r.y, r.h) for r in O._unpacked(df, KEYS).collect())

    few = shares(spark)
    many, some = shares(spark, 0), shares(spark, 5_000)
    assert few.where("NOT whole").isEmpty() and many.where("whole").isEmpty()
    assert 0 < some.where("whole").count() < few.count()
    want = flat(few)
    assert len(want) > 2000 and len({r[:3] for r in want}) < len(want)  # several intervals on a strip
    for other in (many, some):
        got = flat(other)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert all(a[5:] == pytest.approx(b[5:], rel=1e-12) for a, b in zip(got, want))
        for keys in (KEYS, ["polyid"]):
            a, b = ({r.polyid: r for r in O.perimeters(df, keys).collect()} for df in (few, other))
            assert a.keys() == b.keys()
            assert all(a[k][len(keys):] == pytest.approx(b[k][len(keys):], rel=1e-9) for k in a)
        a, b = (sorted((r.fireid, r.ring, r.outer, r.is_outer, len(r.points), r.points) for r in O.rings(df, KEYS).collect()) for df in (few, other))
        assert [r[:5] for r in a] == [r[:5] for r in b] and not all(r[3] for r in a)
        assert all(tuple(p) == pytest.approx(tuple(q)) for r, s in zip(a, b) for p, q in zip(r[5], s[5]))


def test_shares_that_bear_one_id_are_one_area(spark):
    cols = "fireid long, polyid long, south double, h double, strip array<int>, x0 array<double>, x1 array<double>, whole boolean"
    rows = [(1, 5, 0.0, 1.0, [0], [0.0], [1.0], True), (2, 5, 0.0, 1.0, [1], [0.0], [1.0], True), (3, 6, 0.0, 1.0, [0], [0.0], [2.0], True)]
    inside = spark.createDataFrame(rows, cols)
    got = {r.polyid: (r.area_deg2, r.perimeter_deg) for r in O.perimeters(inside, ["polyid"]).collect()}
    assert got == {5: (2.0, 6.0), 6: (2.0, 6.0)}
    assert sorted(r.polyid for r in O.rings(inside, ["polyid"]).collect()) == [5, 6]
    assert O.perimeters(inside, KEYS).count() == 3


def test_sites_without_a_place_keep_their_row(spark):
    hulls = boxes(spark, 0).unionByName(spark.createDataFrame(
        [(1, None, 1.0, 0.01, 0.01, None, 1.0, 0.01, 0.01, True), (2, 3.0, 1.0, 0.01, 0.01, 3.0, 1.0, 0.01, 0.01, True)], boxes(spark, 1).schema))
    seeds = spark.createDataFrame([(1, 10, None, 1.0), (2, 20, 3.0, 1.0)], "fireid long, seed long, lon double, lat double")
    got = {r.polyid: (r.area_deg2, r.perimeter_deg, r.compactness) for r in O.perimeters(cut(O.sub_intervals(hulls, seeds)), KEYS).collect()}
    assert got[10] == (None, 0.0, 0.0) and got[20] == pytest.approx((0.0004, 0.08, math.pi / 4))


def test_rings_are_the_same_on_both_sides_of_the_limit(spark):
    inside = O.area_intervals(boxes(spark, 12))
    want = sorted(map(str, O.rings(inside, ["fireid"]).collect()))
    for limit in (1, 700):
        assert sorted(map(str, O.rings(inside, ["fireid"], limit).collect())) == want


def test_only_answers_of_a_seed_search_are_stored(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(subdivide, "cut", lambda df: stored.append(df.columns) or df.localCheckpoint())
    items = spark.createDataFrame([(1, 0.1, 0.1), (1, 3.0, 3.0), (2, 0.0, 0.0)], "fireid long, px double, py double")
    seeds = spark.createDataFrame([(1, 5, 0.1, 0.101), (1, 6, 0.1, 0.102)], "fireid long, seed long, lon double, lat double")
    got = {(r.fireid, r.px): r.polyid for r in subdivide.nearest_seed(items, seeds).collect()}
    assert got == {(1, 0.1): 5, (1, 3.0): 6, (2, 0.0): None}
    assert stored and all("cand" not in c for c in stored)


def test_stored_pairs_are_ids(spark, monkeypatch):
    stored = []
    keep = C.cut
    monkeypatch.setattr(C, "cut", lambda df: stored.append(df.columns) or keep(df))
    day = F.lit("2024-01-01").cast("date")
    p = spark.range(6).select(
        F.col("id").alias("cleanid"), day.alias("acq_date_use"), (F.col("id") * 0.004).alias("lon"), F.lit(0.0).alias("lat"),
        F.lit("MODIS").alias("instrument"), F.lit(1.0).alias("scan"), F.lit(1.0).alias("track"))
    assert C.cluster(p).points.select("fireid").distinct().count() == 1
    assert ["a_site", "b_site"] in stored and not any("a_lon" in c for c in stored)


@pytest.mark.parametrize("radius", [0.01, 0.25])
def test_near_pairs_on_bin_borders(spark, radius):
    rows = [(10 * i + j, radius * i / 2, radius * j * 0.999) for i in range(-4, 5) for j in range(10)]
    df = spark.createDataFrame(rows, "id long, lon double, lat double").withColumn("g", F.lit(1))
    got = sorted((r.a_id, r.b_id) for r in near_pairs(df, ["g"], "id", radius).collect())
    near = lambda a, b: ((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) ** 0.5 < radius
    assert got == sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and near(a, b))


def test_pixels_near_detections_are_listed_block_by_block(spark, monkeypatch):
    d = spark.createDataFrame([(0.631, -0.005), (0.645, -0.005), (-7.2, 3.3)], "longitude double, latitude double")
    monkeypatch.setattr(queries, "detections", lambda *_: d)
    got = queries.pixels(spark, "", 0.01, 2)
    seen = {(math.floor(x / 0.01), math.floor(y / 0.01)) for x, y in [(0.631, -0.005), (0.645, -0.005), (-7.2, 3.3)]}
    want = {(x + i, y + j) for x, y in seen for i in range(-2, 3) for j in range(-2, 3)}
    assert sorted((r.ix, r.iy) for r in got.collect()) == sorted(want)
    assert "(ix#" not in "".join(line for line in plan(got).splitlines() if "Exchange " in line)
