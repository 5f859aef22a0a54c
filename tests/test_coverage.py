"""Footprints of valid pixels as bitmaps, and the tiles that areas touch, against sets and sampled places."""

import math
import random

from pyspark.sql import functions as F

from firegrid.operators import coverage as Q


def tile(x, y):
    return f"h{math.floor(x * math.cos(math.radians(y)) / 10 + 18):02d}v{math.floor(9 - y / 10):02d}"


def test_bitmaps_hold_what_was_put_in(spark):
    rng = random.Random(1)
    side = 400
    places = [(rng.uniform(-40, 40), rng.uniform(-35, 35)) for _ in range(3000)]
    places += places[:500] * 3
    df = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(places)] + [(-1, None, 1.0), (-2, 1.0, None)], "id long, lon double, lat double").repartition(3)
    pixel = df.select("id", *Q.pixel_of(F.col("lon"), F.col("lat"), side))
    where = {r.id: (r.tile, r.pos) for r in pixel.where("id >= 0").collect()}
    assert all(1 <= pos <= side * side and t == tile(*places[k]) for k, (t, pos) in where.items())
    first, second = pixel.where("id % 4 = 0"), pixel.where("id % 7 = 0")
    valid = {where[k] for k in where if k % 4 == 0 or k % 7 == 0}
    prints = Q.united([Q.footprint(first), Q.footprint(second), Q.footprint(second)])
    assert {r.tile: r.n_pixels for r in Q.n_valid(prints).collect()} == {t: sum(v[0] == t for v in valid) for t in {v[0] for v in valid}}
    got = {r.tile: (r.n_fire, r.n_contained) for r in Q.contained(df, prints, side).collect()}
    want = {}
    for v in where.values():
        n, inside = want.get(v[0], (0, 0))
        want[v[0]] = (n + 1, inside + (v in valid))
    assert got == want


def test_every_bit_of_a_bucket(spark):
    pos = spark.range(1, 70_001).select(F.lit("h18v08").alias("tile"), F.col("id").alias("pos"))
    prints = Q.footprint(pos.where("pos % 3 = 1"))
    keyed = pos.select("tile", "pos", F.bitmap_bucket_number("pos").alias("bucket"), F.bitmap_bit_position("pos").alias("bit"))
    wrong = keyed.join(prints, ["tile", "bucket"], "left").where(Q._has(F.col("bits"), F.col("bit")) != (F.col("pos") % 3 == 1))
    assert wrong.isEmpty()


def test_no_footprint(spark):
    none = Q.footprint(spark.createDataFrame([], "tile string, pos long"))
    points = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "lon double, lat double")
    assert [(r.n_fire, r.n_contained) for r in Q.contained(points, none, 100).collect()] == [(2, 0)]


def test_tiles_of_boxes(spark):
    """All tiles of a fine net of places in each box are there, and no tile without a place nearby."""
    rng = random.Random(7)
    boxes = [(k, x := rng.uniform(-170, 150), x + rng.choice([0.01, 3.0, 25.0]), y := rng.uniform(-80, 70), y + rng.choice([0.01, 2.0, 18.0])) for k in range(60)]
    boxes += [(100, -30.0, 30.0, -12.0, 12.0), (101, -100.0, -99.0, -1.0, 1.0), (102, 0.5, 0.5, 0.5, 0.5)]
    got = {}
    for r in Q.tiles_of(spark.createDataFrame(boxes, "id long, x0 double, x1 double, y0 double, y1 double"), ["id"]).collect():
        got.setdefault(r.id, set()).add(r.tile)
    for k, x0, x1, y0, y1 in boxes:
        n = 60
        net = {tile(x0 + (x1 - x0) * i / n, y0 + (y1 - y0) * j / n) for i in range(n + 1) for j in range(n + 1)}
        assert net <= got[k]
        # A tile found beyond the net is cut at a corner only: the net around a slightly larger box meets it.
        d = 0.5
        wide = {tile(x0 - d + (x1 - x0 + 2 * d) * i / n, y0 - d + (y1 - y0 + 2 * d) * j / n) for i in range(n + 1) for j in range(n + 1)}
        assert got[k] <= wide
