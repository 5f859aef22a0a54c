"""Grids, projections, regional domains and pixel tables."""

import math

import pytest
from pyspark.sql import functions as F

from firegrid.functions import geo
from firegrid.functions.projection import LAMBERT, LATLON, MERCATOR, POLAR, Domain, ijll, llij
from firegrid.operators import grid as G, raster as R, speciesmap as M, wrf as W


@pytest.mark.parametrize("name", sorted(G.GRIDS))
def test_cell_areas_cover_the_sphere(spark, name):
    total = G.regular_grid(spark, name).agg(F.sum("area_cm2").alias("a"), F.count("*").alias("n")).first()
    assert total.a == pytest.approx(4 * math.pi * (G.EARTH_M * 100) ** 2, rel=1e-9)


def test_legacy_pole_rows_are_larger(spark):
    a = G.regular_grid(spark, "1.9x2.5").where("j = 1").first().area_cm2
    b = G.regular_grid(spark, "1.9x2.5", legacy_pole_area=True).where("j = 1").first().area_cm2
    assert b > 50 * a


def test_cell_index_wraps(spark):
    pts = spark.createDataFrame([(-0.2, 0.0), (359.9, -90.0), (0.4, 90.0), (-180.0, 10.0)], "lon double, lat double")
    g = G.grid("0.9x1.25")
    i, j = G.cell_index(g, F.col("lon"), F.col("lat"))
    assert [(r.i, r.j) for r in pts.select(i.alias("i"), j.alias("j")).collect()][1:3] == [(1, 1), (1, 192)]
    i, j = G.cell_index(G.grid("1x1"), F.col("lon"), F.col("lat"))
    assert [(r.i, r.j) for r in pts.select(i.alias("i"), j.alias("j")).collect()] == [(360, 91), (360, 1), (1, 180), (181, 101)]


def test_dense_and_monthly(spark):
    m = M.parse_species_map(spark, ["CO -> CO"])
    e = spark.createDataFrame([("2019-02-03", 10.2, 5.1, 100.0), ("2019-02-20", 10.4, 5.4, 40.0)], "d string, cen_lon double, cen_lat double, CO double")
    daily = G.grid_daily(e.withColumn("acq_date_utc", F.col("d").cast("date")), m, "T42LR")
    full = G.dense(daily, "T42LR")
    assert full.count() == 2 * 128 * 64
    month = G.monthly_mean(daily).agg(F.sum("value").alias("v")).first().v
    assert month == pytest.approx(daily.agg(F.sum("value")).first()[0] / 28)


DOMAINS = [
    Domain(LAMBERT, 100, 80, -97.0, 38.0, -97.0, 30.0, 60.0, 36000.0), Domain(LAMBERT, 100, 80, 145.0, -30.0, 145.0, -30.0, -30.0, 30000.0),
    Domain(POLAR, 90, 90, -100.0, 65.0, -100.0, 60.0, 60.0, 40000.0), Domain(MERCATOR, 100, 60, 20.0, 5.0, 20.0, 10.0, 0.0, 50000.0),
    Domain(LATLON, 40, 30, -30.0, -10.0, dlon=0.5, dlat=0.5),
]


@pytest.mark.parametrize("g", DOMAINS)
def test_projection_inverts_and_is_centred(spark, g):
    pts = spark.range(1, 30).select((F.col("id") * 1.0 + 0.25).alias("i"), (F.col("id") * 0.9).alias("j"))
    lat, lon = ijll(g, F.col("i"), F.col("j"))
    back = pts.select("i", "j", lat.alias("lat"), lon.alias("lon"))
    i, j = llij(g, F.col("lat"), F.col("lon"))
    assert back.select(F.max(F.abs(i - F.col("i")) + F.abs(j - F.col("j")))).first()[0] < 1e-8
    i, j = llij(g, F.lit(g.lat), F.lit(g.lon))
    want = (1.0, 1.0) if g.is_latlon else g.centre
    assert spark.range(1).select(i, j).first()[:2] == pytest.approx(want, abs=1e-9)


def test_hourly_emissions_sum_to_the_day(spark):
    g = DOMAINS[3]
    e = spark.createDataFrame([("2019-02-03", 20.0, 5.0, 240.0, 864.0, 9.0e5), ("2019-02-03", 20.01, 5.01, 24.0, 0.0, 1.5e6), ("2019-02-03", 120.0, 5.0, 1.0, 1.0, 1.0)],
                              "d string, cen_lon double, cen_lat double, CO double, OC double, area_m2 double").withColumn("acq_date_utc", F.col("d").cast("date"))
    out = W.grid_wrf(e, g, M.parse_species_map(spark, ["CO -> CO", "oc -> OC;aerosol"]))
    assert out.count() == 24
    r = out.agg(F.sum("ebu_in_CO").alias("co"), F.sum("ebu_in_oc").alias("oc"), F.max("fire_size").alias("s")).first()
    assert r.co == pytest.approx(264.0 / (50.0 * 50.0))  # mol per km2 and day
    assert r.oc == pytest.approx(24 * 864.0 * 1e9 / 86400 / (50000.0 ** 2))  # ug/m2/s
    assert r.s == 2.0e6
    peak = out.orderBy(F.desc("ebu_in_CO")).first()
    assert peak.hour == (13 - 1) % 24  # local 13h at 20 E is 12h UTC


def test_unstructured_cells(spark):
    cells = spark.createDataFrame([
        (1, 175.0, 5.0, 0.01, [170.0, 190.0, 190.0, 170.0, 170.0], [0.0, 0.0, 10.0, 10.0, 10.0]),
        (2, 0.0, 88.0, 0.01, [0.0, 90.0, 180.0, 270.0], [85.0, 85.0, 85.0, 85.0]),
        (3, 5.0, 5.0, 0.02, [0.0, 10.0, 10.0, 10.0], [0.0, 0.0, 10.0, 10.0]),
    ], "cell long, lon double, lat double, area_sr double, corner_lon array<double>, corner_lat array<double>")
    g = G.mark_grid_cells(G.trim_corners(cells))
    rows = {r.cell: r for r in g.collect()}
    assert [len(rows[c].ring) for c in (1, 2, 3)] == [4, 4, 3]  # one repeat goes from cells 1 and 3
    assert rows[1].x180 and rows[1].active and not rows[2].active and not rows[3].x180
    pts = spark.createDataFrame([(1, -175.0, 5.0), (2, 175.0, 5.0), (3, 9.0, 1.0), (4, 1.0, 9.0), (5, 185.0, 2.0), (6, 20.0, 89.0)], "rid long, cen_lon double, cen_lat double")
    got = {r.rid: r.cell for r in G.locate_cells(pts, g, "rid").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: None, 5: 1, 6: None}
    bad = spark.createDataFrame([(9, 0.0, 0.0, 0.1, [1.0, 2.0, 2.0], [1.0, 2.0, 2.0])], cells.schema)
    with pytest.raises(Exception, match="fewer than 3"):
        G.trim_corners(bad).collect()


def test_rings(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3))])
    r = spark.range(1).select(
        geo.ring_area(ring).alias("a"), geo.point_in_ring(ring, F.lit(1.0), F.lit(1.0)).alias("i"), geo.point_in_ring(ring, F.lit(5.0), F.lit(1.0)).alias("o"),
        geo.point_in_ring(ring, F.lit(4.0), F.lit(3.0)).alias("v"), geo.polsby_popper(F.lit(math.pi), F.lit(2 * math.pi)).alias("pp"),
        F.size(geo.tile_boundary(F.lit(18), F.lit(8))).alias("n"), geo.tile_boundary(F.lit(0), F.lit(8))[0]["x"].alias("edge"),
    ).first()
    assert (r.a, r.i, r.o, r.v, r.n) == (12.0, True, False, True, 42) and r.pp == pytest.approx(1.0) and r.edge == -180.0


def test_sinusoidal_pixels_land_in_their_tile(spark):
    px = spark.createDataFrame([(10, 5, 100, 200), (20, 11, 2399, 0)], "h int, v int, row int, col int")
    lon, lat = R.sinusoidal_lonlat(F.col("h"), F.col("v"), F.col("row"), F.col("col"))
    for r in px.select("h", "v", lon.alias("lon"), lat.alias("lat")).withColumn("t", geo.modis_tile(F.col("lon"), F.col("lat"))).collect():
        assert r.t == f"h{r.h:02d}v{r.v:02d}"
