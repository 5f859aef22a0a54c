"""Readers, writers, streaming and comparisons."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from firegrid import lookups, session
from firegrid.operators import compare, emissions as E, report as S, subdivide as V
from firegrid.plans import derived
from firegrid.sources import detections as SD, fires as SF, lookups as SL, sinks
from firegrid.streaming import stream as T
from tests.conftest import SF_SMALL


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="fg-test-")


def put(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


HEAD = "latitude,longitude,brightness,scan,track,acq_date,acq_time,satellite,confidence,version,bright_t31,frp,daynight\n"


def test_detections_of_several_files(spark, folder):
    a = put(f"{folder}/MODIS_C6_1_Global_MCD14DL_NRT_2020298.txt", HEAD + "10.5,20.5,300,1,1,2020-10-24,0130,Terra,80,6.1,290,5.5,D\n" + "30.5,20.5,300,1,1,2020-10-24,01:30,Terra,80,6.1,290,5.5,D\n" * 2)
    b = put(f"{folder}/unknown_name.csv", "LATITUDE,LONGITUDE,ACQ_DATE,ACQ_TIME,SATELLITE,INSTRUMENT,TYPE\n-1,2,2020-10-25,5,N,VIIRS,2\n")
    df = SD.read_detections(spark, [a, b])
    rows = df.orderBy("rawid").collect()
    assert [r.rawid for r in rows] == [0, 1, 2, 3]
    assert sorted((r.src_file, r.instrument, r.type) for r in rows) == [(1, "MODIS", None)] * 3 + [(2, "VIIRS", 2)]
    assert df.where("src_file = 2").first().scan is None
    carried = SD.with_carryover(df.drop("rawid"), SD.read_one(spark, a), dt.date(2020, 10, 25))
    assert [(r.latitude, r.acq_date) for r in carried.where("src_file = 0").collect()] == [(10.5, dt.date(2020, 10, 25))]
    found, missing = SD.discover(spark, folder, "MODIS_C6_1_Global_MCD14DL_NRT_{yyyyjjj}.txt", [dt.date(2020, 10, 24), dt.date(2020, 10, 25)])
    assert len(found) == 1 and missing == ["MODIS_C6_1_Global_MCD14DL_NRT_2020299.txt"]
    with pytest.raises(FileNotFoundError):
        SD.discover(spark, folder, "MODIS_C6_1_Global_MCD14DL_NRT_{yyyyjjj}.txt", [dt.date(2021, 1, 1)])
    with pytest.raises(ValueError):
        SD.read_one(spark, put(f"{folder}/bad.csv", "a,b\n1,2\n"))


def test_old_fire_list_and_tiles(spark, folder):
    p = put(f"{folder}/v1.txt", "10.5,20.5,x,1.2,1.1,2010-02-03,'07:45',y,85,a,b,c,\r\n")
    r = SD.read_rawfires_v1(spark, p).first()
    assert (r.cen_lat, r.spix, r.acq_date_utc, r.tod, r.confidence) == (10.5, 1.2, dt.date(2010, 2, 3), 745, 85.0)
    t = put(f"{folder}/list.txt", "MCD.A2001.h08v05.hdf\nMCD.A2001.h08v05.xml\nno tile\nx.h10v11.hdf\n")
    assert sorted(r.tile for r in SD.read_tile_list(spark, t).collect()) == ["h08v05", "h10v11"]


def test_lookup_files(spark, folder):
    rows = lookups.EMISSION_FACTORS.strip().splitlines()
    named = [rows[0].replace("GenVegType", "GenVegType,GenVegDescript")] + [r.replace(",", ",name,", 1) for r in rows[1:]]
    p = put(f"{folder}/ef.csv", "Some title, of the file\n" + "\n".join(named) + "\n")
    assert sorted(SL.read_emission_factors(spark, p).collect()) == sorted(lookups.emission_factors(spark).collect())
    rows = lookups.VOC_SPLIT["SAPRC"].strip().splitlines()
    p = put(f"{folder}/voc.csv", "﻿Title,,,\n" + "\r\n".join([rows[0].replace("GenVegIndex", "GenVegIndex,EF_fuel_type")] + [r.replace(",", ",name,", 1) for r in rows[1:]]))
    assert sorted(SL.read_voc_split(spark, p).collect()) == sorted(lookups.voc_split(spark, "SAPRC").collect())
    p = put(f"{folder}/fuel.csv", lookups.FUEL_LOADS.strip())
    assert sorted(SL.read_fuel_loads(spark, p).collect()) == sorted(lookups.fuel_loads(spark).collect())
    p = put(f"{folder}/lct.csv", lookups.LCT_FUEL.strip())
    assert sorted(SL.read_lct_fuel(spark, p).collect()) == sorted(lookups.lct_fuel(spark).collect())
    with pytest.raises(ValueError):
        SL.read_lct_fuel(spark, f"{folder}/fuel.csv")
    p = put(f"{folder}/ef1.csv", "head\n" + ",".join(["2", "3", "forest"] + [str(x) for x in range(4, 21)]) + "\n")
    ef1 = {r.species: r.ef for r in SL.read_ef_v1(spark, p).collect()}
    assert (ef1["CO2"], ef1["NMOC"], ef1["NMHC"], ef1["PM10"]) == (4.0, 7.0, 19.0, 20.0)
    p = put(f"{folder}/spec.csv", "species,1,2,3,4,5,6\nACET,.1,.2,.3,.4,.5,.6\nALK1,1,2,3,4,5,6\n")
    sp = {(r.slot, r.species, r.type): r.frac for r in SL.read_speciation_v1(spark, p).collect()}
    assert sp[(1, "ACET", 6)] == 0.6 and sp[(2, "ALK1", 1)] == 1.0


def test_processed_fires_round_trip(spark, folder):
    f = derived.fires(spark, SF_SMALL).where("fireid < 20")
    sinks.write_fires(f, f"{folder}/out")
    back = SF.read_processed_fires(spark, f"{folder}/out/*")
    assert sorted(back.collect()) == sorted(f.select(*back.columns).collect())
    p = put(f"{folder}/odd.csv", "polyid,fireid,...\n1,2,3.5,4.5,2020-01-02,1.5,,12.0,.5,,,7,,\n1,2,3\n")
    r = SF.read_processed_fires(spark, p).collect()
    assert len(r) == 1 and (r[0].alg_agg, r[0].v_lct, r[0].v_tree, r[0].v_bare, r[0].v_regnum, r[0].v_frp) == (0, 12, 0.0, 7.0, 0, 0.0)


def test_emission_files(spark, folder):
    e = E.emit(E.accepted(E.burned_fires(derived.fires(spark, SF_SMALL).where("fireid < 40"))))
    sinks.write_emissions(e, f"{folder}/base")
    base = SF.read_emissions(spark, f"{folder}/base/*/*.csv")
    assert base.count() == e.count() and "frp" in base.columns
    a, b = base.agg(F.sum("CO")).first()[0], e.agg(F.sum("CO")).first()[0]
    assert a == pytest.approx(b, rel=1e-3)
    sinks.write_emissions(E.speciate(e, "GEOSCHEM", prefix="voc_"), f"{folder}/geos", "GEOSCHEM", legacy_id_swap=True)
    geos = SF.read_emissions(spark, f"{folder}/geos/*/*.csv")
    assert "frp" not in geos.columns and {"ACET", "NO", "NO_voc"} <= set(geos.columns)
    assert geos.agg(F.sum("polyid")).first()[0] == e.agg(F.sum("fireid")).first()[0]
    old = put(f"{folder}/old.txt", "DAY,TIME,GENVEG,LATI,LONGI,CO2,CO ;\n12,1330,3,1.5,2.5,10,20\n")
    r = SF.read_emissions(spark, old).first()
    assert (r.day, r.area_m2, r.CO2, r.CO) == (12, 2.5e5, 10.0, 20.0)
    assert SF.emissions_long(SF.read_emissions(spark, old), ["CO2", "CO"]).count() == 2


def test_stage_and_day_overwrite(spark, folder):
    df = derived.detections(spark, SF_SMALL).select("rawid", F.col("acq_date").alias("acq_date_use"))
    first = sinks.stage(spark, f"{folder}/s", lambda: df)
    again = sinks.stage(spark, f"{folder}/s", lambda: 1 / 0, run=False)
    assert first.count() == again.count() == 1000
    sinks.overwrite_days(df, f"{folder}/d")
    sinks.overwrite_days(df.where("acq_date_use = '2024-01-05' and rawid % 2 = 0"), f"{folder}/d")
    kept = spark.read.parquet(f"{folder}/d")
    assert kept.where("acq_date_use <> '2024-01-05'").count() == df.where("acq_date_use <> '2024-01-05'").count()
    assert kept.where("acq_date_use = '2024-01-05' and rawid % 2 = 1").count() == 0


def test_other_sinks(spark, folder):
    log = S.RunLog(spark)
    log.checkin("prep", "pnt", 10)
    log.checkout("prep", 7)
    log.checkin("bad")
    log.checkout("bad", 0)
    log.purge("bad")
    sinks.write_summary(log.events(), f"{folder}/log")
    assert spark.read.text(f"{folder}/log/text").first().value.startswith("prep: 10 -> 7 (-3)")
    assert spark.read.json(f"{folder}/log/json").count() == 1
    pts = spark.createDataFrame([(i, 5) for i in range(5000)], "cleanid long, polyid long")
    fire = derived.fires(spark, SF_SMALL).limit(1).withColumn("polyid", F.lit(5).cast("long"))
    sinks.write_polygons(fire, V.member_ids(pts), f"{folder}/poly")
    assert spark.read.parquet(f"{folder}/poly/polygons").count() == 1
    members = spark.read.parquet(f"{folder}/poly/members")
    assert sorted(r.cleanid for r in members.collect()) == list(range(5000))
    grid = spark.createDataFrame([("CO", dt.date(2020, 1, 1), 1, 2, 3.0)], "species string, date date, i int, j int, value double")
    sinks.write_grid(grid, f"{folder}/grid")
    assert spark.read.parquet(f"{folder}/grid").schema["value"].metadata["units"] == "molecules/cm^2/s"
    hulls = spark.createDataFrame([(1, dt.date(2020, 1, 1), 0.0, 0.0, 1.0, 1.0, 2.0, 0.0, 1.0, 1.0, False)], "fireid long, acq_date_use date, ax double, ay double, adx double, ady double, bx double, by double, bdx double, bdy double, lone boolean")
    sinks.write_hulls(hulls, f"{folder}/hulls")
    assert spark.read.parquet(f"{folder}/hulls").first().geom.startswith("MULTIPOINT (-1.0 -1.0, 1.0 -1.0")


def test_pixels_and_regions(spark, folder):
    spark.createDataFrame([(0, 0, 50, 200), (0, 1, 255, 30)], "iy int, ix int, lct int, tree int").write.parquet(f"{folder}/px")
    px = SF.read_pixels(spark, f"{folder}/px", ["lct", "tree"], (0, 100), 255)
    assert sorted((r.lct, r.tree) for r in px.collect() if r.lct) == [(50, None)]
    with pytest.raises(ValueError):
        SF.read_regions(spark, f"{folder}/px")


def test_stream_equals_batch(spark, folder):
    src, out = f"{folder}/in", f"{folder}/days"
    d = derived.detections(spark, SF_SMALL).where("rawid < 400")
    files = d.select("latitude", "longitude", "scan", "track", "acq_date", "acq_time", "satellite", F.lit(None).cast("string").alias("instrument"), "confidence",
                     F.lit("1").alias("version"), *[F.lit(1.0).alias(c) for c in ("brightness", "bright_t31", "bright_ti4", "bright_ti5")], "frp", F.lit("D").alias("daynight"), "type")
    def deliver(part):
        files.where(part).coalesce(1).write.mode("append").option("header", True).csv(src)
        job = T.run_available_now(T.stream_prep(T.drop_redelivered(T.with_event_time(T.stream_detections(spark, src)))), out, f"{folder}/cp")
        job.awaitTermination()
        assert job.exception() is None

    deliver("acq_date <= '2024-01-06'")
    deliver("acq_date >= '2024-01-06'")  # one day comes twice
    got = spark.read.parquet(out).select("lon", "lat", "acq_date_use", "acq_time_utc", "instrument", "scan", "frp")
    from firegrid.operators.prep import prepare

    want = prepare(files.dropDuplicates(T.KEYS).withColumn("rawid", F.monotonically_increasing_id())).select(*got.columns)
    assert got.count() == want.count() > 100
    assert sorted(got.select("lon", "lat", "acq_date_use").collect()) == sorted(want.select("lon", "lat", "acq_date_use").collect())


def test_diff_finds_changed_rows_once(spark):
    a = spark.createDataFrame([(1, 1, 1.000001, 2.0), (2, 2, 3.0, 4.0), (3, 3, 3.0, 4.0)], "fireid long, polyid long, cen_lon double, area_sqkm double")
    b = spark.createDataFrame([(7, 9, 1.000002, 2.0), (8, 8, 3.0, 4.0)], a.schema)
    d = compare.diff_outputs(a, b).collect()
    assert len(d) == 1 and (d[0].n_l, d[0].n_r, d[0].fireid_l) == (2, 1, 2)


def test_scratch_tables_can_be_dropped(spark):
    t, n = session.cut_counted(spark.range(7))
    assert (n, t.count()) == (7, 7)
    session.drop_scratch(spark)
    with pytest.raises(Exception):
        spark.read.parquet(session.run_dir(spark)).count()


def test_scratch_folder_follows_the_session():
    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    class Context:
        applicationId = "app-1"

    class Session:
        sparkContext = Context()

        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})

    assert session.scratch_dir(Session(spark_checkpoint_dir="hdfs:///tmp/x/")) == "hdfs:///tmp/x"
    assert session.scratch_dir(Session(spark_master="local[2]")) == session.scratch_dir(Session(spark_master="local[2]"))
    with pytest.raises(RuntimeError):
        session.scratch_dir(Session(spark_master="yarn"))


def test_own_tables_through_the_chain(spark):
    """A user's factors and split: their species come out, values by hand."""
    from firegrid.plans.runs import emissions

    fires = derived.fires(spark, SF_SMALL)
    veg = [1, 2, 3, 4, 5, 6, 9]
    factors = spark.createDataFrame([(v, s, mw, 2.0 * v) for v in veg for s, mw in (("XYL", 100.0), ("SOOT", 1.0), ("NMOC", 1.0))], "genveg int, species string, mw double, ef double")
    split = spark.createDataFrame([(v, "NEW", 0.5) for v in veg[:-1]], "genveg int, species string, frac double")
    out = emissions(fires, factors=factors, split=split)
    assert out.columns[-4:] == ["NMOC", "SOOT", "XYL", "voc_NEW"] and "CO" not in out.columns
    for row in out.limit(50).collect():
        burned = row.area_m2 * row.bmass
        assert abs(row.SOOT - 2e-3 * row.genveg * burned) <= 1e-9 * abs(row.SOOT)
        assert abs(row.XYL - 2e-3 * row.genveg / 0.1 * burned) <= 1e-9 * abs(row.XYL)
        assert abs(row.voc_NEW - (0.0 if row.genveg == 9 else 0.5 * row.NMOC)) <= 1e-9 * abs(row.NMOC)


def test_text_to_grid_over_two_years(spark, folder):
    """Emission text whose names carry the year: dates, then a monthly and a daily grid, written and read again."""
    from firegrid.operators import grid as G
    from firegrid.operators.speciesmap import parse_species_map

    os.makedirs(f"{folder}/txt")
    for year, day in ((2019, 365), (2020, 1), (2020, 366)):
        put(f"{folder}/txt/emis_{year}_{day}.txt", f"DAY,POLYID,FIREID,GENVEG,LATI,LONGI,AREA,BMASS,CO\n{day},1,1,3,10.2,20.3,1000,1.0,5.0\n")
    e = SF.read_emissions(spark, f"{folder}/txt")
    assert sorted(str(r.acq_date_utc) for r in e.collect()) == ["2019-12-31", "2020-01-01", "2020-12-31"]
    assert str(SF.read_emissions(spark, f"{folder}/txt/emis_2020_1.txt", 1999).first().acq_date_utc) == "1999-01-01"
    m = parse_species_map(spark, ["CO -> CO"])
    sinks.write_grid(G.grid_daily(e, m, "1x1"), f"{folder}/daily")
    sinks.write_grid(G.grid_monthly(e, m, "1x1"), f"{folder}/monthly", long_names={"CO": "carbon monoxide"})
    daily, monthly = spark.read.parquet(f"{folder}/daily"), spark.read.parquet(f"{folder}/monthly")
    assert daily.count() == monthly.count() == 3
    assert abs(daily.agg(F.sum("value")).first()[0] / monthly.agg(F.sum("value")).first()[0] - 31) < 1e-9
    assert monthly.schema["value"].metadata["long_names"] == {"CO": "carbon monoxide"}
    cells = spark.createDataFrame([("CO", dt.date(2020, 1, 1), 7, 1.0)], "species string, date date, cell int, value double")
    sinks.write_grid(cells, f"{folder}/cells")
    assert spark.read.parquet(f"{folder}/cells").first().cell == 7


def test_regional_and_first_generation_files(spark, folder):
    from firegrid.operators import wrf
    from firegrid.operators.speciesmap import parse_species_map
    from firegrid.plans.queries import DOMAINS, emitted

    hourly = wrf.grid_wrf(emitted(spark, SF_SMALL), DOMAINS["mercator"], parse_species_map(spark, ["CO -> CO"]))
    sinks.write_wrf(hourly, f"{folder}/wrf", 2)
    again = spark.read.parquet(f"{folder}/wrf")
    assert again.count() == hourly.count() and again.select("domain").distinct().first()[0] == 2
    v1 = spark.createDataFrame([(5, 1330, 2.0, 1.0), (300, 100, 3.0, 4.0)], "jday int, tod int, area_km2 double, CO double")
    sinks.write_v1(v1, f"{folder}/v1", 1, 100)
    row = spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/v1").collect()
    assert [(r.jday, r.tod, r.area_m2, r.CO) for r in row] == [(5, 1330, 2e6, 1.0)]


def test_numeric_confidence(spark):
    """85.0 of a numeric column is a whole number; a text is taken as it stands."""
    from firegrid.operators.prep import prepare

    raw = derived.detections(spark, SF_SMALL).where("upper(substring(satellite, 1, 1)) in ('T', 'A')")
    given = raw.withColumn("confidence", F.lit(85.0))
    text = raw.withColumn("confidence", F.lit("85"))
    assert prepare(given).count() == prepare(text).count() > 0


def test_pixel_tables_are_read_by_tile(spark, folder):
    from firegrid.operators import zonal

    res = 0.1
    px = spark.range(0, 600).select((F.col("id") * 7 % 300 - 150).alias("iy"), (F.col("id") % 400 - 200).alias("ix"), (F.col("id") % 5).cast("int").alias("lct"))
    sinks.write_pixels(px, f"{folder}/px", res)
    tiled = SF.read_pixels(spark, f"{folder}/px", ["lct"])
    cells = session.cut(px.where("ix between -20 and -11").select(F.lit(1).alias("polyid"), "iy", "ix"))
    want = sorted(zonal.class_histogram(cells, px).collect())
    got = zonal.class_histogram(cells, tiled, res=res)
    assert sorted(got.collect()) == sorted(zonal.class_histogram(cells, px, res=res).collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_model_cells_from_file(spark, folder):
    cells = spark.createDataFrame(
        [(1, 355.0, 5.0, 0.03, [350.0, 360.0, 360.0, 350.0, 350.0], [0.0, 0.0, 10.0, 10.0, 10.0]), (2, 10.0, 85.0, 0.01, [0.0, 90.0, 180.0, 270.0, 270.0], [80.0] * 5)],
        "cell int, lon double, lat double, area_sr double, corner_lon array<double>, corner_lat array<double>")
    cells.write.parquet(f"{folder}/cells.parquet")
    got = {r.cell: r for r in SF.read_model_polygons(spark, f"{folder}/cells.parquet").collect()}
    assert [(p.x, p.y) for p in got[1].ring][0] == (-10.0, 0.0) and len(got[1].ring) == 4
    assert len(got[2].ring) == 4


def test_a_stored_run_leaves_no_intermediate_tables(spark, folder):
    import glob

    from firegrid.plans.queries import PIXEL_RES, pixels, stripes
    from firegrid.plans.runs import Config, Layer, processed_fires

    px = session.cut(pixels(spark, SF_SMALL))
    layers = [Layer("thematic", px.select("iy", "ix", "lct"), ("lct",)), Layer("continuous", px, ("tree", "herb", "bare"), (0, 100)), Layer("polygons", stripes(spark, SF_SMALL))]
    out = processed_fires(derived.detections(spark, SF_SMALL), Config(layers, PIXEL_RES, path=f"{folder}/run"))
    assert out.count() > 0 and px.count() > 0
    assert not glob.glob(f"{session.run_dir(spark)}/scope-*")


def test_files_with_one_header_are_one_scan(spark, folder):
    line = "1.5,2.5,300,1.0,1.0,2020-10-25,0130,{sat},85,6,290,{frp},D\n"
    paths = []
    for i in range(6):
        os.makedirs(f"{folder}/day {i}", exist_ok=True)
        paths.append(put(f"{folder}/day {i}/same name.csv", HEAD + line.format(sat="T", frp=i + 1) + line.format(sat="A", frp=i + 1)))
    other = put(f"{folder}/short.csv", "latitude,longitude,acq_date,frp\n1,2,2020-10-25,9\n")
    df = SD.read_detections(spark, [*paths[:3], other, *paths[3:], paths[0]])
    got = sorted((r.src_file, r.frp) for r in df.collect())
    assert got == [(1, 1.0)] * 2 + [(2, 2.0)] * 2 + [(3, 3.0)] * 2 + [(4, 9.0)] + [(5, 4.0)] * 2 + [(6, 5.0)] * 2 + [(7, 6.0)] * 2 + [(8, 1.0)] * 2
    assert sorted(r.rawid for r in df.collect()) == list(range(15))
    twelve = SD.read_detections(spark, paths)
    assert sorted({r.src_file for r in twelve.collect()}) == [1, 2, 3, 4, 5, 6]
