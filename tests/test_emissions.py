"""Golden rows and rules of the emission models."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from firegrid import lookups
from firegrid.functions import dates, geo, text
from firegrid.plans import derived
from firegrid.operators import emissions as E, legacy as L, prep as P, speciesmap as M

FIRE = ("polyid long, fireid long, cen_lon double, cen_lat double, acq_date_utc date, area_sqkm double, alg_agg int, v_lct int, "
        "f_lct double, v_tree double, v_herb double, v_bare double, v_regnum int, v_frp double")


def fire(spark, **change):
    row = dict(polyid=0, fireid=0, cen_lon=52.94576, cen_lat=51.611920000000005, acq_date_utc=dt.date(2026, 5, 30),
               area_sqkm=1.0037730806999206, alg_agg=2, v_lct=12, f_lct=1.0, v_tree=1.1666666666666667, v_herb=55.5,
               v_bare=43.333333333333336, v_regnum=7, v_frp=33.48)
    row.update(change)
    return spark.createDataFrame([tuple(row.values())], FIRE)


def test_sample_row(spark):
    r = E.emit(E.accepted(E.burned_fires(fire(spark)))).first()
    assert r.genveg == 9
    assert r.bmass == pytest.approx(0.8951973333, rel=1e-9)
    assert r.area_m2 == pytest.approx(568804.74573, rel=1e-9)
    want = {"CO2": 16710771.7686, "CO": 1654875.59759, "CH4": 185218.76881, "NMOC": 26172.49407, "OC": 1354.45203, "BC": 259.68817}
    for s, v in want.items():
        assert r[s] == pytest.approx(v, rel=5e-9)  # the row is printed with that many digits


def test_lone_box_area(spark):
    df = spark.createDataFrame([(51.61192, "MODIS"), (51.61192, "VIIRS")], "lat double, instrument string").withColumn("scan", F.lit(1.0)).withColumn("track", F.lit(1.0))
    df = P.pixel_extent(df, "conservative")
    got = [r.a for r in df.select(geo.box_area_km2(F.col("lat"), F.col("fire_dx"), F.col("fire_dy")).alias("a")).collect()]
    assert got == pytest.approx([1.0037730852, 0.14115559023], rel=1e-9)


def test_cover_inside_tolerance_is_not_rescaled(spark):
    r = E.assign_genveg(E.clean_cover(fire(spark, cen_lat=-33.19938, v_lct=8, v_tree=36.078125, v_herb=58.515625, v_bare=5.984375, v_regnum=12))).first()
    assert (r.rescaled, r.genveg, r.tree) == (False, 2, 36.078125)


@pytest.mark.parametrize("change, reason", [
    (dict(v_regnum=0), "no region"), (dict(v_regnum=13), "no region"), (dict(v_lct=15), "land cover"), (dict(v_lct=17), "land cover"),
    (dict(v_bare=250.0), "total cover"), (dict(v_tree=0.0, v_herb=0.0, v_bare=0.0), "total cover"),
    (dict(v_lct=1, v_regnum=2), "fuel"), (dict(f_lct=1e-7), "area"), (dict(v_lct=None), "land cover"),
])
def test_reject_reasons(spark, change, reason):
    assert E.burned_fires(fire(spark, **change)).first().reject_reason == reason


def test_speciation_and_missing_split(spark):
    out = E.speciate(E.emit(E.accepted(E.burned_fires(fire(spark)))), "SAPRC", prefix="voc_").first()
    assert out.voc_CCHO == pytest.approx(3.05 * out.NMOC)
    no_split = lookups.voc_split(spark, "SAPRC").where("genveg <> 9")
    out = E.speciate(E.emit(E.accepted(E.burned_fires(fire(spark)))), "SAPRC", no_split, prefix="voc_").first()
    assert out.voc_CCHO == 0.0


def test_dates_and_text(spark):
    one = spark.range(1)
    r = one.select(
        dates.yyyyddd_to_date(F.lit("2026100")).alias("a"), dates.date_to_yyyyddd(F.lit("2024-12-31").cast("date")).alias("b"),
        *[F.hour(dates.local_solar_ts(F.lit("2024-01-01").cast("date"), F.lit("0000"), F.lit(x))).alias(n) for n, x in (("h1", -7.5), ("h2", 7.5), ("h3", 22.5))],
        text.normalize_hhmm(F.lit("7:05")).alias("t1"), text.normalize_hhmm(F.lit(None).cast("string")).alias("t2"),
        *[text.instrument_from_satellite(F.lit(s)).alias(f"i{n}") for n, s in enumerate(["Terra", "aqua", "N", "FALSE", "TRUE", "X", "N20"])],
        *[text.is_confident(F.lit(i), F.lit(c)).alias(f"c{n}") for n, (i, c) in enumerate([("MODIS", "20"), ("MODIS", "19"), ("MODIS", "20.5"), ("VIIRS", "low"), ("VIIRS", "n"), ("VIIRS", None), (None, "90")])],
        text.instrument_from_path(F.lit("/d/SUOMI_VIIRS_C2_Global_2024001.txt")).alias("p1"), text.instrument_from_path(F.lit("/modis/x.csv")).alias("p2"),
        text.tile_from_name(F.lit("MCD.A2019001.H08V05.hdf")).alias("tile"), geo.modis_tile(F.lit(-100.0), F.lit(40.0)).alias("mt"),
    ).first()
    assert r.a == dt.date(2026, 4, 10) and r.b == "2024366"
    assert (r.h1, r.h2, r.h3) == (0, 0, 2)
    assert (r.t1, r.t2) == ("0705", "0000")
    assert [r[f"i{n}"] for n in range(7)] == ["MODIS", "MODIS", "VIIRS", "VIIRS", None, None, "VIIRS"]
    assert [r[f"c{n}"] for n in range(7)] == [True, False, False, False, True, False, False]
    assert (r.p1, r.p2, r.tile) == ("VIIRS", None, "h08v05")
    assert r.mt == "h10v05"


def test_month_helpers():
    assert dates.snap_months(dt.date(2019, 1, 15), dt.date(2019, 4, 10)) == (dt.date(2019, 2, 1), dt.date(2019, 3, 31))
    with pytest.raises(ValueError):
        dates.snap_months(dt.date(2019, 1, 2), dt.date(2019, 1, 30))
    assert dates.parse_years("2002-2004,2007") == [2002, 2003, 2004, 2007]


def test_species_map(spark):
    m = M.parse_species_map(spark, ["MTERP -> APIN+BPIN", "num((particles/cm2/s)(g/kg))->5.6e18*[BC];aerosol", "x ->0.5*CO+NO;aerosol(24)", "H2=0.5"])
    rows = {(r.target, r.source): r for r in m.collect()}
    assert rows[("num", "BC")].units == "(particles/cm2/s)(g/kg)" and rows[("num", "BC")].weight == 5.6e18 and rows[("num", "BC")].is_aerosol
    assert rows[("num", "BC")].map == "num->5.6e18*[BC];aerosol"
    assert rows[("x", "CO")].weight == 0.5 and rows[("x", "NO")].mw == 24.0 and rows[("MTERP", "BPIN")].mw == 12.0
    assert rows[("H2", None)].conc == 0.5
    with pytest.raises(ValueError):
        M.parse_species_map(spark, ["nothing here"])
    with pytest.raises(ValueError):
        M.check_species(m, ["CO", "NO", "BC"])
    M.check_species(m, ["CO", "NO", "BC", "APIN", "BPIN"])


def sequential_overlaps(rows):
    order = sorted(rows, key=lambda r: (-r[4] * r[5], r[0]))
    kept = []
    for r in order:
        x, y = 6371 * math.radians(r[1]) * math.cos(math.radians(r[2])), 6371 * math.radians(r[2])
        hidden = any(k[0][3] == r[3] and abs(x - k[1]) <= k[0][5] and abs(y - k[2]) <= k[0][4] for k in kept)
        if not hidden:
            kept.append((r, x, y))
    return sorted(k[0][0] for k in kept)


def test_overlaps_match_one_at_a_time(spark):
    import random

    rng = random.Random(6)
    rows = [(i, 10 + rng.random() * 0.15, 5 + rng.random() * 0.15, 1 + i % 2, rng.choice([1.0, 1.5, 2.3]), rng.choice([1.0, 1.2])) for i in range(200)]
    rows += [(200 + i, *rows[3][1:]) for i in range(30)]
    df = spark.createDataFrame(rows, "rid long, cen_lon double, cen_lat double, jday int, spix double, tpix double")
    assert sorted(r.rid for r in L.remove_overlaps(df).collect()) == sequential_overlaps(rows)


def test_v1_confidence_all_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0)], "rid long, confidence double")
    assert L.confidence_v1(df).count() == 2
    assert L.confidence_v1(df.union(spark.createDataFrame([(3, 21.0), (4, 20.0)], df.schema))).count() == 1


def test_v1_cane_box_and_moz4_slots(spark):
    f = fire(spark, cen_lon=-48.0, cen_lat=-21.0, v_regnum=3).withColumn("jday", F.lit(10)).withColumn("rid", F.lit(1)).withColumn("factor", F.lit(0.5))
    b = L.burn_v1(f).first()
    assert (b.fuel, b.genveg, b.reject_reason) == (1100.0, 9, None)
    e = L.emit_v1(E.accepted(L.burn_v1(f)), derived.synthetic_factors_v1(spark))
    table = spark.createDataFrame([(s, f"S{s}", t, 0.1 * s) for s in range(1, 29) for t in range(1, 7)], "slot int, species string, type int, frac double")
    r, out = e.first(), L.speciate_v1(e, table, "MOZ4")
    assert [c for c in out.columns if c[:2] in ("m_", "v_")][:4] == ["m_CO2", "m_CO", "m_H2", "m_NO"] and len(out.columns) == 40 + 6
    o = out.first()
    assert o.m_NO == pytest.approx(r.NO * 1e3 / 30.01 + 2.5 * r.NMOC) and o.v_S24 == pytest.approx(2.4 * r.NMOC)


def test_whole_chain_totals(spark, monkeypatch):
    """The query's last step on given fires: the same totals as by sums of biomass, and by adding up."""
    from firegrid.plans import queries

    rows = fire(spark).unionByName(fire(spark, polyid=1, v_lct=2, area_sqkm=2.5)).unionByName(fire(spark, polyid=2, area_sqkm=3.0))
    monkeypatch.setattr(queries, "processed", lambda spark, sf: rows)
    got = {r.genveg: r for r in queries.REGISTRY["detections_to_emissions"](spark, "").collect()}
    fires = E.emit(E.accepted(E.burned_fires(rows))).collect()
    assert len(fires) == 3 and set(got) == {None} | {r.genveg for r in fires}
    for veg, r in got.items():
        some = [f for f in fires if veg in (None, f.genveg)]
        assert r.n_fires == len(some)
        assert r.biomass_kg == pytest.approx(sum(f.area_m2 * f.bmass for f in some), abs=1)
        assert [r.area_m2, r.CO2, r.CO, r.NMOC] == pytest.approx([sum(f[c] for f in some) for c in ("area_m2", "CO2", "CO", "NMOC")], abs=1)
