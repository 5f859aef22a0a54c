"""The first-generation model: point fires with fixed areas, overlap removal, per-class factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firegrid import lookups
from firegrid.operators.emissions import assign_genveg, burned_biomass, clean_cover
from firegrid.operators.joins import split_hot_bins
from firegrid.session import cut

# Sphere radius (km), box scale, weight of tropical copies, molar weights.
EARTH_KM = 6371.0
BOX_SCALE = 2.0
COPY_FACTOR = 0.5
MOLAR = {"CO2": 44.01, "CO": 28.01, "CH4": 16.04, "NH3": 17.03, "NO": 30.01, "NO2": 46.01, "SO2": 64.06, "H2": 2.02}
# Crop fuel (g/m2), inside and outside the sugar-cane box (lon, lat limits).
CROP_FUEL, CANE_FUEL = 500.0, 1100.0
CANE_BOX = (-49.156, -47.323, -22.708, -20.356)
# Land cover -> row of the factor table where they differ.
FACTOR_ROW = {14: 13, 16: 14}
SPECIES = ["CO2", "CO", "CH4", "NMHC", "NMOC", "H2", "NOX", "NO", "NO2", "SO2", "PM25", "TPM", "TPC", "OC", "BC", "NH3", "PM10"]
# Output order per mechanism; a number n stands for the n-th row of the speciation table.
SLOTS = {
    "MOZ4": ["CO2", "CO", "H2", "NO+25", "NO2", "SO2", "NH3", "CH4", "NMOC", *range(1, 25), 26, 27, 28, "OC", "BC", "PM10", "PM25"],
    "SAPRC99": ["CO2", "CO", "NO", "NO2", "SO2", "NH3", "CH4", "NMOC", *range(1, 29), "OC", "BC", "PM10", "PM25"],
    "GEOSCHEM": ["CO2", "CO", "NO+18", "NO2", "SO2", "NH3", "CH4", *range(1, 18), "OC", "BC", "PM25"],
}


def confidence_v1(df: DataFrame, minimum: float = 20) -> DataFrame:
    """Keep confidence above the minimum; a file whose values are all zero counts as fully confident.

    The global test is a scalar subquery: one aggregated value.
    """
    any_set = df.agg(F.coalesce(F.bool_or(F.col("confidence") != 0), F.lit(False))).scalar()
    return df.where(~any_set | (F.col("confidence") > minimum))


def duplicate_tropics_v1(df: DataFrame, factor: float = COPY_FACTOR) -> DataFrame:
    """Repeat fires between 30 S and 30 N on the next day with a reduced weight ``factor``."""
    tropical = (F.col("cen_lat") > -30) & (F.col("cen_lat") < 30)
    copies = F.when(tropical, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        df.withColumn("copy", F.explode(copies)).withColumn("jday", F.col("jday") + F.col("copy"))
        .withColumn("factor", F.when(F.col("copy") == 1, factor).otherwise(1.0))
    )


def order_by_area(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc(F.col("spix") * F.col("tpix")), "rid")


def order_by_day(df: DataFrame, day: str = "jday", *ids: str) -> DataFrame:
    return df.orderBy(day, *ids)


def days_in_run_year(df: DataFrame, date: str = "acq_date_utc") -> DataFrame:
    """One row: 366 if the last fire falls in a leap year, else 365."""
    last = F.max(date)
    return df.agg(F.dayofyear(F.make_date(F.year(last), F.lit(12), F.lit(31))).alias("n_days"))


def cover_pairs(fires: DataFrame, bin_km: float = 8.0) -> DataFrame:
    """(day, winner, loser): the loser's centre lies in the box of a fire that precedes it by area.

    ``fires``: jday, rid, x, y (km), spix, tpix.  Boxes are listed in the bins they touch, centres
    in one bin; crowded bins are split.
    """
    half_x, half_y = F.col("tpix") * BOX_SCALE / 2.0, F.col("spix") * BOX_SCALE / 2.0
    boxes = fires.select("jday", "rid", "x", "y", half_x.alias("hx"), half_y.alias("hy"), (F.col("spix") * F.col("tpix")).alias("size"))
    listed = boxes.withColumn("_bx", F.explode(F.sequence(
        F.floor((F.col("x") - F.col("hx")) / bin_km), F.floor((F.col("x") + F.col("hx")) / bin_km)
    ))).withColumn("_by", F.explode(F.sequence(
        F.floor((F.col("y") - F.col("hy")) / bin_km), F.floor((F.col("y") + F.col("hy")) / bin_km)
    )))
    centres = boxes.withColumn("_bx", F.floor(F.col("x") / bin_km)).withColumn("_by", F.floor(F.col("y") / bin_km))
    a, b = split_hot_bins(listed, centres, ["jday", "_bx", "_by"], "rid")
    a = a.select("jday", "_bx", "_by", "_salt", *[F.col(c).alias(f"a_{c}") for c in ("rid", "x", "y", "hx", "hy", "size")])
    b = b.select("jday", "_bx", "_by", "_salt", *[F.col(c).alias(f"b_{c}") for c in ("rid", "x", "y", "size")])
    first = (F.col("a_size") > F.col("b_size")) | ((F.col("a_size") == F.col("b_size")) & (F.col("a_rid") < F.col("b_rid")))
    return (
        a.join(b, ["jday", "_bx", "_by", "_salt"]).where(first)
        .where(F.col("b_x").between(F.col("a_x") - F.col("a_hx"), F.col("a_x") + F.col("a_hx")))
        .where(F.col("b_y").between(F.col("a_y") - F.col("a_hy"), F.col("a_y") + F.col("a_hy")))
        .select("jday", F.col("a_rid").alias("winner"), F.col("b_rid").alias("loser"))
    )


def remove_overlaps(fires: DataFrame, lon: str = "cen_lon", lat: str = "cen_lat") -> DataFrame:
    """Drop fires whose centre lies in the box of a larger fire that is itself kept, per day.

    The same outcome as going through the fires from the largest down: a fire is kept once all
    fires that could remove it are gone, and removed once one of them is kept; every round settles
    all fires for which that is known, at least the largest of those left.  Equal fires at one place are settled up front (the first
    one stands for all), so a crowded place costs one row.
    """
    x = EARTH_KM * F.radians(lon) * F.cos(F.radians(lat))
    placed = fires.withColumn("x", x).withColumn("y", EARTH_KM * F.radians(lat))
    shape = ["jday", "x", "y", "spix", "tpix"]
    heads = cut(placed.groupBy(*shape).agg(F.min("rid").alias("rid")))
    open_pairs = cut(cover_pairs(heads).select("winner", "loser"))
    removed = None
    while not open_pairs.isEmpty():
        # Winners nobody can remove any more are kept; what they cover goes.
        losers = open_pairs.select(F.col("loser").alias("winner")).distinct()
        gone = cut(open_pairs.join(losers, "winner", "left_anti").select(F.col("loser").alias("rid")).distinct())
        removed = gone if removed is None else removed.unionByName(gone)
        for side in ("winner", "loser"):
            open_pairs = open_pairs.join(gone.withColumnRenamed("rid", side), side, "left_anti")
        # Pairs of a kept winner end with its losers; the rest stays open.
        open_pairs = cut(open_pairs)
    kept = heads.select("rid")
    if removed is not None:
        kept = kept.join(removed, "rid", "left_anti")
    return fires.join(kept, "rid", "left_semi")


def fuel_load_v1(df: DataFrame, fuels: DataFrame | None = None) -> DataFrame:
    """Fuel by vegetation and region; crops have fixed loads, higher in the sugar-cane box."""
    fuels = fuels if fuels is not None else lookups.fuel_loads(df.sparkSession)
    df = df.join(F.broadcast(fuels), F.col("region") == F.col("fuel_region"), "left")
    w, e, s, n = CANE_BOX
    cane = F.col("cen_lon").between(w, e) & F.col("cen_lat").between(s, n)
    veg = F.col("genveg")
    fuel = (
        F.when(veg == 1, F.col("f_grass")).when(veg == 2, F.col("f_woody")).when(veg == 3, F.col("f_tropical"))
        .when((veg == 4) | ((veg == 5) & (F.col("region") == 11)), F.col("f_temperate")).when(veg == 5, F.col("f_boreal"))
        .when(veg == 9, F.when(cane, CANE_FUEL).otherwise(CROP_FUEL))
    )
    return df.withColumn("fuel", fuel).withColumn("herb_fuel", F.col("f_grass")).drop(
        "fuel_region", "f_tropical", "f_temperate", "f_boreal", "f_woody", "f_grass"
    )


def burn_v1(df: DataFrame) -> DataFrame:
    """Cover -> vegetation -> burned area (0.75 km2 grass and crops, 1 km2 else, less bare ground) and biomass."""
    df = fuel_load_v1(assign_genveg(clean_cover(df, "v1"), "v1"))
    full = F.when(F.col("genveg").isin(1, 9), 0.75).otherwise(1.0)
    mass = burned_biomass(F.col("tree"), F.col("herb"), F.col("herb_fuel"), F.col("fuel"), 100.0)
    late = F.when(F.col("genveg") <= 0, "vegetation").when(F.col("fuel").isNull(), "fuel")
    return (
        df.withColumn("area_km2", full * (100.0 - F.col("bare")) * 0.01).withColumn("bmass", mass)
        .withColumn("reject_reason", F.coalesce("reject_reason", late))
    )


def reject_counts_v1(raw: DataFrame, confident: DataFrame, kept: DataFrame, burned: DataFrame) -> DataFrame:
    """One row of counters: detections by filter, fires by reason."""
    reason = F.col("reject_reason")
    n_raw, n_confident, n_kept = (d.agg(F.count("*")).scalar() for d in (raw, confident, kept))
    ok = reason.isNull()
    return burned.agg(
        F.count("*").alias("n_fires"), F.count_if(reason == "no region").alias("n_no_region"), F.count_if(reason == "land cover").alias("n_land_cover"),
        F.count_if(F.col("all_bare") & (ok | (reason == "all bare"))).alias("n_all_bare"), F.count_if(reason == "vegetation").alias("n_no_vegetation"),
        F.count_if(reason == "fuel").alias("n_no_fuel"), F.count_if(ok & F.col("rescaled") & (F.col("totcov") >= 50)).alias("n_rescaled"),
        F.count_if(ok & F.col("rescaled") & (F.col("totcov") < 50)).alias("n_cover_below_50"), F.count_if(ok & (F.col("lct") == 13)).alias("n_urban"),
    ).select("*", (n_raw - n_confident).alias("n_low_confidence"), (n_confident - n_kept).alias("n_overlap"))


def emit_v1(df: DataFrame, factors: DataFrame) -> DataFrame:
    """kg of each species: factor x burned area (km2) x biomass (g/m2) x copy weight."""
    wide = factors.groupBy("factor_row").agg(*[F.max(F.when(F.col("species") == s, F.col("ef"))).alias(f"_k_{s}") for s in SPECIES])
    row = F.col("lct_used")
    for lct, to in FACTOR_ROW.items():
        row = F.when(F.col("lct_used") == lct, to).otherwise(row)
    burned = F.col("area_km2") * (F.col("bmass") * 1000.0) * F.col("factor")
    out = df.withColumn("factor_row", row.cast("int")).join(F.broadcast(wide), "factor_row")
    return out.select(*[F.col(c) for c in df.columns], *[(F.col(f"_k_{s}") * burned).alias(s) for s in SPECIES])


def speciate_v1(df: DataFrame, speciation: DataFrame, case: str) -> DataFrame:
    """Speciated output columns in the fixed slot order of a mechanism.

    ``speciation``: (slot int, species, type 1-6, frac); type 6 is crops.  Gases become moles, the
    VOC rows are shares of NMOC, and NO takes the HONO share where the mechanism lumps them.
    """
    names = {r.slot: r.species for r in speciation.select("slot", "species").distinct().collect()}
    kind = F.when(F.col("genveg") == 9, 6).otherwise(F.col("genveg"))
    slots = sorted(names)
    wide = speciation.groupBy(F.col("type").alias("_type")).agg(*[F.max(F.when(F.col("slot") == s, F.col("frac"))).alias(f"_s{s}") for s in slots])
    out = df.withColumn("_type", kind).join(F.broadcast(wide), "_type", "left")

    def share(slot: int) -> Column:
        return F.coalesce(F.col(f"_s{slot}"), F.lit(0.0)) * F.col("NMOC")

    def value(item) -> Column:
        if isinstance(item, int):
            return share(item).alias(f"v_{names[item]}")
        name, _, extra = item.partition("+")
        base = F.col(name) * 1e3 / MOLAR[name] if name in MOLAR else F.col(name)
        return (base + share(int(extra)) if extra else base).alias(f"m_{name}")

    keep = [c for c in ("jday", "rid", "genveg", "cen_lat", "cen_lon", "area_km2") if c in df.columns]
    return out.select(*keep, *[value(item) for item in SLOTS[case]])
