"""Emission model: cover cleaning, vegetation, fuel, burned biomass, base and speciated emissions.

The whole chain from a processed-fire table to per-fire emissions is row-local: fixed-size lookup
tables are broadcast and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firegrid import lookups
from firegrid.operators.prep import only_year

# Crop fuel load (g/m2).
CROP_FUEL = 902.0


def _all_bare_cover(lct: Column) -> Column:
    """Tree/herb/bare given to a cell seen as all bare, by its land-cover class."""
    def cover(tree: float, herb: float) -> Column:
        return F.array(F.lit(tree), F.lit(herb), F.lit(0.0))

    return (
        F.when(lct <= 5, cover(60.0, 40.0))
        .when(lct.isin(6, 7, 8, 11, 14), cover(50.0, 50.0))
        .otherwise(cover(20.0, 80.0))
    )


def clean_cover(df: DataFrame, version: str = "v2.9") -> DataFrame:
    """Check region, land cover and cover fractions; add tree/herb/bare and ``reject_reason``.

    Rows are kept, with the first failed check named, so that one pass feeds both the model (rows
    without a reason) and the reject report.
    """
    zero = F.lit(0.0)
    tree, herb, bare = (F.greatest(F.coalesce(F.col(c), zero), zero) for c in ("v_tree", "v_herb", "v_bare"))
    lct = F.coalesce(F.col("v_lct"), F.lit(0))
    reg = F.coalesce(F.col("v_regnum"), F.lit(0))
    df = df.withColumn("_t", tree).withColumn("_h", herb).withColumn("_b", bare)
    df = df.withColumn("totcov", F.col("_t") + F.col("_h") + F.col("_b"))
    out_of_range = (F.col("totcov") >= 240) | (F.col("totcov") < 1)
    if version == "v1":
        rescale = (F.col("totcov") != 100) & ~out_of_range
        reason = (
            F.when(reg == 0, "no region")
            .when((lct < 1) | (lct > 16) | (lct == 15), "land cover")
        )
    else:
        in_region = reg.between(1, 12) if version == "v2.9" else reg.between(0, 100)
        rescale = ((F.col("totcov") > 101) | (F.col("totcov") < 99)) & ~out_of_range
        reason = (
            F.when(~in_region, "no region")
            .when((lct >= 17) | (lct <= 0) | (lct == 15), "land cover")
            .when(out_of_range, "total cover")
        )
    # The covers, and later the species, are arrays: the model then compiles to several small
    # methods instead of one that is too long for the JIT compiler.
    scale = F.when(rescale, F.lit(100.0))
    scaled = F.transform(F.array("_t", "_h", "_b"), lambda c: F.when(F.col("_scale").isNotNull(), c * F.col("_scale") / F.col("totcov")).otherwise(c))
    df = df.withColumn("rescaled", rescale).withColumn("_scale", scale).withColumn("_scaled", scaled)
    bare = F.col("_scaled")[2]
    all_bare = (bare == 100) | out_of_range if version == "v1" else bare >= 99.9
    if version == "v1":
        reason = reason.when((out_of_range | (bare == 100)) & (lct >= 15), "all bare")
    df = df.withColumn("all_bare", all_bare).withColumn("_cover", F.when(F.col("all_bare"), _all_bare_cover(lct)).otherwise(F.col("_scaled")))
    return (
        df.withColumn("reject_reason", reason)
        .withColumns({n: F.col("_cover")[i] for i, n in enumerate(("tree", "herb", "bare"))})
        .withColumn("lct", lct.cast("int"))
        .withColumn("region", reg.cast("int"))
        .drop("_t", "_h", "_b", "_scale", "_scaled", "_cover")
    )


def assign_genveg(df: DataFrame, version: str = "v2.9") -> DataFrame:
    """Generic vegetation type from land cover, latitude and (for urban cells) tree cover.

    Urban cells (13) also get the land cover of the vegetation they are treated as.
    """
    lat, lct, tree = F.col("cen_lat"), F.col("lct"), F.col("tree")
    boreal = lat > 50
    if version == "v1":
        tropics = (lat > -30) & (lat < 30)
        urban_tropics = tropics
        needle = F.when(boreal, 5).otherwise(4)
        broad: Column = F.lit(3)
        mixed = F.when(tropics, 3).when(boreal, 5).otherwise(4)
    else:
        tropics = lat.between(-23.5, 23.5)
        urban_tropics = lat.between(-30, 30)
        needle = F.when(boreal, 5).otherwise(6)
        broad = F.when(tropics, 3).otherwise(4)
        mixed = F.when(boreal, 5).when(tropics, 3).otherwise(4)
    urban = (
        F.when(tree < 40, 1).when(tree < 60, 2).when(boreal, 5).when(urban_tropics, 3).otherwise(4)
    )
    genveg = (
        F.when(lct == 1, needle)
        .when(lct == 2, broad)
        .when(lct == 3, F.when(boreal, 5).otherwise(4))
        .when(lct == 4, 4)
        .when(lct == 5, mixed)
        .when(lct.isin(6, 7, 8), 2)
        .when(lct.isin(9, 10, 11, 14, 16), 1)
        .when(lct == 12, 9)
        .when(lct == 13, urban)
        .otherwise(-1)
    )
    urban_lct = F.when(tree < 40, 10).when(tree < 60, 8).when(boreal, 1).otherwise(5)
    return df.withColumn("genveg", genveg.cast("int")).withColumn(
        "lct_used", F.when(lct == 13, urban_lct).otherwise(lct).cast("int")
    )


def fuel_load(df: DataFrame, fuels: DataFrame | None = None, lct_fuels: DataFrame | None = None) -> DataFrame:
    """Add ``fuel`` (by vegetation type), ``coarse`` and ``herb_fuel`` (g/m2); region 1 uses its own table."""
    spark = df.sparkSession
    fuels = fuels if fuels is not None else lookups.fuel_loads(spark)
    lct_fuels = lct_fuels if lct_fuels is not None else lookups.lct_fuel(spark)
    df = df.join(F.broadcast(fuels), F.col("region") == F.col("fuel_region"), "left").join(
        F.broadcast(lct_fuels), F.col("lct_used") == F.col("fuel_lct"), "left"
    )
    veg = F.col("genveg")
    fuel = (
        F.when(veg == 1, F.col("f_grass"))
        .when(veg == 2, F.col("f_woody"))
        .when(veg == 3, F.col("f_tropical"))
        .when(veg.isin(4, 6) | ((veg == 5) & (F.col("region") == 11)), F.col("f_temperate"))
        .when(veg == 5, F.col("f_boreal"))
        .when(veg == 9, CROP_FUEL)
        .otherwise(-1.0)
    )
    near = F.col("region") == 1
    return (
        df.withColumn("fuel", F.coalesce(fuel, F.lit(-1.0)))
        .withColumn("coarse", F.when(near, F.col("lct_tree")).otherwise(F.col("fuel")))
        .withColumn("herb_fuel", F.when(near, F.col("lct_herb")).otherwise(F.col("f_grass")))
        .drop("fuel_region", "f_tropical", "f_temperate", "f_boreal", "f_woody", "f_grass",
              "fuel_lct", "lct_tree", "lct_herb")
    )


def burned_biomass(tree: Column, herb: Column, herb_fuel: Column, coarse: Column, exponent_per: float = 1.0) -> Column:
    """Dry matter burned (kg/m2) from percent covers and fuels (g/m2).

    Forest (> 60 % tree): 0.90 of leafy and 0.30 of woody fuel.  Woodland (40-60 %):
    exp(-0.013 tree) of leafy, 0.30 of woody.  Grassland: 0.98 of leafy fuel, no woody fuel.
    ``exponent_per`` = 100 uses the tree fraction in the exponent instead of the percentage.
    """
    h, t = herb / 100.0, tree / 100.0
    leafy = (
        F.when(tree > 60, 0.90)
        .when(tree > 40, F.exp(-0.013 * tree / exponent_per))
        .otherwise(0.98)
    )
    woody = F.when(tree > 40, t * coarse * 0.30).otherwise(0.0)
    return ((h + t) * herb_fuel * leafy + woody) / 1000.0


def burn(df: DataFrame) -> DataFrame:
    """Add ``bmass`` (kg/m2) and ``area_m2``; rows without fuel or area get a ``reject_reason``."""
    area = F.col("area_sqkm") * F.col("f_lct") * 1.0e6
    df = df.withColumn("area_m2", area - area * (F.col("bare") / 100.0)).withColumn(
        "bmass", burned_biomass(F.col("tree"), F.col("herb"), F.col("herb_fuel"), F.col("coarse"))
    )
    late = (
        F.when(F.col("genveg") <= 0, "vegetation")
        .when(F.col("fuel") < 0, "fuel")
        .when(F.col("area_m2") < 1, "area")
    )
    return df.withColumn("reject_reason", F.coalesce(F.col("reject_reason"), late))


def burned_fires(fires: DataFrame, year: int | None = None, version: str = "v2.9", fuels: DataFrame | None = None,
                 lct_fuels: DataFrame | None = None) -> DataFrame:
    """Processed fires -> all rows with vegetation, biomass, burned area and ``reject_reason``."""
    if year is not None:
        fires = only_year(fires, year)
    return burn(fuel_load(assign_genveg(clean_cover(fires, version)), fuels, lct_fuels))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull())


def _factor_row(factors: DataFrame, species: list[str], value: Column, missing: float | None = None) -> DataFrame:
    """One row per vegetation type with the species' values as an array (a handful of rows)."""
    each = [F.max(F.when(F.col("species") == s, value)) for s in species]
    return factors.groupBy("genveg").agg(F.array(*[e if missing is None else F.coalesce(e, F.lit(missing)) for e in each]).alias("_k"))


def species_of(table: DataFrame) -> list[str]:
    """Species of a factor or split table, by name (a table of fixed size)."""
    return [r.species for r in table.select("species").distinct().orderBy("species").collect()]


def _times(df: DataFrame, keep: list[str], species: list[str], by: Column, prefix: str = "") -> DataFrame:
    """One column per species: its value in ``_k`` times ``by``."""
    out = df.withColumn("_by", by).withColumn("_v", F.transform("_k", lambda k: k * F.col("_by")))
    return out.select(*[F.col(c) for c in keep], *[F.col("_v")[i].alias(prefix + s) for i, s in enumerate(species)])


def emission_coefficient() -> Column:
    """kg or mol emitted per kg of dry matter: gases (mw != 1) in mol, aerosols and lumps in kg."""
    kg = F.col("ef") * 1e-3
    return F.when(F.col("mw") != 1, kg / (F.col("mw") * 1e-3)).otherwise(kg)


def emit(df: DataFrame, factors: DataFrame | None = None, species: list[str] | None = None) -> DataFrame:
    """Add one column per species: coefficient x burned area x biomass.

    Wide on purpose: a fire stays one row, and later sums move 17 partial sums per key instead of
    17 rows per fire.  Fires whose vegetation has no factors are dropped.  With own ``factors`` the
    columns are that table's species, unless ``species`` names them.
    """
    spark = df.sparkSession
    if species is None:
        species = lookups.base_species() if factors is None else species_of(factors)
    factors = factors if factors is not None else lookups.emission_factors(spark)
    wide = _factor_row(factors, species, emission_coefficient())
    return _times(df.join(F.broadcast(wide), "genveg"), df.columns, species, F.col("area_m2") * F.col("bmass"))


def emission_sums(df: DataFrame, keys: list[str], species: list[str], factors: DataFrame | None = None) -> DataFrame:
    """(keys, genveg, n_fires, area_m2, biomass_kg, species...): sums by key and vegetation.

    An emission is its coefficient, one number per vegetation, times the biomass burned: so the biomass is
    summed first and multiplied afterwards, for the species asked for only.  Fires whose vegetation has no
    factors are left out, as by ``emit``.
    """
    factors = factors if factors is not None else lookups.emission_factors(df.sparkSession)
    wide = _factor_row(factors.where(F.col("species").isin(species)), species, emission_coefficient())
    sums = df.groupBy(*keys, "genveg").agg(
        F.count(F.lit(1)).alias("n_fires"), F.sum("area_m2").alias("area_m2"), F.sum(F.col("area_m2") * F.col("bmass")).alias("biomass_kg"))
    return _times(sums.join(F.broadcast(wide), "genveg"), [*keys, "genveg", "n_fires", "area_m2", "biomass_kg"], species, F.col("biomass_kg"))


def sums_of_emitted(df: DataFrame, keys: list[str], species: list[str]) -> DataFrame:
    """The columns of ``emission_sums`` from the fires that ``emit`` returned."""
    return df.groupBy(*keys, "genveg").agg(
        F.count(F.lit(1)).alias("n_fires"), F.sum("area_m2").alias("area_m2"), F.sum(F.col("area_m2") * F.col("bmass")).alias("biomass_kg"),
        *[F.sum(s).alias(s) for s in species])


def emit_long(df: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """One row per fire and species."""
    factors = factors if factors is not None else lookups.emission_factors(df.sparkSession)
    value = emission_coefficient() * F.col("area_m2") * F.col("bmass")
    return df.join(F.broadcast(factors), "genveg").withColumn("emission", value).drop("mw", "ef")


def speciate(df: DataFrame, mechanism: str, split: DataFrame | None = None, species: list[str] | None = None,
             prefix: str = "") -> DataFrame:
    """Add one column per VOC of a mechanism: moles = split x NMOC (kg); no split -> 0."""
    spark = df.sparkSession
    if species is None:
        species = lookups.voc_species(mechanism) if split is None else species_of(split)
    split = split if split is not None else lookups.voc_split(spark, mechanism)
    wide = _factor_row(split, species, F.col("frac"), missing=0.0)
    none = F.array(*[F.lit(0.0) for _ in species])
    out = df.join(F.broadcast(wide), "genveg", "left").withColumn("_k", F.coalesce("_k", none))
    return _times(out, df.columns, species, F.col("NMOC"), prefix)


def vegetation_audit(df: DataFrame) -> DataFrame:
    """What was assigned to each fire: land cover and covers before and after."""
    return df.where(F.coalesce(F.col("reject_reason"), F.lit("")).isin("", "fuel", "area")).select(
        F.dayofyear("acq_date_utc").alias("jday"), "fireid", "polyid", "cen_lat", "cen_lon",
        F.col("lct").alias("lct_in"), F.col("lct_used").alias("lct_out"),
        F.col("v_tree").alias("tree_in"), F.col("tree").alias("tree_out"),
        F.col("v_herb").alias("herb_in"), F.col("herb").alias("herb_out"),
        F.col("v_bare").alias("bare_in"), F.col("bare").alias("bare_out"), "f_lct", "genveg",
    )
