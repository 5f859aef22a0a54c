"""Small fixed tables the emission model needs, and their DataFrame forms.

Every table here has a fixed, tiny size (at most a few hundred values), so broadcasting it is safe
at any data scale.  Users can replace each one by a CSV of the same layout (``sources.lookups``).
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession

# Dry fuel load (g/m2) by global region; -1 means missing.
FUEL_LOADS = """
GlobalRegion,TropicalForest,TemperateForest,BorealForest,WoodySavanna,SavannaGrasslands
1,28076,10661,17875,4762,976
2,26500,11000,-1,2224,418
3,26755,7400,-1,3077,624
4,25366,3497,-1,2501,382
5,25295,6100,-1,2483,411
6,28076,7120,6228,4523,1321
7,28076,11386,8146,7752,1612
8,6181,20807,14925,11009,2170
9,6181,10316,-1,2946,655
10,14941,7865,-1,4292,722
11,26546,14629,-1,5028,1445
12,16376,13535,-1,2483,552
13,0,0,0,0,0
"""

# Region-1 fuel (g/m2) by land-cover class.
LCT_FUEL = """
Code,TREE,HERB
0,0,0
1,28930,437
2,19917,650
3,15653,541
4,19982,964
5,20339,766
6,5136,229
7,2889,169
8,12907,668
9,10907,764
10,2822,407
11,8509,712
12,0,902
13,0,0
14,9080,822
15,0,0
16,1355,104
"""

# Emission factors (g per kg dry matter); the row of type 0 holds molecular weights.
EMISSION_FACTORS = """
GenVegType,CO2,CO,CH4,NMOC,H2,NOXasNO,SO2,PM25,TPM,TPC,OC,BC,NH3,NO,NO2,NMHC,PM10
0,44,28,16,1,2,1,64,1,1,1,1,1,17,30,46,1,1
1,1686,63,2,28.2,1.7,3.9,0.9,7.17,8.3,3,2.6,0.37,0.56,2.16,3.22,3.4,7.2
2,1681,67,3,24.8,0.97,3.645,0.68,7.1,15.4,7.1,3.7,1.31,1.2,0.77,2.58,3.4,11.4
3,1643,93,5.1,51.9,3.4,2.6,0.4,9.9,18.5,5.2,4.7,0.52,1.3,0.9,3.6,1.7,18.5
4,1510,122,5.61,56,2.03,1.04,1.1,15,18,9.7,7.6,0.56,2.47,0.95,2.34,5.7,16.97
5,1565,111,6,48.5,2.3,0.95,1,18.4,18.4,8.3,7.8,0.2,1.8,0.83,0.63,5.7,18.4
6,1623,112,3.4,49.3,2,1.96,1.1,17.9,18,9.7,7.6,0.56,1.17,0.95,2.34,5.7,18.4
9,1444,91,5.82,51.4,2.59,2.43,0.4,6.43,13,4,2.66,0.51,2.12,1.18,2.99,7,7.02
"""

# Moles of each mechanism species per kg of NMOC, by vegetation type.
VOC_SPLIT = {
    "MOZART": """
GenVegIndex,APIN,BENZENE,BIGALK,BIGENE,BPIN,BZALD,C2H2,C2H4,C2H6,C3H6,C3H8,CH2O,CH3CH2OH,CH3CHO,CH3CN,CH3COCH3,CH3COOH,CH3OH,CRESOL,GLYALD,HCN,HCOOH,HONO,HYAC,ISOP,LIMON,MACR,MEK,MGLY,MVK,MYRC,PHENOL,TOLUENE,XYLENE,XYLOL
1,0.009,0.144,0.156,1.467,0.000,0.791,2.103,1.218,0.859,0.647,0.090,1.532,0.000,1.037,0.117,0.201,2.371,1.451,0.059,0.390,0.559,0.206,0.298,0.309,0.069,0.000,0.000,0.370,0.347,0.317,0.000,0.472,0.457,0.385,0.108
2,0.053,0.442,0.644,1.274,0.004,0.272,1.975,2.886,0.641,0.557,0.561,2.285,0.055,0.792,0.130,0.242,1.353,1.650,0.058,0.128,0.927,0.134,0.643,0.118,0.138,0.013,0.147,0.286,0.094,0.301,0.003,0.457,0.531,0.355,0.046
3,0.000,0.000,0.219,0.662,0.000,0.120,0.672,1.505,0.939,0.603,0.114,2.299,0.000,1.404,0.399,0.433,2.029,3.031,0.000,1.886,0.625,0.683,1.001,0.609,0.029,0.000,0.222,0.666,0.000,0.222,0.000,0.191,0.769,0.040,0.000
4,0.261,0.253,0.415,1.393,0.008,0.298,2.513,1.930,0.611,0.487,0.149,2.181,0.066,0.758,0.088,0.297,1.292,1.744,0.059,0.210,0.684,0.259,0.326,0.223,0.129,0.158,0.113,0.274,0.135,0.247,0.002,0.345,0.605,0.422,0.088
5,0.259,0.290,1.821,0.627,0.209,0.166,1.167,1.407,1.168,0.499,0.194,1.361,0.023,0.416,0.176,0.242,1.360,1.608,0.040,0.233,0.846,0.254,0.228,0.149,0.085,0.000,0.024,0.104,0.090,0.087,0.000,0.517,1.327,0.238,0.056
6,0.261,0.253,0.415,1.393,0.008,0.298,2.513,1.930,0.611,0.487,0.149,2.181,0.066,0.758,0.088,0.297,1.292,1.744,0.059,0.210,0.684,0.259,0.326,0.223,0.129,0.158,0.113,0.274,0.135,0.247,0.002,0.345,0.605,0.422,0.088
9,0.010,0.091,0.246,0.674,0.000,0.325,1.701,1.412,0.673,0.457,0.142,1.716,0.000,0.929,0.142,0.162,2.349,2.328,0.074,0.800,0.416,0.426,0.187,1.548,0.062,0.000,0.000,0.387,0.171,0.193,0.000,0.408,0.375,0.295,0.130
""",
    "SAPRC": """
GenVegIndex,ACET,ALK1,ALK2,ALK3,ALK4,ALK5,ARO1,ARO2,BALD,CCHO,CCO_OH,ETHENE,HCHO,HCN,HCOOH,HONO,ISOPRENE,MEK,MEOH,METHACRO,MGLY,MVK,OLE1,OLE2,PHEN,PROD2,RCHO,TRP1
1,0.22,1.25,0.92,0.04,0.07,0.06,1.11,0.03,0.02,1.03,2.08,2.27,2.11,1.01,0.65,0.38,0.05,1.87,1.91,0.00,0.80,0.22,0.72,0.20,0.44,0.22,0.60,0.01
2,0.71,1.63,1.12,0.05,0.10,0.06,1.24,0.06,0.02,0.95,1.24,2.29,2.22,1.28,0.16,0.74,0.03,0.92,2.48,0.00,0.86,0.00,1.06,0.31,0.00,0.24,1.50,0.01
3,0.40,1.40,0.51,0.04,0.04,0.03,1.86,0.08,0.12,1.31,1.93,1.42,2.14,0.58,0.45,0.76,0.07,1.20,2.68,0.08,0.38,0.20,0.83,0.19,0.18,0.23,1.47,0.04
4,0.20,0.47,0.26,0.03,0.04,0.02,0.53,0.06,0.01,0.38,0.53,1.11,1.33,0.51,0.26,0.26,0.03,8.33,1.51,0.00,0.17,0.00,0.36,0.10,0.07,0.10,0.36,0.03
5,0.20,1.84,0.34,0.05,0.06,0.03,1.18,0.10,0.01,0.67,1.80,1.61,1.45,2.48,0.57,0.70,0.14,2.25,2.49,0.00,0.27,0.00,0.93,0.16,0.84,0.16,0.37,0.04
6,0.20,0.47,0.26,0.03,0.04,0.02,0.53,0.06,0.01,0.38,0.53,1.11,1.33,0.51,0.26,0.26,0.03,8.33,1.51,0.00,0.17,0.00,0.36,0.10,0.07,0.10,0.36,0.03
9,0.83,1.22,0.31,0.02,0.03,0.02,0.95,0.06,0.01,3.05,2.19,1.09,1.84,0.33,0.90,0.09,0.60,0.54,2.11,0.00,0.19,0.14,0.54,0.16,0.60,0.11,2.08,0.00
""",
    "GEOSCHEM": """
GenVegIndex,ACET,ALD2,ALK4,BENZ,C2H2,C2H4,C2H6,C3H8,CH2O,GLYC,GLYX,HAC,MEK,MGLY,PRPE,TOLU,XYLE,NO
1,0.22,1.21,5.03,0.2,0.72,2.27,0.82,0.18,2.12,0.5,0,1.01,1.38,0.81,1.07,0.96,0.01,0.38
2,0.7,1.13,5.21,0.29,0.64,2.39,0.99,0.36,2.43,0.08,0,0,1.21,0.84,1.63,1.15,0.03,0.48
3,0.39,1.96,4.07,0.18,0.36,1.38,0.82,0.1,2.08,0.79,0,0.55,1.04,0.37,1.92,1.03,0.04,0.74
4,0.37,1,5.97,0.38,0.22,1.48,1.61,0.28,1.87,0.35,0,0,0.6,0.3,3.11,0.79,0.05,0.28
5,0.35,0.81,5.75,0.38,0.18,1.35,1.59,0.27,1.66,0.34,0,0.76,0.61,0.27,2.47,0.88,0.05,0.69
6,0.37,1,5.97,0.38,0.22,1.48,1.61,0.28,1.87,0.35,0,0,0.6,0.3,3.11,0.79,0.05,0.28
9,0.83,3.46,4.96,0.21,0.21,1.08,0.43,0.08,1.84,1.68,0,0,0.77,0.19,1.27,0.77,0.03,0.09
""",
}


def parse(text: str) -> list[dict[str, float]]:
    """Rows of one of the tables above as name -> number."""
    return [{k: float(v) for k, v in row.items()} for row in csv.DictReader(io.StringIO(text.strip()))]


def voc_rows(mechanism: str) -> list[dict[str, float]]:
    return parse(VOC_SPLIT[mechanism])


def fuel_loads(spark: SparkSession) -> DataFrame:
    """Fuel per region, wide: one row per region (regnum, tropical, temperate, boreal, woody, grass)."""
    data = [
        (int(r["GlobalRegion"]), r["TropicalForest"], r["TemperateForest"], r["BorealForest"],
         r["WoodySavanna"], r["SavannaGrasslands"])
        for r in parse(FUEL_LOADS)
    ]
    return spark.createDataFrame(
        data, "fuel_region int, f_tropical double, f_temperate double, f_boreal double, f_woody double, f_grass double"
    )


def lct_fuel(spark: SparkSession) -> DataFrame:
    data = [(int(r["Code"]), r["TREE"], r["HERB"]) for r in parse(LCT_FUEL)]
    return spark.createDataFrame(data, "fuel_lct int, lct_tree double, lct_herb double")


def emission_factors(spark: SparkSession) -> DataFrame:
    """Long form: (genveg, species, mw, ef)."""
    rows = parse(EMISSION_FACTORS)
    weights = next(r for r in rows if r["GenVegType"] == 0)
    data = [
        (int(r["GenVegType"]), s, weights[s], r[s])
        for r in rows if r["GenVegType"] != 0 for s in r if s != "GenVegType"
    ]
    return spark.createDataFrame(data, "genveg int, species string, mw double, ef double")


def base_species() -> list[str]:
    return [s for s in parse(EMISSION_FACTORS)[0] if s != "GenVegType"]


def voc_species(mechanism: str) -> list[str]:
    return [s for s in voc_rows(mechanism)[0] if s != "GenVegIndex"]


def voc_split(spark: SparkSession, mechanism: str) -> DataFrame:
    """Long form: (genveg, species, frac)."""
    data = [
        (int(r["GenVegIndex"]), s, r[s]) for r in voc_rows(mechanism) for s in r if s != "GenVegIndex"
    ]
    return spark.createDataFrame(data, "genveg int, species string, frac double")
