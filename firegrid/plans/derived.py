"""Input tables derived from the driver's star schema.

The same expressions are given to the checking engine as SQL text (``SQL``), so that both sides
start from identical rows.  Everything is row-local: the tables grow with their source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firegrid import lookups
from firegrid.operators.legacy import SPECIES

DETECTIONS = """
 event_id as rawid,
 ((user_id*7919)%12000)/100.0e0-60.0e0 + ((event_id*31)%40)*0.002e0 as latitude,
 ((user_id*104729)%34000)/100.0e0-170.0e0 + ((event_id*17)%40)*0.002e0 as longitude,
 1.0e0 + (event_id%5)*0.25e0 as scan, 1.0e0 + (event_id%3)*0.1e0 as track,
 cast(ts as date) as acq_date,
 lpad(cast(hour(ts)*100+minute(ts) as varchar(4)),4,'0') as acq_time,
 case event_id%4 when 0 then 'Terra' when 1 then 'Aqua' when 2 then 'N' else 'X' end as satellite,
 case when event_id%4 in (0,1) then cast(event_id%101 as varchar(3)) else case event_id%3 when 0 then 'l' when 1 then 'nominal' else 'h' end end as confidence,
 cast(case when event_id%9=0 then 1 when event_id%11=0 then 2 when event_id%13=0 then 3 else 0 end as int) as type,
 value/10.0e0 as frp
"""

FIRES = """
 l_orderkey*10+l_linenumber as polyid, l_orderkey as fireid,
 ((l_suppkey*104729+l_linenumber*37)%36000)/100.0e0-180.0e0 as cen_lon,
 ((l_partkey*7919+l_linenumber*31)%14000)/100.0e0-70.0e0 as cen_lat,
 cast(l_shipdate as date) as acq_date_utc, l_quantity/25.0e0 as area_sqkm,
 cast(1+l_orderkey%2 as int) as alg_agg, cast(l_partkey%19 as int) as v_lct, 1.0e0-l_discount as f_lct,
 cast(l_partkey%101 as double) as v_tree, ((100-l_partkey%101)*(l_suppkey%11))/10.0e0 as v_herb,
 case when l_linenumber%7=0 then 250.0e0 else ((100-l_partkey%101)*(10-l_suppkey%11))/10.0e0 end as v_bare,
 cast(l_suppkey%14 as int) as v_regnum, l_tax*100.0e0 as v_frp
"""

SQL = {
    "detections_fx": f"select {DETECTIONS} from events",
    "fires_fx": f"select {FIRES} from lineitem",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"select {DETECTIONS} from {{src}}", src=table(spark, sf_dir, "events"))


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"select {FIRES} from {{src}}", src=table(spark, sf_dir, "lineitem"))


# Synthetic: a vegetation type for each row of a first-generation factor table.  No such table is part
# of the given data; users read their own with ``sources.lookups.read_ef_v1``.
SYNTHETIC_VEGETATION = {1: 6, 2: 3, 3: 5, 4: 4, 5: 4, 6: 2, 7: 2, 8: 2, 9: 1, 10: 1, 11: 1, 12: 9, 13: 1, 14: 1}


def synthetic_factors_v1(spark: SparkSession) -> DataFrame:
    """A factor table by row (long: factor_row, species, ef) in first-generation layout, made of the by-type factors."""
    by_type = {int(r["GenVegType"]): r for r in lookups.parse(lookups.EMISSION_FACTORS)}
    name = {"NOX": "NOXasNO"}
    data = [(row, s, by_type[veg][name.get(s, s)]) for row, veg in SYNTHETIC_VEGETATION.items() for s in SPECIES]
    return spark.createDataFrame(data, "factor_row int, species string, ef double")
