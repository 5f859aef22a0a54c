"""The registered queries as plain SQL on the given tables, for an independent check.

Written directly from the definitions: inequality joins, recursive label spreading and explicit
candidate lists instead of the binned joins and contractions of the library.
"""

from __future__ import annotations

import math

from firegrid import lookups
from firegrid.operators.wrf import HOURLY
from firegrid.plans.derived import SQL, SYNTHETIC_VEGETATION

ORACLES: dict[str, str] = {}

RES = "0.01e0"


def num(x: float) -> str:
    """A double literal (bare decimals would be fixed-point)."""
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def _with(*parts: str) -> str:
    seen = list(dict.fromkeys(p.strip() for p in parts))
    return "with recursive " + ",\n".join(seen) + "\n"


GC = num(2 * math.pi * 6370.997)

DET = f"det as ({SQL['detections_fx']})"
INST = """inst as (select *, case when upper(satellite)[1] in ('T','A') then 'MODIS' when upper(satellite)[1]='N' then 'VIIRS' end as instrument from det)"""
CONF = """conf as (select *, case instrument when 'MODIS' then case when regexp_matches(confidence,'^[0-9]+$') then cast(confidence as int)>=20 else false end
 when 'VIIRS' then not starts_with(lower(confidence),'l') else false end as confident from inst where instrument is not null)"""
LST = """lst as (select *, cast(acq_date as timestamp) + to_hours(cast(acq_time[1:2] as int) + cast(round_even(longitude/15.0e0,0) as int)) + to_minutes(cast(acq_time[3:4] as int)) as acq_datetime_lst from conf)"""
DUP = """dup as (select rawid, longitude as lon, latitude as lat, scan, track, instrument, confident, type as anomtype, frp, k as copy,
 acq_date + k as acq_date_utc, cast(acq_datetime_lst as date) + k as acq_date_lst
 from lst, (values (0),(1)) t(k) where k=0 or (instrument='MODIS' and abs(latitude)<=23.5e0))"""
PNT = """pnt as (select rawid*2+copy as cleanid, *, acq_date_utc as acq_date_use from dup where confident and (anomtype is null or anomtype not in (1,2)))"""
PREP = (DET, INST, CONF, LST, DUP, PNT)

EXT = f"""ext as (select *, 0.5e0*(case instrument when 'MODIS' then 1.0e0 else 0.375e0 end)*360.0e0/{GC}/cos(radians(lat)) as fire_dx,
 0.5e0*(case instrument when 'MODIS' then 1.0e0 else 0.375e0 end)*360.0e0/{GC} as fire_dy,
 1.1e0*0.5e0*scan*360.0e0/{GC}/cos(radians(lat)) as agg_dx, 1.1e0*0.5e0*track*360.0e0/{GC} as agg_dy from pnt)"""


def _cluster(mode: str, p: str) -> tuple[str, ...]:
    """Sites, pairs, labels and hulls of one clustering, with table names prefixed by ``p``."""
    dx, dy = ("agg_dx", "agg_dy") if mode == "aggressive" else ("fire_dx", "fire_dy")
    return (
        f"{p}site as (select acq_date_use, lon, lat, {dx} as dx, {dy} as dy, fire_dx, fire_dy, min(cleanid) as site, count(*) as n_det from ext group by all)",
        f"""{p}pair as (select a.acq_date_use, a.site as a_site, b.site as b_site from {p}site a join {p}site b on a.acq_date_use=b.acq_date_use and a.site<b.site
 and abs(a.lon-b.lon)<a.dx+b.dx and abs(a.lat-b.lat)<a.dy+b.dy)""",
        f"{p}link as (select a_site as s, b_site as t from {p}pair union all select b_site, a_site from {p}pair)",
        f"{p}reach(node, lab) as (select site, site from {p}site union select l.t, r.lab from {p}reach r join {p}link l on l.s=r.node)",
        f"{p}label as (select node as site, min(lab) as fireid from {p}reach group by node)",
        f"{p}full as (select s.*, l.fireid, sum(n_det) over (partition by l.fireid) as ndetect, count(*) over (partition by l.fireid) as n_sites from {p}site s join {p}label l using (site))",
        f"""{p}point as (select e.*, f.fireid, f.ndetect from ext e join {p}full f on e.acq_date_use=f.acq_date_use and e.lon=f.lon and e.lat=f.lat
 and e.{dx}=f.dx and e.{dy}=f.dy and e.fire_dx=f.fire_dx and e.fire_dy=f.fire_dy)""",
        f"""{p}hull as (select a.fireid, a.lon ax, a.lat ay, a.fire_dx adx, a.fire_dy ady, b.lon bx, b.lat by_, b.fire_dx bdx, b.fire_dy bdy
 from {p}pair q join {p}full a on a.site=q.a_site join {p}full b on b.site=q.b_site
 union select fireid, lon, lat, fire_dx, fire_dy, lon, lat, fire_dx, fire_dy from {p}full where n_sites=1)""",
    )


def _cells(p: str) -> tuple[str, ...]:
    """Pixels whose centre lies in a hull, tested on 65 positions of the sweep's four linear limits.

    The limits are solved for the sweep parameter t, as inequalities t * m >= r.
    """
    lim = []
    for axis, c, da, b, db in (("x", "ax", "adx", "bx", "bdx"), ("y", "ay", "ady", "by_", "bdy")):
        for s in ("1e0", "-1e0"):
            lim.append((f"({s}*({b}-{c})+({db}-{da}))", f"({s}*(p{axis}-{c})-{da})"))
    lo = ",".join(f"case when {m}>0 then {r}/{m} else 0e0 end" for m, r in lim)
    hi = ",".join(f"case when {m}<0 then {r}/{m} else 1e0 end" for m, r in lim)
    ok = " and ".join(f"({m}<>0 or {r}<=0)" for m, r in lim)
    return (
        f"""{p}cand as (select *, (ix+0.5e0)*{RES} as px, (iy+0.5e0)*{RES} as py from (select *, unnest(range(cast(floor(least(ax-adx,bx-bdx)/{RES}) as bigint)-1, cast(ceil(greatest(ax+adx,bx+bdx)/{RES}) as bigint)+1)) as ix
 from (select *, unnest(range(cast(floor(least(ay-ady,by_-bdy)/{RES}) as bigint)-1, cast(ceil(greatest(ay+ady,by_+bdy)/{RES}) as bigint)+1)) as iy from {p}hull)))""",
        f"{p}cell as (select distinct fireid, iy, ix from {p}cand where {ok} and greatest(0e0,{lo}) <= least(1e0,{hi}))",
        f"""{p}val as (select *, case when (ix+iy)%37=0 then 200 else t end as tree, 100-t-herb as bare from
 (select *, cast(1+(((7*ix+13*iy)%17)+17)%17 as int) as lct, (((ix+2*iy)%(101-t))+(101-t))%(101-t) as herb from
 (select *, (((3*ix+5*iy)%101)+101)%101 as t from {p}cell)))""",
    )


AGG, CON = _cluster("aggressive", "a"), _cluster("conservative", "c")
A_BASE, C_BASE = (*PREP, EXT, *AGG), (*PREP, EXT, *CON)
A_CELL, C_CELL = _cells("a"), _cells("c")

FIRES = f"fires as ({SQL['fires_fx']})"


def _values(rows: list[dict], names: list[str], table: str, cols: list[str]) -> str:
    body = ",".join("(" + ",".join(f"{num(r[n])}" if n != names[0] else str(int(r[n])) for n in names) + ")" for r in rows)
    return f"{table}({','.join(cols)}) as (values {body})"


FUEL = _values(lookups.parse(lookups.FUEL_LOADS), ["GlobalRegion", "TropicalForest", "TemperateForest", "BorealForest", "WoodySavanna", "SavannaGrasslands"],
               "fuelt", ["reg", "ftrop", "ftemp", "fbor", "fwood", "fgrass"])
LCTF = _values(lookups.parse(lookups.LCT_FUEL), ["Code", "TREE", "HERB"], "lctt", ["code", "lt", "lh"])
_EF = lookups.parse(lookups.EMISSION_FACTORS)
_MW = next(r for r in _EF if r["GenVegType"] == 0)
BASE = lookups.base_species()
EFT = _values([r for r in _EF if r["GenVegType"]], ["GenVegType", *BASE], "eft", ["gv", *[f"k_{s}" for s in BASE]])


def _cover(version: str) -> tuple[str, ...]:
    """Cover checks and corrections written as nested selects."""
    v1 = version == "v1"
    reject = (
        "case when v_regnum=0 then 'no region' when v_lct<1 or v_lct>16 or v_lct=15 then 'land cover' when (totcov>=240 or totcov<1 or b1=100) and v_lct>=15 then 'all bare' end"
        if v1 else
        "case when v_regnum<1 or v_regnum>12 then 'no region' when v_lct>=17 or v_lct<=0 or v_lct=15 then 'land cover' when totcov>=240 or totcov<1 then 'total cover' end"
    )
    scale = "totcov<>100 and totcov<240 and totcov>=1" if v1 else "totcov>101 or totcov<99"
    bare = "b1=100 or totcov>=240 or totcov<1" if v1 else "b1>=99.9e0"
    n = "v1" if v1 else "v2"
    tropics = "(cen_lat>-30 and cen_lat<30)" if v1 else "(cen_lat between -23.5e0 and 23.5e0)"
    urban_tropics = tropics if v1 else "(cen_lat between -30 and 30)"
    return (
        f"{n}a as (select *, greatest(v_tree,0e0) t0, greatest(v_herb,0e0) h0, greatest(v_bare,0e0) b0, greatest(v_tree,0e0)+greatest(v_herb,0e0)+greatest(v_bare,0e0) as totcov from fires)",
        f"{n}b as (select *, {scale} as rescaled, case when {scale} then t0*100e0/totcov else t0 end t1, case when {scale} then h0*100e0/totcov else h0 end h1, case when {scale} then b0*100e0/totcov else b0 end b1 from {n}a)",
        f"""{n}c as (select *, {bare} as all_bare, {reject} as reject,
 case when not ({bare}) then t1 when v_lct<=5 then 60e0 when v_lct in (6,7,8,11,14) then 50e0 else 20e0 end as tree,
 case when not ({bare}) then h1 when v_lct<=5 then 40e0 when v_lct in (6,7,8,11,14) then 50e0 else 80e0 end as herb,
 case when not ({bare}) then b1 else 0e0 end as bare from {n}b)""",
        f"""{n}d as (select *, case when v_lct=1 then case when cen_lat>50 then 5 else {4 if v1 else 6} end
 when v_lct=2 then {"3" if v1 else f"case when {tropics} then 3 else 4 end"}
 when v_lct=3 then case when cen_lat>50 then 5 else 4 end when v_lct=4 then 4
 when v_lct=5 then case when cen_lat>50 then 5 when {tropics} then 3 else 4 end
 when v_lct in (6,7,8) then 2 when v_lct in (9,10,11,14,16) then 1 when v_lct=12 then 9
 when v_lct=13 then case when tree<40 then 1 when tree<60 then 2 when cen_lat>50 then 5 when {urban_tropics} then 3 else 4 end else -1 end as genveg,
 case when v_lct<>13 then v_lct when tree<40 then 10 when tree<60 then 8 when cen_lat>50 then 1 else 5 end as lct_used from {n}c)""",
    )


V2, V1 = _cover("v2.9"), _cover("v1")
BURN = (
    FIRES, *V2, FUEL, LCTF,
    """f2 as (select d.*, case when genveg=1 then fgrass when genveg=2 then fwood when genveg=3 then ftrop when genveg in (4,6) or (genveg=5 and v_regnum=11) then ftemp
 when genveg=5 then fbor when genveg=9 then 902e0 else -1e0 end as fuel0, fgrass, lt, lh from v2d d left join fuelt on reg=v_regnum left join lctt on code=lct_used)""",
    "f3 as (select *, coalesce(fuel0,-1e0) as fuel, case when v_regnum=1 then lt else coalesce(fuel0,-1e0) end as coarse, case when v_regnum=1 then lh else fgrass end as herb_fuel from f2)",
    """f4 as (select *, area_sqkm*f_lct*1.0e6 - area_sqkm*f_lct*1.0e6*(bare/100e0) as area_m2,
 ((herb/100e0+tree/100e0)*herb_fuel*(case when tree>60 then 0.90e0 when tree>40 then exp(-0.013e0*tree) else 0.98e0 end) + (case when tree>40 then tree/100e0*coarse*0.30e0 else 0e0 end))/1000e0 as bmass from f3)""",
    "burnt as (select *, coalesce(reject, case when genveg<=0 then 'vegetation' when fuel<0 then 'fuel' when area_m2<1 then 'area' end) as reason from f4)",
)
_coef = {s: (f"(k_{s}*1e-3/({num(_MW[s])}*1e-3))" if _MW[s] != 1 else f"(k_{s}*1e-3)") for s in BASE}
EMIT = (*BURN, EFT, "em as (select b.*, b.v_regnum as region, " + ", ".join(f"{_coef[s]}*(area_m2*bmass) as {s}" for s in BASE) + " from burnt b join eft on gv=genveg where reason is null)")


def r(expr: str, n: int, name: str) -> str:
    return f"round({expr},{n})+0e0 as {name}"


def put(name: str, ctes: tuple[str, ...], select: str) -> None:
    ORACLES[name] = _with(*ctes) + select


# -- cleaning ----------------------------------------------------------------------------------------------
put("prep_instrument", (DET, INST), "select satellite, instrument, count(*) as n from inst group by all")
put("prep_confidence", (DET, INST, CONF), "select instrument, confident, count(*) as n from conf group by all")
put("prep_lst_date", (DET,), """, l as (select rawid, acq_time as acq_time_utc, cast(acq_date as timestamp) + to_hours(cast(acq_time[1:2] as int) + cast(round_even(longitude/15.0e0,0) as int)) + to_minutes(cast(acq_time[3:4] as int)) as acq_datetime_lst from det)
select rawid, acq_time_utc, acq_datetime_lst, cast(acq_datetime_lst as date) as acq_date_lst, cast(acq_datetime_lst as date) as acq_date_use from l""")
put("prep_points", PREP, "select cleanid, rawid, lon, lat, acq_date_utc, acq_date_lst, acq_date_use, instrument, anomtype, frp from pnt")
put("prep_points_lst_range", PREP, "select acq_date_lst as acq_date_use, instrument, count(*) as n, cast(sum(rawid*2+copy) as bigint) as ids from dup where confident and acq_date_lst between date '2024-01-05' and date '2024-01-12' group by all")
put("tropics_duplicate", (DET, INST), """select acq_date + k as acq_date_use, k as copy, count(*) as n from inst, (values (0),(1)) t(k)
 where instrument is not null and (k=0 or (instrument='MODIS' and abs(latitude)<=23.5e0)) group by all""")
put("pixel_extents", (*PREP, EXT), f"select cleanid, {r('fire_dx',9,'fire_dx')}, {r('fire_dy',9,'fire_dy')}, {r('agg_dx',9,'pix_dx')}, {r('agg_dy',9,'pix_dy')} from ext")
put("serial_ids", PREP, "select cleanid, acq_date_use, row_number() over (order by acq_date_use, cleanid) as serial from pnt")
put("first_last_day", PREP, "select min(acq_date_lst) as first_day, max(acq_date_lst) + cast(bool_or(instrument='MODIS' and abs(lat)<=30) as int) as last_day from pnt")
put("has_type", (DET,), "select bool_or(type is not null) as has_type from det")
put("detection_extent", PREP, "select cast(floor(min(lon)) as bigint) x0, cast(floor(min(lat)) as bigint) y0, cast(ceil(max(lon)) as bigint) x1, cast(ceil(max(lat)) as bigint) y1 from pnt")
put("distinct_dates", PREP, "select acq_date_use, count(*) as n from pnt group by all")
TILE = "tiled as (select *, printf('h%02dv%02d', cast(floor(lon*cos(radians(lat))/10e0+18e0) as int), cast(floor(9e0-lat/10e0) as int)) as tile from pnt)"
put("tile_counts", (*PREP, TILE), "select tile, count(*) as n from tiled group by all")
_PX = f"""px as (select *, lon*cos(radians(lat))/10e0+18e0 as u, 9e0-lat/10e0 as w from pnt),
pp as (select *, printf('h%02dv%02d', cast(floor(u) as int), cast(floor(w) as int)) as tile, least(floor((w-floor(w))*1200),1199)*1200+least(floor((u-floor(u))*1200),1199) as pos from px)"""
put("pixel_coverage", (*PREP, _PX, "ok as (select distinct tile, pos from pp where rawid%3=0 or rawid%5=0)"),
    """select tile, count(*) as n_fire, cast(count(ok.pos) as bigint) as n_contained, cast(coalesce((select count(*) from ok o where o.tile=pp.tile),0) as bigint) as n_pixels
 from pp left join ok using (tile, pos) group by tile""")


def _touched(src: str) -> tuple[str, ...]:
    """Tiles of boxes (key, x0, x1, y0, y1): every band of ten degrees with the range of x cos(y) on a fine ladder of its ends."""
    return (
        f"tv as (select *, unnest(range(cast(floor(9e0-y1/10e0) as int), cast(floor(9e0-y0/10e0) as int)+1)) as v from {src})",
        "tn as (select *, least(y1, 90e0-v*10e0) as nn, greatest(y0, 80e0-v*10e0) as ss from tv)",
        "tc as (select *, unnest([cos(radians(nn)), cos(radians(ss)), cos(radians(greatest(ss, least(nn, 0e0))))]) as c from tn where nn>=ss)",
        "tu as (select key, v, min(least(x0*c, x1*c)) as u0, max(greatest(x0*c, x1*c)) as u1 from tc group by key, v, x0, x1, y0, y1)",
        "bt as (select distinct key, printf('h%02dv%02d', cast(h as int), cast(v as int)) as tile from (select key, v, unnest(range(cast(floor(u0/10e0+18e0) as int), cast(floor(u1/10e0+18e0) as int)+1)) as h from tu))",
    )


put("box_tiles", (*PREP, "bx as (select cleanid as key, lon-0.25e0 as x0, lon+0.25e0 as x1, lat-0.25e0 as y0, lat+0.25e0 as y1 from pnt)", *_touched("bx")),
    "select tile, count(*) as n from bt group by tile")
put("tile_coverage", (*PREP, TILE), """select tile, count(*) as n_fire, bool_or(instrument='MODIS') or not bool_or(rawid%3<>0) as ok, bool_or(rawid%3<>0) and not bool_or(instrument='MODIS') as need from tiled group by tile""")
put("density_grid", PREP, """, b as (select min(lon) x0, max(lat) y1 from pnt), c as (select cast(floor((lon-x0)/2.0e0) as bigint) idx, cast(floor((y1-lat)/2.0e0) as bigint) jdx, count(*) n from pnt, b group by all),
t as (select max(n) top from c) select idx, jdx, n, round(case when top>2000 then log10(n) when top>20 then sqrt(n) else n end,6)+0e0 as shade from c, t""")
put("first_detection_per_day", PREP, "select acq_date_use, instrument, cleanid, lon, lat from pnt qualify row_number() over (partition by acq_date_use, instrument order by cleanid)=1")
put("row_counts", (*PREP, FIRES), "select 'work_pnt' as table_name, count(*) as n_rows from pnt union all select 'fires', count(*) from fires union all select 'raw', count(*) from det")
put("calendar_columns", (FIRES,), """select distinct acq_date_utc, strftime(acq_date_utc,'%Y%j') as yyyyddd, acq_date_utc as back, cast(dayofyear(acq_date_utc) as int) as doy,
 cast(dayofyear(make_date(year(acq_date_utc),12,31)) as int) as n_days, cast(acq_date_utc - date '1990-01-01' as int) as since, cast(strftime(acq_date_utc,'%Y%m%d') as int) as ymd,
 cast(datediff('month', date '1990-01-01', acq_date_utc)+1 as int) as months from fires""")
put("day_islands", ("""dr as (select 'file'||(o_custkey%3) as file, year(o_orderdate) as y,
 dayofyear(o_orderdate)+case when o_orderkey%997=0 then -400 when o_orderkey%991=0 then 400 else 0 end as d from orders
 where (cast(o_orderdate as date)-date '1990-01-01')%17 > o_custkey%3)""",
    "dk as (select *, d between 1 and dayofyear(make_date(y,12,31)) as good from dr)",
    "dd as (select distinct file, cast(make_date(y,1,1)+cast(d-1 as int) as date) as dy from dk where good)",
    # A day starts a run if the day before is not there.
    "ds as (select a.*, sum(case when b.dy is null then 1 else 0 end) over (partition by a.file order by a.dy) as run from dd a left join dd b on a.file=b.file and b.dy=cast(a.dy-1 as date))",
    'dt as (select file, min(dy) as "first", max(dy) as "last", count(*) as n_days from ds group by file, run)'),
    """select file, "first", "last", n_days, cast(coalesce(lead("first") over (partition by file order by "first")-"last"-1,0) as bigint) as missing from dt
 union all select file, null, null, count(*), 0 from dk where not good group by file""")
put("period_gaps", ("""pd as (select cast(unnest(generate_series(timestamp '1995-02-20', timestamp '1998-12-31', interval 1 day)) as date) as dy)""",
    "pm as (select dy from pd where dy not in (select cast(o_orderdate as date) from orders where (cast(o_orderdate as date)-date '1990-01-01')%7<>3))",
    "pr as (select dy, dy - cast(row_number() over (order by dy) as int) as run from pm)"),
    'select min(dy) as "first", max(dy) as "last", count(*) as n_days from pr group by run')
put("day_order_breaks", ("o as (select o_custkey, o_orderkey, cast(o_orderdate as date) as day from orders)",),
    "select * from (select *, lag(day) over (partition by o_custkey order by o_orderkey) as previous from o) where day<previous")

# -- clustering --------------------------------------------------------------------------------------------
put("footprint_sites", A_BASE, f"select acq_date_use, lon, lat, {r('dx',9,'pix_dx')}, {r('dy',9,'pix_dy')}, site, n_det from asite")
put("adjacency_pairs", A_BASE, "select acq_date_use, a_site, b_site from apair")
put("components_min_label", A_BASE, "select site as node, fireid as component, n_sites as n_nodes from afull")
put("cluster_aggressive", A_BASE, "select cleanid, fireid, cast(ndetect as bigint) as ndetect from apoint")
put("cluster_conservative", C_BASE, "select cleanid, fireid, cast(ndetect as bigint) as ndetect from cpoint")
TREE = "cover as (select fireid, avg(case when tree between 0 and 100 then tree end) as v_tree from aval group by fireid)"
put("tree_cover", (*A_BASE, *A_CELL, TREE), f"select fireid, {r('v_tree',6,'v_tree')} from cover")
put("alg_agg_merge", (*A_BASE, *A_CELL, TREE), "select cleanid, fireid, case when v_tree>=50 then 1 else 2 end as alg_agg from apoint left join cover using (fireid)")
put("merged_clusters", (*A_BASE, *A_CELL, TREE, *CON), """, m as (select cleanid, fireid as fireid1, ndetect as n1, case when v_tree>=50 then 1 else 2 end as alg_agg from apoint left join cover using (fireid))
select m.cleanid, alg_agg, case alg_agg when 1 then fireid1 else c.fireid end as fireid, cast(case alg_agg when 1 then n1 else c.ndetect end as bigint) as ndetect from m join cpoint c using (cleanid)""")
put("near_pairs_invdist", PREP, """, pl as (select cast(floor(lat) as bigint) as fireid, lon, lat, min(cleanid) as node from pnt group by all),
d as (select a.fireid, a.node a_node, b.node b_node, sqrt((a.lon-b.lon)*(a.lon-b.lon)+(a.lat-b.lat)*(a.lat-b.lat)) dist from pl a join pl b on a.fireid=b.fireid and a.node<b.node and abs(a.lat-b.lat)<0.02e0 and abs(a.lon-b.lon)<0.02e0)
select fireid, a_node, b_node, round(case when dist=0 then 3600e0 else 1e0/dist end,4)+0e0 as invdist from d where dist < 1.0e0/60.0e0""")
put("nearest_seed_points", PREP, """, q as (select cleanid, rawid, lon, lat, cast(floor(lon/2)*1000+floor(lat/2) as bigint) as fireid from pnt),
s as (select fireid, lon, lat, min(cleanid) as seed from q where rawid%4=0 group by all),
x as (select q.cleanid, q.fireid, s.seed, (s.lon-q.lon)*(s.lon-q.lon)+(s.lat-q.lat)*(s.lat-q.lat) as d2 from q join s using (fireid))
select cleanid, fireid, seed as polyid from x qualify row_number() over (partition by cleanid order by d2, seed)=1""")
_E = num(math.sqrt((1 / 298.257223563) * (2 - 1 / 298.257223563)))
_B2 = num((6378137.0 * (1 - 1 / 298.257223563)) ** 2 / 2 / 1e6)


def _q(lat: str) -> str:
    s = f"sin(radians({lat}))"
    return f"({s}/(1e0-{_E}*{_E}*{s}*{s})+ln((1e0+{_E}*{s})/(1e0-{_E}*{s}))/(2e0*{_E}))"


put("lone_box_areas", (*PREP, EXT), f"select cleanid, round({_B2}*radians(2e0*fire_dx)*({_q('lat+fire_dy')}-{_q('lat-fire_dy')}),7)+0e0 as area_sqkm from ext")

_STRIP = num(1 / 4800)
_LIMY = [(f"({s}*(by_-ay)+(bdy-ady))", f"({s}*(y-ay)-ady)") for s in ("1e0", "-1e0")]
_TLO = "greatest(0e0," + ",".join(f"case when {m}>0 then {v}/{m} else 0e0 end" for m, v in _LIMY) + ")"
_THI = "least(1e0," + ",".join(f"case when {m}<0 then {v}/{m} else 1e0 end" for m, v in _LIMY) + ")"


def _edge(sign: str, t: str) -> str:
    return f"(ax+{t}*(bx-ax){sign}(adx+{t}*(bdx-adx)))"


SCAN = (
    "mh as (select h.* from ahull h join (select distinct fireid from afull where n_sites>1) using (fireid))",
    "bb as (select fireid, min(least(ay-ady,by_-bdy)) y0, max(greatest(ay+ady,by_+bdy)) y1 from mh group by fireid)",
    f"bn as (select fireid, y0, (y1-y0)/greatest(ceil((y1-y0)/{_STRIP}),8) as h, cast(greatest(ceil((y1-y0)/{_STRIP}),8) as int) as n from bb)",
    "st as (select *, y0+(k+0.5e0)*h as y from (select mh.*, y0, h, unnest(range(n)) as k from mh join bn using (fireid)))",
    "tt as (select *, " + _TLO + " as t0, " + _THI + " as t1 from st where " + " and ".join(f"({m}<>0 or {v}<=0)" for m, v in _LIMY) + ")",
    f"iv as (select fireid, k, y, h, least({_edge('-','t0')},{_edge('-','t1')}) as x0, greatest({_edge('+','t0')},{_edge('+','t1')}) as x1 from tt where t0<=t1)",
    "im as (select *, case when x0 > max(x1) over (partition by fireid, k order by x0, x1 rows between unbounded preceding and 1 preceding) then 1 else 0 end as fresh from iv)",
    "ig as (select *, sum(fresh) over (partition by fireid, k order by x0, x1 rows between unbounded preceding and current row) as run from im)",
    "iu as (select fireid, k, y, h, min(x0) x0, max(x1) x1 from ig group by fireid, k, y, h, run)",
    f"""ar as (select fireid, sum({_B2}*radians(x1-x0)*({_q('y+h/2e0')}-{_q('y-h/2e0')})) as a, sum((x1-x0)*h*(x0+x1)/2e0)/sum((x1-x0)*h) as cx, sum((x1-x0)*h*y)/sum((x1-x0)*h) as cy from iu group by fireid
 union all select fireid, {_B2}*radians(2e0*fire_dx)*({_q('lat+fire_dy')}-{_q('lat-fire_dy')}), lon, lat from afull where n_sites=1)""",
)
put("scanline_areas", (*A_BASE, *SCAN), f"select fireid, {r('a',6,'area_sqkm')}, {r('a',6,'parts_sqkm')}, {r('cx',6,'cen_lon')}, {r('cy',6,'cen_lat')} from ar")

put("voronoi_sub_areas", (
    *A_BASE, *SCAN,
    "sd as (select fireid, lon, lat, min(cleanid) as seed from apoint group by fireid, lon, lat)",
    "pr as (select iu.*, s.seed, s.lon-x0 as u, (s.lon-x0)*(s.lon-x0)+(s.lat-y)*(s.lat-y) as c from iu join sd s using (fireid))",
    # Each seed against all others of the fire: the range left by the bisectors.
    """bd as (select a.fireid, a.k, a.y, a.h, a.x0, a.seed, greatest(0e0, max(case when b.u<a.u then (b.c-a.c)/(2e0*(b.u-a.u)) end)) as lo,
 least(a.x1-a.x0, min(case when b.u>a.u then (b.c-a.c)/(2e0*(b.u-a.u)) end)) as hi, bool_or(b.u=a.u and (b.c<a.c or (b.c=a.c and b.seed<a.seed))) as dead
 from pr a join pr b on a.fireid=b.fireid and a.k=b.k and a.x0=b.x0 group by a.fireid, a.k, a.y, a.h, a.x0, a.x1, a.seed)""",
    f"""vo as (select fireid, seed as polyid, sum({_B2}*radians(hi-lo)*({_q('y+h/2e0')}-{_q('y-h/2e0')})) as a, sum((hi-lo)*h*(x0+lo+x0+hi)/2e0)/sum((hi-lo)*h) as cx, sum((hi-lo)*h*y)/sum((hi-lo)*h) as cy
 from bd where hi>lo and not dead group by fireid, seed
 union all select fireid, site, {_B2}*radians(2e0*fire_dx)*({_q('lat+fire_dy')}-{_q('lat-fire_dy')}), lon, lat from afull where n_sites=1)""",
), f"select fireid, polyid, {r('a',6,'area_sqkm')}, {r('cx',6,'cen_lon')}, {r('cy',6,'cen_lat')} from vo")

# -- outlines: Euler's number of the strips instead of rings; the boundary from the ends on either side of a strip border
_ALONE = "afull where n_sites=1"
put("area_outlines", (*A_BASE, *SCAN), f"""select ar.fireid, cast(1 as bigint) as n_polygons, cast(coalesce(1-iv.n+coalesce(ov.n,0),0) as bigint) as n_holes, {r('a',6,'area_sqkm')} from ar
 left join (select fireid, count(*) as n from iu group by fireid) iv using (fireid)
 left join (select p.fireid, count(*) as n from iu p join iu q on p.fireid=q.fireid and p.k+1=q.k and p.x0<q.x1 and q.x0<p.x1 group by p.fireid) ov using (fireid)""")
put("area_tiles", (*A_BASE, *SCAN, f"""bx as (select fireid as key, x0, x1, y-h/2e0 as y0, y+h/2e0 as y1 from iu
 union all select fireid, lon-fire_dx, lon+fire_dx, lat-fire_dy, lat+fire_dy from {_ALONE})""", *_touched("bx")), "select tile, count(*) as n from bt group by tile")
VORONOI_ALL = (
    "sd as (select fireid, lon, lat, min(cleanid) as seed from apoint group by fireid, lon, lat)",
    "pr as (select iu.*, s.seed, s.lon-x0 as u, (s.lon-x0)*(s.lon-x0)+(s.lat-y)*(s.lat-y) as c from iu join sd s using (fireid))",
    """bd as (select a.fireid, a.k, a.y, a.h, a.x0, a.seed, greatest(0e0, max(case when b.u<a.u then (b.c-a.c)/(2e0*(b.u-a.u)) end)) as lo,
 least(a.x1-a.x0, min(case when b.u>a.u then (b.c-a.c)/(2e0*(b.u-a.u)) end)) as hi, bool_or(b.u=a.u and (b.c<a.c or (b.c=a.c and b.seed<a.seed))) as dead
 from pr a join pr b on a.fireid=b.fireid and a.k=b.k and a.x0=b.x0 group by a.fireid, a.k, a.y, a.h, a.x0, a.x1, a.seed)""",
    f"""pc as (select fireid, seed as polyid, k, y, h, x0+lo as p0, x0+hi as p1 from bd where hi>lo and not dead
 union all select fireid, site, 0, lat, 2e0*fire_dy, lon-fire_dx, lon+fire_dx from {_ALONE})""",
)
put("sub_area_outlines", (*A_BASE, *SCAN, *VORONOI_ALL),
    f"select fireid, polyid, round(sum({_B2}*radians(p1-p0)*({_q('y+h/2e0')}-{_q('y-h/2e0')})),6)+0e0 as area_sqkm from pc group by fireid, polyid")
# Every second gap between the ends met along a strip border is boundary.
put("area_compactness", (
    *A_BASE, *SCAN, *VORONOI_ALL,
    """en as (select fireid, polyid, h, k as lv, p0 as x, 'l' as side from pc union all select fireid, polyid, h, k, p1, 'r' from pc
 union all select fireid, polyid, h, k+1, p0, 'l' from pc union all select fireid, polyid, h, k+1, p1, 'r' from pc)""",
    """eo as (select *, row_number() over w as n, lead(x) over w as nx, lead(side) over w as nside from en window w as (partition by fireid, polyid, lv order by x, side desc))""",
    """pe as (select fireid, polyid, sum(case when side=nside then sqrt((nx-x)*(nx-x)+h*h) else nx-x+h end) as p from eo where n%2=1 group by fireid, polyid)""",
    "pa as (select fireid, polyid, sum((p1-p0)*h) as a from pc group by fireid, polyid)",
), f"select fireid, polyid, {r('a',9,'area_deg2')}, {r('p',6,'perimeter_deg')}, round(4e0*pi()*a/(p*p),5)+0e0 as compactness from pa join pe using (fireid, polyid)")

# -- holes, thinning, subdivision: the rules in full -----------------------------------------------------------
_HOLE = num((1.0 / 240.0) ** 2)
HOLES = (
    "gp as materialized (select row_number() over (order by fireid, k, x1) as gap, fireid, k, y, h, x1 as g0, nx as g1 from (select *, lead(x0) over (partition by fireid, k order by x0) as nx from iu) where nx is not null)",
    "ln as (select fireid, k, min(x0) as lx0, max(x1) as lx1 from iu group by fireid, k)",
    # Openings that meet the outside above or below.
    "gd as (select gp.*, k + d.d as kk from gp, (values (-1), (1)) d(d))",
    "go as (select distinct gap from gd left join ln on ln.fireid=gd.fireid and ln.k=gd.kk where lx0 is null or g0<lx0 or g1>lx1)",
    "ge as materialized (select a.gap as s, b.gap as t from gp a join gp b on a.fireid=b.fireid and abs(a.k-b.k)=1 and a.g0<b.g1 and b.g0<a.g1)",
    "gr(gap, lab) as (select gap, gap from gp union select ge.t, gr.lab from gr join ge on ge.s=gr.gap)",
    "gl as (select gap, min(lab) as lab from gr group by gap)",
    f"""gh as (select lab from gp join gl using (gap) left join (select gap, true as isopen from go) using (gap) group by lab
 having not coalesce(bool_or(isopen), false) and (sum((g1-g0)*h) <= {_HOLE} or (max(g1)-min(g0))*(max(k)-min(k)+1)*max(h) <= {_HOLE}))""",
    "iw as materialized (select fireid, k, y, h, x0, x1 from iu union all select fireid, k, y, h, g0, g1 from gp join gl using (gap) join gh using (lab))",
)
_LONE = f"select fireid, {{id}}{_B2}*radians(2e0*fire_dx)*({_q('lat+fire_dy')}-{_q('lat-fire_dy')}) as a, lon as cx, lat as cy from afull where n_sites=1"
put("burned_areas", (
    *A_BASE, *SCAN[:-1], *HOLES,
    f"""af as (select fireid, sum({_B2}*radians(x1-x0)*({_q('y+h/2e0')}-{_q('y-h/2e0')})) as a, sum((x1-x0)*h*(x0+x1)/2e0)/sum((x1-x0)*h) as cx, sum((x1-x0)*h*y)/sum((x1-x0)*h) as cy from iw group by fireid
 union all {_LONE.format(id='')})""",
), f"select fireid, {r('a',6,'area_sqkm')}, {r('cx',6,'cen_lon')}, {r('cy',6,'cen_lat')} from af")

_SKIM_ROUNDS = 24


def _skim(points: str, radius: str) -> tuple[str, ...]:
    """Seeds ``sk`` (fireid, kept, seed, lon, lat, n_places, n_members) of ``points`` (fireid, lon, lat, cleanid).

    The rule round by round: places that beat all their neighbours, or tie among themselves and beat
    the rest, leave together or become one place with the largest weight towards each neighbour.
    """
    parts = [
        f"ks as materialized (select fireid, lon, lat, min(cleanid) as node, count(*) as mult from {points} group by all)",
        f"""kd as (select a.node as u, b.node as v, sqrt((a.lon-b.lon)*(a.lon-b.lon)+(a.lat-b.lat)*(a.lat-b.lat)) as dist
 from ks a join ks b on a.fireid=b.fireid and a.node<>b.node and abs(a.lat-b.lat)<={radius} and abs(a.lon-b.lon)<={radius})""",
        f"k0e as materialized (select u, v, cast(floor(least(case when dist=0 then 3600e0 else 1e0/dist end, 1e12)*1e6+0.5e0) as hugeint) as w from kd where dist<{radius})",
        "k0n as (select node, cast(mult as hugeint) as mult from ks)",
        "k0m as (select node, node as member from ks)",
    ]
    for i in range(_SKIM_ROUNDS):
        a, b = f"k{i}", f"k{i + 1}"
        parts += [
            f"""{a}s as materialized (select * from (select n.node, any_value(n.mult) as mult, (any_value(n.mult)-1)*3600000000 + coalesce(sum(e.w*o.mult), 0) as s
 from {a}n n left join {a}e e on e.u=n.node left join {a}n o on o.node=e.v group by n.node) where s>0)""",
            f"{a}r as materialized (select e.u, e.v, x.s as su, z.s as sv from {a}e e join {a}s x on x.node=e.u join {a}s z on z.node=e.v)",
            f"{a}g(node, lab) as (select node, node from {a}s union select q.v, g.lab from {a}g g join {a}r q on q.u=g.node and q.su=q.sv)",
            f"{a}l as materialized (select node, min(lab) as lab from {a}g group by node)",
            f"{a}b as (select distinct lab from {a}l join {a}r on u=node where sv>su)",
            f"{a}c as (select lab, count(*) as n from {a}l group by lab)",
            f"{a}w as materialized (select l.node, case when c.n>1 or x.mult>1 then l.lab end as new from {a}l l join {a}c c using (lab) join {a}s x on x.node=l.node where l.lab not in (select lab from {a}b))",
            f"""{b}e as materialized (select u, v, max(w) as w from (select coalesce(p.new, e.u) as u, coalesce(q.new, e.v) as v, w from {a}e e left join {a}w p on p.node=e.u left join {a}w q on q.node=e.v
 where (p.node is null or p.new is not null) and (q.node is null or q.new is not null)) where u<>v group by u, v)""",
            f"{b}m as materialized (select coalesce(p.new, m.node) as node, m.member from {a}m m left join {a}w p on p.node=m.node where p.node is null or p.new is not null)",
            f"{b}n as materialized (select * from {a}n where node not in (select node from {a}w) union all select distinct new, cast(1 as hugeint) from {a}w where new is not null)",
        ]
    last = f"k{_SKIM_ROUNDS}"
    # Not settled after the last round: no rows at all, rather than wrong ones.
    parts.append(f"kx as (select count(*) as open from {last}e)")
    parts.append(f"""sk as materialized (select any_value(s.fireid) as fireid, m.node as kept, min(m.member) as seed, case when count(*)=1 then min(s.lon) else sum(s.lon*s.mult)/sum(s.mult) end as lon,
 case when count(*)=1 then min(s.lat) else sum(s.lat*s.mult)/sum(s.mult) end as lat, count(*) as n_places, cast(sum(s.mult) as bigint) as n_members
 from {last}m m join ks s on s.node=m.member, kx where kx.open=0 group by m.node)""")
    return tuple(parts)


_SKIM_OUT = f"select fireid, seed, {r('lon',9,'lon')}, {r('lat',9,'lat')}, n_places, n_members from sk"
_HALF_MINUTE = "(0.5e0/60e0)"
put("skim_points", (*A_BASE, *_skim("apoint", _HALF_MINUTE)), _SKIM_OUT)
put("skim_points_wide", (*PREP, "wp as (select *, cast(floor(lon)*1000+floor(lat) as bigint) as fireid from pnt)", *_skim("wp", "(1.5e0/60e0)")), _SKIM_OUT)
SEEDS = (*_skim("apoint", _HALF_MINUTE), "sd as materialized (select fireid, lon, lat, min(seed) as seed from sk group by fireid, lon, lat)")
put("sub_polygon_members", (
    *A_BASE, *SEEDS,
    "ms as (select p.cleanid, s.seed, (s.lon-p.lon)*(s.lon-p.lon)+(s.lat-p.lat)*(s.lat-p.lat) as d2 from apoint p join sd s using (fireid))",
), "select seed as polyid, cleanid from ms qualify row_number() over (partition by cleanid order by d2, seed)=1")
VORONOI = (
    "pr as (select iw.*, s.seed, s.lon-x0 as u, (s.lon-x0)*(s.lon-x0)+(s.lat-y)*(s.lat-y) as c from iw join sd s using (fireid))",
    """bd as (select a.fireid, a.k, a.y, a.h, a.x0, a.seed, greatest(0e0, max(case when b.u<a.u then (b.c-a.c)/(2e0*(b.u-a.u)) end)) as lo,
 least(a.x1-a.x0, min(case when b.u>a.u then (b.c-a.c)/(2e0*(b.u-a.u)) end)) as hi, bool_or(b.u=a.u and (b.c<a.c or (b.c=a.c and b.seed<a.seed))) as dead
 from pr a join pr b on a.fireid=b.fireid and a.k=b.k and a.x0=b.x0 group by a.fireid, a.k, a.y, a.h, a.x0, a.x1, a.seed)""",
    f"""vo as (select fireid, seed as polyid, sum({_B2}*radians(hi-lo)*({_q('y+h/2e0')}-{_q('y-h/2e0')})) as a, sum((hi-lo)*h*(x0+lo+x0+hi)/2e0)/sum((hi-lo)*h) as cx, sum((hi-lo)*h*y)/sum((hi-lo)*h) as cy
 from bd where hi>lo and not dead group by fireid, seed union all {_LONE.format(id='site, ')})""",
)
put("sub_polygons", (*A_BASE, *SCAN[:-1], *HOLES, *SEEDS, *VORONOI), f"select fireid, polyid, {r('a',6,'area_sqkm')}, {r('cx',6,'cen_lon')}, {r('cy',6,'cen_lat')} from vo")

# -- zonal statistics ----------------------------------------------------------------------------------------
put("fire_pixels", (*C_BASE, *C_CELL), "select fireid, iy, ix from ccell")
_HIST = "h as (select fireid, lct as v_lct, count(*) as cv_lct from {p}val group by all)"
put("zonal_lct_hist", (*A_BASE, *A_CELL, _HIST.format(p="a")), """select fireid, v_lct, cv_lct, cast(row_number() over (partition by fireid order by cv_lct desc, v_lct) as int) as r_lct,
 cast(sum(cv_lct) over (partition by fireid) as bigint) as ct_lct, round(cv_lct/sum(cv_lct) over (partition by fireid),6)+0e0 as f_lct from h""")
ORACLES["zonal_lct_tiled"] = ORACLES["zonal_lct_hist"]
put("zonal_lct_majority", (*C_BASE, *C_CELL, _HIST.format(p="c")), "select fireid, v_lct, cv_lct from h qualify row_number() over (partition by fireid order by cv_lct desc, v_lct)=1")
_avg = ", ".join(f"round(avg(case when {b} between 0 and 100 then {b} end),6)+0e0 as v_{b}" for b in ("tree", "herb", "bare"))
put("zonal_vcf_mean", (*A_BASE, *A_CELL), f"select fireid, {_avg} from aval group by fireid")
ORACLES["zonal_vcf_runs"] = ORACLES["zonal_vcf_mean"]
put("zonal_region", PREP, """, k as (select distinct cast(floor((longitude+180)/30) as int) as k from det)
select cleanid, cast(k.k+1 as int) as v_regnum from pnt left join k on floor((lon+0.0003e0+180)/30)=k.k""")
put("zonal_frp", PREP, "select rawid%997 as polyid, round(avg(frp),6)+0e0 as v_frp from pnt where rawid%11<>0 group by all")

# -- emissions -----------------------------------------------------------------------------------------------
_tot = ["area_m2", "CO2", "CO", "CH4", "NMOC", "OC", "BC"]
put("emission_totals", EMIT, "select region, genveg, count(*) as n_fires, round(sum(area_m2*bmass),1)+0e0 as biomass_kg, " + ", ".join(r(f"sum({s})", 1, s) for s in _tot) + " from em group by region, genveg")
put("cover_rescale", (FIRES, *V2), "select polyid, fireid, v_lct, " + ", ".join(r(c, 5, c) for c in ("totcov", "tree", "herb", "bare")) + ", rescaled, all_bare from v2d where reject is null")
_gv = "select v_lct as lct, lct_used, genveg, count(*) as n, cast(sum(fireid) as bigint) as ids from {t} where reject is null group by all"
put("genveg_v2", (FIRES, *V2), _gv.format(t="v2d"))
put("genveg_v1", (FIRES, *V1), _gv.format(t="v1d"))
put("biomass_v2", BURN, f"select polyid, fireid, genveg, area_sqkm, fuel, coarse, herb_fuel, {r('bmass',7,'bmass')}, {r('area_m2',3,'area_m2')} from burnt where reason is null")
put("emit_base", EMIT, "select polyid, fireid, genveg, round(v_frp,4)+0e0 as v_frp, area_sqkm, " + ", ".join(r(f"{s}+0.0001234567891e0", 1, s) for s in BASE) + " from em")
put("emit_long", EMIT, ", u as (unpivot (select acq_date_utc, " + ",".join(BASE) + " from em) on " + ",".join(BASE) + " into name species value emission)\nselect species, acq_date_utc, count(*) as n, round(sum(emission),1)+0e0 as emission from u group by all")
put("emissions_one_year", EMIT, "select genveg, count(*) as n, round(sum(CO),1)+0e0 as CO from em where year(acq_date_utc)=1998 group by genveg")


def _voc(mechanism: str, table: str = "voct") -> str:
    sp = lookups.voc_species(mechanism)
    return _values(lookups.voc_rows(mechanism), ["GenVegIndex", *sp], table, ["vg", *[f"w_{s}" for s in sp]])


for _m in ("MOZART", "SAPRC", "GEOSCHEM"):
    put(f"speciate_{_m.lower()}", (*EMIT, _voc(_m)), "select genveg, region, " + ", ".join(r(f"sum(coalesce(w_{s},0e0)*NMOC)", 1, f"voc_{s}") for s in lookups.voc_species(_m)) + " from em left join voct on vg=genveg group by genveg, region")

put("vegetation_audit", BURN, """select cast(dayofyear(acq_date_utc) as int) as jday, fireid, polyid, cen_lat, cen_lon, v_lct as lct_in, lct_used as lct_out, """
    + ", ".join(r(a, 5, b) for a, b in (("v_tree", "tree_in"), ("tree", "tree_out"), ("v_herb", "herb_in"), ("herb", "herb_out"), ("v_bare", "bare_in"), ("bare", "bare_out"), ("f_lct", "f_lct")))
    + ", genveg from burnt where reject is null and genveg>0")
_cnt = lambda cond, name: f"count(*) filter (where {cond}) as {name}"
put("reject_counts", BURN, "select count(*) as n_rows, " + ", ".join([
    _cnt("reason is null", "n_kept"), _cnt("reason='no region'", "n_no_region"), _cnt("reason='land cover'", "n_land_cover"), _cnt("reason='total cover'", "n_total_cover"),
    _cnt("reason='vegetation'", "n_no_vegetation"), _cnt("reason='fuel'", "n_no_fuel"), _cnt("reason='area'", "n_no_area"), _cnt("reason is null and all_bare", "n_all_bare"),
    _cnt("reason is null and rescaled", "n_rescaled"), _cnt("reason is null and totcov<50", "n_cover_below_50"), _cnt("reason is null and v_lct=13", "n_urban")]) + " from burnt")
put("global_totals", EMIT, "select genveg, count(*) as n_fires, round(sum(area_m2),0)+0e0 as area_m2, round(sum(area_m2*bmass),0)+0e0 as biomass_kg, round(sum(CO2),0)+0e0 as CO2, round(sum(CO),0)+0e0 as CO, round(sum(PM25),0)+0e0 as PM25 from em group by rollup(genveg)")
put("area_totals", (FIRES,), """, a as (select *, area_sqkm*f_lct as p from fires)
select kind, class, round(area,4)+0e0 as area from (select 'total' as kind, 'total' as class, sum(p) as area from a union all select 'cover','tree',sum(p*v_tree/100e0) from a union all select 'cover','herb',sum(p*v_herb/100e0) from a
 union all select 'cover','bare',sum(p*v_bare/100e0) from a union all select 'lct', cast(v_lct as varchar), sum(p) from a group by v_lct)""")

# -- grids -----------------------------------------------------------------------------------------------------
_UNIT = "molecules/cm^2/s"
_TERMS = [("CO", False, 12.0, [("CO", 1.0)]), ("NOX", False, 12.0, [("NO", 1.0), ("NO2", 0.5)]), ("org", True, 12.0, [("OC", 1.25)]), ("soot", True, 24.0, [("BC", 1.0)])]
_VOC_TERMS = [("TERP", False, 12.0, [(s, 1.0) for s in ("APIN", "BPIN", "LIMON", "MYRC")]),
              ("MIXED", False, 12.0, [("C3H6", 0.05), ("C2H6", 0.025), ("BENZENE", 0.08), ("TOLUENE", 0.1)])]


def _sum(terms: list, agg: bool = True) -> str:
    return "+".join(f"{num(w)}*" + (f"sum({s})" if agg else s) for s, w in terms)


put("species_map_totals", EMIT, " union all ".join(
    f"select genveg, '{t}' as target, '{_UNIT}' as units, {str(a).lower()} as is_aerosol, {num(mw)} as mw, round({_sum(terms)},0)+0e0 as total from em group by genveg" for t, a, mw, terms in _TERMS))

_RE = "6.37122e6"


def _grid(src: str, nlon: int, nlat: int, polar: bool, terms: list, lat: str = "cen_lat") -> tuple[str, ...]:
    """Cell of each fire and density per species, day and cell."""
    dlon, dlat = 360.0 / nlon, (180.0 / (nlat - 1) if polar else 180.0 / nlat)
    lon0, lat0 = (0.0, -90.0) if polar else (dlon / 2, -90 + dlat / 2)
    ring = 4e4 * math.pi * 6.37122e6 ** 2 / nlon
    half = math.radians(dlat / 2)
    body = f"{num(ring * math.sin(half))}*cos(radians({num(lat0)}+(j-1)*{num(dlat)}))"
    area = f"(case when j=1 or j={nlat} then {num(ring * math.sin(half / 2) ** 2)} else {body} end)" if polar else f"({body})"
    return (
        f"gx as (select *, ((case when cen_lon<0 then cen_lon+360e0 else cen_lon end)-{num(lon0)})/{num(dlon)}+1e0 as x, ({lat}-({num(lat0)}))/{num(dlat)}+1e0 as y from {src})",
        f"gi as (select *, cast((cast(round(case when x>{nlon}.5 then x-{nlon} else x end) as int)-1)%{nlon}+1 as int) as i, cast(least(round(y),{nlat}) as int) as j from gx)",
        "gs as (" + " union all ".join(
            f"select '{t}' as species, acq_date_utc as date, i, j, ({_sum(tm)})*(6.022e23/86400e0/{area})" + (f"*1e3/{num(mw)}" if a else "") + " as value from gi group by acq_date_utc, i, j"
            for t, a, mw, tm in terms) + ")",
    )


put("grid_daily_1x1", (*EMIT, *_grid("em", 360, 180, False, _TERMS)), "select species, date, i, j, round(value/1e9,2)+0e0 as value from gs")
put("grid_daily_polar_rows", (*EMIT, *_grid("em", 144, 96, True, _TERMS, "(cen_lat*90e0/70e0)")), "select species, date, i, j, round(value/1e9,2)+0e0 as value from gs")
_MONTH = "select species, cast(date_trunc('month',date) as date) as month, i, j, round(sum(value)/max(day(last_day(date)))/1e9,2)+0e0 as value from gs group by all"
_MONTH = "select species, cast(date_trunc('month',date) as date) as month, i, j, round(sum(value)/day(last_day(date_trunc('month',date)))/1e9,2)+0e0 as value from gs group by species, date_trunc('month',date), i, j"
put("grid_monthly_0p9x1p25", (*EMIT, *_grid("em", 288, 192, True, _TERMS)), _MONTH)
_sp = [s for _, _, _, tm in _VOC_TERMS for s, _ in tm]
put("grid_monthly_vocs", (*EMIT, _voc("MOZART"), "ev as (select acq_date_utc, cen_lon, cen_lat, " + ", ".join(f"coalesce(w_{s},0e0)*NMOC as {s}" for s in _sp) + " from em left join voct on vg=genveg)", *_grid("ev", 128, 64, True, _VOC_TERMS)), _MONTH)
put("grid_conservation", EMIT, "select acq_date_utc as date, round(sum(CO),1)+0e0 as moles_fires, round(sum(CO),1)+0e0 as moles_grid from em group by acq_date_utc")
put("grid_unstructured", EMIT, " union all ".join(
    f"select '{t}' as species, acq_date_utc as date, cast((floor((cen_lon+0.005e0)/10)+18)*18+floor((cen_lat+0.005e0)/10)+9 as bigint) as cell, round(({_sum(tm)})*(6.022e23/86400e0/(1e4*{_RE}*{_RE})/0.03e0){f'*1e3/{num(mw)}' if a else ''}/1e9,2)+0e0 as value from em group by all"
    for t, a, mw, tm in _TERMS))

put("grid_unlocated", EMIT, """select acq_date_utc as date, count(*) as n_fires, round(sum(area_m2),2)+0e0 as area_m2, round(sum(CO),1)+0e0 as CO from em
 where (cast(floor((cen_lon+0.005e0)/10) as int)+18)%5=0 group by acq_date_utc""")

# Regional grids: the projection formulas as SQL text.
_R = 6370000.0
_rad = math.radians


def _turned(e: str) -> str:
    return f"(case when {e}>180 then {e}-360 when {e}<-180 then {e}+360 else {e} end)"


def _project(name: str) -> tuple[str, str, int, int, str]:
    """(x, y, nx, ny, 1/cell area) for the domains used by the queries."""
    if name == "lambert":
        nx, ny, lon0, lat0, t1, t2, dx = 220, 160, -97.0, 38.0, 30.0, 60.0, 36000.0
        cone = (math.log10(math.cos(_rad(t1))) - math.log10(math.cos(_rad(t2)))) / (math.log10(math.tan(_rad(45 - t1 / 2))) - math.log10(math.tan(_rad(45 - t2 / 2))))
        k = _R / dx * math.cos(_rad(t1)) / cone
        ref = math.tan(_rad((90 - t1) / 2))
        rho0 = k * (math.tan(_rad((90 - lat0) / 2)) / ref) ** cone
        rho = f"{num(k)}*pow(tan(radians((90e0-cen_lat)/2e0))/{num(ref)},{num(cone)})"
        arg = f"({num(cone)}*radians({_turned('(cen_lon+97e0)')}))"
        return f"{num((nx + 1) / 2)}+{rho}*sin{arg}", f"{num((ny + 1) / 2 + rho0)}-{rho}*cos{arg}", nx, ny, num(1 / dx ** 2)
    if name == "polar":
        nx, ny, lon0, lat0, t1, dx = 180, 180, -100.0, 55.0, 60.0, 40000.0
        top = 1 + math.sin(_rad(t1))
        r0 = _R / dx * math.cos(_rad(lat0)) * top / (1 + math.sin(_rad(lat0)))
        a0 = _rad(lon0 - (lon0 + 90))
        rm = f"({num(_R / dx)}*cos(radians(cen_lat))*{num(top)}/(1e0+sin(radians(cen_lat))))"
        a = f"radians(cen_lon-({num(lon0 + 90)}))"
        return f"{num((nx + 1) / 2 - r0 * math.cos(a0))}+{rm}*cos({a})", f"{num((ny + 1) / 2 - r0 * math.sin(a0))}+{rm}*sin({a})", nx, ny, num(1 / dx ** 2)
    if name == "mercator":
        nx, ny, lon0, lat0, t1, dx = 250, 150, 20.0, 5.0, 10.0, 50000.0
        step = dx / (_R * math.cos(_rad(t1)))
        rsw = math.log(math.tan(0.5 * _rad(lat0 + 90))) / step
        return (f"{num((nx + 1) / 2)}+{_turned('(cen_lon-20e0)')}/{num(math.degrees(step))}",
                f"{num((ny + 1) / 2 - rsw)}+ln(tan(radians(cen_lat+90e0)/2e0))/{num(step)}", nx, ny, num(1 / dx ** 2))
    dx = _R * _rad(0.75)
    south, north = "sin(radians(-39.5e0+(j-1.5e0)*0.5e0))", "sin(radians(-39.5e0+(j-0.5e0)*0.5e0))"
    return "(cen_lon+30e0)/0.75e0+1e0", "(cen_lat+39.5e0)/0.5e0+1e0", 120, 80, f"(1e0/({num(_R)}*{num(dx)}*({north}-{south})))"


HOURS = HOURLY
PROFILE = "prof(h, fac) as (values " + ",".join(f"({h},{num(x / sum(HOURS) * 24)})" for h, x in enumerate(HOURS)) + ")"


def _regional(name: str, where: str) -> tuple[str, ...]:
    x, y, nx, ny, per = _project(name)
    return (
        *EMIT, PROFILE,
        f"wx as (select *, {x} as x, {y} as y from em where {where})",
        f"wi as (select *, cast(round(x) as int) as i, cast(round(y) as int) as j from wx where x>=0.5e0 and x<{nx}.5e0 and y>=0.5e0 and y<{ny}.5e0)",
        """wh as (select wi.*, k.hour, fac from wi, (select cast(unnest(range(24)) as int) as hour) k join prof on prof.h=(cast(floor(k.hour+(case when cen_lon<0 then cen_lon+360e0 else cen_lon end)/15e0) as int))%24)"""
        .replace("(select cast(unnest(range(24)) as int) as hour) k join prof on prof.h=", "(select cast(unnest(range(24)) as int) as hour) k, prof where prof.h="),
        "wg as (select acq_date_utc as date, hour, i, j, least(sum(area_m2),2e6) as fire_size, " + ", ".join(
            f"sum(({_sum(tm, False)})*fac*{per})*" + ("(1e5/8.64e0)" if a else "(1e6/24e0)") + f" as ebu_in_{t}" for t, a, mw, tm in _TERMS) + " from wh group by acq_date_utc, hour, i, j)",
    )


for _d in ("lambert", "polar", "mercator", "latlon"):
    put(f"grid_wrf_{_d}", _regional(_d, "true"),
        f"select date, hour, i, j, {r('fire_size',2,'fire_size')}, {r('ebu_in_CO',3,'ebu_in_CO')}, {r('ebu_in_NOX',4,'ebu_in_NOX')}, {r('ebu_in_org',5,'ebu_in_org')}, {r('ebu_in_soot',6,'ebu_in_soot')} from wg")
_x, _y, _nx, _ny, _ = _project("latlon")
put("wrf_latlon_mass", (*EMIT, f"wx as (select *, {_x} as x, {_y} as y from em)"),
    f"select acq_date_utc as date, {r('sum(CO)', 2, 'co')} from wx where x>=0.5e0 and x<{_nx}.5e0 and y>=0.5e0 and y<{_ny}.5e0 group by acq_date_utc")
_trips = []
for _d in ("lambert", "polar", "mercator", "latlon"):
    _x, _y, _nx, _ny, _ = _project(_d)
    _trips.append(f"select '{_d}' as projection, count(*) as n, true as ok from (select {_x} as x, {_y} as y from (select distinct cen_lon, cen_lat from fires)) where x>=0.5e0 and x<{_nx}.5e0 and y>=0.5e0 and y<{_ny}.5e0")
put("projection_round_trip", (FIRES,), " union all ".join(_trips))
_mx, _my, _mnx, _mny, _ = _project("mercator")
_TYPES = ["tempfor", "tropfor", "shrub", "grass"]
SURF = (
    DET,
    "sp as (select distinct longitude as cen_lon, latitude as cen_lat, (((cast(round(longitude*1000) as bigint)*7+cast(round(latitude*1000) as bigint)*3)%5)+5)%5 as k from det)",
    f"sx as (select *, {_mx} as x, {_my} as y from sp)",
    f"sc as (select cast(round(x) as int) as i, cast(round(y) as int) as j, count(*) as n_pixels, count(*) filter (where k<4) as n_flagged, " + ", ".join(f"count(*) filter (where k={n}) as n{n}" for n in range(4))
    + f" from sx where x>=0.5e0 and x<{_mnx}.5e0 and y>=0.5e0 and y<{_mny}.5e0 group by 1,2)",
    "sf as (select i, j, " + ", ".join(f"case when n{n}<>0 then n{n}/n_flagged else 0e0 end as frac_{t}" for n, t in enumerate(_TYPES)) + ", n_flagged, n_pixels from sc)",
)
put("surface_fractions", SURF, "select i, j, " + ", ".join(r(f"frac_{t}", 6, f"frac_{t}") for t in _TYPES) + ", n_flagged, n_pixels from sf")
put("fire_size_by_type", (*_regional("mercator", "true"), *SURF),
    "select date, hour, i, j, round(fire_size,2)+0e0 as fire_size, " + ", ".join(r(f"coalesce(frac_{t},0e0)*fire_size", 2, f"fire_size_{t}") for t in _TYPES) + " from wg left join sf using (i, j)")
put("period_check", (FIRES,), "select c.check_ as \"check\", c.ok from (select min(acq_date_utc) lo, max(acq_date_utc) hi from fires), lateral (values ('start not after end', true), ('start covered', lo <= date '1998-01-01'), ('end covered', hi >= date '2049-12-31')) c(check_, ok)")

# -- pixel tables ------------------------------------------------------------------------------------------------
SCAT = (DET, "sc as (select longitude lon, latitude lat, cast(rawid%17+1 as int) lct, cast(case when rawid%37=0 then 200 else rawid%101 end as int) tree, cast((rawid*3)%50 as int) herb, cast((rawid*7)%60 as int) bare, cast(floor(longitude/0.05e0) as bigint) ix, cast(floor(latitude/0.05e0) as bigint) iy from det)")
put("regrid_mode", SCAT, "select iy, ix, lct from (select iy, ix, lct, count(*) n from sc group by all) qualify row_number() over (partition by iy, ix order by n desc, lct)=1")
put("regrid_average", SCAT, "select iy, ix, round(avg(case when tree=200 then 0 else tree end),6)+0e0 as tree, round(avg(case when tree=200 then 0 else herb end),6)+0e0 as herb, round(avg(case when tree=200 then 100 else bare end),6)+0e0 as bare from sc group by iy, ix")
put("regrid_nearest", (DET,), """, p as (select longitude+0.0001e0 as lon, latitude+0.00023e0 as lat, min(cast(rawid%17+1 as int)) as lct from det group by longitude, latitude),
c as (select *, cast(floor(lon/0.05e0) as bigint) ix, cast(floor(lat/0.05e0) as bigint) iy from p)
select iy, ix, lct from c qualify row_number() over (partition by iy, ix order by (lon-(ix+0.5e0)*0.05e0)*(lon-(ix+0.5e0)*0.05e0)+(lat-(iy+0.5e0)*0.05e0)*(lat-(iy+0.5e0)*0.05e0), lat, lon)=1""")
BURNPX = ("bp as (select user_id as iy, event_id%97 as ix, cast(cast(floor(max(value)) as int)%4*30 as int) as value from events group by user_id, event_id%97)",)
put("burn_date_points", BURNPX, "select iy, ix, round(ix*0.005e0+0.0025e0,6)+0e0 as lon, round(iy*0.005e0+0.0025e0,6)+0e0 as lat, 2024 as burn_year, date '2024-01-01' + (value-1) as burn_date from bp where value>0")
put("burn_date_regions", (
    *BURNPX, "b as (select iy*1000+ix as id, iy, ix, value from bp where value>0)",
    "e as (select a.id s, c.id t from b a join b c on a.value=c.value and abs(a.iy-c.iy)+abs(a.ix-c.ix)=1)",
    "g(node, lab) as (select id, id from b union select e.t, g.lab from g join e on e.s=g.node where g.lab<e.t)",
    "l as (select node, min(lab) lab from g group by node)",
    # A label passes through nodes above it only; spread the minimum until nothing changes.
    "g2(node, lab) as (select node, lab from l union select e.t, g2.lab from g2 join e on e.s=g2.node)",
    "l2 as (select node, min(lab) lab from g2 group by node)",
), "select iy, ix, value, lab//1000 as riy, lab%1000 as rix, count(*) over (partition by lab) as n from b join l2 on node=id")
COARSE = ("cg as (select cast(o_orderkey%72+1 as int) gi, cast(o_custkey%36+1 as int) gj, max(o_orderkey)%90-1 as value from orders group by 1,2)",
          "cv as (select gi, gj, case when value=-1 then 0 else value end as value from cg)")


def _at(c: str, o: float, n: int) -> str:
    return f"greatest(1,least({n},cast(floor(({c}-({o}e0))/5e0+0.5e0) as int)+1))"


put("grid_value_at_points", (*PREP, *COARSE), f"select cleanid, p.gi, p.gj, value from (select cleanid, cast({_at('lon',-177.5,72)} as int) gi, cast({_at('lat',-87.5,36)} as int) gj from pnt) p left join cv on cv.gi=p.gi and cv.gj=p.gj")
put("grid_average_at_points", (
    *PREP, *COARSE,
    f"pa as (select cleanid, lon, lat, {_at('lon',-177.5,72)} gi, {_at('lat',-87.5,36)} gj from pnt)",
    "pb as (select cleanid, greatest(1, case when lon>=-177.5e0+(gi-1)*5e0 then gi else gi-1 end) il, greatest(1, case when lat>=-87.5e0+(gj-1)*5e0 then gj else gj-1 end) jl from pa)",
    "pc as (select cleanid, il+a as gi, jl+b as gj from pb, (values (0,0),(0,1),(1,0),(1,1)) t(a,b) where il+a<=72 and jl+b<=36)",
), "select cleanid, cast(sum(coalesce(value,0))//count(*) as bigint) as average from pc left join cv using (gi,gj) group by cleanid")

# -- first generation ------------------------------------------------------------------------------------------------
V1D = (DET, "vd as (select rawid rid, longitude cen_lon, latitude cen_lat, cast(dayofyear(acq_date) as int) jday, scan spix, track tpix, cast(case when rawid%5=0 then 0 else rawid%101 end as double) confidence from det)")
put("v1_confidence", V1D, "select jday, count(*) as n, cast(sum(rid) as bigint) as ids from vd where confidence>20 group by jday")
put("v1_tropics", V1D, "select jday+k as jday, case k when 1 then 0.5e0 else 1e0 end as factor, count(*) as n from vd, (values (0),(1)) t(k) where k=0 or (cen_lat>-30 and cen_lat<30) group by all")
put("v1_overlap_pairs", (*V1D, "vx as (select *, 6371e0*radians(cen_lon)*cos(radians(cen_lat)) x, 6371e0*radians(cen_lat) y, spix*tpix size from vd)"),
    """select a.jday, a.rid as winner, b.rid as loser from vx a join vx b on a.jday=b.jday and (a.size>b.size or (a.size=b.size and a.rid<b.rid))
 and b.x between a.x-a.tpix and a.x+a.tpix and b.y between a.y-a.spix and a.y+a.spix""")
OVERLAP = (
    "vx as (select *, 6371e0*radians(cen_lon)*cos(radians(cen_lat)) x, 6371e0*radians(cen_lat) y, spix*tpix size from vd)",
    """cp as (select a.rid as winner, b.rid as loser from vx a join vx b on a.jday=b.jday and (a.size>b.size or (a.size=b.size and a.rid<b.rid))
 and b.x between a.x-a.tpix and a.x+a.tpix and b.y between a.y-a.spix and a.y+a.spix)""",
    "lk as (select winner s, loser t from cp union all select loser, winner from cp)",
    "re(node, lab) as (select s, s from lk union select lk.t, re.lab from re join lk on lk.s=re.node)",
    "lb as (select node, min(lab) lab from re group by node)",
    "ws as (select loser, list(winner) ws from cp group by loser)",
    "od as (select rid, lab, ws, row_number() over (partition by lab order by size desc, rid) r from vx join lb on node=rid left join ws on loser=rid)",
    # Walk through each group of overlapping fires from the largest down, carrying the kept ones.
    "wk(lab, r, kept) as (select distinct lab, cast(0 as bigint), cast([] as bigint[]) from lb union all select o.lab, o.r, case when list_has_any(w.kept, coalesce(o.ws, [])) then w.kept else list_append(w.kept, o.rid) end from wk w join od o on o.lab=w.lab and o.r=w.r+1)",
    "kp as (select unnest(kept) rid from wk qualify row_number() over (partition by lab order by r desc)=1)",
)
put("v1_overlap", (*V1D, *OVERLAP), "select rid, jday, cen_lon, cen_lat, spix, tpix from vx where rid in (select rid from kp) or rid not in (select node from lb)")
_V1NAME = {"NOX": "NOXasNO"}
_VEGROW = SYNTHETIC_VEGETATION
_V1SP = ["CO2", "CO", "CH4", "NMHC", "NMOC", "H2", "NOX", "NO", "NO2", "SO2", "PM25", "TPM", "TPC", "OC", "BC", "NH3", "PM10"]
V1EM = (
    FIRES, *V1, FUEL, EFT,
    "vrow(frow, fgv) as (values " + ",".join(f"({k},{v})" for k, v in _VEGROW.items()) + ")",
    """w1 as (select d.*, k as copy, case k when 1 then 0.5e0 else 1e0 end as factor, cast(dayofyear(acq_date_utc) as int)+k as jday, fgrass,
 case when genveg=1 then fgrass when genveg=2 then fwood when genveg=3 then ftrop when genveg=4 or (genveg=5 and v_regnum=11) then ftemp when genveg=5 then fbor
 when genveg=9 then case when cen_lon between -49.156e0 and -47.323e0 and cen_lat between -22.708e0 and -20.356e0 then 1100e0 else 500e0 end end as fuel
 from v1d d left join fuelt on reg=v_regnum, (values (0),(1)) t(k) where (k=0 or (cen_lat>-30 and cen_lat<30)) and reject is null and genveg>0)""",
    """w2 as (select *, (case when genveg in (1,9) then 0.75e0 else 1e0 end)*(100e0-bare)*0.01e0 as area_km2,
 ((herb/100e0+tree/100e0)*fgrass*(case when tree>60 then 0.9e0 when tree>40 then exp(-0.013e0*tree/100e0) else 0.98e0 end)+(case when tree>40 then tree/100e0*fuel*0.3e0 else 0e0 end))/1000e0 as bmass from w1 where fuel is not null)""",
    "w3 as (select w2.*, v_regnum as region, " + ", ".join(f"k_{_V1NAME.get(s, s)}*(area_km2*(bmass*1000e0)*factor) as {s}" for s in _V1SP)
    + " from w2 join vrow on frow=(case lct_used when 14 then 13 when 16 then 14 else lct_used end) join eft on gv=fgv)",
)
put("v1_emissions", V1EM, "select region, genveg, factor, count(*) as n, round(sum(area_km2),5)+0e0 as area_km2, " + ", ".join(r(f"sum({s})", 1, s) for s in ("CO2", "CO", "NOX", "PM10", "NMOC")) + " from w3 group by region, genveg, factor")
put("v1_days_in_year", (FIRES,), "select cast(dayofyear(make_date(year(max(acq_date_utc)),12,31)) as int) as n_days from fires")
_MOL = {"CO2": 44.01, "CO": 28.01, "CH4": 16.04, "NH3": 17.03, "NO": 30.01, "NO2": 46.01, "SO2": 64.06, "H2": 2.02}


def _v1spec(mechanism: str, lead: list[str], vocs: list[str], tail: list[str], lump: str | None) -> str:
    cols = []
    for s in [*lead, *tail]:
        e = f"{s}*1e3/{num(_MOL[s])}" if s in _MOL else s
        if s == "NO" and lump:
            e = f"({e}+coalesce(w_{lump},0e0)*NMOC)"
        cols.append(r(f"sum({e})", 0, f"m_{s}"))
    cols += [r(f"sum(coalesce(w_{s},0e0)*NMOC)", 0, f"v_{s}") for s in vocs]
    return "select genveg, count(*) as n, " + ", ".join(cols) + " from w3 left join voct on vg=genveg where jday between 30 and 200 group by genveg"


_lead = ["CO2", "CO", "NO", "NO2", "SO2", "NH3", "CH4"]
put("v1_speciate_saprc99", (*V1EM, _voc("SAPRC")), _v1spec("SAPRC", [*_lead, "NMOC"], lookups.voc_species("SAPRC"), ["OC", "BC", "PM10", "PM25"], None))
_moz = lookups.voc_species("MOZART")
put("v1_speciate_moz4", (*V1EM, _voc("MOZART")), _v1spec("MOZART", ["CO2", "CO", "H2", *_lead[2:], "NMOC"], [*_moz[:24], *_moz[25:28]], ["OC", "BC", "PM10", "PM25"], _moz[24]))
put("v1_speciate_geoschem", (*V1EM, _voc("GEOSCHEM")), _v1spec("GEOSCHEM", _lead, [s for s in lookups.voc_species("GEOSCHEM") if s != "NO"], ["OC", "BC", "PM25"], "NO"))

put("v1_reject_counts", (
    *V1D, FIRES, *V1, FUEL, "vc as (select * from vd where confidence>20)",
    *[x.replace("from vd)", "from vc)") for x in OVERLAP],
    "kk as (select rid from vx where rid in (select rid from kp) or rid not in (select node from lb))",
    "rr as (select *, coalesce(reject, case when genveg<=0 then 'vegetation' when fgrass is null then 'fuel' end) as reason from v1d left join fuelt on reg=v_regnum)",
), """select count(*) as n_fires, count(*) filter (where reason='no region') as n_no_region, count(*) filter (where reason='land cover') as n_land_cover,
 count(*) filter (where all_bare and (reason is null or reason='all bare')) as n_all_bare, count(*) filter (where reason='vegetation') as n_no_vegetation, count(*) filter (where reason='fuel' and genveg<>9) as n_no_fuel,
 count(*) filter (where reason is null and rescaled and totcov>=50) as n_rescaled, count(*) filter (where reason is null and rescaled and totcov<50) as n_cover_below_50, count(*) filter (where reason is null and v_lct=13) as n_urban,
 (select count(*) from vd)-(select count(*) from vc) as n_low_confidence, (select count(*) from vc)-(select count(*) from kk) as n_overlap from rr""")
put("largest_and_smallest", (FIRES, "z as (select *, area_sqkm*1e6+polyid%1000+cen_lon/1e3 as size from fires)"),
    "select min(size) as low, arg_min(cen_lon,size) as low_lon, arg_min(cen_lat,size) as low_lat, max(size) as high, arg_max(cen_lon,size) as high_lon, arg_max(cen_lat,size) as high_lat from z")

# -- comparisons and logs ------------------------------------------------------------------------------------------------
SHIFT = "shifted as (select * replace (fireid+1 as fireid, case when polyid%31=0 then area_sqkm+0.5e0 else area_sqkm end as area_sqkm) from fires where polyid%50<>0)"
_side = "select round(cen_lon,5) cen_lon, round(cen_lat,5) cen_lat, acq_date_utc, round(area_sqkm,5) area_sqkm, v_lct, round(f_lct,3) f_lct, min(polyid) polyid, min(fireid) fireid, count(*) n from {t} group by 1,2,3,4,5,6"
put("diff_outputs", (FIRES, SHIFT), f""", l as ({_side.format(t='fires')}), r as ({_side.format(t='shifted')})
select cen_lon, cen_lat, acq_date_utc, area_sqkm, v_lct, f_lct, l.fireid as fireid_l, r.fireid as fireid_r, l.polyid as polyid_l, r.polyid as polyid_r, coalesce(l.n,0) as n_l, coalesce(r.n,0) as n_r
from l full join r using (cen_lon, cen_lat, acq_date_utc, area_sqkm, v_lct, f_lct) where coalesce(l.n,0)<>coalesce(r.n,0)""")
put("filter_matching", (DET,), "select rawid, longitude as lon, latitude as lat, frp from det where (longitude, latitude, scan, frp) in (select (longitude, latitude, scan, frp) from det where rawid%3=0)")


def _tot(t: str) -> str:
    a = f"(select *, area_sqkm*f_lct as p from {t})"
    return f"""select 'total' as kind, 'total' as class, sum(p) as area from {a} union all select 'cover','tree',sum(p*v_tree/100e0) from {a} union all select 'cover','herb',sum(p*v_herb/100e0) from {a}
 union all select 'cover','bare',sum(p*v_bare/100e0) from {a} union all select 'lct', cast(v_lct as varchar), sum(p) from {a} group by v_lct union all select 'fires','n',count(distinct fireid) from {a}"""


put("compare_totals", (FIRES, SHIFT), f", l as ({_tot('fires')}), r as ({_tot('shifted')}) select kind, class, round(l.area,3)+0e0 as first, round(r.area,3)+0e0 as second from l full join r using (kind, class)")
_byf = "select fireid, v_lct, round(sum(area_sqkm*1.00037e0*f_lct),2) as a from {t} group by fireid, v_lct"
put("compare_by_fire", (FIRES, SHIFT), f", l as ({_byf.format(t='fires')}), r as ({_byf.format(t='shifted')}) select fireid, v_lct, l.a as first, r.a as second from l full join r using (fireid, v_lct)")
PAR = "par as (select fireid, case when fireid%13=0 then sum(area_sqkm)*1.25e0 else sum(area_sqkm) end as parent, sum(area_sqkm) as subs from fires group by fireid)"
put("area_conservation", (FIRES, PAR), "select fireid, round(parent,5)+0e0 as parent, round(subs,5)+0e0 as subs, round((parent-subs)/parent,6)+0e0 as shortfall from par where (parent-subs)/parent>0.05e0")
put("worst_shortfall", (FIRES, PAR), "select fireid, round((parent-subs)/parent,6) as shortfall from par where (parent-subs)/parent>0.05e0 order by 2 desc, 1 limit 5")
put("childless_parents", (FIRES,), "select distinct fireid from fires where fireid not in (select fireid from fires where v_lct<15)")
put("subdivision_diagnostics", (*PREP, FIRES, PAR), """select 'orphan detections' as "check", count(*) filter (where rawid%10=0) as n from pnt
 union all select 'childless parents', (select count(distinct fireid) from fires where fireid not in (select fireid from fires where v_lct<15))
 union all select 'area lost', (select count(*) from par join (select fireid, sum(area_sqkm) s from fires where v_lct<15 group by fireid) using (fireid) where (parent-s)/parent>0.05e0)""")
put("run_log_summary", (
    *PREP,
    "lg as (select event_id as log_id, case user_id%6 when 0 then 'import' when 1 then 'agg to large' when 2 then 'subdiv' when 3 then 'join modlct' when 4 then 'join regnum' else 'merge all' end as event, user_id as n_before, event_id%1000 as n_after, value as elapsed_s from events)",
    "s as (select event, max(log_id) log_id, cast(sum(n_after-n_before) as bigint) n_change, min(n_before) n_before, max(n_after) n_after, sum(elapsed_s) elapsed_s from lg group by event)",
    "t as (select count(*) n_pnt, count(distinct acq_date_use) n_lrg, count(distinct rawid) n_div from pnt)",
), """select log_id, event, case when event like 'join %' or event='merge all' then n_after-n_div else n_change end as n_change,
 case when event='agg to large' then n_pnt when event='subdiv' then n_lrg when event like 'join %' or event='merge all' then n_div else n_before end as n_before,
 case when event='agg to large' then n_lrg when event='subdiv' then n_div else n_after end as n_after, round(elapsed_s,4)+0e0 as elapsed_s from s, t""")

# -- streaming ------------------------------------------------------------------------------------------------------------
put("stream_daily_tile_counts", (DET,), """select acq_date as day, printf('h%02dv%02d', cast(floor(longitude*cos(radians(latitude))/10e0+18e0) as int), cast(floor(9e0-latitude/10e0) as int)) as tile, count(*) as n, round(sum(frp),4)+0e0 as frp from det group by all""")

for _name, _sql in list(ORACLES.items()):
    # A select list that starts with further tables continues the WITH clause.
    ORACLES[_name] = _sql.replace("\n, ", ",\n", 1) if "\n, " in _sql else _sql


# -- the whole chain --------------------------------------------------------------------------------------------
def _merged(parts: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(x.replace("ahull", "mhull").replace("afull", "mfull") for x in parts)


_RESQ = f"({RES})"
CHAIN = (
    *A_BASE, *A_CELL, TREE, *CON,
    """mpt as materialized (select a.cleanid, a.lon, a.lat, a.frp, a.acq_date_use, case when v_tree>=50 then 1 else 2 end as alg, case when v_tree>=50 then a.fireid else c.fireid end as fireid
 from apoint a left join cover using (fireid) join cpoint c using (cleanid))""",
    "mfull as materialized (select * from afull where fireid in (select fireid from mpt where alg=1) union all select * from cfull where fireid in (select fireid from mpt where alg=2))",
    "mhull as materialized (select * from ahull where fireid in (select fireid from mpt where alg=1) union all select * from chull where fireid in (select fireid from mpt where alg=2))",
    *_merged(SCAN[:-1]), *HOLES, *_skim("mpt", _HALF_MINUTE),
    "sd as materialized (select fireid, lon, lat, min(seed) as seed from sk group by fireid, lon, lat)",
    *_merged(VORONOI),
    """lk as (select p.cleanid, p.frp, p.acq_date_use, p.alg, s.seed as polyid from mpt p join sd s using (fireid)
 qualify row_number() over (partition by p.cleanid order by (s.lon-p.lon)*(s.lon-p.lon)+(s.lat-p.lat)*(s.lat-p.lat), s.seed)=1)""",
    "ab as (select polyid, min(acq_date_use) as day, min(alg) as alg_agg, avg(frp) as v_frp from lk group by polyid)",
    *_cells("m")[:2],
    f"""fc as (select fireid, iy, unnest(range(cast(ceil(g0/{_RESQ}-0.5e0) as bigint), cast(floor(g1/{_RESQ}-0.5e0) as bigint)+1)) as ix
 from (select *, unnest(range(cast(ceil((y-h/2e0)/{_RESQ}-0.5e0) as bigint), cast(floor((y+h/2e0)/{_RESQ}-0.5e0) as bigint)+1)) as iy from gp join gl using (gap) join gh using (lab)))""",
    "mc as (select fireid, iy, ix from mcell union select fireid, iy, ix from fc)",
    f"px as (select distinct cast(floor(longitude/{_RESQ}) as bigint)+a.n as ix, cast(floor(latitude/{_RESQ}) as bigint)+b.n as iy from det, range(-4,5) a(n), range(-4,5) b(n))",
    f"""mz as (select mc.iy, mc.ix, s.seed as polyid from mc join px using (iy, ix) join sd s using (fireid)
 qualify row_number() over (partition by mc.fireid, mc.iy, mc.ix order by (s.lon-(mc.ix+0.5e0)*{_RESQ})*(s.lon-(mc.ix+0.5e0)*{_RESQ})+(s.lat-(mc.iy+0.5e0)*{_RESQ})*(s.lat-(mc.iy+0.5e0)*{_RESQ}), s.seed)=1)""",
    _cells("m")[2].replace("from mcell", "from mz"),
    "mh_ as (select polyid, lct as v_lct, count(*) as cv from mval group by polyid, lct)",
    "mt as (select polyid, v_lct, cv/sum(cv) over (partition by polyid) as f_lct from mh_)",
    "mv as (select polyid, " + ", ".join(f"avg(case when {b} between 0 and 100 then {b} end) as v_{b}" for b in ("tree", "herb", "bare")) + " from mval group by polyid)",
    "rk as (select distinct cast(floor((longitude+180)/30) as int) as k from det)",
    """proc as materialized (select vo.polyid, vo.fireid, cx as cen_lon, cy as cen_lat, ab.day as acq_date_utc, a as area_sqkm, ab.alg_agg, v_lct, f_lct, v_tree, v_herb, v_bare, cast(k+1 as int) as v_regnum, v_frp
 from vo left join ab using (polyid) left join mv using (polyid) left join rk on floor((cx+180)/30)=rk.k left join mt using (polyid))""",
)
put("processed_fires", CHAIN, "select polyid, fireid, acq_date_utc, alg_agg, v_lct, v_regnum, " + ", ".join(
    r(c, 6, c) for c in ("cen_lon", "cen_lat", "area_sqkm", "f_lct", "v_tree", "v_herb", "v_bare", "v_frp")) + " from proc")
put("detections_to_emissions", (*CHAIN, "fires as (select * from proc)", *EMIT[1:]),
    "select genveg, count(*) as n_fires, " + ", ".join(r(f"sum({e})", 0, n) for e, n in (("area_m2", "area_m2"), ("area_m2*bmass", "biomass_kg"), ("CO2", "CO2"), ("CO", "CO"), ("NMOC", "NMOC"))) + " from em group by rollup(genveg)")

put("stream_day_upserts", (
    "det as (select * from (" + SQL['detections_fx'] + ") qualify row_number() over (partition by latitude, longitude, acq_date, acq_time, satellite order by rawid)=1)", INST, CONF, LST, DUP, PNT),
    "select acq_date_use, instrument, count(*) as n, count(distinct (lon, lat)) as n_places from pnt group by all")

# -- helpers of reports and runs ----------------------------------------------------------------------------------
put("emissions_day_window", EMIT, "select genveg, count(*) as n, round(sum(CO),1)+0e0 as CO from em where dayofyear(acq_date_utc) between 30 and 200 group by genveg")
put("tile_coverage_total", (*PREP, TILE), """, c as (select tile, count(*) as n_fire, bool_or(instrument='MODIS') or not bool_or(rawid%3<>0) as ok from tiled group by tile)
select cast(sum(n_fire) as bigint) as n_fire, cast(sum(case when ok then n_fire else 0 end) as bigint) as n_contained, cast(sum(case when ok then 0 else n_fire end) as bigint) as n_not_contained from c""")
put("detections_by_satellite", (DET,), "select satellite, count(*) as n from det group by satellite")
put("union_outputs", (FIRES,), "select v_lct, 2*count(*) as n, count(v_frp) as n_frp from fires group by v_lct")
put("detection_boxes", (*PREP, EXT), f"select cleanid, {r('lon-agg_dx',9,'x0')}, {r('lat-agg_dy',9,'y0')}, {r('lon+agg_dx',9,'x1')}, {r('lat+agg_dy',9,'y1')} from ext")
put("v1_order_by_area", V1D, "select rid, spix, tpix from vd")
put("v1_order_by_day", V1D, "select jday, rid from vd")
put("local_hours", (DET,), "select cast(floor(cast(acq_time[1:2] as int)+(case when longitude<0 then longitude+360e0 else longitude end)/15e0) as int)%24 as hour, count(*) as n from det group by 1")
put("surface_conflicts", (DET, SURF[1], SURF[2],
    f"sc as (select cast(round(x) as int) as i, cast(round(y) as int) as j, count(*) as n_pixels, count(*) filter (where k<4)+count(*) filter (where k=1) as n_flagged from sx where x>=0.5e0 and x<{_mnx}.5e0 and y>=0.5e0 and y<{_mny}.5e0 group by 1,2)"),
    "select i, j, n_flagged, n_pixels from sc where n_flagged>n_pixels")
put("run_to_grid", (*CHAIN, "fires as (select * from proc)", *EMIT[1:], *_grid("em", 360, 180, False, _TERMS)), "select species, date, i, j, round(value/1e9,2)+0e0 as value from gs")
