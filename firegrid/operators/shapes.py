"""Burned areas as predicates, not polygons.

A fire is a set of *hulls*; a hull is the convex hull of two lon/lat boxes
(ax, ay, adx, ady) and (bx, by, bdx, bdy), the same box twice for a lone site.  The hull is swept by
the box whose centre and half widths move linearly from a to b, so both "is the point inside" and
"which x-interval does it cover at latitude y" have closed forms in the sweep parameter t.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from firegrid.functions.geo import box_area_km2, zone_area_km2
from firegrid.operators.components import connected_components
from firegrid.operators.joins import hot_lookup
from firegrid.session import cut

STRIP_DEG = 1.0 / 4800.0
SMALL_HOLE_DEG2 = (1.0 / 240.0) ** 2
# Strips that are worked on together: hulls are sent to the bands they touch and cut into strips there.
BAND_STRIPS = 64
BAND_HULLS = 20_000
MIN_PARTS = 32


def _limits(p: Column, a: str, b: str, da: str, db: str) -> tuple[list[Column], list[Column], list[Column]]:
    """Lower bounds, upper bounds on t, and side conditions, for the sweep to cover ``p`` on one axis."""
    lows, highs, free = [], [], []
    for sign in (1.0, -1.0):
        slope = sign * (F.col(b) - F.col(a)) + (F.col(db) - F.col(da))
        need = sign * (p - F.col(a)) - F.col(da)
        lows.append(F.when(slope > 0, F.try_divide(need, slope)).otherwise(0.0))
        highs.append(F.when(slope < 0, F.try_divide(need, slope)).otherwise(1.0))
        free.append((slope != 0) | (need <= 0))
    return lows, highs, free


def _sweep(limits: list[tuple[list[Column], list[Column], list[Column]]]) -> tuple[Column, Column, Column]:
    lows = [c for one in limits for c in one[0]]
    highs = [c for one in limits for c in one[1]]
    free = reduce(lambda p, q: p & q, [c for one in limits for c in one[2]])
    return F.greatest(F.lit(0.0), *lows), F.least(F.lit(1.0), *highs), free


def in_hull(x: Column, y: Column) -> Column:
    """Is the point inside the hull of this row (borders included)?"""
    lo, hi, free = _sweep([_limits(x, "ax", "bx", "adx", "bdx"), _limits(y, "ay", "by", "ady", "bdy")])
    return free & (lo <= hi)


def hull_bounds() -> list[Column]:
    return [
        F.least(F.col("ax") - F.col("adx"), F.col("bx") - F.col("bdx")).alias("hx0"),
        F.greatest(F.col("ax") + F.col("adx"), F.col("bx") + F.col("bdx")).alias("hx1"),
        F.least(F.col("ay") - F.col("ady"), F.col("by") - F.col("bdy")).alias("hy0"),
        F.greatest(F.col("ay") + F.col("ady"), F.col("by") + F.col("bdy")).alias("hy1"),
    ]


def bounds(hulls: DataFrame) -> DataFrame:
    """(fireid, x0, x1, y0, y1, n_hulls)."""
    return hulls.select("fireid", *hull_bounds()).groupBy("fireid").agg(
        F.min("hx0").alias("x0"), F.max("hx1").alias("x1"), F.min("hy0").alias("y0"), F.max("hy1").alias("y1"),
        F.count("*").alias("n_hulls"),
    )


def band_of(strip: str) -> Column:
    return F.floor(F.col(strip) / BAND_STRIPS).cast("int")


def strips(hulls: DataFrame, strip_deg: float = STRIP_DEG, min_strips: int = 8) -> DataFrame:
    """x-intervals of every hull on the mid-line of each horizontal strip of its fire.

    The latitude range of a fire is cut into equal strips no higher than ``strip_deg``.
    Columns: fireid, band, strip, y, h, x0, x1; rows lie in the partition of their (fireid, band).
    """
    extent = cut(bounds(hulls))
    n = F.greatest(F.ceil((F.col("y1") - F.col("y0")) / strip_deg), F.lit(min_strips))
    extent = extent.select("fireid", F.col("y0").alias("fy0"), ((F.col("y1") - F.col("y0")) / n).alias("h"),
                           n.cast("int").alias("n_strips"), "n_hulls")
    spread = hulls.withColumn("_row", F.xxhash64("ax", "ay", "bx", "by"))
    rows = hot_lookup(spread, extent, ["fireid"], "n_hulls", "_row").select("*", *hull_bounds())
    first = F.greatest(F.floor((F.col("hy0") - F.col("fy0")) / F.col("h")), F.lit(0))
    last = F.least(F.floor((F.col("hy1") - F.col("fy0")) / F.col("h")), F.col("n_strips") - 1)
    rows = rows.withColumn("_s0", first.cast("int")).withColumn("_s1", last.cast("int"))
    rows = rows.withColumn("band", F.explode(F.sequence(band_of("_s0"), band_of("_s1"))))
    # By their number, not their bytes: a hull becomes many rows behind the exchange.
    n_parts = max(MIN_PARTS, -(-hulls.count() // BAND_HULLS))
    rows = rows.select("fireid", "band", "_s0", "_s1", "fy0", "h", *[f"{s}{c}" for s in "ab" for c in ("x", "y", "dx", "dy")])
    rows = rows.repartition(n_parts, "fireid", "band")
    within = F.sequence(F.greatest("_s0", F.col("band") * BAND_STRIPS), F.least("_s1", F.col("band") * BAND_STRIPS + (BAND_STRIPS - 1)))
    rows = rows.withColumn("strip", F.explode(within))
    rows = rows.withColumn("y", F.col("fy0") + (F.col("strip") + 0.5) * F.col("h"))
    lo, hi, free = _sweep([_limits(F.col("y"), "ay", "by", "ady", "bdy")])
    rows = rows.withColumn("t0", lo).withColumn("t1", hi).where(free & (F.col("t0") <= F.col("t1")))

    def edge(sign: float, t: str) -> Column:
        centre = F.col("ax") + F.col(t) * (F.col("bx") - F.col("ax"))
        return centre + sign * (F.col("adx") + F.col(t) * (F.col("bdx") - F.col("adx")))

    return rows.select(
        "fireid", "band", "strip", "y", "h",
        F.least(edge(-1.0, "t0"), edge(-1.0, "t1")).alias("x0"),
        F.greatest(edge(1.0, "t0"), edge(1.0, "t1")).alias("x1"),
    )


def merge_intervals(rows: DataFrame) -> DataFrame:
    """Union of the intervals on each strip.  A window is at most a band wide, so a large fire is spread out."""
    rows = rows if "band" in rows.columns else rows.withColumn("band", band_of("strip"))
    line = Window.partitionBy("fireid", "band", "strip").orderBy("x0", "x1")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce((F.col("x0") > F.max("x1").over(before)).cast("int"), F.lit(1))
    marked = rows.withColumn("_start", starts)
    marked = marked.withColumn("_run", F.sum("_start").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("fireid", "band", "strip", "_run").agg(
        F.first("y").alias("y"), F.first("h").alias("h"), F.min("x0").alias("x0"), F.max("x1").alias("x1")
    ).drop("band", "_run")


def gaps(intervals: DataFrame) -> DataFrame:
    """The bounded gaps between merged intervals: fireid, strip, y, h, x0, x1 and a row id."""
    line = Window.partitionBy("fireid", "strip").orderBy("x0")
    return (
        intervals.withColumn("_next", F.lead("x0").over(line)).where(F.col("_next").isNotNull())
        .select("fireid", "strip", "y", "h", F.col("x1").alias("x0"), F.col("_next").alias("x1"))
        .withColumn("gap", F.struct("fireid", "strip", "x0"))
    )


def small_holes(intervals: DataFrame, threshold: float = SMALL_HOLE_DEG2, bin_deg: float = 0.05) -> DataFrame:
    """Gap segments that belong to holes to be filled.

    Gaps that overlap on neighbouring strips are one opening.  An opening that meets the outside on
    some neighbouring strip is no hole; a hole stays open only if both its area and its envelope
    exceed the threshold.
    """
    g = cut(gaps(intervals))
    cols = ["fireid", "strip", "y", "h", "x0", "x1"]
    if g.isEmpty():
        return g.select(*cols)
    line = intervals.groupBy("fireid", "strip").agg(F.min("x0").alias("lx0"), F.max("x1").alias("lx1"))
    line = line.join(g.select("fireid").distinct(), "fireid", "left_semi")
    beside = g.select("gap", "fireid", "x0", "x1", F.explode(F.array(F.col("strip") - 1, F.col("strip") + 1)).alias("strip"))
    outside = (
        beside.join(line, ["fireid", "strip"], "left")
        .where(F.col("lx0").isNull() | (F.col("x0") < F.col("lx0")) | (F.col("x1") > F.col("lx1")))
        .select("gap").distinct().withColumn("_out", F.lit(1))
    )
    bins = F.explode(F.sequence(F.floor(F.col("x0") / bin_deg), F.floor(F.col("x1") / bin_deg)))
    a = g.select("fireid", "strip", bins.alias("_b"), F.col("gap").alias("src"), F.col("x0").alias("ax0"), F.col("x1").alias("ax1"))
    b = g.select("fireid", (F.col("strip") - 1).alias("strip"), bins.alias("_b"), F.col("gap").alias("dst"),
                 F.col("x0").alias("bx0"), F.col("x1").alias("bx1"))
    touching = a.join(b, ["fireid", "strip", "_b"]).where((F.col("ax0") < F.col("bx1")) & (F.col("bx0") < F.col("ax1")))
    labels = connected_components(touching.select("src", "dst"), g, "src", "dst", "gap")
    marked = cut(
        g.join(labels.select(F.col("node").alias("gap"), "component"), "gap").join(outside, "gap", "left")
    )
    width = F.col("x1") - F.col("x0")
    holes = (
        marked.groupBy("component").agg(
            F.max("_out").alias("_open"), F.sum(width * F.col("h")).alias("area"),
            ((F.max("x1") - F.min("x0")) * (F.max("strip") - F.min("strip") + 1) * F.max("h")).alias("envelope"),
        )
        .where(F.col("_open").isNull() & ((F.col("area") <= threshold) | (F.col("envelope") <= threshold)))
        .select("component")
    )
    return marked.join(holes, "component", "left_semi").select(*cols)


class Shape:
    """Merged, hole-filled intervals of multi-site fires plus the filled gap segments.

    ``cells`` extends the pixel test to the filled holes.
    """

    def __init__(self, hulls: DataFrame, strip_deg: float = STRIP_DEG, fill: bool = True):
        self.hulls = hulls
        raw = cut(merge_intervals(strips(hulls, strip_deg)))
        if fill:
            self.filled = cut(small_holes(raw))
            self.intervals = raw if self.filled.isEmpty() else cut(merge_intervals(raw.unionByName(self.filled)))
        else:
            self.filled = raw.limit(0)
            self.intervals = raw


def lone_hulls(hulls: DataFrame) -> DataFrame:
    return hulls.where("lone")


def multi_hulls(hulls: DataFrame) -> DataFrame:
    return hulls.where("not lone")


def area_centroid(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Ellipsoidal area (km2) and planar centroid per key from x-intervals on strips."""
    width = F.col("x1") - F.col("x0")
    half = F.col("h") / 2.0
    return (
        intervals.groupBy(*keys).agg(
            F.sum(zone_area_km2(width, F.col("y") - half, F.col("y") + half)).alias("area_sqkm"),
            F.sum(width * F.col("h")).alias("_w"),
            F.sum(width * F.col("h") * (F.col("x0") + F.col("x1")) / 2.0).alias("_wx"),
            F.sum(width * F.col("h") * F.col("y")).alias("_wy"),
        )
        .select(*keys, "area_sqkm", F.try_divide("_wx", "_w").alias("cen_lon"), F.try_divide("_wy", "_w").alias("cen_lat"))
    )


def fire_areas(hulls: DataFrame, shape: Shape | None = None) -> DataFrame:
    """(fireid, area_sqkm, cen_lon, cen_lat): exact for lone sites, strips for the rest."""
    lone = lone_hulls(hulls).select(
        "fireid", box_area_km2(F.col("ay"), F.col("adx"), F.col("ady")).alias("area_sqkm"),
        F.col("ax").alias("cen_lon"), F.col("ay").alias("cen_lat"),
    )
    shape = shape or Shape(multi_hulls(hulls))
    return lone.unionByName(area_centroid(shape.intervals, ["fireid"]))


def pixel_ranges(hulls: DataFrame, res: float, filled: DataFrame | None = None) -> DataFrame:
    """The pixels of ``pixel_cells`` as runs: disjoint (fireid, iy, i0, i1), i0 to i1 included.

    A hull covers one x-interval on the mid-line of a raster row, so it lists rows, not pixels.
    """
    y = (F.col("iy") + 0.5) * res
    lo, hi, free = _sweep([_limits(y, "ay", "by", "ady", "bdy")])
    first, last = F.ceil(F.col("hy0") / res - 0.5), F.floor(F.col("hy1") / res - 0.5)

    def edge(sign: float, t: str) -> Column:
        centre = F.col("ax") + F.col(t) * (F.col("bx") - F.col("ax"))
        return centre + sign * (F.col("adx") + F.col(t) * (F.col("bdx") - F.col("adx")))

    def run(x0: Column, x1: Column) -> list[Column]:
        return [F.ceil(x0 / res - 0.5).alias("i0"), F.floor(x1 / res - 0.5).alias("i1")]

    rows = (
        hulls.select("*", *hull_bounds()).where(first <= last).withColumn("iy", F.explode(F.sequence(first, last)))
        .withColumn("t0", lo).withColumn("t1", hi).where(free & (F.col("t0") <= F.col("t1")))
        .select("fireid", "iy", *run(F.least(edge(-1.0, "t0"), edge(-1.0, "t1")), F.greatest(edge(1.0, "t0"), edge(1.0, "t1"))))
    )
    if filled is not None:
        half = F.col("h") / 2.0
        low, high = F.ceil((F.col("y") - half) / res - 0.5), F.floor((F.col("y") + half) / res - 0.5)
        rows = rows.unionByName(
            filled.where(low <= high).withColumn("iy", F.explode(F.sequence(low, high))).select("fireid", "iy", *run(F.col("x0"), F.col("x1"))))
    return merge_runs(rows.where("i0 <= i1"), ["fireid"])


def merge_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs (keys, iy, i0, i1) that overlap or follow each other, as one."""
    line = Window.partitionBy(*keys, "iy").orderBy("i0", "i1")
    before = F.max("i1").over(line.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("_start", F.coalesce((F.col("i0") > before + 1).cast("int"), F.lit(1)))
    marked = marked.withColumn("_run", F.sum("_start").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "iy", "_run").agg(F.min("i0").alias("i0"), F.max("i1").alias("i1")).drop("_run")


def pixel_cells(hulls: DataFrame, res: float, filled: DataFrame | None = None) -> DataFrame:
    """Pixels (iy, ix) whose centre lies in the fire: distinct (fireid, iy, ix).

    Pixel (iy, ix) covers [ix*res, (ix+1)*res) x [iy*res, (iy+1)*res).  Hulls enumerate their own
    pixels, so the join with a pixel table is an equi-join on (iy, ix).
    """
    def ids(lo: str, hi: str) -> Column:
        first = F.ceil(F.col(lo) / res - 0.5)
        last = F.floor(F.col(hi) / res - 0.5)
        return F.when(first <= last, F.sequence(first, last))

    rows = (
        hulls.select("*", *hull_bounds())
        .withColumn("iy", F.explode(ids("hy0", "hy1"))).withColumn("ix", F.explode(ids("hx0", "hx1")))
        .where(in_hull((F.col("ix") + 0.5) * res, (F.col("iy") + 0.5) * res))
        .select("fireid", "iy", "ix")
    )
    if filled is not None:
        extra = (
            filled.withColumn("hy0", F.col("y") - F.col("h") / 2.0).withColumn("hy1", F.col("y") + F.col("h") / 2.0)
            .withColumn("iy", F.explode(ids("hy0", "hy1"))).withColumn("ix", F.explode(ids("x0", "x1")))
            .select("fireid", "iy", "ix")
        )
        rows = rows.unionByName(extra)
    return rows.distinct()
