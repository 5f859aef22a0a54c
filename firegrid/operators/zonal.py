"""Zonal statistics: pixels, regions and input fields summarised per burned area or sub-polygon."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from firegrid.session import cut


def rank_classes(counts: DataFrame, key: str = "polyid") -> DataFrame:
    """1-based rank of each class by count; ties go to the smaller class."""
    return counts.withColumn(
        "r_lct", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("cv_lct"), F.asc("v_lct")))
    )


def share_of_total(counts: DataFrame, key: str = "polyid") -> DataFrame:
    total = F.sum("cv_lct").over(Window.partitionBy(key))
    return counts.withColumn("ct_lct", total).withColumn("f_lct", F.col("cv_lct") / total)


def pixel_tile(iy: Column, ix: Column, res: float) -> Column:
    """Number of the one-degree tile that holds a pixel: below 64 800, whatever the resolution."""
    return ((F.floor((iy + 0.5) * res) + 90) * 360 + F.floor((ix + 0.5) * res) + 180).cast("int")


def pixels_of(cells: DataFrame, pixels: DataFrame, res: float) -> DataFrame:
    """The pixels in the tiles that ``cells`` (iy, ix) touch, of a table partitioned by ``tile`` (``write_pixels``).

    At most 64 800 tile numbers are broadcast, and only those folders are read.  Any other table is
    returned as it is: there is nothing to prune.
    """
    if "tile" not in pixels.columns:
        return pixels
    # The range is a real filter on the tile side, without which the planner prunes no partitions.
    numbers = cells.select(pixel_tile(F.col("iy"), F.col("ix"), res).alias("_t")).where(F.col("_t").between(0, 64_799))
    return pixels.join(F.broadcast(numbers.distinct()), F.col("tile") == F.col("_t"), "left_semi").drop("tile")


@dataclass(frozen=True)
class Raster:
    """A pixel table to be summed up by runs: classes (``lct``), or bands with their valid range."""

    table: DataFrame
    bands: tuple[str, ...] = ()
    valid_range: tuple[float, float] | None = (0, 100)
    nodata: int | None = None

    def valid(self, c: str) -> Column:
        ok = F.col(c).isNotNull()
        if self.nodata is not None:
            ok = ok & (F.col(c) != self.nodata)
        if self.bands and self.valid_range is not None:
            ok = ok & F.col(c).between(*self.valid_range)
        return ok


def segment(ix: Column, res: float) -> Column:
    """The one-degree part of a raster row that holds a pixel."""
    return F.floor((ix + 0.5) * res).cast("int")


def row_sums(rasters: list[Raster], res: float, runs: DataFrame | None = None) -> DataFrame:
    """(iy, seg, r0, r1, ...): per raster row and degree, what ``sums_of_runs`` looks up, all rasters side by side.

    For bands, the pixels in order with the running number and sum of valid values; for classes, the
    pixels of each class in order, whose places are the running counts.  A row is bounded by the pixels of
    a degree.  The table depends on the rasters alone; with ``runs`` only their tiles of tables with a
    ``tile`` are read.
    """
    out = None
    for k, raster in enumerate(rasters):
        ends = [runs.select("iy", F.explode(F.array("i0", "i1")).alias("ix"))] if runs is not None and "tile" in raster.table.columns else []
        px = (pixels_of(ends[0], raster.table, res) if ends else raster.table).withColumn("seg", segment(F.col("ix"), res))
        if raster.bands:
            line = Window.partitionBy("iy", "seg").orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
            ok = [raster.valid(b) for b in raster.bands]
            n = [F.sum(v.cast("long")).over(line) for v in ok]
            total = [F.sum(F.when(v, F.col(b).cast("double")).otherwise(0.0)).over(line) for v, b in zip(ok, raster.bands)]
            px = px.select("iy", "seg", F.struct(F.col("ix").cast("long").alias("ix"), F.array(*n).alias("n"), F.array(*total).alias("s")).alias("p"))
            rows = px.groupBy("iy", "seg").agg(F.sort_array(F.collect_list("p")).alias(f"r{k}"))
        else:
            of = px.where(raster.valid("lct")).groupBy("iy", "seg", F.col("lct").cast("int").alias("lct")).agg(
                F.sort_array(F.collect_list(F.col("ix").cast("long"))).alias("at"))
            rows = of.groupBy("iy", "seg").agg(F.collect_list(F.struct("lct", "at")).alias(f"r{k}"))
        out = rows if out is None else out.join(rows, ["iy", "seg"], "full")
    return out


def sums_of_runs(runs: DataFrame, rows: DataFrame, rasters: list[Raster], key: str, res: float) -> list[DataFrame]:
    """Per raster: (key, v_band, ...) means, or the rows of ``class_histogram``.

    ``runs``: disjoint (key, iy, i0, i1).  All rasters are met in one join on (row, degree), one row per
    run and degree; what a run sums up to is the difference of two running values.
    """
    pieces = runs.withColumn("seg", F.explode(F.sequence(segment(F.col("i0"), res), segment(F.col("i1"), res))))

    def upto(k: int, limit: Column) -> Column:
        return F.try_element_at(F.filter(F.col(f"r{k}"), lambda p: p["ix"] <= limit), F.lit(-1))

    picked = []
    for k, raster in enumerate(rasters):
        if raster.bands:
            picked.append(F.struct(upto(k, F.col("i1")).alias("hi"), upto(k, F.col("i0") - 1).alias("lo")).alias(f"r{k}"))
        else:
            inside = lambda at: F.size(F.filter(at, lambda i: i.between(F.col("i0"), F.col("i1")))).cast("long")
            picked.append(F.filter(F.transform(F.col(f"r{k}"), lambda c: F.struct(c["lct"].alias("v_lct"), inside(c["at"]).alias("n"))), lambda c: c["n"] > 0).alias(f"r{k}"))
    met = cut(pieces.join(rows, ["iy", "seg"]).select(key, *picked))
    out = []
    for k, raster in enumerate(rasters):
        if raster.bands:
            def part(c: str, i: int) -> Column:
                return F.sum(F.coalesce(F.col(f"r{k}.hi.{c}")[i], F.lit(0)) - F.coalesce(F.col(f"r{k}.lo.{c}")[i], F.lit(0)))

            # A run that meets no pixel of the raster is no row of it.
            some = met.where(F.col(f"r{k}.hi").isNotNull() & ~F.col(f"r{k}.hi.ix").eqNullSafe(F.col(f"r{k}.lo.ix")))
            out.append(some.groupBy(key).agg(*[F.try_divide(part("s", i), part("n", i)).alias(f"v_{b}") for i, b in enumerate(raster.bands)]))
        else:
            counts = met.select(key, F.inline(f"r{k}")).groupBy(key, "v_lct").agg(F.sum("n").alias("cv_lct"))
            out.append(rank_classes(share_of_total(counts, key), key))
    return out


def class_histogram(
    cells: DataFrame, pixels: DataFrame, key: str = "polyid", nodata: int | None = None, res: float | None = None,
) -> DataFrame:
    """One row per (key, class): v_lct, f_lct, cv_lct (pixels), ct_lct (all valid pixels), r_lct.

    ``cells``: (key, iy, ix); ``pixels``: (iy, ix, lct); with their size ``res`` in degrees only the
    tiles of the cells are read.  Counting happens before the window, which
    then sees at most one row per class.
    """
    pixels = pixels if res is None else pixels_of(cells, pixels, res)
    valid = pixels.where(F.col("lct").isNotNull())
    if nodata is not None:
        valid = valid.where(F.col("lct") != nodata)
    counts = (
        cells.join(valid, ["iy", "ix"]).groupBy(key, F.col("lct").cast("int").alias("v_lct"))
        .agg(F.count("*").alias("cv_lct"))
    )
    return rank_classes(share_of_total(counts, key), key)


def band_means(
    cells: DataFrame, pixels: DataFrame, bands: list[str], key: str = "polyid",
    valid_range: tuple[float, float] | None = (0, 100), nodata: int | None = None, res: float | None = None,
) -> DataFrame:
    """Mean per band over valid pixels, null where there is none; ``res`` as in ``class_histogram``."""
    pixels = pixels if res is None else pixels_of(cells, pixels, res)
    def valid(c: str) -> Column:
        ok = F.col(c).isNotNull()
        if nodata is not None:
            ok = ok & (F.col(c) != nodata)
        if valid_range is not None:
            ok = ok & F.col(c).between(*valid_range)
        return F.when(ok, F.col(c))

    return cells.join(pixels, ["iy", "ix"]).groupBy(key).agg(*[F.avg(valid(b)).alias(f"v_{b}") for b in bands])


def tree_cover(cells: DataFrame, pixels: DataFrame, key: str = "fireid") -> DataFrame:
    """(key, v_tree): the mean that decides between the two clusterings."""
    return band_means(cells, pixels, ["tree"], key)


def input_mean(points: DataFrame, column: str = "frp", key: str = "polyid") -> DataFrame:
    """Mean of a detection field per sub-polygon; nulls skipped, unassigned points ignored."""
    return points.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(column).alias(f"v_{column}"))


# Root cells of the region tree; the origin is off any round coordinate, so that no border of a region runs along cells.
ROOT_DEG, ROOT_X, ROOT_Y = 32.0, -180.7320508, -90.4142136
ROOT_NX, ROOT_NY = 18, 6
LEAF_EDGES, DEEPEST = 48, 12
CELL = ["level", "cx", "cy"]


def _crosses(e, x: Column, y: Column, to_x: Column, to_y: Column) -> Column:
    """Crossings of an edge by the way from (x, y) east to (to_x, y), then north to (to_x, to_y): 0, 1 or 2."""
    at_x = (e["x1"] - e["x0"]) * F.try_divide(y - e["y0"], e["y1"] - e["y0"]) + e["x0"]
    at_y = (e["y1"] - e["y0"]) * F.try_divide(to_x - e["x0"], e["x1"] - e["x0"]) + e["y0"]
    east = ((e["y0"] > y) != (e["y1"] > y)) & (at_x > x) & (at_x <= to_x)
    north = ((e["x0"] > to_x) != (e["x1"] > to_x)) & (at_y > y) & (at_y <= to_y)
    return F.coalesce(east, F.lit(False)).cast("int") + F.coalesce(north, F.lit(False)).cast("int")


def _edge(row: str | None = None) -> dict[str, Column]:
    return {c: F.col(c if row is None else f"{row}.{c}") for c in ("x0", "y0", "x1", "y1")}


def _touches(e: dict[str, Column], west: Column, south: Column, size: Column) -> Column:
    """Does the segment meet the closed cell?  It does unless an axis or the segment's line has them apart."""
    east, north = west + size, south + size
    boxes = (F.least(e["x0"], e["x1"]) <= east) & (F.greatest(e["x0"], e["x1"]) >= west) & (F.least(e["y0"], e["y1"]) <= north) & (F.greatest(e["y0"], e["y1"]) >= south)
    side = [(e["x1"] - e["x0"]) * (y - e["y0"]) - (e["y1"] - e["y0"]) * (x - e["x0"]) for x in (west, east) for y in (south, north)]
    return boxes & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)


def _west_south(level: Column | str = "level") -> tuple[Column, Column, Column]:
    size = ROOT_DEG / F.pow(F.lit(2.0), F.col(level) if isinstance(level, str) else level)
    return ROOT_X + F.col("cx") * size, ROOT_Y + F.col("cy") * size, size


def region_tree(regions: DataFrame, leaf_edges: int = LEAF_EDGES, deepest: int = DEEPEST) -> DataFrame:
    """The leaves of a quadtree over the globe: (level, cx, cy, inside array<int>, edges array<struct>).

    ``regions``: (region_num, ring array<struct<x,y>>).  A cell that more than ``leaf_edges`` edges meet is split in
    four, down to level ``deepest``.  ``inside`` are the regions that hold the cell's south-west corner; a
    child's follow from its parent's and the edges crossed on the way, which all meet the parent.  So a cell
    without edges answers for all its places, and any other needs its own edges only.  The table depends on
    the region layer; crowded borders make small cells, not long rows.
    """
    nxt = F.concat(F.slice("ring", F.lit(2), F.size("ring")), F.slice("ring", F.lit(1), F.lit(1)))
    edges = cut(regions.select(F.col("region_num").cast("int").alias("region_num"), F.inline(F.zip_with("ring", nxt, lambda p, q: F.struct(
        p["x"].cast("double").alias("x0"), p["y"].cast("double").alias("y0"), q["x"].cast("double").alias("x1"), q["y"].cast("double").alias("y1"))))))
    west, south, size = _west_south()
    spark = regions.sparkSession
    cells = spark.range(ROOT_NX * ROOT_NY).select(F.lit(0).alias("level"), (F.col("id") % ROOT_NX).cast("int").alias("cx"), F.floor(F.col("id") / ROOT_NX).cast("int").alias("cy"))
    # The roots, 108 of them: which edges each meets, and which regions hold its corner.
    met = edges.join(F.broadcast(cells), _touches(_edge(), west, south, size))
    e = _edge()
    west_of = ((e["y0"] > south) != (e["y1"] > south)) & ((e["x1"] - e["x0"]) * F.try_divide(south - e["y0"], e["y1"] - e["y0"]) + e["x0"] <= west)
    holds = edges.join(F.broadcast(cells), west_of).groupBy(*CELL, "region_num").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").drop("n")
    done, level = None, 0
    while True:
        met, holds = cut(met), cut(holds)
        crowded = met.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf_edges).select(*CELL) if level < deepest else cells.limit(0)
        crowded = cut(crowded)
        kept = cells.join(crowded, CELL, "left_anti")
        own = met.groupBy(*CELL).agg(F.collect_list(F.struct("region_num", "x0", "y0", "x1", "y1")).alias("edges"))
        inside = holds.groupBy(*CELL).agg(F.collect_list("region_num").alias("inside"))
        leaves = kept.join(own, CELL, "left").join(inside, CELL, "left")
        done = leaves if done is None else done.unionByName(leaves)
        if crowded.isEmpty():
            return cut(done.select(*CELL, F.coalesce("inside", F.array().cast("array<int>")).alias("inside"), F.coalesce(
                "edges", F.array().cast("array<struct<region_num:int,x0:double,y0:double,x1:double,y1:double>>")).alias("edges")))
        level += 1
        quarters = F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (0, 1) for j in (0, 1)]))
        child = [F.lit(level).alias("level"), (2 * F.col("cx") + F.col("q.dx")).alias("cx"), (2 * F.col("cy") + F.col("q.dy")).alias("cy")]
        parents = met.join(crowded, CELL, "left_semi").withColumn("q", quarters)
        half = size / 2.0
        turns = _crosses(_edge(), west, south, west + F.col("q.dx") * half, south + F.col("q.dy") * half)
        crossed = parents.select(*child, "region_num", turns.alias("n")).where("n > 0")
        kept_in = holds.join(crowded, CELL, "left_semi").withColumn("q", quarters).select(*child, "region_num", F.lit(1).alias("n"))
        holds = crossed.unionByName(kept_in).groupBy(*CELL, "region_num").agg(F.sum("n").alias("n")).where("n % 2 = 1").drop("n")
        cells = cut(crowded.withColumn("q", quarters).select(*child))
        met = parents.select(*child, "region_num", *_edge().values()).where(_touches(_edge(), west, south, size))


def region_of(points: DataFrame, regions: DataFrame, key: str = "polyid", lon: str = "cen_lon", lat: str = "cen_lat",
              leaf_edges: int = LEAF_EDGES) -> DataFrame:
    """(key, v_regnum): region holding each point by ray casting, smallest number first, null if none.

    A point meets the one leaf of ``region_tree`` that holds it, by equality of cell numbers on the levels that
    have leaves; only in cells with edges is a short way cast, from the cell's corner.  The tree is stored
    first: the planner knows its size and broadcasts it only if it is small.
    """
    tree = region_tree(regions, leaf_edges)
    levels = [r.level for r in tree.select("level").distinct().collect()]  # at most DEEPEST + 1 numbers
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    far = ~(x.between(-180.5, 360.5) & y.between(-90, 90))
    named = points.select(key, x.alias("_x"), y.alias("_y"))
    on_globe = F.col("_x").between(-180.5, 360.5) & F.col("_y").between(-90, 90)
    where_ = named.where(on_globe).withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels])))
    size = ROOT_DEG / F.pow(F.lit(2.0), F.col("level"))
    where_ = where_.withColumn("cx", F.floor((F.col("_x") - ROOT_X) / size).cast("int")).withColumn("cy", F.floor((F.col("_y") - ROOT_Y) / size).cast("int"))
    west, south, _ = _west_south()
    times = F.transform("edges", lambda e: F.struct(e["region_num"].alias("r"), _crosses(e, west, south, F.col("_x"), F.col("_y")).alias("n")))
    passed = F.concat(F.transform("inside", lambda r: F.struct(r.alias("r"), F.lit(1).alias("n"))), F.filter(times, lambda t: t["n"] > 0))
    odd = F.filter(F.array_distinct(F.transform(F.col("_p"), lambda t: t["r"])), lambda r: F.aggregate(
        F.col("_p"), F.lit(0), lambda acc, t: acc + F.when(t["r"] == r, t["n"]).otherwise(0)) % 2 == 1)
    found = where_.join(tree, CELL).select(key, "_x", "_y", passed.alias("_p")).select(key, F.array_min(odd).alias("v_regnum"))
    beyond = points.where(far | x.isNull() | y.isNull()).select(key, F.lit(None).cast("int").alias("v_regnum"))
    return found.unionByName(beyond)


def assemble(div: DataFrame, parts: list[DataFrame], thematic: DataFrame | None = None, key: str = "polyid") -> DataFrame:
    """Left-join the per-polygon parts, then expand by the thematic rows (one output row per class).

    All joins share one key, so the polygons are shuffled once.
    """
    out = div
    for part in parts:
        out = out.join(part, key, "left")
    return out if thematic is None else out.join(thematic, key, "left")
