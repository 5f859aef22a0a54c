"""From detections to processed fires, emissions and grids in stages.

Each stage's table is stored under the run folder and can be read back instead of being computed
again.  All days of a run are processed together; the day is a column, not a loop.
"""

from __future__ import annotations

import datetime as dt
from contextlib import nullcontext
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from firegrid.operators import cluster as C, emissions as E, grid as G, outline as O, prep as P, shapes, skim as K, subdivide as V, zonal as Z
from firegrid.operators.report import RunLog
from firegrid.session import cut, cut_counted, scratch_scope
from firegrid.sources import sinks


@dataclass(frozen=True)
class Layer:
    """One thing to sample per sub-polygon.

    thematic: class table (iy, ix, lct), at most one per recipe, one output row per class.
    continuous: table (iy, ix, bands...), mean per band.  polygons: regions (region_num, ring).
    input: a detection column, mean per sub-polygon.
    """

    kind: str
    table: DataFrame | None = None
    columns: tuple[str, ...] = ()
    valid_range: tuple[float, float] | None = None
    nodata: int | None = None

    def raster(self) -> Z.Raster:
        return Z.Raster(self.table, self.columns if self.kind == "continuous" else (), self.valid_range, self.nodata)

    def __post_init__(self):
        if self.kind not in ("thematic", "continuous", "polygons", "input"):
            raise ValueError(f"unknown layer kind {self.kind!r}")


@dataclass
class Config:
    layers: list[Layer]
    res: float
    date_definition: str = "UTC"
    first: dt.date | None = None
    last: dt.date | None = None
    filter_persistent: bool = True
    tree_threshold: float = 50.0
    # "chosen": aggressive areas where tree cover is high, else conservative ones; "conservative": always those.
    subdivide: str = "chosen"
    # Adds ``compactness`` and the outline as WKT (``geom``) to every sub-polygon.
    outlines: bool = False
    path: str | None = None
    run: dict[str, bool] = field(default_factory=lambda: {"import": True, "step1": True, "step2": True})


def tree_layer(layers: list[Layer]) -> Layer:
    for layer in layers:
        if layer.kind == "continuous" and "tree" in layer.columns:
            return layer
    raise ValueError("the recipe needs a continuous layer with a 'tree' column")


class Areas:
    """Clustered burned areas with their seeds: everything step 2 needs."""

    def __init__(self, merged: C.Clusters, res: float, outlines: bool = False):
        self.points, self.hulls, self.res = merged.points, merged.hulls, res
        self.seeds = cut(K.skim(merged.points))
        self.shape = shapes.Shape(shapes.multi_hulls(merged.hulls))
        self.linked = cut(V.assign_points(merged.points, self.seeds))
        div = V.sub_polygons(merged.hulls, self.seeds, self.shape)
        if outlines:
            inside = cut(O.sub_intervals(merged.hulls, self.seeds, self.shape))
            round_ = O.perimeters(inside, ["polyid"]).select("polyid", "compactness")
            div = div.join(round_, "polyid", "left").join(O.outlines(inside, ["polyid"]).select("polyid", "geom"), "polyid", "left")
        self.div, self.n_div = cut_counted(P.drop_degenerate(div))

    def runs(self) -> DataFrame:
        return cut(V.ranges_of(self.hulls, self.seeds, self.res, self.shape))


def burned_areas(points: DataFrame, cfg: Config) -> C.Clusters:
    """The areas that get subdivided, with ``alg_agg`` on every point."""
    aggressive, conservative = C.cluster(points, "aggressive"), C.cluster(points, "conservative")
    tree = replace(tree_layer(cfg.layers), columns=("tree",)).raster()
    inside = cut(shapes.pixel_ranges(aggressive.hulls, cfg.res))
    cover = Z.sums_of_runs(inside, Z.row_sums([tree], cfg.res, inside), [tree], "fireid", cfg.res)[0]
    if cfg.subdivide == "chosen":
        return C.replace_merge(aggressive, conservative, cover, cfg.tree_threshold)
    if cfg.subdivide != "conservative":
        raise ValueError(f"subdivide must be 'chosen' or 'conservative', got {cfg.subdivide!r}")
    flags = C.merge_algorithm(aggressive.points, cover, cfg.tree_threshold).select("cleanid", "alg_agg")
    return C.Clusters(conservative.points.join(flags, "cleanid"), conservative.hulls)


def zonal_join(areas: Areas, layers: list[Layer]) -> DataFrame:
    """Sub-polygons with all layers of the recipe; rows are repeated per thematic class."""
    thematic = [layer for layer in layers if layer.kind == "thematic"]
    if len(thematic) > 1:
        raise ValueError("a recipe can have one thematic layer")
    about = areas.linked.groupBy("polyid").agg(F.min("acq_date_use").alias("acq_date_use"), F.min("alg_agg").alias("alg_agg"))
    sampled = [layer for layer in layers if layer.kind in ("thematic", "continuous")]
    rasters = [layer.raster() for layer in sampled]
    inside = areas.runs() if rasters else None
    # All raster layers in one pass over the runs of pixels.
    means = Z.sums_of_runs(inside, Z.row_sums(rasters, areas.res, inside), rasters, "polyid", areas.res) if rasters else []
    parts = [about, *[m for layer, m in zip(sampled, means) if layer.kind == "continuous"]]
    for layer in layers:
        if layer.kind == "polygons":
            parts.append(Z.region_of(areas.div, layer.table))
        elif layer.kind == "input":
            parts += [Z.input_mean(areas.linked, c) for c in layer.columns]
    classes = next((m for layer, m in zip(sampled, means) if layer.kind == "thematic"), None)
    return Z.assemble(areas.div, parts, classes)


def processed_fires(raw: DataFrame, cfg: Config, log: RunLog | None = None) -> DataFrame:
    """Raw detections -> processed fires.  With ``cfg.path`` the stages are stored there, and intermediate tables go at the end."""
    with scratch_scope(raw.sparkSession) if cfg.path is not None else nullcontext():
        return _processed_fires(raw, cfg, log or RunLog(raw.sparkSession))


def _processed_fires(raw: DataFrame, cfg: Config, log: RunLog) -> DataFrame:
    """Every stage's rows are counted by its own write (``Observation``); no event costs a job."""
    spark = raw.sparkSession

    def stage(name: str, table: str, build, inputs: tuple[DataFrame, ...], params: dict) -> tuple[DataFrame, int]:
        if cfg.path is None:
            return cut_counted(build())
        path = f"{cfg.path}/{table}"
        return sinks.stage(spark, path, build, cfg.run.get(name, True), inputs, params), sinks.stage_rows(spark, path)

    cleaning = {"date": cfg.date_definition, "first": cfg.first, "last": cfg.last, "persistent": cfg.filter_persistent}
    log.checkin("import", "work_pnt", 0)
    points, n_points = stage(
        "import", "work_pnt", lambda: P.prepare(raw, cfg.date_definition, cfg.first, cfg.last, cfg.filter_persistent), (raw,), cleaning)
    log.checkout("import", n_points)

    def step2() -> DataFrame:
        log.checkin("subdiv", "work_div", n_points)
        areas = Areas(burned_areas(points, cfg), cfg.res, cfg.outlines)
        if cfg.path is not None:
            areas.div.write.mode("overwrite").parquet(f"{cfg.path}/work_div")
            areas.linked.write.mode("overwrite").parquet(f"{cfg.path}/work_pnt_linked")
        log.checkout("subdiv", areas.n_div)
        return zonal_join(areas, cfg.layers)

    sampling = cleaning | {
        "res": cfg.res, "trees": cfg.tree_threshold, "subdivide": cfg.subdivide, "outlines": cfg.outlines,
        "layers": [[la.kind, la.columns, la.valid_range, la.nodata] for la in cfg.layers]}
    tables = tuple(la.table for la in cfg.layers if la.table is not None)
    return stage("step2", "out", step2, (points, *tables), sampling)[0]


def emissions(fires: DataFrame, date_definition: str = "UTC", year: int | None = None, mechanism: str | None = None,
              fuels: DataFrame | None = None, lct_fuels: DataFrame | None = None, factors: DataFrame | None = None,
              split: DataFrame | None = None) -> DataFrame:
    """Processed fires -> base species, with the VOCs of a mechanism (prefix ``voc_``) if one is named.

    Own tables (see ``sources.lookups``) replace the built-in fuels, factors and split; the species are then theirs.
    """
    if "acq_date_utc" not in fires.columns:
        fires = fires.withColumn("acq_date_utc", F.col("acq_date_use"))
    out = E.emit(E.accepted(E.burned_fires(fires, year, fuels=fuels, lct_fuels=lct_fuels)), factors)
    return E.speciate(out, mechanism or "", split, prefix="voc_") if mechanism or split is not None else out


def run_to_grid(raw: DataFrame, cfg: Config, species_map: DataFrame, grid: str, mechanism: str | None = None) -> DataFrame:
    """Detections -> daily gridded emissions."""
    return G.grid_daily(emissions(processed_fires(raw, cfg), mechanism=mechanism), species_map, grid)
