"""Counts, totals, checks and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firegrid.functions.geo import modis_tile
from firegrid.operators.prep import serial_key
from firegrid.session import cut

LOG_SCHEMA = "event string, table_name string, n_before long, n_after long, elapsed_s double, message string"


def first_last_day(points: DataFrame, lat: float = 30.0) -> DataFrame:
    """First and last local day; the last day moves on by one if a MODIS row lies within ``lat`` degrees."""
    tropical = F.count_if((F.col("instrument") == "MODIS") & (F.abs("lat") <= lat)) > 0
    return points.agg(
        F.min("acq_date_lst").alias("first_day"),
        F.date_add(F.max("acq_date_lst"), F.when(tropical, 1).otherwise(0)).alias("last_day"),
    )


def distinct_dates(df: DataFrame, date: str = "acq_date_use") -> DataFrame:
    return df.groupBy(date).agg(F.count("*").alias("n"))


def extent(df: DataFrame, lon: str = "lon", lat: str = "lat", whole: bool = False) -> DataFrame:
    """Bounding box; ``whole`` widens it to whole degrees."""
    lo, hi = (F.floor, F.ceil) if whole else (lambda c: c, lambda c: c)
    return df.agg(
        lo(F.min(lon)).alias("x0"), lo(F.min(lat)).alias("y0"), hi(F.max(lon)).alias("x1"), hi(F.max(lat)).alias("y1")
    )


def density(df: DataFrame, dx: float = 32 * 6 / 3600, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Detections per cell counted from the north-west corner: (idx, jdx, n, shade).

    ``shade`` compresses the count for display: log10 if any cell exceeds 2000, square root if any
    exceeds 20.  The corner is one aggregate, the largest count comes from the stored cells.
    """
    corner = df.agg(F.min(lon).alias("west"), F.max(lat).alias("north")).first()
    west, north = F.lit(corner.west).cast("double"), F.lit(corner.north).cast("double")
    cells = cut(df.groupBy(F.floor((F.col(lon) - west) / dx).alias("idx"), F.floor((north - F.col(lat)) / dx).alias("jdx")).agg(
        F.count("*").alias("n")
    ))
    top = F.lit(cells.agg(F.max("n").alias("top")).first().top)
    shade = F.when(top > 2000, F.log10("n")).when(top > 20, F.sqrt("n")).otherwise(F.col("n").cast("double"))
    return cells.select("idx", "jdx", "n", shade.alias("shade"))


def tile_counts(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return df.groupBy(modis_tile(F.col(lon), F.col(lat)).alias("tile")).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, loaded: DataFrame, land: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Per tile: detections and whether the land-cover tile they need is there.

    ``loaded``, ``land``: (tile) tables, a few hundred rows each.  A tile is fine when it is loaded
    or when no land tile exists for it.
    """
    counts = tile_counts(df, lon, lat)
    out = (
        counts.join(F.broadcast(loaded.distinct().withColumn("is_loaded", F.lit(True))), "tile", "left")
        .join(F.broadcast(land.distinct().withColumn("is_land", F.lit(True))), "tile", "left")
    )
    is_loaded, is_land = F.coalesce("is_loaded", F.lit(False)), F.coalesce("is_land", F.lit(False))
    return out.select("tile", F.col("n").alias("n_fire"), (is_loaded | ~is_land).alias("ok"), (is_land & ~is_loaded).alias("need"))


def coverage_summary(cov: DataFrame) -> DataFrame:
    return cov.agg(
        F.sum("n_fire").alias("n_fire"), F.sum(F.when(F.col("ok"), F.col("n_fire")).otherwise(0)).alias("n_contained"),
        F.sum(F.when(F.col("ok"), 0).otherwise(F.col("n_fire"))).alias("n_not_contained"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for the tables of a run."""
    parts = [t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, t in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def area_totals(fires: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Total area, area by cover class and area by land cover: (kind, class, area).

    One aggregation per land cover; the totals add up its few rows.
    """
    extra = extra or []
    part = F.col("area_sqkm") * F.col("f_lct")
    by_lct = fires.groupBy(*extra, "v_lct").agg(
        F.sum(part).alias("total"), *[F.sum(part * F.col(f"v_{b}") / 100.0).alias(b) for b in ("tree", "herb", "bare")]
    )
    def melted(names: list[str], kind: str) -> DataFrame:
        sums = by_lct.groupBy(*extra).agg(*[F.sum(n).alias(n) for n in names])
        return sums.unpivot(extra, names, "class", "area").withColumn("kind", F.lit(kind))

    lct = by_lct.select(*extra, F.lit("lct").alias("kind"), F.col("v_lct").cast("string").alias("class"), F.col("total").alias("area"))
    cols = [*extra, "kind", "class", "area"]
    return melted(["total"], "total").select(*cols).unionByName(melted(["tree", "herb", "bare"], "cover").select(*cols)).unionByName(lct)


def global_totals(sums: DataFrame, species: list[str]) -> DataFrame:
    """Burned area, biomass and species sums per vegetation type and overall (genveg null).

    ``sums``: rows by vegetation (``emissions.emission_sums``, ``emissions.sums_of_emitted``), so that only a
    few rows are rolled up.
    """
    return sums.rollup("genveg").agg(*[F.sum(c).alias(c) for c in ("n_fires", "area_m2", "biomass_kg", *species)])


def reject_counts(burned: DataFrame) -> DataFrame:
    """One row of counters over all checked fires."""
    reason = F.col("reject_reason")
    return burned.agg(
        F.count("*").alias("n_rows"), F.count_if(reason.isNull()).alias("n_kept"),
        F.count_if(reason == "no region").alias("n_no_region"), F.count_if(reason == "land cover").alias("n_land_cover"),
        F.count_if(reason == "total cover").alias("n_total_cover"), F.count_if(reason == "vegetation").alias("n_no_vegetation"),
        F.count_if(reason == "fuel").alias("n_no_fuel"), F.count_if(reason == "area").alias("n_no_area"),
        F.count_if(reason.isNull() & F.col("all_bare")).alias("n_all_bare"),
        F.count_if(reason.isNull() & F.col("rescaled")).alias("n_rescaled"),
        F.count_if(reason.isNull() & (F.col("totcov") < 50)).alias("n_cover_below_50"),
        F.count_if(reason.isNull() & (F.col("lct") == 13)).alias("n_urban"),
    )


def missing_ids(parent: DataFrame, child: DataFrame, key: str = "fireid") -> DataFrame:
    """Parents without a child."""
    return parent.select(key).distinct().join(child, key, "left_anti")


def conservation(div: DataFrame, lrg: DataFrame, tol: float = 0.05) -> DataFrame:
    """Fires whose parts miss more than ``tol`` of the parent area."""
    parts = div.groupBy("fireid").agg(F.sum("area_sqkm").alias("subs"))
    both = lrg.select("fireid", F.col("area_sqkm").alias("parent")).join(parts, "fireid")
    return both.withColumn("shortfall", F.try_divide(F.col("parent") - F.col("subs"), F.col("parent"))).where(F.col("shortfall") > tol)


def worst(df: DataFrame, column: str = "shortfall", n: int = 5) -> DataFrame:
    return df.orderBy(F.desc(column), *[c for c in df.columns if c != column]).limit(n)


def diagnostics(points: DataFrame, lrg: DataFrame, div: DataFrame, tol: float = 0.05) -> DataFrame:
    """(check, n): detections without a sub-polygon, parents without children, parents that lost area."""
    orphans = points.agg(F.count_if(F.col("polyid").isNull()).alias("n")).select(F.lit("orphan detections").alias("check"), "n")
    childless = missing_ids(lrg, div).agg(F.count("*").alias("n")).select(F.lit("childless parents").alias("check"), "n")
    lost = conservation(div, lrg, tol).agg(F.count("*").alias("n")).select(F.lit("area lost").alias("check"), "n")
    return orphans.unionByName(childless).unionByName(lost)


def extreme_location(df: DataFrame, column: str, lon: str = "cen_lon", lat: str = "cen_lat") -> DataFrame:
    """Smallest and largest value with their places, in one aggregated row."""
    return df.agg(
        F.min(column).alias("low"), F.min_by(lon, column).alias("low_lon"), F.min_by(lat, column).alias("low_lat"),
        F.max(column).alias("high"), F.max_by(lon, column).alias("high_lon"), F.max_by(lat, column).alias("high_lat"),
    )


def order_by_count(df: DataFrame, column: str) -> DataFrame:
    """Values by how often they occur, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows of several tables by column name; missing columns become null."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def check_day_order(df: DataFrame, day: str, order: str, groups: list[str]) -> DataFrame:
    """Rows whose day precedes the day of the row before them within a source file.

    Rows are numbered by a distributed sort and each meets the row before it by number, so a file
    that holds most of the rows is not sorted in one task.  ``order`` must be unique within a file.
    """
    numbered = serial_key(df, [*groups, order], "_at")
    before = numbered.select((F.col("_at") + 1).alias("_at"), *groups, F.col(day).alias("previous"))
    return numbered.join(before, ["_at", *groups]).where(F.col(day) < F.col("previous")).select(*df.columns, "previous")


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; an aggregate, so partial results shrink before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*key).agg(first.alias("_r")).select(*key, "_r.*")


# -- run log -----------------------------------------------------------------------------------------

def log_change() -> Column:
    return F.col("n_after") - F.col("n_before")


def summarize_log(events: DataFrame) -> DataFrame:
    """One row per event: first-before, last-after, net change and time."""
    return events.groupBy("event").agg(
        F.max("log_id").alias("log_id"), F.sum(log_change()).alias("n_change"), F.min("n_before").alias("n_before"),
        F.max("n_after").alias("n_after"), F.sum("elapsed_s").alias("elapsed_s"),
    )


def with_totals(summary: DataFrame, totals: DataFrame) -> DataFrame:
    """Put the totals of the run (one row: n_pnt, n_lrg, n_div) into the events they belong to."""
    event = F.col("event")
    joins = event.startswith("join ") | (event == "merge all")
    n_pnt, n_lrg, n_div = (totals.select(c).scalar() for c in ("n_pnt", "n_lrg", "n_div"))
    before = F.when(event == "agg to large", n_pnt).when(event == "subdiv", n_lrg).when(joins, n_div).otherwise(F.col("n_before"))
    after = F.when(event == "agg to large", n_lrg).when(event == "subdiv", n_div).otherwise(F.col("n_after"))
    change = F.when(joins, F.col("n_after") - n_div).otherwise(F.col("n_change"))
    return summary.select("log_id", "event", change.alias("n_change"), before.alias("n_before"), after.alias("n_after"), "elapsed_s")


class RunLog:
    """Events of a run (a handful per stage): check in, check out, summarise, purge."""

    def __init__(self, spark):
        self.spark, self.rows, self._open = spark, [], {}

    def checkin(self, event: str, table: str = "", n_before: int = 0) -> None:
        import time

        self._open[event] = (table, n_before, time.time())

    def checkout(self, event: str, n_after: int, message: str = "") -> None:
        import time

        table, before, start = self._open.pop(event)
        self.rows.append((len(self.rows) + 1, event, table, before, n_after, time.time() - start, message))

    def purge(self, event: str) -> None:
        self.rows = [r for r in self.rows if r[1] != event]

    def events(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, f"log_id long, {LOG_SCHEMA}")
