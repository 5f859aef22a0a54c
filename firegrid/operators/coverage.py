"""What of a raster is there, and what areas need: footprints of valid pixels and tiles of the sinusoidal grid.

A footprint is a bitmap per tile, in buckets of 32 768 pixels: built, united and probed by the engine's
bitmap functions, a few kilobytes per bucket however often a pixel is delivered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def tile_name(h: Column, v: Column) -> Column:
    return F.format_string("h%02dv%02d", h.cast("int"), v.cast("int"))


def pixel_of(lon: Column, lat: Column, side: int) -> list[Column]:
    """[tile, position]: the sinusoidal tile of a place and its pixel there, row by row from the north-west, from 1.

    ``side`` pixels make the side of a tile (10 degrees at the equator).
    """
    u, w = lon * F.cos(F.radians(lat)) / 10.0 + 18.0, 9.0 - lat / 10.0
    row, col = (F.least(F.floor((c - F.floor(c)) * side), F.lit(side - 1)) for c in (w, u))
    return [tile_name(F.floor(u), F.floor(w)).alias("tile"), (row * side + col + 1).cast("long").alias("pos")]


def footprint(pixels: DataFrame) -> DataFrame:
    """(tile, bucket, bits): the valid pixels of rows (tile, pos), in which a pixel may occur any number of times."""
    keyed = pixels.select("tile", F.bitmap_bucket_number("pos").alias("bucket"), F.bitmap_bit_position("pos").alias("bit"))
    return keyed.groupBy("tile", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def united(footprints: list[DataFrame]) -> DataFrame:
    """One footprint of several, such as those of files that arrive one after the other."""
    every = footprints[0]
    for other in footprints[1:]:
        every = every.unionByName(other)
    return every.groupBy("tile", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def n_valid(prints: DataFrame) -> DataFrame:
    """(tile, n_pixels): valid pixels of each tile."""
    return prints.groupBy("tile").agg(F.sum(F.bitmap_count("bits")).alias("n_pixels"))


def _has(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    shifted = F.call_function("shiftright", byte, (bit % 8).cast("int"))
    return F.coalesce(shifted.bitwiseAND(F.lit(1)) == 1, F.lit(False))


def contained(points: DataFrame, prints: DataFrame, side: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(tile, n_fire, n_contained): the points of each tile and those that lie on a valid pixel.

    Points are counted per pixel before they meet the footprint; a place seen a million times is one row.
    Points without a place are in no tile and not counted.
    """
    placed = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(*pixel_of(F.col(lon), F.col(lat), side))
    counts = placed.groupBy("tile", "pos").agg(F.count(F.lit(1)).alias("n"))
    keyed = counts.select("tile", "n", F.bitmap_bucket_number("pos").alias("bucket"), F.bitmap_bit_position("pos").alias("bit"))
    per_bucket = keyed.join(prints, ["tile", "bucket"], "left")
    return per_bucket.groupBy("tile").agg(
        F.sum("n").alias("n_fire"), F.sum(F.when(_has(F.col("bits"), F.col("bit")), F.col("n")).otherwise(0)).alias("n_contained"))


def tiles_of(boxes: DataFrame, keys: list[str], x0: str = "x0", x1: str = "x1", y0: str = "y0", y1: str = "y1") -> DataFrame:
    """Distinct (keys, tile): the sinusoidal tiles that each box touches; boxes may be the strips of an area.

    In each band of ten degrees the box covers one range of x cos(y), from its corners and, over the
    equator, from the widest parallel; it touches the tiles of that range and no others.  Boxes are
    listed once per band, not once per tile of the globe.
    """
    band = boxes.select(*keys, x0, x1, y0, y1, F.explode(F.sequence(
        F.floor(9.0 - F.col(y1) / 10.0).cast("int"), F.floor(9.0 - F.col(y0) / 10.0).cast("int"))).alias("v"))
    north = F.least(F.col(y1), 90.0 - F.col("v") * 10.0)
    south = F.greatest(F.col(y0), 80.0 - F.col("v") * 10.0)
    widest = F.when((south <= 0) & (north >= 0), 1.0).otherwise(F.greatest(F.cos(F.radians(south)), F.cos(F.radians(north))))
    least = F.least(F.cos(F.radians(south)), F.cos(F.radians(north)))

    def end(x: str, low: bool) -> Column:
        outer, inner = F.col(x) * widest, F.col(x) * least
        return F.floor((F.least(outer, inner) if low else F.greatest(outer, inner)) / 10.0 + 18.0).cast("int")

    listed = band.where(north >= south).select(*keys, "v", F.explode(F.sequence(end(x0, True), end(x1, False))).alias("h"))
    return listed.select(*keys, tile_name(F.col("h"), F.col("v")).alias("tile")).distinct()


def tile_needs(touched: DataFrame) -> DataFrame:
    """(tile, n): how many areas touch each tile, from ``tiles_of``."""
    return touched.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
