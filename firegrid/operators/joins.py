"""Shared join helpers: lookups with hot keys and grid-binned neighbour joins.

Nothing here emits all pairs of a group: candidates come from equal bin keys, bins that hold many
rows are split, and only pairs that pass the exact test leave the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firegrid.session import cut

HOT_ROWS = 50_000
MAX_HOT_KEYS = 10_000
HOT_BIN = 2_000


def spread(cols: list[str], parts: Column) -> Column:
    """A bucket 0..parts-1 that depends on the row alone, so that a re-run task gives the same one."""
    return F.pmod(F.xxhash64(*cols), parts.cast("long")).cast("int")


def hot_lookup(
    left: DataFrame, right: DataFrame, keys: list[str], size: str, row_id: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left-join ``right`` (unique on ``keys``) onto ``left`` when few keys may own most rows.

    ``right[size]`` is the number of left rows of the key.  Keys above the limit are broadcast, so
    their rows never meet in one shuffle partition; all others take the ordinary shuffled join.  The
    limit grows with the data: at most ``MAX_HOT_KEYS`` keys can own more than 1 / MAX_HOT_KEYS of
    the rows, which bounds the broadcast.  ``row_id`` names a left column that differs between the
    rows of a key.
    """
    values = [c for c in right.columns if c not in keys]
    top = right.agg(F.max(size).alias("top"), F.sum(size).alias("rows")).first()
    limit = max(hot_rows, (top.rows or 0) // MAX_HOT_KEYS)
    # New names for the key columns: ``right`` may stem from ``left``.
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(v).alias(f"_v_{v}") for v in values])
    if (top.top or 0) <= limit:
        on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        return left.join(renamed, on, "left").select(*left.columns, *[F.col(f"_v_{v}").alias(v) for v in values])
    names = [F.col(f"_k_{k}") for k in keys]
    packed = F.struct(*[F.col(f"_v_{v}").alias(v) for v in values])
    is_hot = F.col(f"_v_{size}") > limit
    hot = renamed.where(is_hot).select(*names, packed.alias("_hot"))
    cold = renamed.where(~is_hot).select(*names, packed.alias("_cold"), F.lit(-1).alias("_c_bucket"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    first = left.join(F.broadcast(hot), same, "left").select(*left.columns, "_hot")
    # Rows already answered must not shuffle to their hot key: they go to spread, unmatched buckets.
    bucket = F.when(F.col("_hot").isNotNull(), spread([row_id], F.lit(1_000_000))).otherwise(-1)
    joined = first.withColumn("_bucket", bucket).join(cold, [F.col("_bucket") == F.col("_c_bucket"), *same], "left")
    picked = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*left.columns, *[picked[v].alias(v) for v in values])


def bin_range(lo: Column, hi: Column, size: float) -> Column:
    """Bin numbers covered by [lo, hi]."""
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def split_hot_bins(a: DataFrame, b: DataFrame, keys: list[str], row_id: str, hot: int = HOT_BIN) -> tuple[DataFrame, DataFrame]:
    """Add a ``_salt`` column so that crowded bins are joined by several tasks.

    A bin with n rows on the left is cut into ceil(n / hot) parts; the right rows are repeated for
    each part.  The result is exact: every (left, right) candidate meets exactly once.
    """
    # Stored, so that its size is known: a few crowded bins are broadcast, and no row is exchanged to meet them.
    crowded = cut(
        a.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot)
        .select(*keys, F.ceil(F.col("_n") / hot).cast("int").alias("_parts"))
    )
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = a.join(crowded, keys, "left").withColumn("_salt", spread([row_id], parts)).drop("_parts")
    right = b.join(crowded, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left, right


def overlap_pairs(df: DataFrame, group: list[str], id_col: str, bin_deg: float = 0.05, hot: int = HOT_BIN) -> DataFrame:
    """Pairs (a < b) of boxes (lon, lat, dx, dy) that overlap, within equal ``group`` values.

    Each box is listed in the bins its envelope touches.  A pair counts only in the bin holding the
    larger of the two left edges and the larger of the two bottom edges, which both boxes touch, so
    no de-duplication is needed.  Longitude does not wrap.
    """
    x0, x1 = F.col("lon") - F.col("dx"), F.col("lon") + F.col("dx")
    y0, y1 = F.col("lat") - F.col("dy"), F.col("lat") + F.col("dy")
    binned = (
        df.select(*group, id_col, "lon", "lat", "dx", "dy")
        .withColumn("_bx", F.explode(bin_range(x0, x1, bin_deg)))
        .withColumn("_by", F.explode(bin_range(y0, y1, bin_deg)))
    )
    keys = [*group, "_bx", "_by"]
    a, b = split_hot_bins(binned, binned, keys, id_col, hot)
    cols = [id_col, "lon", "lat", "dx", "dy"]
    a = a.select(*keys, "_salt", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = b.select(*keys, "_salt", *[F.col(c).alias(f"b_{c}") for c in cols])
    ax0, bx0 = F.col("a_lon") - F.col("a_dx"), F.col("b_lon") - F.col("b_dx")
    ay0, by0 = F.col("a_lat") - F.col("a_dy"), F.col("b_lat") - F.col("b_dy")
    return (
        a.join(b, [*keys, "_salt"])
        .where(F.col(f"a_{id_col}") < F.col(f"b_{id_col}"))
        .where(F.abs(F.col("a_lon") - F.col("b_lon")) < F.col("a_dx") + F.col("b_dx"))
        .where(F.abs(F.col("a_lat") - F.col("b_lat")) < F.col("a_dy") + F.col("b_dy"))
        .where(F.col("_bx") == F.floor(F.greatest(ax0, bx0) / bin_deg))
        .where(F.col("_by") == F.floor(F.greatest(ay0, by0) / bin_deg))
        .drop("_bx", "_by", "_salt")
    )


def near_pairs(df: DataFrame, group: list[str], id_col: str, radius: float = 0.5 / 60.0, hot: int = HOT_BIN) -> DataFrame:
    """Pairs (a < b) of points closer than ``radius`` degrees (strict), within equal ``group`` values.

    ``invdist`` is 1 / distance, 3600 for coinciding points.  Bins are two radii wide, and a point is
    listed in those within the radius (a little more, for rounding): four or five instead of nine.
    """
    size, reach = 2.0 * radius, radius * (1 + 1e-6)

    def bins(c: str) -> Column:
        return F.sequence(F.floor((F.col(c) - reach) / size), F.floor((F.col(c) + reach) / size))

    plain = df.select(*group, id_col, "lon", "lat")
    cell = plain.withColumn("_bx", F.floor(F.col("lon") / size)).withColumn("_by", F.floor(F.col("lat") / size))
    around = plain.withColumn("_bx", F.explode(bins("lon"))).withColumn("_by", F.explode(bins("lat")))
    keys = [*group, "_bx", "_by"]
    a, b = split_hot_bins(cell, around, keys, id_col, hot)
    a = a.select(*keys, "_salt", *[F.col(c).alias(f"a_{c}") for c in (id_col, "lon", "lat")])
    b = b.select(*keys, "_salt", *[F.col(c).alias(f"b_{c}") for c in (id_col, "lon", "lat")])
    dx, dy = F.col("a_lon") - F.col("b_lon"), F.col("a_lat") - F.col("b_lat")
    return (
        a.join(b, [*keys, "_salt"])
        .where(F.col(f"a_{id_col}") < F.col(f"b_{id_col}"))
        .withColumn("dist", F.sqrt(dx * dx + dy * dy))
        .where(F.col("dist") < radius)
        .withColumn("invdist", F.when(F.col("dist") == 0, 3600.0).otherwise(1.0 / F.col("dist")))
        .drop("_bx", "_by", "_salt")
    )
