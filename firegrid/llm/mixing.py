"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose documents queue in a shuffled order (by the MD5 of their id), up to
three times over.  A document's virtual finish time is the source's words up to and including it
divided by the source's target.  All copies are sorted by finish time over the cluster and taken
until the total budget is used up, so at any moment of the virtual clock each source has given the
same share of its target.

Running sums are taken in bounded pieces: a source's order is cut into buckets of the hash, the
global order into range partitions; only the totals of the pieces meet in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from firegrid.llm.common import n_words
from firegrid.operators.joins import hot_lookup
from firegrid.session import cut

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
# Rows of one running sum, on average.
PIECE = 20_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MAX_COPIES) -> DataFrame:
    """(source, n_docs, source_size, target) from rows (source, size).

    Sources in code-point order, null last, get ``weights`` in turn.  They share the sum of all
    sizes by weight; a target stops at ``copies`` times its source's size and the excess is shared
    again by weight.  In the order of cap / weight the capped sources come first, so the level of
    the others follows from the first source that is not capped.  One row per source: a small table.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int")).cast("long")
    every = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (
        per.withColumn("w", weight).withColumn("cap", copies * F.col("source_size"))
        .withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(order), F.lit(0)))
        .withColumn("w_rest", F.sum("w").over(every) - F.coalesce(F.sum("w").over(order), F.lit(0)))
        .withColumn("free", F.col("rest") * F.col("w") <= F.col("cap") * F.col("w_rest"))
        .withColumn("at", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), F.struct(F.col("source").isNull(), "source"), "rest", "w_rest"))).over(every))
    )
    share = (F.col("w") * F.col("at.rest")).cast("double") / F.col("at.w_rest").cast("double")
    return level.select("source", "n_docs", "source_size", F.least(F.col("cap").cast("double"), share).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MAX_COPIES, size: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, n_taken, taken): one row per row of ``docs``.

    ``n_taken`` whole copies of a document are taken, 0 to ``copies``; ``taken`` = n_taken * size.
    ``size`` defaults to the number of words of ``text``; null and blank texts have size 0 and are
    never taken.  A null source is a source like any other, last in order.  Equal ids are ordered by
    size; rows equal in both are interchangeable.  The result depends on the rows alone, not on
    their order or partitioning.  ``keep`` names further columns of ``docs`` to carry along.
    An empty table gives an empty result.
    """
    total_size = n_words(F.col("text")) if size is None else size
    carried = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("string")
    base = cut(docs.select("doc_id", "source", total_size.alias("size"), carried.alias("_keep")))
    targets = cut(source_targets(base.select("source", "size"), weights, copies))
    stats = targets.agg(F.sum("n_docs").alias("n"), F.sum("source_size").alias("words")).first()
    n, budget = stats.n or 0, stats.words or 0
    digits = max(1, math.ceil(math.log(max(n, 1) / PIECE, 16))) if n > PIECE else 1
    known = hot_lookup(base, targets, ["source"], "n_docs", "doc_id").withColumn(
        "key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("bucket", F.substring("key", 1, digits))
    out = ["doc_id", "source", "size", "source_size", "target"]
    words = known.where("size > 0")

    # Running sum of each source in hash order: inside a bucket, plus all buckets before it.
    per_bucket = words.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = (
        words.withColumn("inside", F.sum("size").over(inside))
        .join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
        .withColumn("cum", F.col("offset") + F.col("inside")).select(*out, "_keep", "cum")
    )
    copy = queued.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    finish = (F.col("copy") * F.col("source_size") + F.col("cum")).cast("double") / F.col("target")
    order = ["finish", "source", "copy", "cum"]
    # The global order, by ranges; stored, so that pieces and their totals see the same partitions.
    ranged = cut(
        copy.withColumn("finish", finish).repartitionByRange(max(1, copies * n // PIECE), *order).withColumn("piece", F.spark_partition_id())
    )
    totals = ranged.groupBy("piece").agg(F.sum("size").alias("in_piece"))
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("piece", F.coalesce(F.sum("in_piece").over(earlier), F.lit(0)).alias("start"))
    running = F.sum("size").over(Window.partitionBy("piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    taken = (
        ranged.withColumn("running", running).join(starts, "piece")
        .withColumn("take", (F.col("start") + F.col("running") <= budget).cast("int"))
        # Sizes are positive here, so (source, cum) names one row.
        .groupBy("source", "cum").agg(*[F.first(c).alias(c) for c in out if c != "source"], F.first("_keep").alias("_keep"), F.sum("take").alias("n_taken"))
    )
    nothing = known.where("size = 0").select(*out, "_keep", F.lit(0).cast("long").alias("n_taken"))
    every = taken.select(*out, "_keep", "n_taken").unionByName(nothing)
    more = [F.col(f"_keep.{c}").alias(c) for c in keep]
    return every.select(*out, "n_taken", (F.col("n_taken") * F.col("size")).alias("taken"), *more)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MAX_COPIES) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns as they are, plus ``copies`` and ``taken``.

    The mix itself is made on narrow rows; the texts are joined once, at the end.  Rows with equal
    doc_id, source and text share the largest number of copies among them.
    """
    names = docs.columns
    narrow = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("_hash"))
    found = mix(narrow, weights, copies, keep=("_hash",)).where("n_taken > 0")
    chosen = found.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("_hash").alias("_text")).agg(
        F.max("n_taken").alias("_copies"), F.max("taken").alias("_taken"))
    packed = docs.select("doc_id", "source", F.xxhash64("text").alias("_hash"), F.struct(*[F.col(c) for c in names]).alias("_row"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_hash") == F.col("_text"))
    added = [F.col("_copies").cast("long").alias("copies"), F.col("_taken").alias("taken")]
    return packed.join(chosen, same).select(*[F.col("_row")[c].alias(c) for c in names if c not in ("copies", "taken")], *added)


ORACLE = """
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
weighed AS (
  SELECT *, 3 * source_size AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w FROM per),
level AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER prev, 0))::BIGINT AS rest,
         (sum(w) OVER () - coalesce(sum(w) OVER prev, 0))::BIGINT AS w_rest, cap / w AS ratio
  FROM weighed
  WINDOW prev AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
open AS (SELECT rest, w_rest FROM level WHERE rest * w <= cap * w_rest ORDER BY ratio, source ASC NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, (w * open.rest)::DOUBLE / open.w_rest::DOUBLE) AS target FROM level, open),
queued AS (
  SELECT b.doc_id, b.source, b.size, t.source_size, t.target,
         (sum(b.size) OVER (PARTITION BY b.source ORDER BY md5(coalesce(b.doc_id::VARCHAR, '')), b.doc_id, b.size
                            ROWS UNBOUNDED PRECEDING))::BIGINT AS cum
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source WHERE b.size > 0),
copies AS (
  SELECT *, (copy * source_size + cum)::DOUBLE / target AS finish FROM queued, range(3) AS r(copy)),
running AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source, copy, cum ROWS UNBOUNDED PRECEDING) AS used FROM copies),
taken AS (
  SELECT source, cum, first(doc_id) AS doc_id, first(size) AS size, first(source_size) AS source_size, first(target) AS target,
         (count(*) FILTER (used <= (SELECT sum(size) FROM base)))::BIGINT * first(size) AS taken
  FROM running GROUP BY source, cum)
SELECT doc_id, size, source_size, target, taken FROM taken
UNION ALL
SELECT b.doc_id, b.size, t.source_size, t.target, 0::BIGINT
FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source WHERE b.size = 0
"""
