"""Near duplicates by SimHash: fingerprints, block joins, Hamming check, connected components.

Fingerprints that differ in at most two bits are linked.  Cut into four blocks of 16 bits, two such
fingerprints agree in at least two blocks, so every link shows up in one of the six tables keyed by
a pair of blocks.  Candidates of a bucket are compared bit by bit inside the join.

Only distinct fingerprints are compared: copies of a text, however many, are one row.  A bucket with
more than ``crowd`` distinct fingerprints (a large family of near copies) would still give all its
pairs.  Its members are linked over midpoints instead: two fingerprints are at most two bits apart
exactly if some value lies within one bit of both, and no value has more than 65 such neighbours.
This loses no link and writes no more than 65 rows per fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import combinations, islice, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from firegrid.llm.common import map_batches, unused
from firegrid.operators.components import connected_components
from firegrid.operators.joins import hot_lookup
from firegrid.session import cut

SEED = 42
BITS = 64
BLOCKS = 4
BLOCK_BITS = BITS // BLOCKS
MAX_DISTANCE = 2
CROWD = 64
CHUNK = 1 << 18


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles; 0 for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width))))
        n = len(words) - width + 1
    sizes = (min(CHUNK, n - start) for start in range(0, n, CHUNK))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, islice(shingles, size), repeat(SEED)), np.uint64, size) for size in sizes)


def majority(parts: Iterable[np.ndarray]) -> int:
    """Signed 64-bit SimHash of hashes that come in parts: a bit is set if it is in over half of them."""
    ones, n = np.zeros(BITS, np.int64), 0
    for h in parts:
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(h)
    value = int("".join("1" if 2 * c > n else "0" for c in ones), 2)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document; a null text has fingerprint 0."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "fp": [fingerprint(t, width) for t in cols["text"]]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run, f"doc_id {kind}, fp bigint")


def _block_keys(fp: Column) -> Column:
    """One long per pair of blocks: number of the pair, then the bits of both blocks."""
    block = [F.shiftrightunsigned(fp, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for i in range(BLOCKS)]
    pairs = combinations(range(BLOCKS), BLOCKS - MAX_DISTANCE)
    return F.array(*[
        F.lit(k << 2 * BLOCK_BITS).cast("long") + F.shiftleft(block[i].cast("long"), BLOCK_BITS) + block[j] for k, (i, j) in enumerate(pairs)
    ])


def links(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints ``nodes.fp`` whose closure links all that differ in at most two bits."""
    keyed = nodes.select("fp", F.explode(_block_keys(F.col("fp"))).alias("key"))
    shared = cut(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    bucket = cut(keyed.join(shared, "key"))
    small = bucket.where(F.col("n") <= crowd)
    a = small.select("key", F.col("fp").alias("src"))
    b = small.select(F.col("key").alias("key_b"), F.col("fp").alias("dst"))
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= MAX_DISTANCE
    pairs = a.join(b, (F.col("key") == F.col("key_b")) & (F.col("src") < F.col("dst")) & near).select("src", "dst")
    crowded = bucket.where(F.col("n") > crowd).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << BITS) if i == BITS - 1 else 1 << i).cast("long") for i in range(BITS)])
    stars = (
        crowded.select("fp", F.explode(flips).alias("flip"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
        .agg(F.min("fp").alias("src"), F.collect_set("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select("src", F.explode("fps").alias("dst")).where("src <> dst")
    )
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, width: int = 3, crowd: int = CROWD) -> DataFrame:
    """(doc_id, fp, component_id, n_copies): one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, the document's own included;
    ``n_copies`` counts the rows with the same fingerprint.  Null and blank texts share fingerprint 0
    and are linked like any other.  Rows without doc_id take part; their component is the smallest
    doc_id they reach, or null.  Repeated rows stay repeated; other columns of ``docs`` are ignored.
    An empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, width))
    nodes = cut(prints.groupBy("fp").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first_doc")))
    return labelled(prints, nodes, links(nodes, crowd))


def labelled(prints: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id, n_copies) for the stored ``prints`` (doc_id, fp), their ``nodes`` and links."""
    parts = connected_components(edges).select(F.col("node").alias("fp"), "component")
    member = nodes.join(parts, "fp", "left").select("fp", "n_copies", "first_doc", F.coalesce("component", "fp").alias("component"))
    member = cut(member)
    smallest = member.groupBy("component").agg(F.min("first_doc").alias("component_id"), F.count("*").alias("n_member"))
    labels = hot_lookup(member, cut(smallest), ["component"], "n_member", "fp").select("fp", "n_copies", "component_id")
    out = hot_lookup(prints, cut(labels), ["fp"], "n_copies", "doc_id")
    return out.select("doc_id", "fp", "component_id", "n_copies")


def keep_first(docs: DataFrame, width: int = 3, crowd: int = CROWD) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they are: the row with the smallest doc_id.

    Of several rows with that id the one with the smallest text stays (null first), of rows equal in
    both any one.  Rows without an id go if their component has one; otherwise one text per
    fingerprint stays, the smallest.
    """
    return keep_one(docs, near_duplicates(docs, width, crowd), lambda d: fingerprints(d, width))


def keep_one(docs: DataFrame, found: DataFrame, prints: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keep_first`` for the result ``found`` of a search; ``prints`` gives (doc_id, fp) of rows."""
    first_id, text = unused(docs, "_first"), unused(docs, "_text")
    first = found.where("component_id IS NOT NULL").select(F.col("component_id").alias(first_id)).distinct()
    named = docs.where("doc_id IS NOT NULL").join(first, F.col("doc_id") == F.col(first_id), "left_semi")
    # Rows that share an id are few; a group holds the rows of one id, never a component.
    packed = named.select("doc_id", F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("_row")["text"]))
    unpack = [F.col("_row")[c].alias(c) for c in docs.columns]
    named = packed.withColumn("_rank", rank).where("_rank = 1").select(*unpack)
    unnamed = docs.where("doc_id IS NULL")
    if unnamed.isEmpty():
        return named
    lost = cut(found.where("component_id IS NULL").select(F.col("fp").alias("_lost")).distinct())
    texts = prints(unnamed.select(F.col("text").alias("doc_id"), "text")).join(lost, F.col("fp") == F.col("_lost"))
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("is_text"), F.col("doc_id").alias("text")))
    chosen = cut(texts.groupBy("fp").agg(least.alias("t")).select(F.col("t.text").alias(text)))
    return named.unionByName(unnamed.join(chosen, F.col("text").eqNullSafe(F.col(text)), "left_semi").dropDuplicates(["text"]))


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
