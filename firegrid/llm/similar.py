"""Near duplicates by similarity: documents whose sets of word shingles have a Jaccard similarity of ``least`` or more.

SimHash prints of the shingle sets within two bits of each other are linked first, by block joins and the
Hamming check of ``simhash``, and every such pair is verified on the exact sets.  That finds the closest copies;
at a similarity of 0.8 prints are some ten bits apart.  So a MinHash signature of ``BANDS`` x ``ROWS`` values proposes the
other pairs: at a similarity of 0.8 a pair shares a band with probability 1 - (1 - 0.8^5)^26 = 0.99997, at 0.9 with more.  Every proposed pair is verified on
the exact sets of shingle hashes, so nothing below ``least`` is linked.

Documents with the same shingles are one node.  In a crowded bucket the pairs with its hub (the node in
the largest buckets) are verified first; what the hub links is a component already, and only pairs across
components are left.  Of those, an exact filter on the differences to what the members have in common
leaves the pairs that can be similar (``_across``).  A large family of near copies, or of documents around
one common passage, takes no pass over all its pairs.
"""

from __future__ import annotations

from itertools import islice, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from firegrid.llm import simhash
from firegrid.llm.common import map_batches
from firegrid.operators.components import connected_components
from firegrid.operators.joins import hot_lookup
from firegrid.session import cut

WIDTH = 5
LEAST = 0.8
BANDS = 26
ROWS = 5
CHUNK = 1 << 9
# Counters of how rare shingles are, in crowded buckets.
COUNTER_BITS = 20

_RNG = np.random.default_rng(42)
_MUL = _RNG.integers(1, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a text of fewer words is one shingle, one without words has none."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), simhash.SEED)], np.uint64)
    n = len(words) - width + 1
    joined = map(b" ".join, zip(*(islice(words, i, None) for i in range(width))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(simhash.SEED)), np.uint64, n))


def bands(hashes: np.ndarray) -> list[int]:
    """A signed 64-bit key per band; none for an empty set."""
    if not len(hashes):
        return []
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        np.minimum(low, (hashes[start:start + CHUNK] * _MUL + _ADD).min(1), out=low)
    raw = low.tobytes()
    size = 8 * ROWS
    return [xxhash.xxh64_intdigest(raw[size * b:size * b + size], b) - (1 << 63) for b in range(BANDS)]


def node_of(hashes: np.ndarray) -> int:
    """Signed 64-bit hash of a set; 0 for the empty one."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), simhash.SEED) - (1 << 63) if len(hashes) else 0


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted arrays without repeats; two empty sets are equal."""
    every = np.union1d(a, b).size
    return (a.size + b.size - every) / every if every else 1.0


def nodes_of(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp): the node of each row of ``docs``, by the set of its shingles."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "fp": [node_of(shingles(t, width)) for t in cols["text"]]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run, f"doc_id {kind}, fp bigint")


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp, size, print, keys): node, number of shingles, SimHash and band keys of each row of ``docs``."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        sets = [shingles(t, width) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"], "fp": [node_of(s) for s in sets], "size": [len(s) for s in sets],
            "print": [simhash.majority(s[i:i + simhash.CHUNK] for i in range(0, len(s), simhash.CHUNK)) for s in sets],
            "keys": [bands(s) for s in sets],
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, fp bigint, size bigint, print bigint, keys array<bigint>"
    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run, schema)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The rows (src, dst) of ``pairs`` whose sets are similar; many pairs may share one ``src``."""
    counted = cut(pairs.groupBy("src").agg(F.count("*").alias("n")).join(sets.withColumnRenamed("fp", "src"), "src"))
    both = hot_lookup(pairs, counted, ["src"], "n", "dst").withColumnRenamed("hashes", "a").join(
        sets.select(F.col("fp").alias("dst"), F.col("hashes").alias("b")), "dst")

    def run(cols: dict[str, list]) -> dict[str, list]:
        read = lambda x: np.frombuffer(x, np.uint64)
        good = [jaccard(read(a), read(b)) >= least for a, b in zip(cols["a"], cols["b"])]
        return {c: [x for x, g in zip(cols[c], good) if g] for c in ("src", "dst")}

    return cut(map_batches(both.select("src", "dst", "a", "b"), run, "src bigint, dst bigint"))


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(fp, hashes): the shingle set of each of the nodes ``wanted`` (fp, first_doc), stored."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        sets = [shingles(t, width) for t in cols["text"]]
        return {"fp": [node_of(s) for s in sets], "hashes": [s.tobytes() for s in sets]}

    named = docs.join(wanted.select(F.col("first_doc").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = named.select("text").unionByName(docs.where("doc_id IS NULL").select("text"))
    found = map_batches(texts.select(F.col("text").cast("binary").alias("text")), run, "fp bigint, hashes binary")
    return cut(found.join(wanted.select("fp"), "fp", "left_semi").dropDuplicates(["fp"]))


def _fits(a: Column | str, b: Column | str, least: float) -> Column:
    """Can sets of these sizes be similar?"""
    return F.least(a, b) >= F.greatest(a, b) * least - 1e-9


def by_print(nodes: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs (src, dst) of ``nodes`` (fp, size, print) whose SimHash prints differ in at most two bits.

    Nodes of one print are paired with the smallest of them, prints by those (``simhash.links``).
    """
    first = F.min(F.struct("fp", "size")).alias("first")
    prints = cut(nodes.where("size > 0").groupBy("print").agg(first, F.count("*").alias("n")))
    same = hot_lookup(nodes.where("size > 0").select("fp", "size", "print"), prints.where("n > 1"), ["print"], "n", "fp")
    same = same.where((F.col("fp") != F.col("first.fp")) & _fits(F.col("size"), F.col("first.size"), least))
    near = simhash.links(prints.select(F.col("print").alias("fp")))
    a, b = (prints.select(F.col("print").alias(c), F.col("first").alias(f"_{c}")) for c in ("src", "dst"))
    near = near.join(a, "src").join(b, "dst").where(_fits(F.col("_src.size"), F.col("_dst.size"), least))
    return same.select(F.col("first.fp").alias("src"), F.col("fp").alias("dst")).unionByName(
        near.select(F.col("_src.fp").alias("src"), F.col("_dst.fp").alias("dst")))


def links(docs: DataFrame, nodes: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """Edges (src, dst) between the nodes (fp, size, print, keys, first_doc) of ``docs``, whose closure links all similar pairs that
    have near prints or share a band."""
    close = cut(by_print(nodes, least))
    keyed = nodes.select("fp", "size", F.explode("keys").alias("key"))
    shared = cut(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    bucket = cut(hot_lookup(keyed, shared, ["key"], "n", "fp").where("n IS NOT NULL"))
    ends = [close.select(F.col(c).alias("fp")) for c in ("src", "dst")]
    wanted = bucket.select("fp").unionByName(ends[0]).unionByName(ends[1]).distinct()
    sets = _sets(docs, cut(nodes.join(wanted, "fp", "left_semi").select("fp", "first_doc")), width)

    weight = cut(bucket.groupBy("fp").agg(F.sum("n").alias("weight"), F.count("*").alias("n_key")))
    heavy = cut(hot_lookup(bucket, weight, ["fp"], "n_key", "key"))
    hub = F.max_by(F.struct("fp", "size"), F.struct("weight", "fp")).alias("hub")
    hubs = cut(heavy.groupBy("key").agg(hub, F.first("n").alias("n_hub")))
    starred = hot_lookup(heavy, hubs, ["key"], "n_hub", "fp")
    stars = cut(
        starred.where((F.col("fp") != F.col("hub.fp")) & _fits(F.col("size"), F.col("hub.size"), least))
        .select(F.col("hub.fp").alias("src"), F.col("fp").alias("dst")).unionByName(close).distinct()
    )
    edges = _verified(stars, sets, least)

    # A bucket of two is settled.  In a larger one, pairs across components are left.
    parts = connected_components(edges).select(F.col("node").alias("fp"), "component", "n_nodes")
    parts = parts.join(weight.select("fp", "n_key"), "fp")
    crowd = bucket.where("n > 2")
    member = hot_lookup(crowd, cut(parts), ["fp"], "n_key", "key").withColumn("component", F.coalesce("component", "fp"))
    member = cut(member.select("key", "fp", "size", "component", "n"))
    groups = member.groupBy("key", "component").agg(F.count("*").alias("m"), F.first("n").alias("n"))
    main = groups.groupBy("key").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.max("m").alias("m"), F.first("n").alias("n_key"))
    mixed = hot_lookup(member, cut(main), ["key"], "n_key", "fp").where("m < n").select("fp", "size", "component", "main")
    rest = _across(cut(mixed.distinct()), sets, least)
    known = stars.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return edges.unionByName(_verified(cut(rest.join(known, ["src", "dst"], "left_anti")), sets, least))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The counter of each shingle: rarity only orders shingles, so that a shared counter costs candidates and no link."""
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _across(placed: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (src, dst) of ``placed`` (fp, size, component, main) that may be similar, across the components of a main one.

    Members of crowded buckets have most shingles in common.  What they share cancels out when each is
    described by its difference to one reference set, here the shingles of more than half of the main
    component: two sets differ as their differences differ, so sets with at most k shingles in only one of
    them share at least (|d1| + |d2| - k) / 2 of their differences.  That number is large where neither is
    close to the reference, and no pair that lacks it is looked at: rarest first, two differences with t
    in common meet in the first |d| - t + 1 of each.  So the r-th rarest serves only to meet differences no
    longer than |d| + k - 2 r.  Differences so short that they need nothing in common are linked over the
    shortest.  No similar pair is lost.
    """
    ratio = (1 - least) / (1 + least)
    size = placed.groupBy("main").agg(F.count("*").alias("n_rows"), F.sum((F.col("component") == F.col("main")).cast("long")).alias("n_main"))
    with_sets = cut(placed.join(sets, "fp"))

    def votes(cols: dict[str, list]) -> dict[str, list]:
        found: dict[int, list[np.ndarray]] = {}
        for m, h in zip(cols["main"], cols["hashes"]):
            found.setdefault(m, []).append(np.frombuffer(h, np.int64))
        out: dict[str, list] = {"main": [], "shingle": [], "n": []}
        for m, some in found.items():
            shingle, n = np.unique(np.concatenate(some), return_counts=True)
            out["main"] += [m] * len(n)
            out["shingle"] += shingle.tolist()
            out["n"] += n.tolist()
        return out

    voters = with_sets.where(F.col("component") == F.col("main")).select("main", "hashes")
    common = map_batches(voters, votes, "main bigint, shingle bigint, n bigint").groupBy("main", "shingle").agg(F.sum("n").alias("n"))
    # At most twice as many as a member has on average.
    reference = common.join(size, "main").where("2 * n > n_main").groupBy("main").agg(F.collect_list("shingle").alias("reference"), F.first("n_rows").alias("n_rows"))

    def differences(cols: dict[str, list]) -> dict[str, list]:
        delta = []
        for h, r in zip(cols["hashes"], cols["reference"]):
            delta.append(np.setxor1d(np.frombuffer(h, np.uint64), np.array(r or [], np.int64).view(np.uint64), assume_unique=True))
        return {c: cols[c] for c in ("fp", "size", "component", "main")} | {"n": [len(d) for d in delta], "delta": [d.tobytes() for d in delta]}

    schema = "fp bigint, size bigint, component bigint, main bigint, n bigint, delta binary"
    described = hot_lookup(with_sets, cut(reference), ["main"], "n_rows", "fp").select("fp", "size", "component", "main", "hashes", "reference")
    deltas = cut(map_batches(described, differences, schema))

    def counted(cols: dict[str, list]) -> dict[str, list]:
        seen = [_bits(np.frombuffer(d, np.uint64)) for d in cols["delta"]]
        at, n = np.unique(np.concatenate([np.zeros(0, np.int64), *seen]), return_counts=True)
        return {"at": at.tolist(), "n": n.tolist()}

    # A table of fixed size, whatever the corpus.
    counts = np.zeros(1 << COUNTER_BITS, np.int32)
    some = map_batches(deltas.select("delta"), counted, "at bigint, n bigint").groupBy("at").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).alias("n")).toArrow()
    counts[some["at"].to_numpy()] = some["n"].to_numpy()
    shared = deltas.sparkSession.sparkContext.broadcast(counts)

    def prefixes(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("fp", "size", "component", "main", "n", "reach", "shingle")}
        for fp, n_all, component, main_, n, raw in zip(*(cols[c] for c in ("fp", "size", "component", "main", "n", "delta"))):
            delta = np.frombuffer(raw, np.uint64)
            order = delta[np.lexsort((delta, shared.value[_bits(delta)]))].view(np.int64)
            # No partner is larger than size / least; one whose difference is shorter by more than ``most`` is not similar.
            most = int(ratio * (n_all + n_all / least) + 1e-9)
            first = min(n, most + 1)
            out["shingle"] += order[:first].tolist()
            out["reach"] += [n + most - 2 * r for r in range(first)]
            for c, v in (("fp", fp), ("size", n_all), ("component", component), ("main", main_), ("n", n)):
                out[c] += [v] * first
        return out

    schema = "fp bigint, size bigint, component bigint, main bigint, n bigint, reach bigint, shingle bigint"
    listed = cut(map_batches(deltas, prefixes, schema))
    a = listed.where("component <> main").withColumnsRenamed({"fp": "src", "size": "size_a", "component": "of_a", "n": "n_a", "reach": "reach_a"})
    b = listed.select(
        F.col("main").alias("main_b"), F.col("shingle").alias("shingle_b"), F.col("n").alias("n_b"), F.col("reach").alias("reach_b"),
        F.col("fp").alias("dst"), F.col("size").alias("size_b"), F.col("component").alias("of_b"))
    same = (F.col("main") == F.col("main_b")) & (F.col("shingle") == F.col("shingle_b")) & (F.col("n_b") <= F.col("reach_a")) & (F.col("n_a") <= F.col("reach_b"))
    once = (F.col("of_b") == F.col("main")) | (F.col("src") < F.col("dst"))
    met = a.join(b, same & (F.col("of_a") != F.col("of_b")) & once & _fits("size_a", "size_b", least)).select("src", "dst")

    slack = F.col("n") - ratio * F.col("size")
    nearest = deltas.groupBy("main").agg(F.min(F.struct(slack.alias("slack"), "fp")).alias("near"), F.count("*").alias("n_rows"))
    close = hot_lookup(deltas, cut(nearest), ["main"], "n_rows", "fp").where((slack + F.col("near.slack") <= 1e-6) & (F.col("fp") != F.col("near.fp")))
    pairs = met.unionByName(close.select(F.col("fp").alias("src"), F.col("near.fp").alias("dst")))
    return pairs.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """(doc_id, fp, component_id, n_copies): one row per row of ``docs``, as ``simhash.near_duplicates``; ``fp`` is the hash of the shingle set."""
    rows = cut(signatures(docs, width))
    first = F.min(F.col("doc_id")).alias("first_doc")
    nodes = cut(rows.groupBy("fp").agg(F.count("*").alias("n_copies"), first, F.first("size").alias("size"), F.first("print").alias("print"), F.first("keys").alias("keys")))
    return simhash.labelled(rows.select("doc_id", "fp"), nodes.select("fp", "n_copies", "first_doc"), links(docs, nodes, width, least))


def keep_first(docs: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """One row of ``docs`` for each component, chosen as ``simhash.keep_first`` does."""
    return simhash.keep_one(docs, near_duplicates(docs, width, least), lambda d: nodes_of(d, width))
