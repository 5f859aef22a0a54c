"""Prefix trie of conversations that share their first turns, by collapsing whole sequences.

Conversations are rebuilt (a head taken from the first conversation of their hundred, then their own
turns), identical ones become one weighted sequence with the list of conversations that end there,
sequences that are proper prefixes of others are told from leaves by an anti-join, and the prefixes of
the weighted sequences are added up per node.

A prefix is named by the XOR of hashes of (position, turn), twice over: 128 bits that can be summed in
any order, so a conversation that owns most of the rows is read by many tasks.  Rows carry the number of
the range partition they were sorted into; joins and windows run on (conversation, partition), never on
the conversation alone.  That every node's members agree on parent and turn is verified, which by
induction over the depth proves that no two prefixes share a name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from firegrid.operators.joins import hot_lookup
from firegrid.session import cut

# A conversation takes 0 to MOST - 1 first turns of the first conversation of its block of BLOCK ids.
MOST, BLOCK = 6, 100
# The hashes of the two halves of a name start from these.
SALTS = (1, 2)
NODE = ["x1", "x2", "depth"]
# Rows outside any range partition: heads and roots, at most MOST per conversation.
HEAD = -1


def _marks(position: Column, digest: Column) -> list[Column]:
    return [F.xxhash64(F.lit(s), position.cast("long"), digest) for s in SALTS]


def _running(window_cols: list[str], order: str) -> Window:
    return Window.partitionBy(*window_cols).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier_parts() -> Window:
    return Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)


def sorted_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, i, digest, chars) of every turn, and (conv_id, part, n, before, n_own) of every place.

    ``i`` counts the turns of a conversation from 0, in order of ``turn``, null first, then of the
    SHA-256 of role and text.  ``part`` is the range partition; a place is a conversation's share of one,
    ``before`` its turns in earlier partitions.  Null role or text is empty; rows without conv_id are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    order = ["conv_id", "turn", "digest"]
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    staged = cut(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    places = staged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    places = cut(places.select(
        "*", F.coalesce(F.sum("n").over(_earlier_parts()), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_own")))
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "digest"))
    # A partition holds the start of all its conversations but one, so these are no more than the partitions.
    later = places.where("before > 0").select("conv_id", "part", "before")
    turns = staged.withColumn("inside", inside).join(F.broadcast(later), ["conv_id", "part"], "left").select(
        "conv_id", "part", (F.col("inside") - 1 + F.coalesce("before", F.lit(0))).alias("i"), "digest", "chars")
    return cut(turns), places


def rebuilt(conversations: DataFrame, most: int = MOST, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Prefixes and places of the rebuilt conversations.

    Conversation c gets the first h turns of conversation c - c % block (all if it has fewer, none if it
    is absent), then its own turns after its first h; h = crc32(c in decimal) % most.  The prefixes are
    (conv_id, part, depth, x1, x2, p1, p2, digest, chars, through, length): the name of the first ``depth``
    turns and of their parent, the last turn, its code points and those of the whole prefix, and the
    conversation's length.  Depth 0 is there for every conversation.
    """
    turns, places = sorted_turns(conversations)
    convs = places.groupBy("conv_id").agg(F.first("n_own").alias("n_own")).select(
        "conv_id", "n_own", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    firsts = turns.where((F.col("conv_id") % block == 0) & (F.col("i") < most - 1)).select(
        F.col("conv_id").alias("base"), "i", "digest", "chars")
    depth = (F.col("i") + 1).alias("depth")
    marks = [m.alias(f"f{k}") for k, m in enumerate(_marks(F.col("i") + 1, F.col("digest")), 1)]
    heads = convs.join(firsts, "base").where("i < h").select("conv_id", depth, "digest", "chars", *marks)
    run = _running(["conv_id"], "depth")
    heads = cut(heads.select(
        "*", F.bit_xor("f1").over(run).alias("x1"), F.bit_xor("f2").over(run).alias("x2"), F.sum("chars").over(run).alias("through")))
    head = heads.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("head_n"), F.bit_xor("f1").alias("head_x1"), F.bit_xor("f2").alias("head_x2"), F.sum("chars").alias("head_chars"))
    zero = F.lit(0).cast("long")
    convs = cut(convs.join(head, "conv_id", "left").select(
        "conv_id", "h", *[F.coalesce(c, zero).alias(c) for c in ("head_n", "head_x1", "head_x2", "head_chars")],
        (F.coalesce("head_n", zero) + F.greatest(F.col("n_own") - F.col("h"), zero)).alias("length")))

    # What a conversation's rows need to know is joined to its places first, then to the rows of each place.
    known = places.select("conv_id", "part").join(convs, "conv_id")
    own = turns.join(known, ["conv_id", "part"]).where("i >= h").withColumn("depth", F.col("head_n") + F.col("i") - F.col("h") + 1)
    own = own.select("*", *[m.alias(f"f{k}") for k, m in enumerate(_marks(F.col("depth"), F.col("digest")), 1)])
    run = _running(["conv_id", "part"], "depth")
    own = cut(own.select(
        "*", F.bit_xor("f1").over(run).alias("r1"), F.bit_xor("f2").over(run).alias("r2"), F.sum("chars").over(run).alias("r_chars")))
    sums = own.groupBy("conv_id", "part").agg(F.bit_xor("f1").alias("s1"), F.bit_xor("f2").alias("s2"), F.sum("chars").alias("s_chars"))
    across = sums.join(places.where("n < n_own").select("conv_id", "part"), ["conv_id", "part"])
    w = _earlier_parts()
    # As above: at most one row per partition.
    across = across.select(
        "conv_id", "part", F.bit_xor("s1").over(w).alias("b1"), F.bit_xor("s2").over(w).alias("b2"), F.sum("s_chars").over(w).alias("b_chars")
    ).where("b_chars IS NOT NULL")
    own = own.join(F.broadcast(across), ["conv_id", "part"], "left")
    name = [F.col(f"r{k}").bitwiseXOR(F.col(f"head_x{k}")).bitwiseXOR(F.coalesce(f"b{k}", zero)) for k in (1, 2)]
    out = ["conv_id", "part", "depth", "x1", "x2", "p1", "p2", "digest", "chars", "through", "length"]
    parent = [F.col(f"x{k}").bitwiseXOR(F.col(f"f{k}")).alias(f"p{k}") for k in (1, 2)]
    own = own.withColumn("x1", name[0]).withColumn("x2", name[1]).withColumn(
        "through", F.col("r_chars") + F.col("head_chars") + F.coalesce("b_chars", zero)).select("*", *parent).select(*out)
    heads = heads.join(convs.select("conv_id", "length"), "conv_id").select("*", *parent, F.lit(HEAD).alias("part")).select(*out)
    none = F.lit(None)
    roots = convs.select(
        "conv_id", F.lit(HEAD).alias("part"), *[zero.alias(c) for c in ("depth", "x1", "x2")], *[none.cast("long").alias(c) for c in ("p1", "p2")],
        none.cast("binary").alias("digest"), zero.alias("chars"), zero.alias("through"), "length")
    all_places = places.select("conv_id", "part").union(convs.select("conv_id", F.lit(HEAD).alias("part")))
    return cut(own.unionByName(heads).unionByName(roots)), cut(all_places)


def weighted_sequences(prefixes: DataFrame) -> DataFrame:
    """(x1, x2, depth, conv_id, weight, total): identical rebuilt conversations as one, named by the smallest."""
    return cut(prefixes.where("depth = length").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("through").alias("total")))


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one node, sorted by conversation, as one row with the ids as text."""
    for batch in batches:
        out: dict[str, list] = {"x1": [], "x2": [], "depth": [], "first": [], "ids": []}
        last = None
        for x1, x2, depth, conv in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if last != (x1, x2, depth):
                last = (x1, x2, depth)
                for k, v in zip(out, (x1, x2, depth, conv, [])):
                    out[k].append(v)
            out["ids"][-1].append(str(conv))
        out["ids"] = [",".join(ids) for ids in out["ids"]]
        yield pa.RecordBatch.from_pydict(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the id texts of each node, one after the other: one hash state at a time, whatever the node's size."""
    last, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"x1": [last[0]], "x2": [last[1]], "depth": [last[2]], "ends_sha256": [state.hexdigest()]})

    for batch in batches:
        done: list[pa.RecordBatch] = []
        for x1, x2, depth, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
            if last == (x1, x2, depth):
                state.update(b"," + ids.encode())
                continue
            if last is not None:
                done.append(row())
            last, state = (x1, x2, depth), hashlib.sha256(ids.encode())
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if last is not None:
        yield row()


def end_lists(prefixes: DataFrame) -> DataFrame:
    """(x1, x2, depth, ends_sha256): hash of the ids that end at a node, ascending, comma-joined.

    The ids are sorted and written as text by ranges of (node, id); what one task reads per node is one
    row per run, and it keeps only the state of the hash, which is sequential by definition.
    """
    ends = prefixes.where("depth = length").select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    texts = ends.mapInArrow(_id_texts, "x1 long, x2 long, depth long, first long, ids string")
    runs = texts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return runs.mapInArrow(_digests, "x1 long, x2 long, depth long, ends_sha256 string")


def prefix_tree(conversations: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node.

    A node is a distinct sequence of the first ``depth`` turns (role, text) of rebuilt conversations, from
    the root without turns; ``conv_id`` is the smallest conversation that starts with it.  ``saved_tokens``
    adds up, over the subtree, (n_convs - 1) times the code points of each node's last text.

    Null role and text are empty, null turns come first, equal turns go by the hash of role and text,
    repeated rows are turns of their own, rows without conv_id are left out, other columns are ignored.
    Conversations without any turn left are members of the root.  An empty table gives no rows, not even a root.
    """
    prefixes, places = rebuilt(conversations.select("conv_id", "turn", "role", "text"), most, block)
    sequences = weighted_sequences(prefixes)
    # One conversation stands for all that are identical: only its rows go on.
    chosen = places.join(sequences.select("conv_id"), "conv_id", "left_semi")
    rows = cut(prefixes.join(chosen, ["conv_id", "part"], "left_semi"))
    inner = rows.where("depth < length").select(*NODE).distinct()
    leaves = sequences.join(inner, NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))

    # The smallest member owns a node; along a sequence it owns all nodes from some depth on.
    owners = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        ((F.min("p1") != F.max("p1")) | (F.min("p2") != F.max("p2")) | (F.min("digest") != F.max("digest"))).alias("differ"))
    owned = cut(owners.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_owned"), F.sum("chars").alias("owned_chars"), F.max("differ").alias("differ")))
    if owned.agg(F.max("differ")).first()[0]:
        raise RuntimeError("two prefixes share their 128-bit name; take other SALTS")
    about = sequences.select("conv_id", "weight", "total").join(owned.drop("differ"), "conv_id", "left").join(leaves, "conv_id", "left").na.fill(
        0, ["n_owned", "owned_chars", "leaf"])
    known = rows.join(chosen.join(about, "conv_id"), ["conv_id", "part"])
    top = F.col("length") + 1 - F.col("n_owned")
    rest = F.col("total") - F.col("through") + F.col("chars")
    nodes = cut(known.groupBy(*NODE).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max(F.when(F.col("depth") >= top, F.col("conv_id"))).alias("conv_id"),
        F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        (F.sum(F.col("weight") * rest) - F.sum(F.least(rest, F.col("owned_chars")))).alias("saved_tokens"),
        F.max((F.col("depth") == top).cast("int")).alias("is_top")))
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("is_top").alias("n_tops"))
    full = cut(nodes.join(children, NODE, "left").join(end_lists(prefixes), NODE, "left").na.fill(0, ["n_children", "n_tops"]))
    # Below the top node of an owner the parent has the same owner; only the tops look theirs up.
    parents = full.where("n_tops > 0").select(
        F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("depth").alias("p_depth"), F.col("conv_id").alias("parent_conv_id"), "n_tops")
    tops = full.where("is_top = 1 AND depth > 0").withColumn("p_depth", F.col("depth") - 1).drop("n_tops")
    found = hot_lookup(tops, parents, ["p1", "p2", "p_depth"], "n_tops", "x1")
    others = full.where("is_top = 0 OR depth = 0").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    return found.select(*out, ends).unionByName(others.select(*out, ends))


# CRC-32 has no function in DuckDB: eight steps of the polynomial per character.
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % {BLOCK} AS base, conv_id::VARCHAR AS dec FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, base, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(dec, ''), lambda s: ascii(s)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                       lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))) % {MOST} AS h
  FROM ids),
parts AS (
  SELECT h.conv_id, 0 AS own, t.i, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.base AND t.i < h.h
  UNION ALL
  SELECT h.conv_id, 1, t.i, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.i >= h.h),
whole AS (
  SELECT h.conv_id, coalesce(list(struct_pack(role := p.role, text := p.text) ORDER BY p.own, p.i) FILTER (p.i IS NOT NULL), []) AS seq
  FROM heads h LEFT JOIN parts p ON p.conv_id = h.conv_id GROUP BY h.conv_id),
prefixes AS (SELECT conv_id, len(seq) AS n, d::BIGINT AS depth, seq[1:d] AS key FROM whole, unnest(range(0, len(seq) + 1)) AS r(d)),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.key[1:n.depth] = n.key) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]),
below AS (
  SELECT key[1:d] AS key, d::BIGINT AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
         sum((n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(key[depth].text) END)::BIGINT AS saved_tokens
  FROM linked, unnest(range(0, depth + 1)) AS r(d) GROUP BY 1, 2)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children, b.n_leaves, b.saved_tokens, l.ends_sha256
FROM linked l JOIN below b ON b.key = l.key AND b.depth = l.depth
"""
