import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from firegrid.llm import prefix_tree

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows, most=6, block=100):
    """The definition, one conversation at a time."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - c % block, [])[:h] + turns[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)

    def below(key):
        out, todo = [], [key]
        while todo:
            k = todo.pop()
            out.append(k)
            todo += children.get(k, [])
        return out

    out = []
    for key, ids in members.items():
        under = below(key)
        ends = ",".join(map(str, sorted(c for c in ids if len(built[c]) == len(key))))
        out.append((
            min(ids), len(key), min(members[key[:-1]]) if key else None, len(ids), len(children.get(key, [])),
            sum(k not in children for k in under), sum((len(members[k]) - 1) * len(k[-1][1]) for k in under if k),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 260), 1000, 1017, 5042]:  # 5042 has no first conversation
        for t in range(rng.randrange(0, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), f"é{rng.randrange(3)}" * rng.randrange(1, 4)))
    rows += [(700 + c, t, "user", "same") for c in range(40) for t in range(7)]
    rows += [(300, t, "user", f"long {t}") for t in range(400)] + [(301, t, "user", f"long {t}") for t in range(380)]
    rows += [(9, None, None, None), (9, None, "user", None), (9, 3, "user", "tie"), (9, 3, "user", "tie b"), (9, 3, "user", "tie b")]
    rows += [(None, 1, "user", "nobody's"), (11, 0, "a", "b"), (11, 0, "ab", ""), (13, 0, "", "x" * 30_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("spread", [False, True])
def test_against_definition(spark, spread):
    """Also when long conversations lie in several range partitions."""
    rows = corpus()
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"} if spread else {}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        df = df.select("*", *[F.lit("clash").alias(c) for c in ("part", "i", "depth", "x1", "p1", "digest", "chars", "length", "h", "base")])
        assert result(prefix_tree.prefix_tree(df)) == brute(rows)
        if spread:
            _, places = prefix_tree.sorted_turns(df)
            assert places.where("before > 0").count() > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_other_blocks(spark):
    rows = [(c, t, "user", f"{t}") for c in range(30) for t in range(c % 5)]
    assert result(prefix_tree.prefix_tree(spark.createDataFrame(rows, SCHEMA), most=3, block=10)) == brute(rows, 3, 10)


def test_no_conversations(spark):
    assert prefix_tree.prefix_tree(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_tree.prefix_tree(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).collect() == []


def test_all_the_same(spark):
    """One sequence for thousands of conversations: the ends are hashed in order of the number."""
    ids = list(range(100, 4000, 100))
    rows = [(c, t, "user", "hi") for c in ids for t in range(2)]
    got = result(prefix_tree.prefix_tree(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() in {r[-1] for r in got}
