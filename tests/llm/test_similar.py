"""Near copies by exact shingle similarity, against all pairs."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from firegrid.llm import similar
from .conftest import SCHEMA


def shingle_set(text, width=5):
    w = (text or "").lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def corpus():
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    out = []
    for _ in range(60):
        base = prose(rng.randrange(40, 400))
        out += [base, base + " tail", edited(rng, base, 1), edited(rng, base, rng.randrange(1, 8))]
    # A family whose members are similar to its original, most of them not to each other.
    base = prose(150)
    out += [edited(rng, base, 2) for _ in range(150)] + [base]
    out += [None, "", " \n", "a b", "A  b", "a b c", *out[:5]]
    rng.shuffle(out)
    return out


def test_against_all_pairs(spark):
    texts = corpus()
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r.component_id for r in similar.near_duplicates(docs).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    kept = similar.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_stage_removes_near_copies(spark):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randrange(4000)}" for _ in range(100)) for _ in range(20)]
    near = [b + " tail" for b in base[:10]] + [edited(rng, b, 1) for b in base[10:]]
    assert all(0.8 <= jaccard(shingle_set(a), shingle_set(b)) < 1 for a, b in zip(base, near))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(base + near)], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == list(range(20))


def test_rows_without_id(spark, docs, no_docs):
    assert similar.keep_first(no_docs).count() == 0
    lone = spark.createDataFrame([(None, "one two three four five six", None, None, None)] * 3 + [(None, None, None, None, None)], SCHEMA)
    assert sorted((r.text or "") for r in similar.keep_first(lone).collect()) == ["", "one two three four five six"]
    kept = similar.keep_first(docs.withColumn("extra", F.lit(1)))
    found = {r.component_id for r in similar.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(found - {None})


def test_a_family_around_a_passage_takes_no_pairs(spark, monkeypatch):
    """2 000 texts share a passage and lie at 0.6 to 0.9 of each other: the links are those of all pairs, few pairs are looked at."""
    import numpy as np

    rng = random.Random(12)
    passage = [f"p{k}" for k in range(110)]
    base = passage + [f"q{k}" for k in range(40)]
    texts = []
    for k in range(2000):
        if k % 2:
            own = passage + [f"own{k}x{j}" for j in range(rng.randrange(18, 40))]  # only the passage in common
            texts.append(" ".join(own))
            if k % 40 == 1:
                texts.append(edited(rng, " ".join(own), 1))
        else:
            texts.append(edited(rng, " ".join(base), rng.randrange(1, 5)))
    sets = [similar.shingles(t.encode()) for t in texts]
    number = {}
    rows = [[number.setdefault(h, len(number)) for h in s.tolist()] for s in sets]
    has = np.zeros((len(texts), len(number)), np.float32)
    for r, c in enumerate(rows):
        has[r, c] = 1
    both, n = has @ has.T, has.sum(1)
    linked = both / (n[:, None] + n[None, :] - both) >= 0.8
    label = np.arange(len(texts))
    while True:
        new = np.array([label[row].min() for row in linked])
        if (new == label).all():
            break
        label = new
    looked_at = []
    verified = similar._verified
    monkeypatch.setattr(similar, "_verified", lambda pairs, *rest: (looked_at.append(pairs.count()), verified(pairs, *rest))[1])
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r.component_id for r in similar.near_duplicates(docs).collect()}
    assert got == dict(enumerate(label.tolist()))
    assert sum(looked_at) < 20 * len(texts), looked_at


def test_prints_link_first(spark):
    """SimHash prints within two bits propose pairs of their own, and what they propose is verified."""
    rng = random.Random(9)
    bases = [" ".join(f"w{rng.randrange(4000)}" for _ in range(600)) for _ in range(20)]
    texts = bases + [b + " tail" for b in bases] + [None, "a b"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    rows = similar.signatures(docs).withColumnRenamed("doc_id", "first_doc").drop("keys").cache()
    node = {r.first_doc: r for r in rows.collect()}
    near = {(a, b) for a in range(40) for b in range(40) if a < b and bin((node[a].print ^ node[b].print) & (2**64 - 1)).count("1") <= 2}
    found = {tuple(sorted((r.src, r.dst))) for r in similar.by_print(rows).collect()}
    assert len(near) >= 15 and found == {tuple(sorted((node[a].fp, node[b].fp))) for a, b in near}
    # Without any band the prints alone link these pairs.
    nodes = rows.withColumn("keys", F.array().cast("array<bigint>"))
    linked = {tuple(sorted((r.src, r.dst))) for r in similar.links(docs, nodes).collect()}
    assert linked == found
