import math
import random
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from firegrid.llm import language_model as lm
from firegrid.llm.ngram_trie import DISCOUNT, STEP, EliasFano, Trie, code_of, select_in_word

SCHEMA = "doc_id bigint, text string"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1 << 45), max_size=200), st.lists(st.integers(0, 1 << 45), max_size=50), st.sampled_from([1, 7, 1 << 20, 1 << 46]))
def test_elias_fano(values, asked, most):
    v = np.sort(np.array(values, np.int64) % most)
    level = EliasFano(EliasFano.pack(v, most))
    assert level[np.arange(len(v))].tolist() == v.tolist()
    x = np.concatenate([np.array(asked, np.int64) % most, v])
    place, found = level.successor(x)
    assert place.tolist() == np.searchsorted(v, x).tolist() and found.tolist() == np.isin(x, v).tolist()


@given(st.integers(1, (1 << 64) - 1))
def test_select(x):
    bits = [k for k in range(64) if x >> k & 1]
    assert select_in_word(np.full(len(bits), x, np.uint64), np.arange(len(bits))).tolist() == bits


def triples(rng, n, contexts=12, words=30):
    seen = Counter((rng.randrange(contexts) * 5, rng.randrange(words), rng.randrange(words)) for _ in range(n))
    key, u, w = (np.array(x, np.int64) for x in zip(*seen))
    return seen, key, u, w, np.array(list(seen.values()), np.int64)


def probability(seen, p1, k, u, w):
    """Interpolated absolute discounting by its formula."""
    def step(rows, lower):
        total = sum(rows.values())
        return (max(rows[w] - DISCOUNT, 0) + DISCOUNT * len(rows) * lower) / total if total else lower
    pair, triple = Counter(), Counter()
    for (k2, u2, w2), n in seen.items():
        if k2 == k:
            pair[w2] += n
            if u2 == u:
                triple[w2] += n
    return step(triple, step(pair, p1[w]))


def test_trie_against_formula():
    rng = random.Random(2)
    seen, key, u, w, n = triples(rng, 400)
    p1 = np.array([1 / 2 ** (1 + k % 5) for k in range(31)])
    p1 /= p1.sum()
    packed = Trie.pack(key, u, w, n, p1[w], 31)
    with tempfile.TemporaryFile() as file:  # the same levels out of a mapped file
        file.write(packed)
        file.flush()
        tries = [Trie.mapped(packed), Trie(np.memmap(file, np.uint8, "r"))]
        asked = [(k, x, y) for k in (0, 5, 7, 55, 99) for x in range(31) for y in range(31)]
        k, x, y = (np.array(c, np.int64) for c in zip(*asked))
        for trie in tries:
            got = trie.codes(k, x, y, code_of(p1[y]))
            want = [-math.log10(probability(seen, p1, *a)) * STEP for a in asked]
            assert np.abs(got - want).max() < 2
            sums = defaultdict(float)
            for (a, b, _), c in zip(asked, got):
                sums[a, b] += 10 ** (-c / STEP)
            assert all(abs(s - 1) < 1e-3 for s in sums.values())


def test_empty_trie():
    none = np.zeros(0, np.int64)
    trie = Trie.mapped(Trie.pack(none, none, none, none, none.astype(float), 5))
    assert trie.codes(np.array([3, -1]), np.array([1, 2]), np.array([1, 1]), np.array([7, 8])).tolist() == [7, 8]


def mix(h, x):
    z = (h ^ (x % 2**64)) * 0x9E3779B97F4A7C15 % 2**64
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    return z ^ z >> 31


def brute(rows, heavy):
    """The whole model one token at a time; ids by rank, as one shard of words gives them."""
    docs = []
    for i, t in rows:
        raw = (t or "").encode()
        docs.append((i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, [*bytes(b + 32 if 65 <= b <= 90 else b for b in raw).split(), b""]))
    c = Counter(w for _, held, ws in docs if not held for w in ws)
    total, vocabulary = sum(c.values()), len(c)
    number = {w: k for k, w in enumerate(sorted(c, key=lambda w: (-c[w], w)))}

    def context(i, ws, at):
        words = ws[:at][::-1]
        v = words[0] if words else b""
        h, state = 0, c[v]
        if c[v] > heavy:
            doc = mix(1, i or 0)
            for k in range(1, lm.HISTORY + 1):
                if len(words) < k:
                    h = mix(h, doc)
                    break
                if k == lm.HISTORY:
                    h = mix(h, doc)
                    break
                last = words[k] if len(words) > k else b""
                h = mix(h, number.get(last, -1))
                if c[last] <= heavy:
                    break
        classes = -(-c[v] // heavy)
        return (v, h % classes if c[v] > heavy else 0), words[1] if len(words) > 1 else b""

    seen = defaultdict(Counter)
    for i, held, ws in docs:
        if not held:
            for at, w in enumerate(ws):
                k, u = context(i, ws, at)
                seen[k][w] += 1
                seen[k, u][w] += 1

    def step(rows, w, lower):
        n = sum(rows.values())
        return (max(rows[w] - DISCOUNT, 0) + DISCOUNT * len(rows) * lower) / n if n else lower

    out = []
    for i, held, ws in docs:
        p1 = [(c[w] + 0.5) / (total + 0.5 * (vocabulary + 1)) for w in ws]
        score = 0.0
        for at, w in enumerate(ws):
            k, u = context(i, ws, at)
            # Behind an unknown word, and for words not learnt, nothing is seen.
            p2 = step(seen.get(k, Counter()), w, p1[at]) if c[k[0]] else p1[at]
            p3 = step(seen.get((k, u), Counter()), w, p2) if c[k[0]] and c[u] else p2
            score += math.log10(p3)
        out.append((i, held, len(ws), sum(c[w] > 0 for w in ws), total, sum(map(math.log10, p1)), score))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choice(["the", "of", "a", "b", "The", f"w{rng.randrange(40)}"]) for _ in range(rng.randrange(0, 60)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "the " * 300), (104, "É ß the\x0bof\x1cof"), (105, "nowhere else\x85x"), (None, "the of a"), (None, None)]
    return rows + [rows[0], rows[0], (0, "another text the of")]


def check(found, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got = sorted((tuple(r) for r in found.collect()), key=order)
    want = sorted(want, key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert abs(g[6] - w[6]) <= 2 * g[2] / STEP + 1e-9, (g, w)


@pytest.mark.parametrize("heavy", [10**6, 15])
def test_against_formula(spark, heavy):
    """Also with many classes of contexts, small pieces and many shards."""
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("piece", "shard", "payload", "n", "v", "top", "held_out", "score")])
    check(lm.score(df, lm.every_fifth(F.col("doc_id")), piece=300, shard=200, heavy=heavy), brute(rows, heavy))


def test_sizes_do_not_matter(spark):
    """Scores are sums of whole codes: pieces and shards leave no trace, but for ids in the classes."""
    df = spark.createDataFrame(corpus(4), SCHEMA)
    order = lambda d: sorted((tuple(r) for r in d.collect()), key=str)
    one = order(lm.score(df.repartition(1), lm.every_fifth(F.col("doc_id"))))
    assert one == order(lm.score(df.repartition(7), lm.every_fifth(F.col("doc_id")), piece=100, word_shard=50, shard=60))


def test_nothing_to_learn(spark):
    assert lm.score(spark.createDataFrame([], SCHEMA), lm.every_fifth(F.col("doc_id"))).collect() == []
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 1]
    rows = [(k, "a b c") for k in held]
    check(lm.score(spark.createDataFrame(rows, SCHEMA), lm.every_fifth(F.col("doc_id"))), brute(rows, 10**6))


def test_long_text_and_better_than_unigrams(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice([f"x{j} y{j} z{j}" for j in range(20)]) for _ in range(100))) for k in range(50)]
    rows.append((1000, "x1 y1 z1 " * 40_000))
    found = [r for r in lm.score(spark.createDataFrame(rows, SCHEMA), lm.every_fifth(F.col("doc_id"))).collect() if r.held_out]
    assert found and all(r.score > 0.7 * r.base_score for r in found)


@pytest.mark.parametrize("crowd", [3, 15, 60])
def test_crowded_words_leave_no_trace(spark, crowd):
    """Successors of frequent words are spread over shards; the model and every code stay those of one shard."""
    rows = corpus(6) + [(k, " ".join(["the of a the the of"] * (k % 7))) for k in range(200, 230)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    order = lambda d: sorted((tuple(r) for r in d.collect()), key=str)
    whole = lm.score(df, lm.every_fifth(F.col("doc_id")), crowd=10**6)
    check(whole, brute(rows, 10**9))
    assert order(lm.score(df, lm.every_fifth(F.col("doc_id")), piece=300, shard=200, crowd=crowd)) == order(whole)


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(-1, 60), st.integers(-1, 9), st.integers(0, 8)), min_size=1, max_size=60), st.integers(0, 9))
def test_triples_are_sent_in_steps(rows, n_learns):
    rows = sorted(set(rows))
    key, u, w, doc = (np.array(x, np.int64) for x in zip(*rows))
    key, c, times = key << lm.CLASS_BITS, (w + 1) * 1000, doc + 1
    got = lm._triples(lm._packed_triples(key, u, w, c, doc, times, n_learns))
    assert all(a.tolist() == b.tolist() for a, b in zip(got, (key, u, w, c, doc, times, doc < n_learns)))


def payloads(n_shards):
    """Bytes of what a piece of 4000 short documents tells its shards."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(8)) for _ in range(4000)]
    told = pa.Table.from_batches([lm._tokenised(0, list(range(4000)), texts, [rng.random() < 0.7 for _ in texts], 1)])
    shard = np.array(told["shard"].to_pylist())
    numbered = lm._numbered(told.filter(pa.array(shard >= 0)), 1)
    whole = pa.concat_tables([told.filter(pa.array(shard < 0)), numbered.select(["piece", "shard", "payload"])])
    sent = lm._sent(whole, numbered["n"][0].as_py(), numbered["v"][0].as_py(), n_shards, None, 10**9, 1)
    return sum(len(p) for p, s in zip(sent["payload"].to_pylist(), sent["shard"].to_pylist()) if s >= 0), len(set(sent["shard"].to_pylist())) - 1


def test_payloads_do_not_repeat_the_documents():
    """Which documents are learnt is one number, not a list in every shard's payload."""
    (one, n_one), (many, n_many) = payloads(1), payloads(10**6)
    assert n_one == 1 and n_many > 40
    assert many - one < 400 * n_many


def test_repeated_phrases_compress():
    """Numbers of words go as whole two-byte numbers, in which phrases repeat; rare words beyond these come back."""
    rng = random.Random(4)
    phrases = [" ".join(f"w{rng.randrange(30000)}" for _ in range(8)) for _ in range(500)]
    texts = [" ".join(rng.choice(phrases) for _ in range(10)) for _ in range(400)]
    own = lm._tokenised(0, list(range(400)), texts, [True] * 400, 1)["payload"][0].as_py()
    *_, n, often, halves, over = lm.unpack(own)
    assert len(own) < 32400  # less than a byte a token
    assert n.sum() == len(lm._ranks(halves, over)) == 32400
    ranks = np.array([0, 65534, 65535, 65536, 3, 200000, 1])
    assert lm._ranks(*lm.unpack(lm.pack(*lm._halves(ranks)))).tolist() == ranks.tolist()


@pytest.mark.parametrize("n_parts", [2, 7])
def test_a_shard_is_worked_on_in_parts(monkeypatch, n_parts):
    """A shard's contexts go through several small tries, with the sums of one large trie; a piece sends one row to it."""
    rng = random.Random(6)
    pieces = []
    for piece in range(3):
        rows = sorted({(rng.randrange(40), rng.randrange(20), rng.randrange(20), rng.randrange(9)) for _ in range(300)})
        key, u, w, doc = (np.array(x, np.int64) for x in zip(*rows))
        pieces.append(lm._packed_triples(key << lm.CLASS_BITS, u, w, w + 1, doc, doc % 3 + 1, 6))
    table = lm._rows([0, 1, 2], [0, 0, 0], pieces)
    sizes, built = [], Trie.pack
    monkeypatch.setattr(Trie, "pack", classmethod(lambda cls, key, *rest: sizes.append(len(key)) or built(key, *rest)))
    whole, parts = (lm._scored(table, 1000, 20, 19, 1, n) for n in (1, n_parts))
    assert [lm.unpack(x)[1].tolist() for x in whole["payload"].to_pylist()] == [lm.unpack(x)[1].tolist() for x in parts["payload"].to_pylist()]
    assert len(sizes) == 1 + n_parts and sum(sizes[1:]) == sizes[0] and max(sizes[1:]) < sizes[0]
    assert parts["piece"].to_pylist() == [0, 1, 2]


def test_an_exchange_shard_holds_several_parts():
    assert lm.MOST_SHARD >= 8 * lm.PART and lm.SHARD >= 2 * lm.PART


def test_trie_searches_a_context_once(monkeypatch):
    """Neighbours of one context, or of one predecessor in it, are found by one search."""
    rng = random.Random(5)
    seen, key, u, w, n = triples(rng, 600, contexts=4, words=12)
    order = np.lexsort((w, u, key))
    key, u, w, n = key[order], u[order], w[order], n[order]
    p1 = np.full(len(w), 0.05)
    trie = Trie.mapped(Trie.pack(key, u, w, n, p1, 31))
    asked, find = [], Trie._find
    monkeypatch.setattr(Trie, "_find", staticmethod(lambda level, x, valid: asked.append(len(x)) or find(level, x, valid)))
    together = trie.codes(key, u, w, code_of(p1))
    assert asked[0] == len(set(key.tolist())) and asked[2] == len(set(zip(key.tolist(), u.tolist()))) < asked[1] == len(key)
    mixed = rng.sample(range(len(key)), len(key))
    alone = trie.codes(key[mixed], u[mixed], w[mixed], code_of(p1))
    assert alone.tolist() == together[mixed].tolist()
