"""Document operators against brute force, and on nulls, blanks, long texts, repeated rows and empty tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from firegrid.llm import decontaminate, mixing, passages, privacy, quality, simhash, substrings

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---- near duplicates

def brute_print(text):
    w = SPACE.findall(lower(text))
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints):
    keys = sorted(set(prints))
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(a ^ b).count("1") <= 2:
                parent[find(a)] = find(b)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash(docs, rows, crowd):
    got = simhash.near_duplicates(docs, crowd=crowd).select("doc_id", simhash.hex_print(simhash.F.col("fp")).alias("h"), "component_id").collect()
    prints = [brute_print(r[1]) for r in rows]
    part = brute_components(prints)
    smallest = defaultdict(list)
    for r, p in zip(rows, prints):
        if r[0] is not None:
            smallest[part[p]].append(r[0])
    want = Counter((r[0], f"{p:016x}", min(smallest[part[p]], default=None)) for r, p in zip(rows, prints))
    assert Counter(tuple(r) for r in got) == want


def test_links_of_close_prints(spark):
    """Chains and stars of one and two flipped bits around crowded and lonely values."""
    rng = random.Random(3)
    values = set()
    for _ in range(20):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(rng.choice([0, 3, 60])):
            values.add(v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for crowd in (4, 1000):
        parent = {v: v for v in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in simhash.links(nodes, crowd).collect():
            assert bin((r.src ^ r.dst) & (1 << 64) - 1).count("1") <= 2
            parent[find(r.src)] = find(r.dst)
        want = brute_components([v & (1 << 64) - 1 for v in signed])
        groups, expect = defaultdict(set), defaultdict(set)
        for v in signed:
            groups[find(v)].add(v)
            expect[want[v & (1 << 64) - 1]].add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_keep_first(docs, rows):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    got = kept.select("doc_id", "text").collect()
    comp = {}
    for r in simhash.near_duplicates(docs).collect():
        comp[r.doc_id] = r.component_id
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted({c for c in comp.values() if c is not None})


# ---- quality

def brute_quality(text):
    t = text or ""
    w = SPACE.findall(t)
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(win)
    covered = {i + k for i, x in enumerate(win) if n[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, rows):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(docs).collect())
    want = Counter()
    for r in rows:
        c = brute_quality(r[1])
        want[(r[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert got == want


def test_quality_verdict_does_not_depend_on_the_order(docs):
    kept = Counter(r.doc_id for r in quality.judge(docs).where("kept").collect())
    conditions = dict(reversed(quality.rules().items()))
    assert kept == Counter(r.doc_id for r in quality.judge(docs, conditions, sample_rows=3).where("kept").collect())
    assert kept


# ---- privacy

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_spans(t):
    t = t or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m)) <= 19 and brute_luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]


def test_base_spans():
    rng = random.Random(1)
    pieces = ["a@b.c", "x.y+1@mail-2.example.com", "@", ".", "..", "1.2.3.4", "256.1.1.1", "00001.2.3.4", "5.", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "+1 (386) 555-3733", "+", "+4", "-", " ", "\n", "é", "a", "9", "49927398716", "@a.b@c.d", "%", "1.2.3.4.5.6.7.8", "()", "+49.30.1234567 "]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert privacy.base_spans(t) == brute_spans(t), t
    assert privacy.base_spans(None) == privacy.base_spans("") == []
    for long in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a.b@" * 60_000):
        assert isinstance(privacy.base_spans(long), list)  # linear time


def test_disclosing_terms(spark):
    """A name that only ever stands beside one address gives it away, also where the address is missing."""
    rng = random.Random(2)
    filler = lambda: " ".join(rng.choice("alpha beta gamma delta omega kappa".split()) for _ in range(8))
    rows = [(i, f"{filler()} Zorblat wrote zz@mail.example.com {filler()}") for i in range(6)]
    rows += [(6, f"{filler()} Zorblat, again {filler()}"), (7, filler()), (8, None), (9, ""), (None, f"{filler()} zorblat")]
    rows += [(100 + i, filler() + " wrote") for i in range(40)]
    rows += [(200 + i, "copied Qwertle aa@mail.example.com text") for i in range(9)]  # copies of one text prove nothing
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.terms for r in privacy.find_spans(df).collect()}
    text = dict(rows)
    for i in [*range(7), None]:
        assert [text[i][s.start:s.end].lower() for s in found[i]] == ["zorblat"], i
    assert all(not found[i] for i in found if i is not None and i > 6)
    safe = {r.doc_id: r.text for r in privacy.sanitise(df).collect()}
    assert "[TERM]" in safe[6] and "[EMAIL]" in safe[0] and safe[8] is None and safe[7] == text[7]


def test_privacy_edges(docs, rows, no_docs):
    got = privacy.find_spans(docs)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r[0] for r in rows)
    safe = privacy.sanitise(docs)
    assert safe.columns == docs.columns and safe.count() == len(rows)
    assert privacy.find_spans(no_docs).count() == privacy.sanitise(no_docs).count() == 0


# ---- mixing

def test_mixing(docs, rows, no_docs):
    got = mixing.mix(docs).collect()
    size = lambda t: len(SPACE.findall(t or ""))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], size(r[1])) for r in rows)
    assert Counter(r.taken for r in got) == Counter(r.taken for r in mixing.mix(docs.repartition(7)).collect())
    total = sum(r.size for r in got)
    # The budget is used up to the one copy that no longer fits.
    assert total - max(r.size for r in got) <= sum(r.taken for r in got) <= total
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mix(no_docs).count() == 0


def test_mixed_rows(docs, rows, no_docs):
    taken = {}
    for r in mixing.mix(docs).collect():
        taken.setdefault(r.doc_id, []).append(r.n_taken)
    got = mixing.mixed(docs)
    assert got.columns == [*[c for c in docs.columns if c != "taken"], "copies", "taken"]
    for r in got.collect():
        assert r.copies in taken[r.doc_id] and r.taken == r.copies * len(SPACE.findall(r.text))
    assert {r.doc_id for r in got.collect()} == {d for d, n in taken.items() if any(n)}
    assert mixing.mixed(no_docs).count() == 0


def test_targets(spark):
    """Water-filling against the rule applied step by step."""
    rng = random.Random(4)
    for _ in range(6):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 10, 100, 5000]) for i in range(rng.randrange(1, 9))} | ({None: 7} if rng.random() < 0.5 else {})
        names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        want, free, rest = {}, set(names), float(sum(sizes.values()))
        while free:
            w = sum(weight[s] for s in free)
            over = {s for s in free if rest * weight[s] / w > 3 * sizes[s]}
            if not over:
                want |= {s: rest * weight[s] / w for s in free}
                break
            want |= {s: 3.0 * sizes[s] for s in over}
            rest -= sum(3.0 * sizes[s] for s in over)
            free -= over
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size bigint")).collect()}
        assert got == pytest.approx(want)


# ---- passages

def test_passages(spark, docs, rows, no_docs):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"q{rng.randrange(9000)}{'.' if rng.random() < 0.12 else ''}" for _ in range(n))
    passage, unending = prose(70), " ".join(f"u{rng.randrange(9000)}" for _ in range(120))
    data = [(1, prose(40) + " " + passage + " " + prose(30)), (2, passage), (3, prose(50) + "\n" + passage + "\n" + prose(20)),
            (4, prose(200)), (5, prose(25) + " " + unending + " " + prose(9)), (6, prose(7) + " " + unending), (7, "Short line here.\n" * 3)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r.doc_id: sum(s.end - s.start for s in r.spans) for r in passages.find_repeats(df).collect()}
    assert got[1] == got[4] == got[5] == 0
    for i, text in ((2, passage), (3, passage), (6, unending)):
        assert 0.7 * len(text) <= got[i] <= len(text) + 2
    cut = {r.doc_id: r.text for r in passages.without_repeats(df).collect()}
    for d, t in data:
        assert len(cut[d]) == len(t) - got[d]
    edge = passages.find_repeats(docs).collect()
    assert Counter(r.doc_id for r in edge) == Counter(r[0] for r in rows)
    spans = {r.doc_id: r.spans for r in edge}
    assert all(sum(s.end - s.start for s in spans[40 + i]) > 0 for i in range(8) if len(rows[i][1].split()) > 40)
    assert passages.find_repeats(no_docs).count() == 0


# ---- decontamination

def brute_hits(text, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    w, hit, ids = find(text), set(), set()
    for item, t in items:
        x = find(t)
        n = min(13, len(x))
        for win in {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else ():
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) == win:
                    hit |= set(range(i, i + n))
                    ids.add("" if item is None else str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("max_windows", [10**6, 40])
def test_decontamination(spark, docs, rows, max_windows):
    items = [(1, rows[0][1]), (2, rows[1][1][:60]), (3, "w1 w2"), (4, None), (5, "..."), (None, "a"), (7, rows[2][1].upper()), (7, "extra"), (8, "漢字 z")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.find_contamination(docs, bench, max_windows=max_windows).collect())
    want = Counter()
    for r in rows:
        n, hit, ids = brute_hits(r[1], items)
        want[(r[0], n, hit, tuple(ids))] += 1
    assert got == want
    kept = decontaminate.decontaminate(docs, bench, max_windows=max_windows)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for (d, n, h, _), c in want.items() if not (h and 20 * h >= n) for _ in range(c))


def test_decontamination_empty(spark, docs, no_docs, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_contamination(docs, none).where("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(docs, none).count() == len(rows)
    assert decontaminate.find_contamination(no_docs, none).count() == 0


# ---- substrings

def brute_runs(texts, n):
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                hit[i:i + n] = b"\x01" * n
        out.append([m.span() for m in re.finditer(b"\x01+", bytes(hit))])
    return out


def test_substrings(docs, rows):
    short = [r for r in rows if r[1] is None or len(r[1]) < 40_000]
    df = docs.where("text IS NULL OR length(text) < 40000")
    got = Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), r.kept_sha256) for r in substrings.remove_repeats(df).collect())
    texts = [(r[1] or "").encode() for r in short]
    want = Counter()
    for r, t, runs in zip(short, texts, brute_runs(texts, 200)):
        kept = t
        for a, b in reversed(runs):
            kept = kept[:a] + kept[b:]
        want[(r[0], len(t), tuple(runs), hashlib.sha256(kept).hexdigest())] += 1
    assert got == want


@pytest.mark.parametrize("crowd", [20_000, 3])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh"])
def test_substrings_small(spark, alphabet, crowd):
    rng = random.Random(len(alphabet))
    part = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 5, 30, 150]))) for _ in range(25)]
    texts = [a + b + a for a, b in zip(part, part[1:] + part[:1])] + ["a" * 100, "ab" * 60, "abc" * 70, "", None] + part[:3] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in substrings.remove_repeats(df, 12, 4, crowd).collect()}
    assert [got[i] for i in range(len(texts))] == brute_runs([(t or "").encode() for t in texts], 12)


def test_suffix_sort_survives_collisions(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (150, 9)).astype(np.uint16)
    for broken in (False, True):
        if broken:  # every prefix hash equal: the comparison is wrong, the verification must notice
            monkeypatch.setattr(substrings, "_prefix_hashes", lambda r: np.zeros((r.shape[1] + 1, r.shape[0]), np.uint64))
        order, common = substrings.suffix_sort(rows)
        keys = [rows[i].astype(">u2").tobytes() for i in order]
        assert keys == sorted(keys)
        for k in range(1, len(order)):
            a, b = rows[order[k - 1]].tolist(), rows[order[k]].tolist()
            assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))


def test_substrings_long_and_empty(docs, no_docs):
    got = {r.doc_id: r for r in substrings.remove_repeats(docs, with_kept=False).collect()}
    long = [r for r in got.values() if r.n_bytes >= 50_000]
    assert len(long) == 2 and all(r.n_removed == r.n_bytes for r in long)
    assert substrings.remove_repeats(no_docs).count() == 0
