import hashlib
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firegrid.llm import alignment

FILES = (Path(alignment.A_FILE).read_bytes(), Path(alignment.B_FILE).read_bytes())
ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b\n\n  c ", "漢字 é🙂  x", "<|endoftext|> <s></s> <0x41> <unk>",
    "▁ lower line", "a ▁", "\x00\x1c \x85 x", "it's  'we'll' 12345 €", "é क्षि \U0001F468‍\U0001F469", "x" * 20_000, "ab " * 3_000, " " * 3_000, "日本" * 2_000,
]


def encoders():
    a = Tokenizer.from_str(FILES[0].decode())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=FILES[1])


A, B = encoders()
ALPHABET = alignment.byte_alphabet()


def plain(text):
    """Ids and bytes of the tokens of a whole text, by the definition; None if they do not give it back."""
    if not text:
        return None
    a = [(i, bytes(ALPHABET[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()) for i in B.encode(text) for p in [B.id_to_piece(i)]]
    raw = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == raw == b"".join(t for _, t in b) else None


def ends(tokens):
    out, at = [], 0
    for i, raw in tokens:
        at += len(raw)
        out.append((i, at))
    return out


def groups(a, b):
    common = sorted({e for _, e in ends(a)} & {e for _, e in ends(b)})
    text, start = [], 0
    for c in common:
        text.append("|".join(",".join(str(i) for i, e in ends(side) if start < e <= c) for side in (a, b)))
        start = c
    return ";".join(text)


def brute(texts):
    sides = [plain(t) for t in texts]
    links = [[(i, j) for i, e in ends(s[0]) for j, f in [x for x in ends(s[1]) if x[1] == e]] if s else [] for s in sides]
    counts = Counter(x for doc in links for x in doc)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for s, doc in zip(sides, links):
        g = groups(*s) if s else ""
        out.append((
            len(s[0]) if s else 0, len(s[1]) if s else 0, g.count(";") + 1 if g else 0, len(doc), sum(counts[x] == best[x[1]] for x in doc),
            sum(counts[x] for x in doc), hashlib.sha256(g.encode()).hexdigest() if g else ""))
    return out


def test_alphabet():
    assert sorted(ALPHABET.values()) == list(range(256)) and ALPHABET["Ġ"] == 32 and ALPHABET["Ċ"] == 10


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t▁ae<>0x'.")), max_size=40), max_size=4))
def test_stretches_are_whole_texts(texts):
    """Encoding by stretches gives the tokens of the whole text, and every stretch is found again."""
    pair = alignment._pair(FILES)
    which, n = pair.encode(texts)
    at = 0
    for text, k in zip(texts, n.tolist()):
        assert "".join(pair.stretches(text)) == " " + text
        want = plain(text)
        mine, at = which[at : at + k], at + k
        if want is None:
            assert k == 0
            continue
        for side, tokens in zip(want, (pair.a_tokens, pair.b_tokens)):
            ids, lens, _ = tokens.take(mine)
            assert ids.tolist() == [i for i, _ in side] and lens.tolist() == [len(raw) for _, raw in side]


def test_forgets(monkeypatch):
    """What a worker keeps of earlier stretches does not change anything."""
    monkeypatch.setattr(alignment, "KEPT", 2)
    pair = alignment.Pair(*FILES)
    for _ in range(2):
        for t in ("one two three", "four five one", "two"):
            which, _ = pair.encode([t])
            assert pair.a_tokens.take(which)[0].tolist() == A.encode(" " + t, add_special_tokens=False).ids


def test_against_definition(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 3000").limit(60).select("text").collect()
    texts = ODD[:-4] + [r.text for r in rows] + ["one two", "one two"]
    df = spark.createDataFrame([(None if k == 3 else k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("pairs", "times", "n_a", "n", "col", "groups_sha256")])
    found = alignment.align(df)
    assert sorted(tuple(r)[1:] for r in found.collect()) == sorted(brute(texts))
    assert sorted(r.doc_id for r in found.where("doc_id IS NOT NULL").collect()) == [k for k in range(len(texts)) if k != 3]


def test_long_texts(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in alignment.align(df, with_tokens=True).collect()}
    for k, t in enumerate(ODD):
        want = plain(t)
        got = found[k]
        assert (got.a_ids, got.b_ids) == (([i for i, _ in want[0]], [i for i, _ in want[1]]) if want else ([], []))
        assert (got.a_ends, got.b_ends) == (([e for _, e in ends(want[0])], [e for _, e in ends(want[1])]) if want else ([], []))


def test_no_documents(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    none = alignment.align(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in none) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]


def test_bound_of_pairs():
    """No corpus can link more pairs than the vocabularies allow, and that is a small table."""
    pair = alignment._pair(FILES)
    assert alignment.possible_pairs(FILES) < 1_000_000
    a, b = pair.a_bytes, pair.b_bytes
    some_a, some_b = a[:400], b[3:700]
    want = sum(x.endswith(y) or y.endswith(x) for x in some_a for y in some_b if x and y)
    small = alignment.Pair.__new__(alignment.Pair)
    small.a_bytes, small.b_bytes = some_a, some_b
    alignment._PAIRS["small"] = small
    key = alignment._pair
    try:
        alignment._pair = lambda files: small
        assert alignment.possible_pairs(FILES) == want
    finally:
        alignment._pair = key
