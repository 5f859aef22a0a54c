"""Passages whose surroundings make every line and sentence around them different."""

import random
from itertools import groupby

import numpy as np
import pytest

from firegrid.llm import passages


@pytest.mark.parametrize("case", ["halves", "inside"])
def test_passage_in_foreign_sentences(spark, case):
    rng = random.Random(21)
    words = lambda n: [f"q{rng.randrange(9000)}" for _ in range(n)]
    foreign = lambda: " ".join(words(rng.randrange(2, 5)))
    first, second = [], []
    for _ in range(100):
        a, b = words(27), words(27)
        text = " ".join([*a[:-1], a[-1] + ".", *b])
        if case == "halves":
            first.append(f"{foreign()} {text} {foreign()}.")
            second.append((f"{foreign()} {text} {foreign()}.", text))
        else:
            first.append(f"{' '.join(words(6))}. {text}. {' '.join(words(6))}.")
            second.append((f"{' '.join(words(10))} {text} {' '.join(words(10))}", text))
    docs = [(i, t) for i, t in enumerate(first)] + [(1000 + i, t) for i, (t, _) in enumerate(second)]
    found = {r.doc_id: r.spans for r in passages.find_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert all(not found[i] for i in range(100))
    hit = 0
    for i, (t, text) in enumerate(second):
        spans = found[1000 + i]
        a = t.index(text)
        assert all(a - 1 <= s.start and s.end <= a + len(text) + 1 for s in spans)
        hit += sum(s.end - s.start for s in spans) >= 0.3 * len(text)
    assert hit >= 95


def test_pieces_cover_the_text_once():
    rng = random.Random(2)
    text = "\n".join(" ".join(f"É{rng.randrange(99)}" for _ in range(rng.randrange(1, 20))) for _ in range(50))
    got = passages.pieces_of(text)
    assert sum(n for _, _, n, _ in got) == len(text.split()) and len(got) > 20
    assert " ".join(text[a:b].replace("\n", " ") for a, b, _, _ in got) == text.replace("\n", " ")
    assert passages.pieces_of(None) == [] and len(passages.pieces_of("ab " * 30_000)) <= 2


def loops(units, min_line_words=passages.MIN_LINE_WORDS, min_run_words=passages.MIN_RUN_WORDS):
    """Spans to remove from different units (at, line, start, end, words, edge) of one document, one unit at a time."""
    spans = []
    for pieces in (False, True):
        part = sorted(u for u in units if (u[1] == passages.PIECE_LINE) == pieces)
        for _, run in groupby(enumerate(part), key=lambda x: x[1][0] - x[0]):
            run = [u for _, u in run]
            if sum(u[4] for u in run) >= min_run_words:
                spans.append((run[0][2], run[-1][3]))
                continue
            for _, line in groupby(run, key=lambda u: u[1]):
                line = list(line)
                if line[0][5] & 1 and line[-1][5] & 2 and sum(u[4] for u in line) >= min_line_words:
                    spans.append((line[0][2], line[-1][3]))
    out = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def test_spans_of_many_documents_at_once():
    rng = random.Random(7)
    docs = []
    for _ in range(400):
        units = set()
        for _ in range(rng.randrange(25)):
            at, line = rng.randrange(12), rng.choice([0, 0, 1, 2, passages.PIECE_LINE])
            start = at * 10 + rng.choice([0, 0, 3])
            units.add((at, line, start, start + rng.choice([9, 10, 25]), rng.randrange(1, 9), 0 if line < 0 else rng.randrange(4)))
        docs.append(units)
    rows = [(d, *u) for d, units in enumerate(docs) for u in units]
    rng.shuffle(rows)
    found = [[] for _ in docs]
    for d, a, b in zip(*(x.tolist() for x in passages.removed_spans(*map(np.array, zip(*rows))))):
        found[d].append((a, b))
    assert found == [loops(units) for units in docs]
    assert sum(map(len, found)) > 200
    none = np.zeros(0, np.int64)
    assert all(len(x) == 0 for x in passages.removed_spans(*[none] * 7))


def test_units_are_exchanged_as_few_numbers(spark):
    texts = ["One line of words.\nOne line of words. And more", None, " \n\t", "É b c d e f g h\x1ci j k l m n"]
    scanned = passages._scan({"doc_id": list(range(4)), "text": texts})
    df = spark.createDataFrame([(7, scanned["units"][0].as_py())], f"doc_id bigint, units {passages._UNITS}")
    got = passages.packed_units(df)
    assert got.columns == ["doc_id", "digest", "size", "tag", "span"]
    back = sorted((r.size >> 32, r.tag >> 3, r.span >> 32, r.span % 2**32, r.size % 2**32, r.tag >> 1 & 3, r.digest, bool(r.tag & 1)) for r in got.collect())
    assert back == sorted(tuple(u.values()) for u in scanned["units"][0].as_py())
    for text, units in zip(texts, scanned["units"].to_pylist()):
        want = [u[:-1] for u in passages.units_of(text)] + [(passages.PIECE_LINE, *p[:-1]) for p in passages.pieces_of(text)]
        assert [(u["line"], u["start"], u["end"], u["words"]) for u in units] == want
    assert [u["again"] for u in scanned["units"][0].as_py() if u["line"] >= 0] == [False, True, False]
    assert [u["edge"] for u in scanned["units"][0].as_py() if u["line"] >= 0] == [3, 1, 2]
