"""The staged pipeline on a small corpus with planted cases, each stage on all that its predecessor kept."""

import random
import re

import pytest

import corpus_pipeline
from firegrid.session import cut


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    syllables = "ta re mi no ka lu pe so di va ri mo".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    docs, labels = [], []
    for i in range(600):
        text = prose(rng.randrange(40, 120))
        bad = i % 6 == 0
        docs.append((i, text + " blorgat" if bad else text))
        labels.append((i, 1, int(bad)))
    exam = [(k, prose(40)) for k in range(3)]
    docs += [(1000, docs[1][1]), (1001, docs[2][1]), (1002, docs[2][1] + " " + "tail")]
    docs += [(1010, prose(20) + " " + exam[0][1]), (1011, exam[1][1])]
    docs += [(1020, prose(30) + " write to someone@mail.example.com now"), (1021, None), (1022, "")]
    docs += [(1030, prose(30) + " b l o r g a t " + prose(30)), (1031, prose(20) + " bl0rgat " + prose(20))]
    rows = [(i, t, "en", f"src{i % 4}" if i % 7 else None, len(t or "")) for i, t in docs]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(exam, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {i: t for i, t in docs}


def test_stages(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = cut(stage(spark, docs, folder))
        seen.append({r.doc_id: r for r in docs.collect()})
        assert docs.columns[:5] == columns and (k == 4 or docs.columns == columns)
    toxic, unique, clean, private, mixed = seen
    assert set(texts) - set(toxic) == {i for i in range(0, 600, 6)} | {1030, 1031}
    # Exact copies go, the smallest id stays; null and blank texts are copies of each other.
    assert {1000, 1001, 1022} & set(unique) == set() and {1, 2, 1021} <= set(unique) and set(unique) <= set(toxic)
    assert set(unique) - set(clean) == {1010, 1011} & set(unique) == {1010, 1011}
    assert set(private) == set(clean)
    assert "[EMAIL]" in private[1020].text and private[1020].n_chars == len(private[1020].text)
    assert all(private[i].text == texts[i] for i in private if i != 1020)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = sum(size(r.text) for r in private.values())
    assert set(mixed) <= set(private) and 0.9 * total <= sum(r.taken for r in mixed.values()) <= total
    assert all(r.taken == r.copies * size(r.text) and 1 <= r.copies <= 3 for r in mixed.values())


def test_run_agrees_with_itself(spark, corpus):
    folder, _ = corpus
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) for _ in range(2))
    assert a == b
