"""Columns of the input that have the names the operators use for themselves while they join."""

from pyspark.sql import functions as F

from firegrid.llm import decontaminate, passages, similar, simhash

NAMES = ("_first", "_text", "_bad", "_bad_h", "_id", "_removed", "__first", "_BAD_H")


def clashing(spark):
    line = "one line of seven words stays here"
    rows = [(1, line), (2, line), (3, "b " * 30), (None, line), (None, None), (4, "quite another text without any copy")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(NAMES) if c != "_BAD_H"])


def test_keep_first(spark):
    docs = clashing(spark)
    for kept in (simhash.keep_first(docs), similar.keep_first(docs)):
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 3, 4]
        assert all(r["_text"] == 1 and r["_first"] == 0 for r in kept.collect())


def test_decontaminate_in_blocks(spark):
    docs = clashing(spark)
    bench = spark.createDataFrame([("i", "b " * 30), ("j", "c d e f " * 10)], "item_id string, text string")
    for most in (10**6, 3):
        kept = decontaminate.decontaminate(docs, bench, max_windows=most)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 4]


def test_without_repeats(spark):
    out = passages.without_repeats(clashing(spark))
    assert {r.doc_id: r["_id"] for r in out.collect()}[4] == 4
    assert dict(out.dtypes)["_removed"].startswith("array")
