"""The staged corpus pipeline: each stage gets what its predecessor kept, as stored Parquet.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from firegrid.llm import decontaminate, mixing, privacy, similar, toxicity
from firegrid.llm.common import table
from firegrid.session import cut


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored as toxic; the model is fitted on the labels of ``sf_dir``."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more): the one with the smallest doc_id.

    Linked by SimHash prints, and by MinHash bands where prints lie further apart; every pair is verified on its shingles.

    Of repeated rows with that id one stays, the smallest by its columns.  A group without any id keeps one row.
    """
    return similar.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stems from the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that disclose it replaced by their kind."""
    return privacy.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with the number of copies and the words taken; the columns of ``documents`` stay."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("near duplicates", dedup),
    ("decontamination", decontaminated),
    ("personal data", private),
    ("mixing", mixed),
]

#: A trained classifier and shingle hashes by XXH64 have no SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
