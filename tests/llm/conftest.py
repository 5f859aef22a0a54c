import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for themselves, as extra columns of the input.
CLASHING = ("fp", "key", "n", "_row", "_rank", "spans", "base", "n_words", "size", "taken", "score", "digest", "_keep", "component")


def words(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Prose, near and exact copies, nulls, blanks, very long texts, repeated rows."""
    rng = random.Random(5)
    base = [words(rng, rng.randrange(5, 300), 4000) for _ in range(40)]
    texts = base + base[:8] + [t + " extra" for t in base[8:16]] + [None, "", " \t\n ", "a", "x" * 50_000, "ab " * 30_000, "é ü 漢字 \x00 z"]
    out = [(i, t, "en", f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, "no id here", None, None, 10), (None, None, None, None, None), (1000, base[0], None, None, 1)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
