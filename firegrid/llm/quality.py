"""Quality rules as a short-circuit cascade, in DataFrame functions only.

The counts of the contract are made for every document.  The verdict is a chain of CASE branches:
each rule runs only on documents that all earlier rules have let pass.  Its order comes from a
bounded sample: the seconds a rule takes and the share of rows it rejects, largest rejection per
second first.  The order decides only what is computed, never which documents are kept.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from firegrid.llm.common import SPACE, word_array
from firegrid.session import cut

WINDOW = 3
# Rows looked at to order the rules; the only use of a part of the input.
SAMPLE_ROWS = 2_000


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    split = docs.withColumns({"_words": word_array(F.col("text")), "_lines": lines})
    n = F.size("_words")
    counted = split.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.when(n >= WINDOW, F.arrays_zip(
            *[F.slice("_words", k + 1, n - (WINDOW - 1)).alias(f"w{k}") for k in range(WINDOW)],
            F.sequence(F.lit(0), n - WINDOW).alias("at"),
        )),
    }).drop("_words", "_lines")
    return repeat_words(counted, "_windows", "n_repeat_words").drop("_windows")


def repeat_words(df: DataFrame, windows: str, name: str) -> DataFrame:
    """Number of words inside windows that occur more than once in their array.

    A text without two equal window hashes is done at once.  Otherwise equal windows are neighbours
    once the windows are sorted; their places, sorted again, are a union of intervals.
    """
    field = lambda x, k: x[f"w{k}"]
    hashes = df.withColumn("_hashes", F.transform(windows, lambda x: F.xxhash64(*[field(x, k) for k in range(WINDOW)])))
    ordered = hashes.withColumn(
        "_sorted", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array(F.col(windows)))).drop("_hashes")

    def same(x: Column, y: Column) -> Column:
        equal = field(x, 0) == field(y, 0)
        for k in range(1, WINDOW):
            equal = equal & (field(x, k) == field(y, k))
        return F.coalesce(equal, F.lit(False))

    places = F.sort_array(F.transform(
        F.filter(F.col("_sorted"), lambda x, i: same(x, F.get("_sorted", i - 1)) | same(x, F.get("_sorted", i + 1))), lambda x: x["at"]))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n"), at.alias("last")),
        lambda acc: acc["n"],
    )
    return ordered.withColumn("_places", places).withColumn(name, F.coalesce(covered, F.lit(0)).cast("long")).drop("_sorted", "_places")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Rejecting conditions over ``text`` and the counts of ``with_counts``; thresholds leave ordinary prose alone."""
    text = F.coalesce(F.col("text"), F.lit(""))
    letters = F.regexp_count(text, F.lit("\\p{L}"))
    capitals = F.regexp_count(text, F.lit("\\p{Lu}"))
    wordy = F.regexp_count(text, F.lit("[^ \\x09-\\x0D\\p{L}]*+\\p{L}[^ \\x09-\\x0D]*+"))
    return {
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "repeated_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
        "long_word": text.rlike("[^ \\x09-\\x0D]{1000}"),
        "few_letters": 2 * wordy < F.col("n_words"),
        "capitals": 5 * capitals > 3 * letters,
    }


def cascade_order(docs: DataFrame, conditions: Mapping[str, Column], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names, most rejections per second first, as measured on ``sample_rows`` rows of ``docs``."""
    sample = docs.limit(sample_rows).cache()
    n = sample.count()
    if not n:
        sample.unpersist()
        return list(conditions)

    def timed(*aggregates: Column) -> tuple[float, list[int]]:
        start = time.monotonic()
        row = sample.agg(*aggregates).first()
        return time.monotonic() - start, [v or 0 for v in row]

    timed(F.count("*"))
    empty = min(timed(F.count("*"))[0] for _ in range(2))
    gain = {}
    for name, rejects in conditions.items():
        hits = F.sum(F.coalesce(rejects, F.lit(False)).cast("int"))
        timed(hits)  # compiles the expression
        seconds, (rejected,) = timed(hits)
        gain[name] = rejected / n / max(seconds - empty, 1e-4)
    sample.unpersist()
    return sorted(conditions, key=lambda name: (-gain[name], name))


def judge(docs: DataFrame, conditions: Mapping[str, Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (doc_id, text) with the counts, base_failed, kept and rejected_by.

    ``rejected_by`` names the rule that stopped the cascade (``base`` for the contract's own
    limits), null for kept rows; with several rejecting rules it depends on the measured order,
    ``kept`` does not.  Null and blank texts have no words, so they fail the base.  Repeated rows get
    equal results; an empty table gives an empty result.  Only doc_id and text of ``docs`` are used.
    """
    conditions = dict(conditions or rules())
    # The result is stored: a filter on it must not be pushed into, and repeat, the expressions of the counts.
    counted = with_counts(docs.select("doc_id", "text"))
    order = cascade_order(with_counts(docs.select("doc_id", "text").limit(sample_rows)), conditions, sample_rows)
    cascade = F.when(base_failed(), F.lit("base"))
    for name in order:
        cascade = cascade.when(conditions[name], F.lit(name))
    judged = counted.withColumns({"base_failed": base_failed(), "rejected_by": cascade}).drop("text")
    return cut(judged).withColumn("kept", F.col("rejected_by").isNull())


ORACLE = """
WITH base AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
split AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM base),
wins AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3),
named AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w FROM wins),
twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, w) AS n FROM named) WHERE n > 1),
covered AS (
  SELECT r, sum(least(3, i - coalesce(prev, i - 3)))::BIGINT AS n_repeat_words
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS prev FROM twice) GROUP BY r),
counted AS (
  SELECT s.*, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(t, '\\p{L}')) AS letters, len(regexp_extract_all(t, '\\p{Lu}')) AS capitals,
         len(list_filter(words, lambda x: regexp_matches(x, '\\p{L}'))) AS wordy
  FROM split s LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR len(list_filter(words, lambda x: length(x) >= 1000)) > 0 OR 2 * wordy < n_words OR 5 * capitals > 3 * letters AS rejected
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM judged
"""
