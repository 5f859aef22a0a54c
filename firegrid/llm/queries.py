"""The registered queries of the package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from firegrid.llm import alignment, decontaminate, hosts, html_text, language_model, mixing, passages, prefix_tree, privacy, quality, simhash, substrings, toxicity
from firegrid.llm.common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op3_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find_spans(table(spark, sf_dir, "documents"))
    offsets = F.array_join(F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[privacy.count_kind(F.col("base"), k).alias(f"n_{k}") for k in privacy.KINDS],
        F.lower(F.sha2(offsets, 256)).alias("base_sha256"), privacy.span_text(F.concat("base", "terms")).alias("spans"),
    )


@query
def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.find_repeats(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select(
        "doc_id", "n_units", F.col("n_chars_all").alias("n_chars"), passages.n_removed("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), spans.alias("removed_spans"),
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op13_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree.prefix_tree(table(spark, sf_dir, "conversations"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query
def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"), language_model.every_fifth(F.col("doc_id")))
