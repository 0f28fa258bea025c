"""Queries of this subpackage over the driver tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (cotraining, decontaminate, html_text, line_dedup, minhash_dedup, periodic_runs, pieces, pii,
                          quality_rules, resample, sql, substring_dedup, token_counts, warc)
from tripmart.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by fixed patterns and bootstrapped contexts."""
    got = pii.personal_data(table(spark, sf_dir, "documents"))
    names = "element_at(array(" + ", ".join(f"'{k}'" for k in pii.KINDS) + "), x.kind + 1)"
    joined = f"array_join(transform({{}}, x -> concat_ws(':', {names}, x.start, x.end)), ',')"
    return got.select("doc_id", *[F.expr(f"cast(size(filter(spans, x -> x.base AND x.kind = {i})) AS BIGINT)").alias(f"n_{k}")
                                  for i, k in enumerate(pii.KINDS)],
                      F.sha2(F.expr(joined.format("filter(spans, x -> x.base)")), 256).alias("base_sha256"),
                      F.expr(joined.format("spans")).alias("spans"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over three-word shingles at a similarity of 0.85."""
    how = minhash_dedup.NearDup(words=3, percent=85, band_rows=4, bands=25)
    got = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), how)
    return got.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows shared with the benchmark."""
    got = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality statistics, the base rule, and risk-controlled cutoffs per language."""
    got = quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    return pieces.encode(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without runs of two or more lines that occur earlier in the corpus."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), whole_runs=True)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document by co-training."""
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings of earlier documents, removed."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text, after runs were planted in a tenth of them."""
    got = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")))
    return got.withColumn("top", F.expr("array_min(transform(runs, r -> struct(-r.length AS l, r.start AS s, r.period AS p)))")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.s").alias("start"), (-F.col("top.l")).alias("length"),
        F.col("top.p").alias("period"), F.expr("1000 * -top.l DIV top.p").alias("exponent_milli"),
        F.sha2(F.expr("array_join(transform(runs, r -> concat(concat_ws(',', r.start, r.length, r.period), '\\n')), '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives, read back and assembled into captures."""
    got = warc.captures(table(spark, sf_dir, "pages"))
    return got.select("page_id", "response.payload_bytes", "response.payload_digest", "record_type", "refers_to")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's distribution of words."""
    got = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_minhash_dedup, op3_decontaminate, op4_quality_rules, op5_sentencepiece, op6_line_dedup,
                            op7_quality_classifier, op8_token_counts, op9_suffix_array_dedup, op10_html_extraction,
                            op11_periodic_runs, op12_warc, op13_importance_resampling)
}

ORACLE: dict[str, str] = {
    "op2_minhash_dedup": sql.MINHASH_DEDUP,
    "op3_decontaminate": sql.DECONTAMINATE,
    "op4_quality_rules": sql.QUALITY_RULES,
    "op6_line_dedup": sql.LINE_DEDUP,
    "op9_suffix_array_dedup": sql.SUBSTRING_DEDUP,
    "op11_periodic_runs": sql.PERIODIC_RUNS,
    "op12_warc": sql.WARC,
    "op13_importance_resampling": sql.IMPORTANCE_RESAMPLING,
}
