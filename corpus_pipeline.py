"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

1. quality rules: documents that the base rule or a risk-controlled cutoff rejects go;
2. line dedup: repeated multi-line chunks go from the texts, and documents that lose every line;
3. near-duplicates (five-word shingles, similarity 0.8): the least doc_id of each group stays;
4. decontamination: documents that hold a ten-word window of the benchmark go;
5. SentencePiece: the ids of every text that is left, and whether decoding gives the text back.

Stages 1 to 4 return the columns of their input (``n_chars`` follows the text). Every stage keeps
rows with a null doc_id unless their text is rejected; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import decontaminate, line_dedup, minhash_dedup, pieces, quality_rules
from tripmart.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("sentencepiece", encoding)]

#: SQL can't express the tokenizer's search nor the near-duplicate sketches; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
