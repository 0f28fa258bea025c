"""Operator 13: importance resampling of documents towards a target distribution.

Texts become bags of hashed features: all runs of 1 to ``grams`` consecutive words (letters A-Z in
lower case), joined by one space, in ``buckets`` buckets by CRC-32. Raw documents hold ``s`` of their
``S`` features in a bucket, the target texts ``t`` of ``T``; the bucket's gain is the logarithm of the
ratio of both smoothed shares, in thousandths. A document's weight is the floored mean of its
features' gains; Gumbel noise drawn from its id is added, and the greatest sums are a sample without
replacement, in proportion to the exponentials of the weights.

A batch's texts are joined with a separator that no word holds; one pass of a regular expression finds
all words of the batch, and binary search among the documents' offsets tells whose each word is.
Hashes of longer runs continue those of shorter ones; runs that cross from one document into the next
are masked before anything is counted. The buckets of each document are written once, so texts are
read and split once: totals and weights come from that table.

What grows with the corpus stays in Spark. The driver gets one row per bucket (``buckets`` at most, 16
bytes each) and the gains go back as an array of that size. Ranks need no sort of all rows: scores are
integers bounded by the logarithms (some ten thousands of values at any size), so counts per score,
added up in blocks of ``BLOCK`` scores, give the number of documents before each score; only the drawn
documents are numbered, within their own score.

Defined results: null or blank text has no words, no features and weight 0; a null doc_id has no noise,
so its score and rank are null and it does not count among the N documents that may be drawn; repeated
rows count as documents of their own and get neighbouring ranks; without target texts all gains come
from the raw shares alone; an empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import in_arrow, lists, mapped, written

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEPARATOR = b"\x00"  # not a byte of any word
BLOCK = 256  # scores whose counts are added up by one task


@dataclass(frozen=True)
class Resample:
    grams: int = 1
    buckets: int = 10_000
    seed: str = "2024"
    percent: int = 10  # share of the eligible documents that is drawn
    least_words: int = 20


def gram_buckets(data: bytes, at: np.ndarray, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, text of each feature, bucket of each feature) of the texts data[at[i]:at[i+1]]."""
    n = len(at) - 1
    joined = SEPARATOR.join(data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())).lower()  # bytes: A-Z only
    starts = at[:-1] + np.arange(n)  # one separator before each text but the first
    found = list(WORDS.finditer(joined))
    words = [m.group() for m in found]
    place = np.fromiter((m.start() for m in found), dtype=np.int64, count=len(found))
    of = np.searchsorted(starts, place, "right") - 1
    crc = [zlib.crc32(w) for w in words]
    row, value = [of], [np.array(crc, dtype=np.int64)]
    for k in range(1, grams):
        crc = [zlib.crc32(w, zlib.crc32(b" ", c)) for w, c in zip(words[k:], crc)]
        inside = of[k:] == of[:-k] if len(of) > k else np.zeros(0, dtype=bool)
        row.append(of[k:][inside])
        value.append(np.array(crc, dtype=np.int64)[inside])
    row, value = np.concatenate(row), np.concatenate(value) % buckets
    if grams > 1:
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    return np.bincount(of, minlength=n), row, value


def features(texts: DataFrame, how: Resample) -> DataFrame:
    """doc_id, n_words and the buckets of all features, of rows (doc_id, text)."""
    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        counts, row, value = gram_buckets(data.tobytes(), at, how.grams, how.buckets)
        return {"doc_id": rows.column(0), "n_words": counts.astype(np.int64),
                "buckets": lists(np.bincount(row, minlength=len(counts)), pa.array(value.astype(np.int32)))}

    return mapped(texts.select("doc_id", "text"), "text", "doc_id long, n_words long, buckets array<int>", work)


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """bucket, n: how often the features fall into each bucket. Each task sends one row a bucket at most."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for x in batches:
            total += np.bincount(x.column(0).flatten().to_numpy(), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return in_arrow(features.select("buckets"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _totals(features: DataFrame, buckets: int) -> np.ndarray:
    rows = bucket_counts(features, buckets).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, from both counts per bucket."""
    n, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight (floored mean gain)."""
    def run(batches):
        for x in batches:
            column = x.column(2)
            sizes = np.diff(column.offsets.to_numpy())
            sums = np.concatenate([[0], np.cumsum(gain[column.flatten().to_numpy()])])
            ends = np.cumsum(sizes)
            total = sums[ends] - sums[ends - sizes]
            yield pa.RecordBatch.from_arrays(
                [x.column(0), x.column(1), pa.array(sizes.astype(np.int64)), pa.array(total // np.maximum(sizes, 1))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return in_arrow(features.select("doc_id", "n_words", "buckets"), run,
                    "doc_id long, n_words long, n_features long, weight long")


def with_ranks(scored: DataFrame, how: Resample) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the drawn documents by score, then doc_id; else null."""
    may = f"score IS NOT NULL AND n_words >= {how.least_words}"
    counts = written(scored.where(may).groupBy("score").agg(F.count("*").alias("n"))
                     .withColumn("block", F.expr(f"cast(floor(score / {BLOCK}) AS LONG)")), "scores")
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n"))  # a few hundred rows
    ahead = blocks.select("block", F.expr("coalesce(sum(n) OVER (ORDER BY block DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
                                          ).alias("ahead"), F.expr("sum(n) OVER ()").alias("of"))
    inside = Window.partitionBy("block").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = written(counts.join(ahead, "block").select(
        "score", "of", (F.col("ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))
        .withColumn("drawn", F.expr(f"{how.percent} * of DIV 100")).where("before < drawn"), "drawn")
    least = before.agg(F.min("score")).first()[0]
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = scored.where(f"{may} AND score >= {least}").join(before.select("score", "before", "drawn"), "score")
    order = Window.partitionBy("score").orderBy("doc_id", "n_features", "weight")
    high = high.withColumn("rank", F.col("before") + F.row_number().over(order)).withColumn(
        "rank", F.expr("IF(rank <= drawn, rank, NULL)"))
    rest = scored.where(f"NOT coalesce({may} AND score >= {least}, false)").withColumn("rank", F.lit(None).cast("long"))
    return high.select(*rest.columns).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, how: Resample = Resample()) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs`` (doc_id, text); ``target`` has a column text."""
    bags = written(features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), how), "buckets")
    goal = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), how)
    gain = gains(_totals(bags, how.buckets), _totals(goal, how.buckets))
    noise = f"cast(conv(substr(sha2(concat('{how.seed}:', doc_id), 256), 1, 8), 16, 10) AS LONG)"
    scored = weighed(bags, gain).withColumn(
        "score", F.expr(f"weight + cast(floor(-1000 * ln(-ln(({noise} + 0.5D) / 4294967296D))) AS LONG)"))
    return with_ranks(written(scored, "scored"), how)
