"""Operator 4: quality rules with risk-controlled thresholds.

Each rule rejects texts whose statistic exceeds a cutoff, in percent of a base, compared as integers.
A rule has a ladder of cutoffs fixed in advance, from loose to strict. For every stratum (language)
the labelled good documents are the holdout: a cutoff is safe if an exact binomial test rejects
"more than ``RISK / number of rules`` of the stratum's good documents are lost" at the level
``LEVEL / (strata * rules)``. The ladder is walked from the loose end and left at the first cutoff
that is not safe (fixed-sequence testing, so no correction over its steps); Bonferroni corrects for
rules and strata. Thus with probability 1 - LEVEL, no stratum loses more than RISK of its good
documents to the chosen cutoffs. A stratum with too few labels keeps everything that passes the
fixed base rule.

The holdout counts are one grouped aggregate over all labelled documents; the table of cutoffs has
a row per stratum and is broadcast only if it is small.

Defined results: null or blank text has no words and fails the base rule; a null language is a
stratum of its own; rows with a null doc_id have no label but get a verdict; repeated rows each get
the same result; a repeated label counts once, and labels of one document that disagree don't count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmart.llm.common import (BASE2, NOT_SPACE, Rolling, Words, in_arrow, lines, mapped, pack, row_windows,
                                 span_hashes, unpack, written)

RISK = 0.05
LEVEL = 0.05
SMALL_STRATA = 20_000  # rows of the cutoff table that are still broadcast
REPEAT_WORDS = 5

#: Rules: statistic, base, and the ladder of cutoffs in percent (of characters, lines or words).
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (60, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5)),
    "duplicate_lines": ("n_dup_lines", "n_lines", (95, 90, 80, 70, 60, 50, 40, 30)),
    "repeated_words": ("n_repeat_words", "n_words", (18, 16, 14, 12, 10)),
    "capitals": ("n_capitals", "word_chars", (95, 90, 80, 70, 60, 50, 40)),
    "word_length": ("word_chars", "n_words", (4000, 3000, 2000, 1600, 1400, 1200)),
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
CAPITALS = np.isin(np.arange(256), np.arange(65, 91))
HEAD = (np.arange(256) & 0xC0) != 0x80  # first bytes of characters


def _per_row(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=sums[1:])
    return np.diff(sums[at])


def _later_copies(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: equal to an earlier item of the row; equal to any other item of the row."""
    order = np.lexsort((value, row))  # stable: the first of equal items comes first
    r, v = row[order], value[order]
    same = np.zeros(len(r) + 1, dtype=bool)
    if len(r):
        same[1:-1] = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    later, any_ = np.empty(len(r), dtype=bool), np.empty(len(r), dtype=bool)
    later[order], any_[order] = same[:-1], same[:-1] | same[1:]
    return later, any_


def text_stats(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    n = len(at) - 1
    words = Words(data, at, NOT_SPACE, lower=False)
    counts = words.counts()
    row, first = row_windows(counts, words.first, REPEAT_WORDS)
    seq = Rolling(words.keys, BASE2)
    _, twice = _later_copies(row, seq.spans(first, first + REPEAT_WORDS))
    covered = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(covered, first[twice], 1)
    np.add.at(covered, first[twice] + REPEAT_WORDS, -1)
    covered = np.cumsum(covered)[:-1] > 0

    return {"n_words": counts, "word_chars": _per_row(NOT_SPACE[data] & HEAD[data], at),
            "n_symbols": _per_row(SYMBOLS[data], at), "n_capitals": _per_row(CAPITALS[data], at),
            "n_repeat_words": _per_row(covered, words.first), **_line_stats(data, at, words)}


def _line_stats(data: np.ndarray, at: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    n = len(at) - 1
    row, start, end = lines(data, at)
    wordy = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    row, start, end = row[wordy], start[wordy], end[wordy]
    later, _ = _later_copies(row, span_hashes(data, start, end))
    return {"n_lines": np.bincount(row, minlength=n), "n_dup_lines": np.bincount(row[later], minlength=n)}


def stats(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (one is text) and the statistics of its text."""
    names = docs.columns

    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        return {**dict(zip(names, rows.columns)), **{k: v.astype(np.int64) for k, v in text_stats(data, at).items()}}

    schema = StructType([*docs.schema.fields, *(StructField(k, LongType()) for k in STATS)])
    return mapped(docs, "text", schema, work).withColumn(
        "base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


def _exceeds(rule: str, cut) -> str:
    statistic, base, _ = RULES[rule]
    return f"100 * {statistic} > {cut} * {base}"


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    logs = log_fact[n] - log_fact[i] - log_fact[n - i] + i * math.log(p) + (n - i) * math.log1p(-p)
    return float(min(1.0, np.exp(logs - logs.max()).sum() * math.exp(logs.max())))


def cutoffs(scored: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """stratum and one column per rule: the strictest safe cutoff, null if none is."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = 1 AND high = 1").select("doc_id")
    holdout = scored.where("NOT base_failed").join(good, "doc_id").dropDuplicates(["doc_id"])
    lost = [F.sum(F.expr(f"cast({_exceeds(r, c)} AS LONG)")).alias(f"{r}_{c}") for r, (_, _, ladder) in RULES.items() for c in ladder]
    counts = written(holdout.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("good"), *lost), "holdout")
    level = LEVEL / max(1, counts.count() * len(RULES))
    risk = RISK / len(RULES)

    def run(batches):
        for x in batches:
            rows = []
            for r in x.to_pylist():
                row = {"stratum": r["stratum"]}
                for rule, (_, _, ladder) in RULES.items():
                    row[rule] = None
                    for cut in ladder:
                        if binomial_cdf(r[f"{rule}_{cut}"], r["good"], risk) > level:
                            break
                        row[rule] = cut
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, pa.schema(
                [("stratum", x.schema.field("stratum").type), *((rule, pa.int64()) for rule in RULES)]))

    kind = dict(counts.dtypes)["stratum"]
    return written(in_arrow(counts, run, f"stratum {kind}, " + ", ".join(f"{r} long" for r in RULES)), "cutoffs")


def verdicts(scored: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``scored`` with ``kept``. Rejected by a rule: its statistic is above the stratum's cutoff."""
    cuts = cutoffs(scored, labels, stratum)
    if cuts.count() <= SMALL_STRATA:
        cuts = F.broadcast(cuts)
    joined = scored.join(cuts, scored[stratum].eqNullSafe(cuts["stratum"]), "left")
    rejected = " OR ".join(f"coalesce({_exceeds(r, r)}, false)" for r in RULES)
    return joined.withColumn("kept", F.expr(f"NOT base_failed AND NOT ({rejected})")).drop("stratum", *RULES)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed and kept for every row of ``docs`` (doc_id, text, lang)."""
    scored = written(stats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")).drop("text"), "stats")
    return verdicts(scored, labels)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    rows = pack(docs, F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").withColumn(
        "row_", F.col("row_").dropFields("text"))
    scored = written(stats(rows), "scored")
    kept = verdicts(scored, labels).where("kept")
    return unpack(kept, docs)
