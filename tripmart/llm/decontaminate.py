"""Operator 3: benchmark decontamination by winnowing.

The least hash of the ``KGRAM``-word grams in every run of ``SPAN`` words is that run's fingerprint,
so any shared run of ``SPAN`` words has the same fingerprint on both sides; items of fewer words are
fingerprinted as one gram of their length (a winnowing window of one). A fixed-size bitmap of the
benchmark's fingerprints is broadcast; document windows whose fingerprint is in it are extended to
the whole window (a 128-bit digest of its words) and joined with the benchmark's windows, and the
hits of a document are merged. Nothing else of the documents is shuffled, and a window that very
many documents share is split by adaptive execution, as the join's other side is small per key.

Defined results: null, empty or wordless texts have no words and no hits; wordless items hit
nothing; items with a null id mark words but are not counted; each row gets its own result, also
where rows repeat or doc_id is null. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import (ALNUM, BASE2, U64, Rolling, Words, bitmap, in_bitmap, lists, mapped, mix,
                                 pack, row_windows, signed, sliding_min, written)

SPAN = 10
KGRAM = 5
WINDOW_TYPE = "array<struct<fp:long,h1:long,h2:long,start:int,len:int>>"


def _windows(words: Words, counts: np.ndarray, length: int, span: int) -> dict[str, np.ndarray]:
    """All windows of ``length`` words: row, start within the row, fingerprint and digest."""
    a, b = Rolling(words.keys, BASE2), Rolling(mix(words.keys ^ U64(0x5851F42D4C957F2D)))
    row, first = row_windows(counts, words.first, length)
    digest = a.spans(first, first + length)
    if length < span:
        fp = mix(digest ^ U64(length))
    else:
        fp = sliding_min(a.windows(KGRAM), span - KGRAM + 1)[first] if len(first) else digest
    return {"row": row, "first": first, "start": first - words.first[:-1][row], "fp": fp,
            "h1": digest, "h2": b.spans(first, first + length)}


def _column(parts: list[dict], lengths: list[int], n: int) -> pa.Array:
    row = np.concatenate([p["row"] for p in parts])
    order = np.argsort(row, kind="stable")
    cat = {k: np.concatenate([p[k] for p in parts])[order] for k in ("fp", "h1", "h2", "start")}
    size = np.concatenate([np.full(len(p["row"]), ln) for p, ln in zip(parts, lengths)])[order]
    struct = pa.StructArray.from_arrays(
        [pa.array(signed(cat["fp"])), pa.array(signed(cat["h1"])), pa.array(signed(cat["h2"])),
         pa.array(cat["start"].astype(np.int32)), pa.array(size.astype(np.int32))],
        names=["fp", "h1", "h2", "start", "len"])
    return lists(np.bincount(row, minlength=n), struct)


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(item_id, fp, h1, h2, len) of every distinct window of the items."""
    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        words = Words(data, at, ALNUM, lower=True)
        counts = words.counts()
        parts, lengths = [], []
        for length in range(1, span + 1):
            parts.append(_windows(words, np.where(counts >= span if length == span else counts == length,
                                                  counts, 0), length, span))
            lengths.append(length)
        return {"item_id": rows.column(0), "windows": _column(parts, lengths, len(at) - 1)}

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return mapped(items, "text", f"item_id string, windows {WINDOW_TYPE}", work).select(
        "item_id", F.explode("windows").alias("x")).select("item_id", "x.fp", "x.h1", "x.h2", "x.len").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, text_key (hash of the text), n_words, n_hit and items (sorted ids) for every row of ``docs``."""
    windows = written(benchmark_windows(benchmark, span), "benchmark")
    short = sorted(r[0] for r in windows.select("len").distinct().collect())  # 1 to span
    seen = bitmap(windows, "fp")

    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        words = Words(data, at, ALNUM, lower=True)
        counts, bits = words.counts(), seen.value
        parts, lengths = [], []
        for length in short or [span]:
            w = _windows(words, counts, length, span)
            hit = in_bitmap(bits, w["fp"])
            parts.append({k: v[hit] for k, v in w.items()})
            lengths.append(length)
        return {"row_id": rows.column(0), "doc_id": rows.column(1), "text_key": rows.column(2), "n_words": counts.astype(np.int64),
                "windows": _column(parts, lengths, len(at) - 1)}

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_key"), "text")
    base = written(mapped(rows, "text", f"row_id long, doc_id long, text_key long, n_words long, windows {WINDOW_TYPE}", work), "words")
    hits = base.where("size(windows) > 0").select("row_id", F.explode("windows").alias("x")).select("row_id", "x.*") \
        .join(windows, ["fp", "h1", "h2", "len"]).groupBy("row_id").agg(
            F.array_sort(F.collect_set("item_id")).alias("items"),
            F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"))
    n_hit = F.expr("""aggregate(spans, named_struct('n', 0L, 'upto', 0), (a, s) -> named_struct(
        'n', a.n + greatest(0, s.start + s.len - greatest(a.upto, s.start)),
        'upto', greatest(a.upto, s.start + s.len)), a -> a.n)""")
    return base.drop("windows").join(hits.select("row_id", n_hit.alias("n_hit"), "items"), "row_id", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    hit = contamination(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("hit_id"), "text_key").distinct()
    rows = pack(docs, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"))
    clean = rows.join(hit, rows.doc_id.eqNullSafe(hit.hit_id) & (F.col("key") == F.col("text_key")), "left_anti")
    return clean.select("row_.*")
