"""Operator 7: quality classification by co-training.

Two views of a document get a logistic classifier each: its text (hashed words present, and ratios
of symbols, capitals, repeated lines and the like) and its metadata (source, language, length). For
``ROUNDS`` rounds each view is fitted on its labelled rows, scores all unlabelled documents, and hands
confident ones (calibrated probability beyond ``CONFIDENT``) as pseudo-labels to the other view: by
hash, evenly from the strata of source and language, about as many per class as its share of
``HANDED`` rows, but ``LEAST_DOCS`` of each stratum that has them. At the end each view is
calibrated on labelled rows that no round trained on, and the calibrated log-odds are added, less the
prior's, to score every document. ``quality`` and ``toxic`` labels are learned alike.

Each round is one narrow pass with a broadcast model of fixed size (``SLOTS`` weights a label). Fitting
uses the ``LABELLED`` labelled rows with the least hash of doc_id and the rows handed over, whose
number grows with the strata (at most ``META_SLOTS``) and not with the corpus.

Defined results: null or empty text has no words (its metadata and the prior decide); null metadata
are values of their own; a doc_id whose labels disagree is not used; without labels of both classes
the score is the known class's share, or 0.5; repeated rows and null doc_ids each get a score. A
document is kept if its quality is 0.5 or more and its toxicity is below 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ALNUM, U64, Rolling, Words, byte_values, lists, mapped, mix, written
from tripmart.llm.quality_rules import text_stats

LABELLED = 8_000
ROUNDS = 3
HANDED = 400
CONFIDENT = 0.95
HELD = 0.25  # share of the labelled rows kept for calibration
SLOTS = 1 << 20
META_SLOTS = 1 << 12
LEAST_DOCS = 3  # words in fewer sample documents get no weight
STEPS = 200
CHI_SQUARED = 15.0  # words and metadata below it get no weight
TASKS = ("quality", "toxic")
N_STATS = 7


def text_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot) of the distinct words of each row, and its ratios [row, stat]."""
    words = Words(data, at, ALNUM, lower=True)
    row = np.repeat(np.arange(len(at) - 1), words.counts())
    both = np.unique(row.astype(np.int64) * SLOTS + (words.hashes & U64(SLOTS - 1)).astype(np.int64))
    s = {k: v.astype(np.float64) for k, v in text_stats(data, at).items()}
    chars, n, ln = np.maximum(s["word_chars"], 1), np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    stats = np.stack([np.minimum(10 * s["n_symbols"] / chars, 3), 3 * s["n_capitals"] / chars, 3 * s["n_dup_lines"] / ln,
                      3 * s["n_repeat_words"] / n, np.log1p(s["n_words"]) / 3, np.minimum(chars / n, 30) / 5,
                      np.diff(words.first) / n], axis=1)
    return both // SLOTS, both % SLOTS, stats


def meta_features(source: list, lang: list, length: list) -> np.ndarray:
    """Slots [row, 4] of the metadata: source, language, both, and length in octaves."""
    size = [-1 if x is None else int(x).bit_length() for x in length]
    keys = [[f"s{a}", f"l{b}", f"s{a} l{b}", f"n{c}"] for a, b, c in zip(source, lang, size)]
    flat = pa.array([y for x in keys for y in x], pa.large_string()).cast(pa.large_binary())
    at = np.frombuffer(flat.buffers()[1], dtype=np.int64)[:len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], dtype=np.uint8) if len(flat) else np.zeros(0, dtype=np.uint8)
    h = Rolling(byte_values(7)[data]).spans(at[:-1], at[1:])
    return (h & U64(META_SLOTS - 1)).astype(np.int64).reshape(len(keys), 4)


@dataclass
class Sparse:
    """Rows of presence features and dense columns."""
    row: np.ndarray
    col: np.ndarray
    n_rows: int
    n_cols: int
    dense: np.ndarray

    def take(self, rows: np.ndarray) -> Sparse:
        new = np.full(self.n_rows, -1)
        new[rows] = np.arange(len(rows))
        keep = new[self.row] >= 0
        return Sparse(new[self.row[keep]], self.col[keep], len(rows), self.n_cols, self.dense[rows])

    def score(self, w: np.ndarray, d: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n_rows) + self.dense @ d + bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def informative(x: Sparse, y: np.ndarray) -> np.ndarray:
    """Columns whose presence depends on the class, by the chi-squared statistic of each."""
    n, p = len(y), y.mean()
    seen = np.bincount(x.col, minlength=x.n_cols)
    positive = np.bincount(x.col, weights=y[x.row], minlength=x.n_cols)
    variance = seen * p * (1 - p) * (1 - seen / n)
    return np.flatnonzero((positive - seen * p) ** 2 >= CHI_SQUARED * np.maximum(variance, 1e-9))


def fit(x: Sparse, y: np.ndarray, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression over the informative columns, by Adam over all rows."""
    columns = informative(x, y)
    new = np.full(x.n_cols, -1)
    new[columns] = np.arange(len(columns))
    keep = new[x.col] >= 0
    k, full = len(columns), x.n_cols
    x = Sparse(x.row[keep], new[x.col[keep]], x.n_rows, k, x.dense)
    p = np.zeros(k + x.dense.shape[1] + 1)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    p[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, STEPS + 1):
        g = (sigmoid(x.score(p[:k], p[k:-1], p[-1])) - y) / len(y)
        grad = np.concatenate([np.bincount(x.col, weights=g[x.row], minlength=k), x.dense.T @ g, [g.sum()]])
        grad[:-1] += l2 * p[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        p -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    words = np.zeros(full)
    words[columns] = p[:k]
    return words, p[k:-1], float(p[-1])


def calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's slope and offset, with smoothed targets, by Newton steps."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1e-3, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(50):
        p = sigmoid(a * score + b)
        g = np.array([((p - target) * score).sum() + 1e-3 * a, (p - target).sum()])
        w = np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return max(a, 0.0), b


def features(docs: DataFrame, chosen: DataFrame) -> pd.DataFrame:
    """Features and labels of the chosen documents (doc_id, TASKS), in the order of the hash of doc_id."""
    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        n = len(at) - 1
        row, slot, stats = text_features(data, at)
        meta = meta_features(*(rows.column(i).to_pylist() for i in (3, 4, 5)))
        return {"doc_id": rows.column(0), **{t: rows.column(i + 1) for i, t in enumerate(TASKS)},
                "slots": lists(np.bincount(row, minlength=n), pa.array(slot.astype(np.int32))),
                "stats": lists(np.full(n, N_STATS), pa.array(stats.ravel())),
                "meta": lists(np.full(n, 4), pa.array(meta.ravel().astype(np.int32)))}

    picked = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", *TASKS, "source", "lang", "n_chars", "text")
    got = mapped(picked, "text", "doc_id long, quality int, toxic int, slots array<int>, stats array<double>, meta array<int>",
                 work).toArrow().to_pandas()
    got = got.assign(key=mix(got["doc_id"].to_numpy().astype(np.int64).view(np.uint64)))
    return got.sort_values(["key", "doc_id"]).drop_duplicates("doc_id").reset_index(drop=True)


def train(sample: pd.DataFrame, handed: dict[tuple[str, int], dict[int, int]]) -> dict[str, dict]:
    """Per task: word weights by slot, ratio weights, metadata weights, biases and calibration, from the labelled
    rows and the pseudo-labels handed to each view."""
    n = len(sample)
    size = sample["slots"].map(len).to_numpy() if n else np.zeros(0, dtype=int)
    row = np.repeat(np.arange(n), size)
    slot = np.concatenate([np.zeros(0, dtype=np.int64), *sample["slots"]]).astype(np.int64)
    used = np.flatnonzero(np.bincount(slot, minlength=SLOTS) >= LEAST_DOCS)
    compact = np.full(SLOTS, -1)
    compact[used] = np.arange(len(used))
    keep = compact[slot] >= 0
    stats = np.stack(sample["stats"].to_list()) if n else np.zeros((0, N_STATS))
    text = Sparse(row[keep], compact[slot[keep]], n, len(used), stats)
    meta_col = np.concatenate([np.zeros(0, dtype=np.int64), *sample["meta"]]).astype(np.int64)
    meta = Sparse(np.repeat(np.arange(n), 4), meta_col, n, META_SLOTS, np.zeros((n, 0)))
    where = {x: i for i, x in enumerate(sample["doc_id"].tolist())}
    out = {}
    for task in TASKS:
        labelled = np.flatnonzero(sample[task].notna().to_numpy()) if n else np.zeros(0, dtype=int)
        y = sample[task].fillna(0).to_numpy().astype(np.float64) if n else np.zeros(0)
        held = labelled[: int(len(labelled) * HELD)]
        rest = labelled[len(held):]
        if min(len(set(y[rest].tolist())), len(set(y[held].tolist()))) < 2:
            out[task] = {"share": float(y[labelled].mean()) if len(labelled) else 0.5}
            continue
        models, calibration = [], []
        for i, view in enumerate((text, meta)):
            more = handed[task, i]
            rows = np.concatenate([rest, np.array([where[x] for x in more], dtype=rest.dtype)])
            models.append(fit(view.take(rows), np.concatenate([y[rest], np.array(list(more.values()), dtype=np.float64)])))
            calibration.append(calibrate(view.take(held).score(*models[i]), y[held]))
        w = np.zeros(SLOTS, dtype=np.float32)
        w[used] = models[0][0]
        out[task] = {"words": w, "stats": models[0][1], "bias": models[0][2], "meta": models[1][0], "meta_bias": models[1][2],
                     "calibration": calibration, "prior": float(np.log(y[rest].mean() / (1 - y[rest].mean())))}
    return out


def view_scores(m: dict, row: np.ndarray, slot: np.ndarray, stats: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Calibrated log-odds of the text and of the metadata."""
    by_text = np.bincount(row, weights=m["words"][slot], minlength=len(stats)) + stats @ m["stats"] + m["bias"]
    by_meta = m["meta"][meta].sum(1) + m["meta_bias"]
    (a, b), (c, d) = m["calibration"]
    return a * by_text + b, c * by_meta + d


def quotas(counts: dict[int, int], wanted: int) -> dict[int, int]:
    """Rows to take of each stratum: evenly, up to ``wanted`` in all, but ``LEAST_DOCS`` of each that has them."""
    out, left = {}, wanted
    for i, (stratum, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[stratum] = min(n, max(left // (len(counts) - i), LEAST_DOCS))
        left = max(left - out[stratum], 0)
    return out


def hand_over(docs: DataFrame, known: DataFrame, models: dict[str, dict], turn: int) -> dict[tuple[str, int], dict[int, int]]:
    """Pseudo-labels for each (task, view) from the other view's confident documents, of all that are unlabelled."""
    model = docs.sparkSession.sparkContext.broadcast(models)
    pairs = [(t, v) for t in TASKS for v in (0, 1) if "share" not in models[t]]

    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        row, slot, stats = text_features(data, at)
        meta = meta_features(*(rows.column(i).to_pylist() for i in (1, 2, 3)))
        marks = np.full((len(at) - 1, 2 * len(TASKS)), -1, dtype=np.int32)
        for k, (task, view) in enumerate(pairs):
            p = sigmoid(view_scores(model.value[task], row, slot, stats, meta)[1 - view])
            marks[p >= CONFIDENT, k] = 1
            marks[1 - p >= CONFIDENT, k] = 0
        return {"doc_id": rows.column(0), "stratum": meta[:, 2].astype(np.int32),
                **{f"m{k}": np.ascontiguousarray(marks[:, k]) for k in range(2 * len(TASKS))}}

    names = [f"m{k}" for k in range(2 * len(TASKS))]
    schema = "doc_id long, stratum int, " + ", ".join(f"{x} int" for x in names)
    sure = mapped(docs.where("doc_id IS NOT NULL"), "text", schema, work).where(" OR ".join(f"{x} >= 0" for x in names))
    sure = written(sure.join(known.select("doc_id"), "doc_id", "left_anti")
                   .withColumn("key", F.xxhash64("doc_id", F.lit(turn)).bitwiseAND((1 << 62) - 1)), "confident")
    found = sure.groupBy("stratum", *names).count().toArrow().to_pylist()
    take: dict[tuple[int, int], dict[int, int]] = {}
    below = []  # (mark, label, stratum, key): twice the quota lies below the key, so that enough do
    for k, (task, _) in enumerate(pairs):
        share = float(sigmoid(np.array(models[task]["prior"])))
        for label in (0, 1):
            counts: Counter[int] = Counter()
            for x in found:
                if x[names[k]] == label:
                    counts[x["stratum"]] += x["count"]
            take[k, label] = quotas(counts, int(round(HANDED * (share if label else 1 - share))))
            below += [(k, label, s, min(1 << 62, (1 << 62) * (2 * n + 50) // counts[s])) for s, n in take[k, label].items()]
    out: dict[tuple[str, int], dict[int, int]] = {x: {} for x in pairs}
    if not below:
        return out
    limits = docs.sparkSession.createDataFrame(below, "k int, label int, s int, below long")
    marks = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(x).alias("label")) for k, x in enumerate(names)])).alias("x")
    near = sure.select("doc_id", "key", F.col("stratum").alias("s"), marks).select("doc_id", "key", "s", "x.*").where("label >= 0") \
        .join(F.broadcast(limits), ["k", "label", "s"]).where("key < below").drop("below").distinct().toArrow().to_pandas()
    for (k, label, s), group in near.sort_values(["key", "doc_id"]).groupby(["k", "label", "s"]):
        for x in group["doc_id"].tolist()[:take[k, label][s]]:
            out[pairs[k]][x] = label
    return out


def cotrain(docs: DataFrame, labels: DataFrame) -> dict[str, dict]:
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.when(F.min(t) == F.max(t), F.min(t)).alias(t) for t in TASKS])
    sample = features(docs, written(known.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(LABELLED), "sample"))
    handed: dict[tuple[str, int], dict[int, int]] = {(t, v): {} for t in TASKS for v in (0, 1)}
    for turn in range(ROUNDS):
        models = train(sample, handed)
        if all("share" in m for m in models.values()):
            return models
        for x, fresh in hand_over(docs, known, models, turn).items():
            handed[x] = {**fresh, **handed[x]}
        new = sorted({i for x in handed.values() for i in x} - set(sample["doc_id"].tolist()))
        if new:
            chosen = docs.sparkSession.createDataFrame([(i, None, None) for i in new], "doc_id long, quality int, toxic int")
            sample = pd.concat([sample, features(docs, chosen)], ignore_index=True)
    return train(sample, handed)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality_score, toxic_score and kept of every row of ``docs`` (doc_id, text, source, lang, n_chars)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
                       F.col("n_chars").cast("long").alias("n_chars"), "text")
    model = docs.sparkSession.sparkContext.broadcast(cotrain(docs, labels))

    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        n = len(at) - 1
        row, slot, stats = text_features(data, at)
        meta = meta_features(*(rows.column(i).to_pylist() for i in (1, 2, 3)))
        scores = {}
        for task in TASKS:
            m = model.value[task]
            if "share" in m:
                scores[task] = np.full(n, m["share"])
                continue
            scores[task] = sigmoid(sum(view_scores(m, row, slot, stats, meta)) - m["prior"])
        return {"doc_id": rows.column(0), "quality_score": scores["quality"], "toxic_score": scores["toxic"],
                "kept": (scores["quality"] >= 0.5) & (scores["toxic"] < 0.5) if "share" not in model.value["toxic"]
                else scores["quality"] >= 0.5}

    return mapped(docs, "text", "doc_id long, quality_score double, toxic_score double, kept boolean", work)
