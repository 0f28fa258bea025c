"""Operator 11: stretches of a text that repeat a few words over and over.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``least_words`` and ``least_periods`` periods long, that no neighbouring word extends. Each run's first
position s and s + q are a maximal pair: what follows both is equal for exactly the run's length less q,
and the words before them differ. So runs are the maximal pairs at a distance that the lengths allow,
and nothing has to be extended or compared with the text.

The pairs are read off the LCP-interval tree of each text's suffixes, bottom-up. Suffixes are sorted by
doubling, all texts of a chunk at once (texts never mix: their suffixes are apart from the first key
on); only those that share their first few words with another suffix go into the tree. An interval keeps
its positions as one ordered list with the class of each, its left word; a list of one class alone has
no pairs within. When a child's list is merged into its parent's (the shorter into the longer), each of
its positions is only held against its two neighbours there: with three periods or more in common, an
occurrence between s and s + q would make the period smaller. Time and memory are thus those of the
words, not of the pairs.

Defined results: null, empty or blank text has no words and no runs, and its collapsed text is empty;
rows with a null doc_id and repeated rows are treated like any other; runs are ordered by start, then
period. A text that repeats itself takes about 16 bytes times its words times log2 of its longest repeat.
An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import NOT_SPACE, Words, lists, mapped

LEAST_WORDS = 6
LEAST_PERIODS = 4
MIXED = -2  # class of a list whose positions have different left words


def dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1]


class Suffixes:
    """Suffixes of the rows of ``word`` (numbers) that have ``least`` words or more in common with another suffix of their
    row: positions in suffix order and, for each, its common length with the one before it (0 if less than ``least``)."""

    def __init__(self, word: np.ndarray, row: np.ndarray, least: int):
        n = len(word)
        end = np.searchsorted(row, row, "right")  # where each position's row ends
        # A rank is the number of suffixes with a lesser beginning of ``width`` words; suffixes with one rank are sorted on.
        key = row.astype(np.int64) * (word.max(initial=0) + 1) + word
        at, old, rank, width = np.arange(n), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), 1
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # width, positions with a rank in common, ranks
        while len(at):
            order = np.argsort(key, kind="stable")
            at, old, key = at[order], old[order], key[order]
            fresh, group = np.ones(len(at), dtype=bool), np.ones(len(at), dtype=bool)
            fresh[1:] = key[1:] != key[:-1]
            group[1:] = old[1:] != old[:-1]
            index = np.arange(len(at))
            new = old + np.maximum.accumulate(np.where(fresh, index, 0)) - np.maximum.accumulate(np.where(group, index, 0))
            rank[at] = new
            alone = fresh & np.append(fresh[1:], True)
            at = np.sort(at[~alone])
            old = rank[at]
            self.levels.append((width, at, old))
            after = at + width
            key = old * (n + 1) + np.where(after < end[at], rank[np.minimum(after, n - 1)] + 1, 0)
            width *= 2
        self._find(least, rank)

    def _rank(self, at: np.ndarray, level: int) -> np.ndarray:
        """Ranks of positions at a level; -1 where no other position has it."""
        _, positions, ranks = self.levels[level]
        if not len(positions):
            return np.full(len(at), -1)
        spot = np.minimum(np.searchsorted(positions, at), len(positions) - 1)
        return np.where(positions[spot] == at, ranks[spot], -1)

    def _find(self, least: int, rank: np.ndarray) -> None:
        at = next((x[1] for x in reversed(self.levels) if x[0] <= least), np.zeros(0, dtype=np.int64))
        order = at[np.argsort(rank[at], kind="stable")]
        a, b, got = order[:-1], order[1:], np.zeros(max(0, len(order) - 1), dtype=np.int64)
        for i in range(len(self.levels) - 1, -1, -1):
            one, other = self._rank(a + got, i), self._rank(b + got, i)
            got = got + np.where((one >= 0) & (one == other), self.levels[i][0], 0)
        common = np.zeros(len(order) + 1, dtype=np.int64)
        common[1:len(order)] = np.where(got >= least, got, 0)
        shared = (common[:-1] > 0) | (common[1:] > 0)
        self.order, self.common = order[shared], common[:-1][shared]


def _join(a: list[int], a_class: int, b: list[int], b_class: int, common: int, left: list[int], found: list) -> tuple[list[int], int]:
    """Both children's positions as one list; their maximal pairs at a distance of a third of ``common`` at most are added to ``found``."""
    if len(a) < len(b):
        a, b = b, a
    if a_class == MIXED or a_class != b_class:
        for p in b:
            k = bisect(a, p)
            for q in a[k - 1:k + 1] if k else a[:1]:
                d = abs(p - q)
                if (LEAST_PERIODS - 1) * d <= common and d + common >= LEAST_WORDS and left[p] != left[q]:
                    found.append((min(p, q), d + common, d))
        a_class = MIXED
    if b[0] > a[-1]:
        a.extend(b)
    elif 8 * len(b) < len(a):
        for p in b:
            insort(a, p)
    else:
        a.extend(b)
        a.sort()
    return a, a_class


def maximal_pairs(order: list[int], common: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, distance) of the maximal pairs that can be runs, from the LCP-interval tree of the suffixes."""
    found: list[tuple[int, int, int]] = []
    open_: list[tuple[int, list[int], int]] = []  # intervals that are still growing: common length, positions, class
    for i, p in enumerate(order):
        held, kind = [p], left[p]
        depth = common[i + 1] if i + 1 < len(order) else 0
        while open_ and open_[-1][0] > depth:
            top, positions, its = open_.pop()
            held, kind = _join(positions, its, held, kind, top, left, found)
        if open_ and open_[-1][0] == depth:
            _, positions, its = open_.pop()
            held, kind = _join(positions, its, held, kind, depth, left, found)
        if depth:
            open_.append((depth, held, kind))
    return found


def runs(word: np.ndarray, row: np.ndarray) -> np.ndarray:
    """(start, length, period) of the runs of all rows, by start, then period."""
    least = min(LEAST_WORDS - 1, (LEAST_PERIODS - 1) * LEAST_WORDS)
    suffixes = Suffixes(word, row, least)
    left = np.full(len(word), -1, dtype=np.int64)
    left[1:] = np.where(row[1:] == row[:-1], word[:-1], -1)
    pairs = maximal_pairs(suffixes.order.tolist(), suffixes.common.tolist(), left.tolist() if len(suffixes.order) else [])
    if not pairs:
        return np.zeros((0, 3), dtype=np.int64)
    got = np.array(pairs, dtype=np.int64)
    got = got[np.lexsort(got.T[[2, 1, 0]])]
    # A stretch with period q is a pair at distances 2q, 3q... as well.
    first = np.ones(len(got), dtype=bool)
    first[1:] = (got[1:, :2] != got[:-1, :2]).any(axis=1)
    got = got[first]
    return got[np.lexsort((got[:, 2], got[:, 0]))]


def _collapsed(words: Words, dropped: np.ndarray) -> pa.Array:
    """Words that aren't dropped, joined by one space, a text per row."""
    counts = words.counts()
    row = np.repeat(np.arange(len(counts)), counts)
    kept = np.flatnonzero(~dropped)
    inner = np.zeros(len(kept), dtype=bool)  # another kept word of its row follows
    inner[:-1] = row[kept][1:] == row[kept][:-1]
    mask = np.zeros(len(words.data) + 1, dtype=np.int8)
    np.add.at(mask, words.start[kept], 1)
    np.add.at(mask, words.end[kept], -1)
    mask = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
    spaces = words.end[kept[inner]]  # white space, as a word of the same row follows
    mask[spaces] = True
    data = words.data.copy()
    data[spaces] = 0x20
    size = np.bincount(row[kept], weights=(words.end - words.start)[kept] + inner, minlength=len(counts)).astype(np.int64)
    at = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(size, out=at[1:])
    return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(at), pa.py_buffer(data[mask])).cast(pa.string())


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (array of start, length, period; start as word number) and collapsed (the words left, joined by one
    space, when of each run only the first period stays) of every row of ``docs`` (doc_id, text)."""
    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        words = Words(data, at, NOT_SPACE, lower=False)
        row = np.repeat(np.arange(len(at) - 1), words.counts())
        got = runs(dense(words.keys), row)
        change = np.zeros(len(row) + 1, dtype=np.int64)
        np.add.at(change, got[:, 0] + got[:, 2], 1)
        np.add.at(change, got[:, 0] + got[:, 1], -1)
        of = row[got[:, 0]]
        fields = pa.StructArray.from_arrays([pa.array(got[:, 0] - words.first[of]), pa.array(got[:, 1]), pa.array(got[:, 2])],
                                            names=["start", "length", "period"])
        return {"doc_id": rows.column(0), "runs": lists(np.bincount(of, minlength=len(at) - 1), fields),
                "collapsed": _collapsed(words, np.cumsum(change)[:-1] > 0)}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text",
                  "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string", work)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where the end of every tenth text by the CRC-32 of its doc_id repeats its own words
    (word i >= a is word a + (i - a) % p of the text). Rows with a null doc_id stay as they are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "h", F.crc32(F.col("doc_id").cast("string"))).withColumn(
        "w", F.when(F.expr("h % 10 = 0"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))).withColumn(
        "a", F.expr("IF(size(w) > 0, (h DIV 10) % size(w), NULL)")).withColumn(
        "p", F.expr("1 + (size(w) - a) DIV (3 + (h DIV 10) % 8)")).select("doc_id", F.expr(
            """IF(a IS NULL, text, array_join(transform(sequence(0, size(w) - 1),
                i -> w[cast(IF(i < a, i, a + (i - a) % p) AS INT)]), ' '))""").alias("text"))
