"""Operator 8: token counts by dynamic programming on a trie.

The distinct pre-tokens of a chunk (the units of operator 5) go into a trie, built level by level:
a node is a distinct prefix. Its forward score and last piece follow from the nodes up to one piece
length above it, so a prefix that many pre-tokens share is scored once; each node also carries the
number of tokens on its best path, and a pre-token's count is that of its last node. The step from
prefix to prefix, with a merge model's rule for neighbours, unknown characters (one token per UTF-8
byte) and ties, is that of operator 5, so the counts are the lengths of its ids. Pre-tokens over ``LONG`` characters share no prefix worth storing and are
scored alone.

Defined results: null or empty text counts 0; repeated rows and null doc_ids each get their own
count. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.common import BASE2, Rolling, mapped
from tripmart.llm.pieces import CHUNK, LITERAL, LONG, MODEL, SPACE, Pairs, PieceTable, best_long, cp_values, step, units, unit_hashes


def byte_length(cps: np.ndarray) -> np.ndarray:
    cps = np.where(cps == LITERAL, SPACE, cps)
    return 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)


def trie_counts(pairs: Pairs, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tokens of each distinct pre-token cps[start:end] of up to LONG characters."""
    roll = Rolling(cp_values(cps), BASE2)
    length = ends - starts
    out = np.zeros(len(starts), dtype=np.int64)
    node = {0: np.zeros(len(starts), dtype=np.int64)}  # of each pre-token, by depth
    score, count, last = {0: np.zeros(1)}, {0: np.zeros(1, dtype=np.int64)}, {0: np.full(1, -1)}  # of each node, by depth
    table = pairs.table
    for depth in range(1, int(length.max(initial=0)) + 1):
        live = np.flatnonzero(length >= depth)
        # Children: distinct (parent, character), each with one pre-token through it.
        code, children = pd.factorize(node[depth - 1][live] * (1 << 22) + cps[starts[live] + depth - 1])
        through = np.zeros(len(children), dtype=np.int64)
        through[code] = live
        at = starts[through] + depth
        sizes = np.arange(1, min(depth, table.longest) + 1)
        up = [node[depth - k][through] for k in sizes.tolist()]
        best, size, piece = step(pairs, np.stack([score[depth - k][u] for k, u in zip(sizes.tolist(), up)]),
                                 np.stack([roll.spans(at - k, at) for k in sizes.tolist()]),
                                 np.stack([last[depth - k][u] for k, u in zip(sizes.tolist(), up)]))
        tokens = np.stack([count[depth - k][u] for k, u in zip(sizes.tolist(), up)])[size - 1, np.arange(len(size))]
        tokens += np.where(piece >= 0, 1, byte_length(cps[at - 1]))
        last[depth] = piece
        score[depth], count[depth] = best, tokens
        node[depth] = np.full(len(starts), -1, dtype=np.int64)
        node[depth][live] = code
        done = live[length[live] == depth]
        out[done] = tokens[node[depth][done]]
        for d in (node, score, count, last):
            d.pop(depth - table.longest, None)
    return out


def token_counts(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every row of ``docs``."""
    table = docs.sparkSession.sparkContext.broadcast(PieceTable.load(path))
    state: dict = {}

    def work(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict:
        t = table.value
        if "pairs" not in state:
            state["pairs"] = Pairs(t)
        pairs = state["pairs"]
        cps, start, first = units(data, at, t.split_lines)
        if len(start) < 2:
            zero = np.zeros(len(at) - 1, dtype=np.int64)
            return {"doc_id": rows.column(0), "n_pretokens": zero, "n_tokens": zero}
        code, unique = pd.factorize(unit_hashes(cps, start))
        example = np.zeros(len(unique), dtype=np.int64)
        example[code[::-1]] = np.arange(len(code))[::-1]
        s, e = start[:-1][example], start[1:][example]
        tokens = np.zeros(len(unique), dtype=np.int64)
        short = np.flatnonzero(e - s <= LONG)
        tokens[short] = trie_counts(pairs, cps, s[short], e[short])
        for i in np.flatnonzero(e - s > LONG).tolist():
            begin, key = best_long(pairs, cp_values(cps[s[i]:e[i]]))
            tokens[i] = np.where(key >= 0, 1, byte_length(cps[s[i]:e[i]][begin])).sum()
        sums = np.concatenate([[0], np.cumsum(tokens[code])])
        return {"doc_id": rows.column(0), "n_pretokens": np.diff(first).astype(np.int64), "n_tokens": np.diff(sums[first])}

    return mapped(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text"), "text",
                  "doc_id long, n_pretokens long, n_tokens long", work, CHUNK)
