"""Words and lines that sums of powers modulo 2**64 take for each other: Thue-Morse words and their complements."""

import numpy as np
import pytest
from tripmart.llm import decontaminate, periodic_runs, pieces, quality_rules, token_counts
from tripmart.llm.common import span_hashes

X = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
Y = "".join("ba"[bin(i).count("1") % 2] for i in range(2048))


def test_span_hashes_tell_spans_apart():
    rng = np.random.default_rng(1)
    texts = {X, Y, "", "\0", "\0" * 8, "\0" * 9, "a" * 7, "a" * 8, "a" * 9, X + "a", X + "b", X + X, X + Y, Y + X}
    texts |= {"".join(rng.choice(["a", "b"], size=n)) for n in rng.integers(1, 40, size=3000)}
    texts = sorted(texts)
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    at = np.cumsum([0, *map(len, texts)])
    h = span_hashes(data, at[:-1], at[1:])
    assert len(set(h.tolist())) == len(texts)
    order = rng.permutation(len(texts))
    assert (span_hashes(data, at[:-1][order], at[1:][order]) == h[order]).all()
    alone = [span_hashes(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0]), np.array([len(t)]))[0] for t in texts[::50]]
    assert alone == h[::50].tolist()  # whatever else is in the chunk
    assert len(span_hashes(data, at[:0], at[:0])) == 0


def test_quality_and_runs(documents):
    s = quality_rules.stats(documents([(1, f"{X}\n{Y}\n{X}")]).select("doc_id", "text")).first()
    assert s.n_dup_lines == 1
    r = periodic_runs.periodic_runs(documents([(1, f"{X} {Y} " * 4 + f"{X} {X}")])).first()
    assert [tuple(x) for x in r.runs] == [(0, 9, 2)]


def test_decontamination(spark, documents):
    items = spark.createDataFrame([(7, f"one two {X} three")], "item_id long, text string")
    got = {r.doc_id: r.n_hit for r in decontaminate.contamination(documents([(1, f"one two {X} three"), (2, f"one two {Y} three")]), items).collect()}
    assert got == {1: 4, 2: 0}


@pytest.mark.parametrize("text", [f"{X} {Y} {X}", X + Y, Y])
def test_tokens(documents, text):
    got = {r.doc_id: r for r in pieces.encode(documents([(1, f"{X} {text}"), (2, text), (3, X)])).collect()}
    assert all(r.round_trip for r in got.values()) and got[2].ids != got[3].ids
    n = {r.doc_id: r.n_tokens for r in token_counts.token_counts(documents([(1, f"{X} {text}"), (2, text), (3, X)])).collect()}
    assert n == {i: len(r.ids) for i, r in got.items()}
