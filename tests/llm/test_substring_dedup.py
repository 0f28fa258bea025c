import random

import brute
import numpy as np
import pytest
from tripmart.llm import substring_dedup as S
from tripmart.llm.suffix_array import suffix_array, suffix_arrays


def test_suffix_arrays_equal_sorting():
    rng = random.Random(3)
    for _ in range(200):
        top = rng.choice([0, 1, 2, 25, 255])
        strings = [bytes(rng.randint(0, top) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 7))]
        want = [sorted(range(len(s)), key=lambda i, s=s: s[i:]) for s in strings]
        assert [suffix_array(s) for s in strings] == want
        at = np.cumsum([0, *map(len, strings)])
        got = suffix_arrays(np.frombuffer(b"".join(strings), dtype=np.uint8), at)
        assert got.tolist() == [i + a for w, a in zip(want, at) for i in w]


@pytest.mark.parametrize("hot", [1000, 1])
def test_equals_brute_force(documents, corpus, odd_rows, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rows = corpus + [(i + 200, t) for i, t in odd_rows if i and i != 6] + [
        (400, "xy" * 70), (401, "xy" * 49 + "x"), (402, "z" * 49), (403, "z" * 49), (404, "z" * 50), (405, "z" * 51), (406, "é" * 60), (407, "aé" + "é" * 40)]
    got = S.remove_repeats(documents(rows)).collect()
    assert len(got) == len(rows)
    want = brute.substring_dedup(list(dict.fromkeys(rows)))
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert sum(r.n_removed > 0 for r in got) > 40


def test_null_ids_and_empty_tables(documents):
    text = "a text of more than fifty bytes, which occurs in all of the rows here"
    got = {(r.doc_id, r.n_removed) for r in S.remove_repeats(documents([(None, text), (3, text), (5, text), (5, text), (6, None)])).collect()}
    assert got == {(None, 0), (3, 0), (5, len(text)), (6, 0)}
    assert S.remove_repeats(documents([])).collect() == []


def test_long_periodic_texts(documents):
    rows = [(1, "ab cd " * 3000), (2, "x " + "ab cd " * 3000), (3, "ab cd " * 2999 + "!")]
    want = brute.substring_dedup(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(documents(rows)).collect()}
    assert got == want and want[2][:3] == (18002, 18001, 1)
