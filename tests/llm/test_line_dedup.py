from collections import Counter

import numpy as np
from tripmart.llm import line_dedup as L


def plain(rows):
    """doc_id -> text without chunks that occur before (in doc_id, then position)."""
    seen, out = set(), {}
    for i, t in sorted((r for r in dict.fromkeys(rows) if r[0] is not None), key=lambda r: r[0]):
        raw = (t or "").encode()
        lines = raw.split(b"\n")
        c = L.line_chunks(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
        gone = set()
        for idx, n in zip(c["idx"].tolist(), c["n"].tolist()):
            chunk = b"\n".join(lines[idx:idx + n])
            if chunk in seen:
                gone.update(range(idx, idx + n))
            seen.add(chunk)
        kept = [x for k, x in enumerate(lines) if k not in gone]
        out[i] = ((b"\n".join(kept).decode() if kept else None) if gone else t, len(lines), len(gone))
    return out


def test_equals_plain_version(documents, corpus, odd_rows):
    rows = corpus + [(i + 200 if i else None, t) for i, t in odd_rows] + [(300, "a\nb\nc\nd\na\nb\nc\nd\n"), (301, "\n\n\n\n")]
    got = L.dedup_lines(documents(rows)).collect()
    assert len(got) == len(rows)
    want = plain(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.text, r.n_lines, r.n_removed) == want[r.doc_id], r.doc_id
        else:
            assert r.n_removed == 0
    assert Counter(r.n_removed > 0 for r in got)[True] >= 15


def test_chunks_have_two_lines_and_survive_shifts():
    lines = [f"line {i * 7919 % 1000}" for i in range(400)]
    def cuts(ls):
        raw = "\n".join(ls).encode()
        c = L.line_chunks(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
        assert (c["n"] >= 2).all() and c["n"].sum() == len(ls)
        return {tuple(ls[i:i + n]) for i, n in zip(c["idx"].tolist(), c["n"].tolist())}
    a, b = cuts(lines), cuts(["inserted"] + lines[:200] + ["another"] + lines[200:])
    assert len(a - b) <= 4 < len(a) / 10


def test_copies_go_and_columns_stay(documents, odd_rows):
    docs = documents(odd_rows)
    got = L.drop_repeated_lines(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert sum(r.doc_id is None for r in rows) == 2
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.row_ == "x" for r in rows)
    assert L.drop_repeated_lines(documents([])).collect() == []
