import numpy as np
import pyarrow as pa

from tripmart.llm import line_dedup as L


def test_lines_are_hashed_once_for_chunks_and_pairs(monkeypatch):
    texts = ["a\nb\nc\nd\ne", "", "x\n\ny\n", "\n"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    at = np.cumsum([0, *(len(t) for t in texts)])
    assert L.line_counts(data, at).tolist() == [5, 1, 4, 2]
    c = L.line_chunks(data, at)
    kind = pa.list_(pa.struct([("idx", pa.int32()), ("h1", pa.int64())]))
    first = {"idx": int(c["idx"][0]), "h1": int(c["h1"].view(np.int64)[0])}
    copied = pa.array([[first], None, None, None], kind)
    calls, real = [], L.lines
    monkeypatch.setattr(L, "lines", lambda *a: calls.append(1) or real(*a))
    free = L.open_pairs(data, at, copied)
    assert len(calls) == 1
    pairs = L.line_pairs(data, at)
    inside = [(r, i) for r, i in zip(pairs["row"].tolist(), pairs["idx"].tolist()) if r == 0 and c["idx"][0] <= i < c["idx"][0] + c["n"][0] - 1]
    assert inside and sorted(zip(free["row"].tolist(), free["idx"].tolist())) == sorted(set(zip(pairs["row"].tolist(), pairs["idx"].tolist())) - set(inside))
