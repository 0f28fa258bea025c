import random
from collections import Counter

from tripmart.llm import line_dedup as L
from tripmart.llm import registry


def brute(rows):
    """doc_id -> (text, lines removed): every line of a pair of lines that occurs before goes."""
    seen, out = set(), {}
    for i, t in sorted((r for r in dict.fromkeys(rows) if r[0] is not None), key=lambda r: r[0]):
        ls, gone = (t or "").split("\n"), set()
        for k, pair in enumerate(zip(ls, ls[1:])):
            if pair in seen and any(x.strip(" \t\r\v\f") for x in pair):
                gone |= {k, k + 1}
            seen.add(pair)
        for k in range(len(ls)) if gone else ():
            a, b = k, k
            while a >= 0 and a not in gone and not ls[a].strip(" \t\r\v\f"):
                a -= 1
            while b < len(ls) and b not in gone and not ls[b].strip(" \t\r\v\f"):
                b += 1
            if (a < 0 or a in gone) and (b == len(ls) or b in gone):
                gone = gone | {k}
        kept = [x for k, x in enumerate(ls) if k not in gone]
        out[i] = (("\n".join(kept) if kept else None) if gone else t, len(gone))
    return out


def planted():
    """Blocks of 2 to 8 lines, each in several texts between lines of their own, at any place."""
    rng = random.Random(3)
    blocks = [[f"block {b} of {n} line {k} {rng.random()}" for k in range(n)] for n in range(2, 9) for b in range(3)]
    blocks += [["", "after a blank", "", "", "", "more", ""]]
    rows, lengths = [], {}
    for i in range(150):
        block = blocks[i % len(blocks)]
        before, after = ([f"own {i} {s} {k}" for k in range(rng.randint(0, 4))] for s in "ab")
        rows.append((i, "\n".join(before + block + after)))
        lengths[i] = (len(block), len(before) + len(after))
    return rows, lengths, len(blocks)


def test_planted_blocks_go_whole(documents, odd_rows, corpus, tmp_path, spark):
    rows, lengths, n = planted()
    rows += [(i + 1000, t) for i, t in corpus] + [(i + 2000 if i else None, t) for i, t in odd_rows]
    rows += [(3000, "a\nb\nc\nd\na\nb\nc\nd\n"), (3001, "\n\n\n\n"), (3002, "x\nx\nx\nx"), (3003, "y\n\n\nz")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op6_line_dedup(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.text, r.n_removed) == want[r.doc_id], r.doc_id
    seen = Counter()
    for r in sorted((r for r in got if r.doc_id is not None and r.doc_id < 150), key=lambda r: r.doc_id):
        block, own = lengths[r.doc_id]
        assert (r.n_removed, r.n_lines - r.n_removed) == ((block, own) if r.doc_id >= n else (0, block + own))
        seen[block] += r.n_removed > 0
    assert min(seen[k] for k in range(2, 9)) >= 10


def test_pairs_are_all_neighbouring_lines_but_blank_ones():
    import numpy as np
    raw = [b"a\nb\n\n \nc", b"", b"one", b"d\ne"]
    at = np.cumsum([0, *map(len, raw)])
    c = L.line_pairs(np.frombuffer(b"".join(raw), dtype=np.uint8), at)
    assert list(zip(c["row"].tolist(), c["idx"].tolist())) == [(0, 0), (0, 1), (0, 3), (3, 0)]


def test_few_kinds_of_lines(documents, tmp_path, spark):
    """Texts of a few kinds of lines, blank ones too, so that copied chunks, their edges and short runs meet everywhere."""
    rng = random.Random(5)
    block = ["a", "", "b", "c", "", "", "a", "b", "d", "c", "", "e", "f", "a", "g"]
    rows = []
    for i in range(200):
        own = [rng.choice(["", " ", "a", "b", "c", f"own {i}", f"own {rng.randint(0, 99)}"]) for _ in range(rng.randint(0, 12))]
        at = rng.randint(0, len(block) - 2)
        rows.append((i, "\n".join(own[:len(own) // 2] + block[at:at + rng.randint(0, 15)] + own[len(own) // 2:])))
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows)
    for r in registry.op6_line_dedup(spark, str(tmp_path)).collect():
        assert (r.text, r.n_removed) == want[r.doc_id], r.doc_id


def test_pairs_in_copied_chunks_are_left_out():
    import numpy as np
    import pyarrow as pa
    raw = "\n".join(f"line {i * 7919 % 1000}" for i in range(60)).encode()
    data, at = np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])
    c = L.line_chunks(data, at)
    assert len(c["idx"]) > 4
    wanted = [{"idx": int(c["idx"][k]), "h1": int(L.signed(c["h1"])[k])} for k in (1, 3)] + [{"idx": 0, "h1": 1}, {"idx": 999, "h1": 2}]
    copied = pa.array([wanted], pa.list_(pa.struct([("idx", pa.int32()), ("h1", pa.int64())])))
    inside = {i + j for k in (1, 3) for i, n in [(int(c["idx"][k]), int(c["n"][k]))] for j in range(n - 1)}
    assert set(L.open_pairs(data, at, copied)["idx"].tolist()) == set(range(59)) - inside


def test_rows_that_share_a_doc_id_lose_their_own_repeats_only(documents, tmp_path, spark):
    rows = [(1, "a\nb\nc"), (2, "a\nb\nx"), (2, "p\nq\nr")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op6_line_dedup(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "a\nb\nc"), (2, "p\nq\nr"), (2, "x")]
