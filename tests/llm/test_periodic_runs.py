import random
import re
import zlib

import numpy as np
import pytest
from tripmart.llm import periodic_runs as P
from tripmart.llm import registry

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """Runs by trying every period at every place."""
    out = {}
    for q in range(len(w) // 4, 0, -1):
        i = 0
        while i + q < len(w):
            n = 0
            while i + q + n < len(w) and w[i + n] == w[i + q + n]:
                n += 1
            if n and n + q >= max(6, 4 * q):
                out[i, n + q] = q  # the smallest period comes last
            i += n + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain(text):
    w = WORDS.findall(text or "")
    got = plain_runs(w)
    gone = {i for s, n, q in got for i in range(s + q, s + n)}
    return got, " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i if i < a else a + (i - a) % p] for i in range(n))


def periodic_texts():
    rng = random.Random(5)
    out = ["a " * 6, "a " * 5, "a b " * 4, "a b " * 3 + "a", "x " + "a b c " * 4 + "a y", "a a a a a a b " * 5, "a b a b a b a b c " * 4 + "a b",
           "p q r p q r p q r p q r s t s t s t s t s", "the same line\n" * 30 + "tail", "ab cd " * 2000]
    for _ in range(150):
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        t = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            t += (unit * rng.randint(1, 9))[:rng.randint(1, 60)] + [rng.choice(letters) for _ in range(rng.randint(0, 5))]
        out.append(rng.choice([" ", "  ", "\n"]).join(t))
    return out


def test_runs_equal_brute_force(documents, corpus, odd_rows):
    rows = [(1000 + i, t) for i, t in enumerate(periodic_texts())] + corpus + [r for r in odd_rows if len(r[1] or "") < 10_000]
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in P.periodic_runs(documents(rows).selectExpr("*", "1 AS runs", "2 AS start")).collect()]
    assert sorted(got, key=str) == sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert P.periodic_runs(documents([])).collect() == []


def test_long_texts_of_one_period(documents):
    rows = [(1, "ab cd " * 30_000), (2, "w " * 100_000), (3, " ".join(f"w{i % 997}" for i in range(60_000)))]
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in P.periodic_runs(documents(rows)).collect()}
    assert got[1] == ([(0, 60_000, 2)], "ab cd") and got[2] == ([(0, 100_000, 1)], "w")
    assert got[3] == ([(0, 60_000, 997)], " ".join(f"w{i}" for i in range(997)))


def test_common_lengths_are_exact():
    rng = random.Random(2)
    for _ in range(60):
        word = np.array([rng.randint(0, 2) for _ in range(rng.randint(1, 90))])
        row = np.sort([rng.randint(0, 2) for _ in word])
        s = P.Suffixes(word, row, 5)

        def suffix(p):
            return tuple(word[p:][row[p:] == row[p]])

        want = [p for p in range(len(word)) if sum(suffix(q)[:5] == suffix(p)[:5] and row[q] == row[p] for q in range(len(word))) > 1 and len(suffix(p)) >= 5]
        assert sorted(s.order.tolist()) == want
        for a, b, n in zip(s.order, s.order[1:], s.common[1:]):
            x, y = suffix(a), suffix(b)
            same = next((i for i, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y))) if row[a] == row[b] else 0
            assert n == (same if same >= 5 else 0)


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(periodic_texts() * 3)] + [(None, "a " * 9), (9_001, None)]


def test_planted_texts(documents, rows):
    got = P.with_planted_runs(documents(rows)).collect()
    assert sorted(((r.doc_id, WORDS.findall(r.text or "")) for r in got), key=str) == sorted(
        ((i, WORDS.findall(planted(i, t) or "")) for i, t in rows), key=str)


def test_query_equals_its_sql(spark, tmp_path, rows, corpus):
    import duckdb
    from tripmart.llm import sql
    known = [r for r in rows if r[0] is not None and len(r[1] or "") < 5_000] + [(10_000 + i, t) for i, t in corpus]
    spark.createDataFrame(known, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = registry.op11_periodic_runs(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({sql.PERIODIC_RUNS})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
