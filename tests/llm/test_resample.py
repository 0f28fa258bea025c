import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from tripmart.llm import registry, resample as R, sql

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(rows, target, how):
    """(doc_id, n_features, weight, score, rank) from the definition."""
    def bag(text):
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = [" ".join(w[i:i + k]) for k in range(1, how.grams + 1) for i in range(len(w) - k + 1)]
        return len(w), [zlib.crc32(g.encode()) % how.buckets for g in grams]

    bags = [(i, *bag(t)) for i, t in rows]
    s, t = Counter(b for x in bags for b in x[2]), Counter(b for x in target for b in bag(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + how.buckets) / ((s[b] + 1) * (n_t + how.buckets)))) for b in s}
    out = []
    for i, n, bs in bags:
        weight = math.floor(Fraction(sum(gain[b] for b in bs), len(bs))) if bs else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{how.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(bs), weight, score, None, n])
    may = sorted((x for x in out if x[3] is not None and x[5] >= how.least_words), key=lambda x: (-x[3], x[0], x[1], x[2]))
    for rank, x in enumerate(may[:how.percent * len(may) // 100], 1):
        x[4] = rank
    return sorted(([*x[:5]] for x in out), key=str)


def got(spark, docs, target, how):
    goal = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, bucket int")
    return sorted((list(r) for r in R.resample(docs, goal, how).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("how", [R.Resample(), R.Resample(grams=3, buckets=97, percent=45, least_words=2), R.Resample(buckets=1, percent=100, least_words=1)])
def test_equals_brute_force(spark, documents, corpus, odd_rows, how):
    target = [corpus[3][1], "The WORD one two", None, ""]
    rows = corpus + odd_rows + [(7, "größe ▁ 日本語 🙂 x y\r\nz"), (900, "\x00a\x00b c\x7fd É é")]
    assert got(spark, documents(rows).selectExpr("*", "7 AS rank", "8 AS buckets", "9 AS score"), target, how) == plain(rows, target, how)


def test_no_feature_crosses_documents():
    counts, row, value = R.gram_buckets(b"a bc d", __import__("numpy").array([0, 3, 3, 6]), 2, 1 << 32)
    assert counts.tolist() == [2, 0, 2] and row.tolist() == [0, 0, 0, 2, 2, 2]
    assert value.tolist() == [zlib.crc32(g) for g in (b"a", b"b", b"a b", b"c", b"d", b"c d")]


def test_ties_and_empty_tables(spark, documents):
    rows = [(5, "same words here " * 9)] * 30 + [(i, "same words here " * 9) for i in range(100, 140)]
    assert got(spark, documents(rows), ["same"], R.Resample(percent=70)) == plain(rows, ["same"], R.Resample(percent=70))
    assert got(spark, documents([]), ["same"], R.Resample()) == []
    assert got(spark, documents(rows), [], R.Resample()) == plain(rows, [], R.Resample())


def test_query_equals_sql(spark, tmp_path, corpus):
    spark.createDataFrame(corpus, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, corpus[2][1]), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(f"SELECT doc_id, n_features, weight, score, rank FROM ({sql.IMPORTANCE_RESAMPLING})").fetchall()
    assert sorted(map(tuple, registry.op13_importance_resampling(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
