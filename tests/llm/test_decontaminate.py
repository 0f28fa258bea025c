import brute
import pytest
from tripmart.llm import decontaminate as D


def check(docs, items, spark, documents):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, tuple(r["items"]))
                 for r in D.contamination(documents(docs), benchmark).collect())
    want = sorted((i if i is not None else -1, *[x if not isinstance(x, list) else tuple(x) for x in brute.contamination(t, items)])
                  for i, t in docs)
    assert got == want
    return got


def test_equals_brute_force(spark, documents, corpus, odd_rows):
    items = [(100 + i, " ".join(t.split()[3:3 + n])) for (i, t), n in zip(corpus[2:60:3], [10, 11, 25, 4, 9, 1, 14] * 3)]
    items += [(7, None), (8, ""), (9, "..."), (2, "the same LINE of a text and one more line third"), (11, "one"), (11, "one"),
              (12, "ab cd " * 40), (13, "größe 日本語")]
    got = check(corpus + odd_rows, items, spark, documents)
    assert sum(r[2] > 0 for r in got) > 20


def test_empty_tables(spark, documents, corpus):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in D.contamination(documents(corpus[:9]), benchmark).collect()} == {0}
    assert D.contamination(documents([]), benchmark).collect() == []


def test_keep_clean_keeps_columns_and_clean_rows(spark, documents, odd_rows):
    docs = documents(odd_rows)
    benchmark = spark.createDataFrame([(1, "one more line third line here")], "item_id long, text string")
    kept = D.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 10]
    assert kept.where("doc_id IS NULL").count() == 1


@pytest.mark.parametrize("span", [10, 12])
def test_every_long_shared_span_is_found(spark, documents, span):
    """The guarantee: whatever the position, a shared run of ``span`` words is hit in full."""
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(["x"] * 7 + words[i:i + span] + ["y"] * 7)) for i in range(0, 150)]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert {r.n_hit for r in D.contamination(documents(docs), benchmark, span).collect()} == {span}
