import random

from tripmart.llm import cotraining as C


def labelled(spark, n=900):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(n):
        quality, toxic = int(rng.random() > 0.25), int(rng.random() < 0.2)
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["vile", "nasty"])
        text = " ".join(t if quality else t + "%%%" for t in text)
        rows.append((i, text, f"src{rng.randint(0, 3) if quality else rng.randint(2, 5)}", "en", len(text)))
        marks.append((i, quality, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    return docs, marks


def test_held_out_accuracy(spark):
    docs, marks = labelled(spark)
    known = spark.createDataFrame(marks[:600], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in C.classify(docs, known).collect()}
    assert len(got) == 900
    held = marks[600:]
    assert sum((got[i].quality_score >= 0.5) == bool(q) for i, q, _ in held) >= 0.98 * len(held)
    assert sum((got[i].toxic_score >= 0.5) == bool(t) for i, _, t in held) >= 0.95 * len(held)
    assert sum(got[i].kept == (q == 1 and t == 0) for i, q, t in held) >= 0.93 * len(held)


def test_odd_rows_and_labels(spark, documents, odd_rows):
    def scores(labels):
        return C.classify(documents(odd_rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r.quality_score, r.kept) for r in scores([])} == {(0.5, True)}
    assert {r.quality_score for r in scores([(1, 1, 0), (2, 1, 0), (2, 1, 0)])} == {1.0}
    mixed = scores([(i, i % 2, None) for i in range(1, 11)] + [(None, 0, 0), (3, 0, 1)])
    assert len(mixed) == len(odd_rows) and all(0 <= r.quality_score <= 1 for r in mixed)
    assert C.classify(documents([]), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []
