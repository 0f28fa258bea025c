import random

from tripmart.llm import cotraining as C


def test_quotas_reach_every_stratum():
    assert C.quotas({1: 2, 2: 1000, 3: 1000}, 400) == {1: 2, 2: 199, 3: 199}
    assert C.quotas({i: 50 for i in range(300)}, 400) == {i: 3 for i in range(300)}
    assert C.quotas({}, 400) == {}


def test_small_source_among_many_documents_hands_over(spark):
    """Of 9,000 unlabelled documents all count: 6 of a source of their own reach the metadata view."""
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(9_600):
        good = i % 2
        rare = 600 <= i < 606
        text = ["%%%" if not good and rng.random() < 0.5 else f"w{rng.randint(0, 50)}" for _ in range(12)] + (["rareword"] if rare else [])
        rows.append((i, " ".join(text), "tiny" if rare else f"src{good}", "en", 50))
        if i < 600:
            marks.append((i, good, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").select(
        "doc_id", "source", "lang", "n_chars", "text")
    known = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    models = C.train(C.features(docs, known), {(t, v): {} for t in C.TASKS for v in (0, 1)})
    got = C.hand_over(docs, known, models, 0)
    labels = dict((i, i % 2) for i in range(9_600))
    to_meta, to_text = got["quality", 1], got["quality", 0]
    assert len(set(range(600, 606)) & set(to_meta)) >= 3
    assert not set(to_meta) & set(range(600)) and max(to_meta) > 4_600
    for x in (to_meta, to_text):
        wrong = [(i, v) for i, v in x.items() if labels[i] != v]
        assert 300 < len(x) <= 420 and len(wrong) <= 2, wrong
