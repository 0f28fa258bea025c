import math

import brute
import pytest
from tripmart.llm import quality_rules as Q


def test_statistics_equal_brute_force(documents, corpus, odd_rows):
    docs = corpus + odd_rows + [(500, "#x\n\n#x\n #x\n" * 7), (501, "a b c d e " * 9 + "ÄÖ"), (502, "\n")]
    got = sorted(Q.stats(documents(docs).select("doc_id", "text")).drop("text").collect(), key=str)
    want = []
    for i, t in docs:
        s = brute.quality_stats(t)
        want.append((i, *[s[k] for k in Q.STATS], brute.base_failed(s)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_binomial_is_exact():
    for n, p in ((20, 0.1), (7, 0.5)):
        for k in range(n + 1):
            assert Q.binomial_cdf(k, n, p) == pytest.approx(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def holdout(n, bad_share):
    """n good texts per language; in "de" a share of them is all capitals."""
    def spelt(number):  # no digits: a text in capitals is all capitals
        return "".join(chr(97 + int(c)) for c in str(number))

    rows, labels = [], []
    for i in range(n):
        for j, lang in enumerate(("en", "de")):
            words = " ".join(f"{'Wort' if lang == 'de' else 'word'}{spelt((i * 7 + k * 13) % 997)} und" for k in range(12))
            rows.append((2 * i + j, words.upper() if lang == "de" and i < bad_share * n else words, lang))
            labels.append((2 * i + j, 1, 0))
    return rows, labels


def test_cutoffs_hold_the_risk(spark):
    rows, labels = holdout(1500, 0.2)
    extra = [(9001, "SHOUTING WORDS ONLY " + " ".join(f"LOUD{c}" for c in "ABCDEFGHIJKLMN"), "en"),
             (9002, "SHOUTING WORDS ONLY " + " ".join(f"LOUD{c}" for c in "ABCDEFGHIJKLMN"), "de"),
             (9003, "SHOUTING WORDS ONLY " + " ".join(f"LOUD{c}" for c in "ABCDEFGHIJKLMN"), None),
             (9004, " ".join(f"w{i}***" for i in range(30)), "en")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels + labels[:5] + [(7000, None, 0), (None, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    scored = Q.written(Q.stats(docs.select("doc_id", "lang", "text")).drop("text"), "t")
    cuts = {r.stratum: r.asDict() for r in Q.cutoffs(scored, marks).collect()}
    assert set(cuts) == {"en", "de"}
    assert cuts["en"]["capitals"] == 40 and cuts["de"]["capitals"] is None  # a fifth of "de" is in capitals
    kept = {r.doc_id: r.kept for r in Q.quality(docs, marks).collect()}
    assert not kept[9001] and kept[9002] and kept[9003] and not kept[9004]
    # Independent check of the guarantee: the exact bound of what is lost, per rule and stratum.
    for lang in cuts:
        good = [brute.quality_stats(t) for i, t, x in rows if x == lang and i != 1]
        for rule, (stat, base, ladder) in Q.RULES.items():
            cut = cuts[lang][rule]
            if cut is not None:
                lost = sum(100 * s[stat] > cut * s[base] for s in good)
                assert Q.binomial_cdf(lost, len(good), Q.RISK / len(Q.RULES)) <= Q.LEVEL / (2 * len(Q.RULES))


def test_few_labels_keep_everything_that_passes_the_base_rule(spark, documents, odd_rows, corpus):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for got in Q.quality(documents(odd_rows + corpus), labels).collect():
        assert got.kept == (not got.base_failed)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(odd_rows)
    kept = Q.keep_good(docs, empty)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if not brute.base_failed(brute.quality_stats(r.text))), key=str)
    assert Q.keep_good(documents([]), empty).collect() == []
