import brute
import numpy as np
import pytest
from tripmart.llm import minhash_dedup as M


def result(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("rounds", [0, 2])
@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(documents, corpus, monkeypatch, words, percent, rounds):
    monkeypatch.setattr(M, "STAR_ROUNDS", rounds)  # 0: everything by the exact join
    want = brute.near(corpus, words, percent)
    got = result(M.near_duplicates(documents(corpus), M.NearDup(words, percent)))
    assert got == {(i, n, c) for i, (n, c) in want.items()}
    assert len({c for _, c in want.values()}) < len(corpus) - 25


def test_odd_rows(documents, odd_rows):
    rows = M.near_duplicates(documents(odd_rows), M.NearDup(3, 85)).collect()
    assert len(rows) == len(odd_rows)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (1, 4) and by[5] == (1, 5)
    assert by[9] == (by[8][0], 8)
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id is None} == {(0, None), (by[8][0], None)}


def test_empty_table_and_kept_rows(documents, odd_rows, corpus):
    assert M.near_duplicates(documents([]).limit(0)).collect() == []
    docs = documents(odd_rows)
    kept = M.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert kept.where("doc_id IS NULL").count() == 2


def test_registers_agree_as_often_as_sets(spark):
    """Registers of two sets with a known similarity, and the likelihood's estimate of it."""
    a = " ".join(f"w{i}" for i in range(1000))
    b = " ".join(f"w{i}" for i in range(100, 1100))  # 898 of 1098 shingles shared
    how = M.NearDup(3, 80, 4, 100)
    rows = M.sketch(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), how).orderBy("doc_id").collect()
    x, y = (np.frombuffer(r.registers, dtype=np.uint16) for r in rows)
    true = 898 / 1098
    assert abs((x == y).mean() - true) < 0.1
    grid = np.arange(0, 1, 0.01)
    one = np.ones(1)
    scores = [M.log_likelihood((x > y).sum() * one, (x < y).sum() * one, (x == y).sum() * one, 0.5 * one, j * one)[0] for j in grid]
    assert abs(grid[int(np.argmax(scores))] - true) < 0.1


def test_clashing_names_of_every_helper_column(spark, corpus):
    names = ["row_", "gone_id", "id_", "component", "component_id", "n_shingles", "n", "h1", "h2", "rep", "key", "id", "leader", "a", "b", "registers"]
    docs = spark.createDataFrame([(i, t, *range(len(names))) for i, t in corpus], ["doc_id", "text", *names])
    kept = M.keep_representatives(docs)
    assert kept.columns == docs.columns
    want = brute.near(corpus, 5, 80)
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in docs.collect() if want[r.doc_id][1] == r.doc_id)


def test_words_that_sums_of_powers_take_for_each_other(spark):
    """Two words of 2,048 letters whose polynomial hashes modulo 2**64 are equal whatever the base."""
    x = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    y = "".join("ba"[bin(i).count("1") % 2] for i in range(2048))
    rows = M.near_duplicates(spark.createDataFrame([(1, x), (2, y), (3, x)], "doc_id long, text string"), M.NearDup(3, 85)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 2, 3: 1}


def test_the_likelihood_keeps_pairs_at_the_threshold():
    """Registers of pairs of sets at the least similarity of a link: how many the likelihood would drop."""
    rng = np.random.default_rng(4)
    for percent, how in ((85, M.NearDup(3, 85, 4, 25)), (80, M.NearDup())):
        lost = 0
        for size in (20, 100, 1000):
            common = -(-2 * size * percent // (100 + percent))
            for _ in range(10):  # 10 batches of some hundred pairs
                pairs = 340
                h = rng.random((pairs, how.registers, 3)) ** (1 / np.array([common, size - common, size - common]).clip(1))
                h = 1 - h  # least of that many uniform hashes
                least = [np.minimum(h[:, :, 0], h[:, :, i] if size > common else 1) for i in (1, 2)]
                ra, rb = (M.register_scale((x * 2.0**64).astype(np.uint64)) for x in least)
                more, less = (ra > rb).sum(1), (ra < rb).sum(1)
                same, u = how.registers - more - less, np.full(pairs, 0.5)
                best = np.max([M.log_likelihood(more, less, same, u, np.full(pairs, j)) for j in np.arange(0, 1.0001, 0.02)], axis=0)
                at = np.max([M.log_likelihood(more, less, same, u, np.full(pairs, j)) for j in np.arange(percent / 100, 1.0001, 0.01)], axis=0)
                lost += int((at <= best - M.REJECT).sum())
        assert lost == 0  # of 10,200 pairs
