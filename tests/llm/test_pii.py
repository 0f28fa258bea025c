import brute
from tripmart.llm import pii, registry


def result(docs):
    rows = pii.personal_data(docs).collect()
    return [(r.doc_id, [(s.start, s.kind, s.end) for s in r.spans if s.base], [(s.start, s.kind, s.end) for s in r.spans if not s.base]) for r in rows]


TEXTS = ["a@b.co_x@y.zz, 1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.4 256.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 5 6 7",
         "+1 (222) 333-4444, +12 3, +49 30 1234567890123, ++1234567890", "x..y@-a.b-.c@d.e", "é🙂 a@b.cd é 10.0.0.1 🙂 +1234567890",
         "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2 3", "12  4111111111111111", "a" * 5000 + "@" + "b" * 5000 + ".c", "1." * 4000, "@" * 100, "+" * 50 + "1" * 12,
         "4111 1111 1111 1111 4111 1111 1111 1111", "1.2.3.4" * 30, "mail me: joe@example.com. Or +1 (222) 333-4444."]


def test_base_spans_equal_brute_force(documents, odd_rows, corpus):
    rows = odd_rows + corpus[:20] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = sorted(((i, b) for i, b, _ in result(documents(rows))), key=str)
    assert got == sorted(((i, brute.pii(t)) for i, t in rows), key=str)


def test_contexts_find_more(documents):
    rows = [(i, f"word number {i} hotline: +1 (222) 333-{4000 + i} thanks") for i in range(12)]
    rows += [(50, "their hotline: (222) 555-1234 thanks"), (51, "the size is (222) 555-9876 metres"), (52, "hotline: +1 (222) 333-4000 thanks")]
    got = {i: (b, more) for i, b, more in result(documents(rows))}
    assert got[50] == ([], [(15, 3, 29)]) and rows[12][1][15:29] == "(222) 555-1234"
    assert got[51] == ([], []) and all(not more for i, (_, more) in got.items() if i != 50)


def test_query_columns(spark, tmp_path, documents, odd_rows):
    documents(odd_rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.op1_pii(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = dict(odd_rows)
    for r in got.collect():
        if r.doc_id is not None:
            base = brute.pii(texts[r.doc_id])
            assert (r.base_sha256, r.spans) == (brute.sha(brute.spans_text(base)), brute.spans_text(base))
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
    assert pii.personal_data(documents([])).collect() == []
