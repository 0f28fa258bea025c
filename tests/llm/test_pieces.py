import brute
import pytest
import sentencepiece
from tripmart.llm import pieces as P
from tripmart.llm.token_counts import token_counts

TEXTS = ["", " ", "  a  b ", "\n\nx\n", "\t tab", "▁ literal ▁▁", "日本語テキスト 🙂🙂 mixed", "a" * 700, "wordwordword" * 30 + " end",
         "ééé ß İ ﬁ", "\x00\x01", "The end.\r\nNew line", "x" * 64, "x" * 65, " " * 90 + "y"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


@pytest.fixture(scope="module")
def rows(corpus, odd_rows):
    return corpus[:60] + [(1000 + i, t) for i, t in enumerate(TEXTS)] + [
        (i if i is None else 5000 + i, t) for i, t in odd_rows]


def test_ids_are_the_library_s(documents, rows, library):
    got = P.encode(documents(rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert r.round_trip and r.n_tokens == len(r.ids)
        if r.doc_id is not None and "▁" not in (texts[r.doc_id] or ""):
            assert r.ids == library.encode(texts[r.doc_id] or ""), texts[r.doc_id][:60]


def test_decoding_gives_the_text_back(documents, rows):
    encoded = P.encode(documents(rows))
    back = {(r.doc_id, r.text) for r in P.decode(encoded).collect()}
    assert back == {(i, t or "") for i, t in rows}


def test_unigram_search_equals_plain_viterbi(rows, library):
    import numpy as np
    table = P.PieceTable.load(merges=False)
    plain = {library.id_to_piece(i): (i, library.get_score(i)) for i in range(259, library.get_piece_size())}
    texts = [t or "" for _, t in rows if len(t or "") < 5000]
    raw = [t.encode() for t in texts]
    at = np.cumsum([0, *map(len, raw)])
    ids, counts = P.Encoder(table).encode(np.frombuffer(b"".join(raw), dtype=np.uint8), at)
    ends = np.cumsum([0, *counts])
    for t, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == brute.viterbi(t, plain, table.longest, table.unknown, table.byte_ids.tolist())


def test_trie_counts_are_the_lengths(documents, rows):
    lengths = sorted(((r.doc_id, r.n_tokens) for r in P.encode(documents(rows)).collect()), key=str)
    counts = token_counts(documents(rows)).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in counts), key=str) == lengths
    assert all((r.n_pretokens == 0) == (r.n_tokens == 0) for r in counts)


def test_empty_table(documents):
    assert P.encode(documents([])).collect() == [] and token_counts(documents([])).collect() == []
