import brute
import corpus_pipeline as P
import pytest
import sentencepiece
from test_line_dedup import plain
from tripmart.llm.pieces import MODEL


@pytest.fixture(scope="module")
def tables(spark, documents, corpus, odd_rows, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    rows = corpus + [(i + 200 if i else None, t) for i, t in odd_rows]
    items = [(1, " ".join(corpus[5][1].split()[2:16])), (2, None)]
    documents(rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), rows, items


def test_run_equals_plain_stages(spark, tables):
    """All stages again, by brute force (no stratum has labels enough for cutoffs)."""
    d, rows, items = tables
    rows = [(i, t) for i, t in rows if not brute.base_failed(brute.quality_stats(t))]
    new = plain(rows)
    rows = [(i, t if i is None else new[i][0]) for i, t in rows if i is None or not (new[i][2] and new[i][0] is None)]
    component = brute.near([(i, t) for i, t in dict.fromkeys(rows) if i is not None], 5, 80)
    rows = [(i, t) for i, t in rows if i is None or component[i][1] == i]
    rows = [(i, t) for i, t in rows if not brute.contamination(t, items)[1]]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = P.run(spark, d).collect()
    assert all(r.round_trip for r in got)
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(((i, sp.encode(t)) for i, t in rows), key=str)
    assert 20 < len(got) < 130


def test_stages_keep_columns_and_take_empty_tables(spark, tables, documents):
    d, _, _ = tables
    for name, stage in P.STAGES[:-1]:
        docs = spark.read.parquet(f"{d}/documents.parquet")
        assert stage(spark, docs, d).columns == docs.columns, name
        assert stage(spark, docs.limit(0), d).collect() == [], name
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]
