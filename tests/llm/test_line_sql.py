"""op6's SQL on the texts of the tests, against its operator."""

import duckdb
from test_line_runs import planted
from tripmart.llm import registry


def test_sql_equals_operator(documents, odd_rows, corpus, tmp_path, spark):
    rows = planted()[0] + [(i + 1000, t) for i, t in corpus] + [(i + 2000 if i else None, t) for i, t in odd_rows]
    rows += [(3000, "a\nb\nc\nd\na\nb\nc\nd\n"), (3001, "\n\n\n\n"), (3002, "x\nx\nx\nx"), (3003, "y\n\n\nz"), (3004, "y\n \t\n\nq"), (3005, "w\ny\n\n\nz")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(registry.ORACLE["op6_line_dedup"]).fetchall()
    got = [tuple(r) for r in registry.op6_line_dedup(spark, str(tmp_path)).select("doc_id", "text", "n_lines", "n_removed").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
