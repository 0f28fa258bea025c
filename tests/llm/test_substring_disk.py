"""What op9 leaves on disk and lets through its filters."""

import os
import time
from urllib.parse import urlparse

import brute
import numpy as np
from pyspark.sql import functions as F
from tripmart.llm import common as C
from tripmart.llm import substring_dedup as S


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_the_filter_grows_with_its_keys(spark, monkeypatch):
    monkeypatch.setattr(C, "BITS", 10)
    keys = spark.range(4_000).select(F.xxhash64("id").alias("m"))
    bits = C.key_filter(keys, "m", 4_000).value
    own = np.array([r.m for r in keys.collect()], dtype=np.int64).view(np.uint64)
    other = np.array([r.m for r in spark.range(4_000, 44_000).select(F.xxhash64("id").alias("m")).collect()], dtype=np.int64).view(np.uint64)
    assert C.in_filter(bits, own).all() and C.in_filter(bits, other).mean() < 0.08
    monkeypatch.setattr(C, "MOST_BITS", 12)
    small = C.key_filter(keys, "m", 4_000).value
    assert len(small) == 1 << 6 and C.in_filter(small, own).all()
    assert not C.in_filter(C.key_filter(keys.limit(0), "m", 0).value, other).any()


def test_tables_and_shuffles_go_with_their_last_reader(spark, documents, corpus, monkeypatch):
    made = []
    real = C.scratch_dir
    monkeypatch.setattr(C, "scratch_dir", lambda s, name: made.append((name, real(s, name))) or made[-1][1])
    monkeypatch.setattr(C, "BITS", 8)  # the filters of hashes are sized by their keys
    monkeypatch.setattr(S, "bitmap", lambda df, column: spark.sparkContext.broadcast(np.full(1 << 19, -1, dtype=np.int64).view(np.uint64)))
    before = _shuffles(spark)
    got = S.remove_repeats(documents(corpus))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for _ in range(40):
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(key, None) in (None, "false")
    assert sorted(name for name, path in made if os.path.isdir(urlparse(path).path)) == ["base", "cut"]
    assert len(made) > 10
    want = brute.substring_dedup(corpus)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == want


def test_texts_come_back_from_their_packed_form(spark, documents):
    rows = [(1, "é" * 60), (2, "a" * 70_000), (3, "x"), (4, "\x00 and more")]
    bits = C.bitmap(documents(rows).where("doc_id <> 3"), "doc_id")
    got = S.packed(documents(rows), bits).toArrow()
    back = S.unpacked(got.column("size").combine_chunks(), got.column("packed").combine_chunks())
    assert dict(zip(got.column("doc_id").to_pylist(), back)) == {i: t.encode() for i, t in rows if i != 3}
