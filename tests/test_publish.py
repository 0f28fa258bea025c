"""Write, audit, publish: failing builds stay unseen."""

import os

import pytest

from tripmart.operators.quality import ModelTests
from tripmart.plans import publish as P

SPEC = ModelTests("m", not_null=("k",), unique=("k",), accepted_values=(("t", ("a", "b")),))


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k int, t string, pickup_date string").selectExpr("k", "t", "cast(pickup_date AS date) AS pickup_date")


def test_a_failing_version_is_not_published_and_readers_keep_theirs(spark, tmp):
    with pytest.raises(LookupError):
        P.current(spark, tmp, "m")
    assert P.publish(spark, tmp, "m", _rows(spark, [(1, "a", "2026-04-01")]), SPEC, view="published_m")
    reader = P.current(spark, tmp, "m")
    assert not P.publish(spark, tmp, "m", _rows(spark, [(1, "a", None), (1, "c", None), (None, "b", None)]), SPEC, view="published_m")
    assert [r.k for r in P.current(spark, tmp, "m").collect()] == [r.k for r in spark.table("published_m").collect()] == [1]
    assert P.publish(spark, tmp, "m", _rows(spark, [(2, "b", None), (3, None, None)]), SPEC, view="published_m")
    assert [r.k for r in reader.collect()] == [1], "a reader goes on with the version that it began with"
    assert sorted(r.k for r in spark.table("published_m").collect()) == [2, 3]
    log = {r.version: (r.published, [tuple(f) for f in r.failures]) for r in P.versions(spark, tmp).collect()}
    assert log == {1: (True, []), 2: (False, [("k", "not_null", 1), ("k", "unique", 1), ("t", "accepted_values", 1)]), 3: (True, [])}


def test_an_upsert_that_fails_changes_nothing(spark, tmp):
    path = os.path.join(tmp, "t")
    assert P.publish_upsert(spark, path, _rows(spark, [(1, "a", "2026-04-01"), (2, "a", "2026-04-02")]), SPEC, key="k") == []
    bad = _rows(spark, [(3, "c", "2026-04-02")])
    assert P.publish_upsert(spark, path, bad, SPEC, key="k") == [("t", "accepted_values", 1)]
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]
    assert P.publish_upsert(spark, path, _rows(spark, [(2, "b", "2026-04-02"), (3, "b", "2026-04-02")]), SPEC, key="k") == []
    assert sorted((r.k, r.t) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "b")]
