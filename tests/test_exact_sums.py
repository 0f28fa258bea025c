"""Sums of doubles against exact rational sums, rounded once."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripmart.operators.exact_sums import exact_sums, finish, merge_states, sum_states


def _expected(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(map(math.isnan, values)) or {math.inf, -math.inf} <= set(values):
        return math.nan
    if any(map(math.isinf, values)):
        return next(v for v in values if math.isinf(v))
    exact = sum(map(Fraction, values))
    try:
        return float(exact) + 0.0
    except OverflowError:
        return math.inf if exact > 0 else -math.inf


def _same(a, b):
    return (a is None and b is None) or (a is not None and b is not None and (a == b and math.copysign(1, a) == math.copysign(1, b)
                                                                             or math.isnan(a) and math.isnan(b)))


def _groups():
    rnd = random.Random(5)
    spread = [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-12, 25) for _ in range(3000)]
    tiny = 5e-324
    return {
        "spread": spread,
        "cancels": spread + [-v for v in spread] + [1e-12],
        "cents": [rnd.randint(-10**6, 10**6) / 100 for _ in range(3000)],
        "tenths": [0.1] * 10,
        "all exponents": [rnd.choice((-1, 1)) * math.ldexp(rnd.random() + 0.5, e) for e in range(-1074, 1020, 3)],
        "powers": [math.ldexp(1.0, e) for e in range(-1074, 1023)],
        "beside powers": [math.nextafter(math.ldexp(1.0, e), 0.0) for e in range(-1020, 900, 7)],
        "subnormal": [tiny, tiny, -3 * tiny, 7e-320],
        "half up": [1.0, 2.0 ** -53, tiny],
        "half even": [1.0, 2.0 ** -53],
        "half even odd": [1.0 + 2.0 ** -52, 2.0 ** -53],
        "half down": [1.0, 2.0 ** -53, -tiny],
        "negative half": [-1.0, -(2.0 ** -53), -tiny],
        "too large": [1.7976931348623157e308, 1.7976931348623157e308],
        "too large, then not": [1.7976931348623157e308, 1.7976931348623157e308, -1.7976931348623157e308],
        "too low": [-1.7976931348623157e308] * 3,
        "zeros": [0.0, -0.0, None],
        "nulls": [None, None],
        "nan": [1.0, math.nan, math.inf],
        "up": [1.0, math.inf],
        "down": [-math.inf, 4.0, None],
        "both": [math.inf, -math.inf],
        None: [1e16, 1.0, -1e16],
    }


@pytest.mark.parametrize("parts", [1, 7])
def test_equal_to_rational_sums(spark, parts):
    groups = _groups()
    rows = [(k, v, None if v is None else -v) for k, values in groups.items() for v in values]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(parts)
    got = {r.k: r for r in exact_sums(df, ["k"], ["v", "w"]).collect()}
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        assert _same(got[k].v_sum, _expected(values)), (k, got[k].v_sum, _expected(values))
        assert _same(got[k].w_sum, _expected([None if v is None else -v for v in values])), k
        assert got[k].v_n == sum(v is not None for v in values)


def test_states_of_parts_merge_to_the_whole(spark):
    rows = [(i % 3, i % 5, v) for i, v in enumerate(_groups()["spread"])]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    parts = sum_states(df.where("b < 2"), ["a", "b"], ["v"]).unionByName(sum_states(df.where("b >= 2"), ["a", "b"], ["v"]))
    whole = {r.a: r.v_sum for r in exact_sums(df, ["a"], ["v"]).collect()}
    assert {r.a: r.v_sum for r in finish(merge_states(parts, ["a"]), ["a"], ["v"]).collect()} == whole
    assert {r.a: r.v_sum for r in finish(parts, ["a"], ["v"]).collect()} == whole


def test_odd_input(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert exact_sums(none, ["k"], ["v"]).collect() == []
    with pytest.raises(ValueError):
        exact_sums(none.withColumnRenamed("k", "band"), ["band"], ["v"])


def test_one_pass_without_python(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") / 7).alias("v"))
    plan = exact_sums(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastNestedLoop" not in plan
