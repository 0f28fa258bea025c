"""Sums of doubles that are exact before one final rounding (A2/A3 without a fixed scale).

A double is an integer times a power of two. Values are grouped by the band of ``STEP`` binary exponents
that they lie in; within a band they are integers of 66 bits of one unit, kept as three longs of 22 bits,
whose sums are exact whatever the order (2**40 rows a band; more would raise an error, as the session's
arithmetic is checked). So a state (keys, column, band, three sums, counts) is a plain grouped sum: it is
added up on the map side, merges with other states of the same keys by adding, and does not depend on the
number of partitions or on retries. ``finish`` puts a group's bands, 181 at most, together into one
number in base 2**20 and rounds once, half to even: the sum is the double nearest to the true one.

Defined results: NULLs are left out, a group without other values has a NULL sum; NaN or infinities of
both signs give NaN, those of one sign give it; a sum beyond the largest double is infinite; a sum of
zeros is 0.0 (never -0.0). Averages are that sum over the number of non-NULL values. NULL keys are a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 12  # exponents in a band
BELOW = 53  # a band's unit is 2**(STEP * band - BELOW)
PIECE = 22  # bits of one long
LIMB = 20  # bits of a digit of the final number
LOWEST = -1140  # the final number counts units of 2**LOWEST, under the unit of the least band; a multiple of LIMB and of STEP
STATE = ("p0", "p1", "p2", "n", "n_nan", "n_up", "n_down", "n_rows")


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _scaled(x: Column, exponent: Column) -> Column:
    """x * 2**exponent in two steps, as one power alone may be no double."""
    half = F.floor(exponent / 2)
    return x * _power(half) * _power(exponent - half)


def sum_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, column, band, p0, p1, p2, n, n_nan, n_up, n_down, n_rows) of the double ``columns``."""
    clash = {"column", "band", "x", *STATE} & {k.lower() for k in keys}
    if clash:
        raise ValueError(f"keys named as a state's own columns: {sorted(clash)}")
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    rows = df.select(*keys, values.alias("_v")).select(*keys, "_v.column", "_v.x")
    size = F.abs("x")
    finite = F.col("x").isNotNull() & ~F.isnan("x") & (size < float("inf"))
    # log2 may be off near a power of two: bands have a bit to spare at both ends.
    band = F.when(finite & (size > 0), F.floor(F.log2(size) / STEP)).otherwise(F.lit(0)).cast("int")
    rows = rows.select(*keys, "column", "x", band.alias("band"), finite.alias("_finite"))
    y = F.when(F.col("_finite"), _scaled(F.col("x"), BELOW - STEP * F.col("band"))).otherwise(F.lit(0.0))
    high = (F.col("_y") / float(2 ** (2 * PIECE))).cast("long")
    rest = F.col("_y") - F.col("p2") * float(2 ** (2 * PIECE))
    middle = (F.col("_rest") / float(2 ** PIECE)).cast("long")
    low = (F.col("_rest") - F.col("p1") * float(2 ** PIECE)).cast("long")
    rows = rows.withColumn("_y", y).withColumn("p2", high).withColumn("_rest", rest).withColumn("p1", middle).withColumn("p0", low)
    return rows.groupBy(*keys, "column", "band").agg(
        F.sum("p0").alias("p0"), F.sum("p1").alias("p1"), F.sum("p2").alias("p2"), F.count("x").alias("n"),
        F.count_if(F.isnan("x")).alias("n_nan"), F.count_if(F.col("x") == float("inf")).alias("n_up"),
        F.count_if(F.col("x") == float("-inf")).alias("n_down"), F.count("*").alias("n_rows"))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of the same or of fewer keys: they are added."""
    return states.groupBy(*keys, "column", "band").agg(*[F.sum(c).alias(c) for c in STATE])


def _times_power(v: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", v, bits.cast("int"))


def _parts(pieces: Column) -> Column:
    """Pieces (at: bit above LOWEST, v: long) cut at the borders of digits: (i: digit, v), three a piece; only the last of
    them may be negative."""
    def three(p):
        digit, bit = F.floor(p["at"] / LIMB).cast("int"), p["at"] % LIMB
        parts = (F.pmod(p["v"], F.lit(2 ** LIMB)), F.pmod(F.shiftright(p["v"], LIMB), F.lit(2 ** LIMB)), F.shiftright(p["v"], 2 * LIMB))
        return F.array(*[F.struct((digit + k).alias("i"), _times_power(v, bit).alias("v")) for k, v in enumerate(parts)])

    return F.flatten(F.transform(pieces, three))


def _carried(parts: str, low: str) -> Column:
    """Digits in [0, 2**LIMB), least first, from digit ``low`` to where no carry is left, and the sign: 0 or -1."""
    plain = F.transform(F.sequence(F.col(low), F.array_max(F.transform(parts, lambda p: p["i"])) + 4), lambda i: F.aggregate(
        F.filter(parts, lambda p: p["i"] == i), F.lit(0).cast("long"), lambda total, p: total + p["v"]))
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(state, v):
        total = state["carry"] + v
        return F.struct(F.shiftright(total, LIMB).alias("carry"),
                        F.concat(state["out"], F.array(F.pmod(total, F.lit(2 ** LIMB)))).alias("out"))

    return F.aggregate(plain, start, step, lambda state: F.concat(state["out"], F.array(state["carry"])))


def _rounded(df: DataFrame) -> DataFrame:
    """``df`` (pieces) with ``size``, the double nearest to the sum of the pieces without its sign, and ``below``."""
    df = df.withColumn("_parts", _parts(F.col("pieces")))
    df = df.withColumn("_low", F.array_min(F.transform("_parts", lambda p: p["i"])))
    df = df.withColumn("_digits", _carried("_parts", "_low")).withColumn("below", F.element_at("_digits", -1) < 0)
    minus = F.transform("pieces", lambda p: F.struct(p["at"].alias("at"), (-p["v"]).alias("v")))
    df = df.withColumn("_parts", F.when(F.col("below"), _parts(minus)).otherwise(F.col("_parts")))
    df = df.withColumn("_digits", F.when(F.col("below"), _carried("_parts", "_low")).otherwise(F.col("_digits")))
    df = df.withColumn("_top", F.array_max(F.transform("_digits", lambda d, i: F.when(d != 0, i))))  # NULL: all are zero

    def digit(k: int) -> Column:  # the k-th from the greatest that is not zero
        return F.coalesce(F.get("_digits", F.col("_top") - k), F.lit(0).cast("long"))

    three = _times_power(digit(0), F.lit(2 * LIMB)) + _times_power(digit(1), F.lit(LIMB)) + digit(2)  # 41 to 60 bits
    df = df.withColumn("_three", three).withColumn("_fourth", digit(3))
    df = df.withColumn("_more", F.least(F.lit(LIMB), 62 - F.length(F.bin("_three"))))  # bits of the fourth that still fit
    unit = _times_power(F.lit(1).cast("long"), LIMB - F.col("_more"))
    df = df.withColumn("_unit", unit)
    taken = _times_power(F.col("_three"), F.col("_more")) + F.floor(F.col("_fourth") / F.col("_unit"))
    lower = F.slice("_digits", F.lit(1), F.greatest(F.col("_top") - 3, F.lit(0)))
    left = (F.col("_fourth") % F.col("_unit") != 0) | F.exists(lower, lambda d: d != 0)
    # The last of 61 or 62 bits tells whether anything follows, so that the one rounding to 53 bits is right.
    df = df.withColumn("_taken", taken.bitwiseOR(F.when(left, F.lit(1)).otherwise(F.lit(0)).cast("long")))
    exponent = (F.col("_top") - 2 + F.col("_low")) * LIMB - F.col("_more") + LOWEST
    return df.withColumn("size", F.when(F.col("_top").isNull(), F.lit(0.0)).otherwise(_scaled(F.col("_taken").cast("double"), exponent)))


def finish(states: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A row per key with ``n_rows``, ``<column>_sum`` (double) and ``<column>_n`` (non-NULL values) from states, one or more a band."""
    states = merge_states(states, keys)
    base = F.col("band") * STEP - BELOW - LOWEST
    pieces = F.array(*[F.struct((base + PIECE * k).alias("at"), F.col(f"p{k}").alias("v")) for k in range(3)])
    one = _rounded(states.groupBy(*keys, "column").agg(
        F.flatten(F.collect_list(pieces)).alias("pieces"), *[F.sum(c).alias(c) for c in STATE[3:]]))
    total = (F.when(F.col("n") == 0, F.lit(None).cast("double"))
              .when((F.col("n_nan") > 0) | ((F.col("n_up") > 0) & (F.col("n_down") > 0)), F.lit(float("nan")))
              .when(F.col("n_up") > 0, F.lit(float("inf"))).when(F.col("n_down") > 0, F.lit(float("-inf")))
              .otherwise(F.when(F.col("below"), -F.col("size")).otherwise(F.col("size"))))
    one = one.select(*keys, "column", total.alias("total"), "n", "n_rows")
    wide = [F.max(F.when(F.col("column") == c, F.col(v))).alias(f"{c}_{name}") for c in columns for v, name in (("total", "sum"), ("n", "n"))]
    return one.groupBy(*keys).agg(F.max("n_rows").alias("n_rows"), *wide)


def exact_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys, ``n_rows``, and ``<column>_sum`` and ``<column>_n`` for each of ``columns``."""
    return finish(sum_states(df, keys, columns), keys, columns)
