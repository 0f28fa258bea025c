"""Data tests and run metrics as DataFrame operators.

Checks return DataFrames of failures/counts instead of raising, so a suite
over many models runs as a few distributed aggregates: every not_null and
accepted_values check of one table shares a single pass, each unique check is
one grouped count (partial aggregation absorbs hot values).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RESULT_COLS = ["model", "column_name", "test", "failures"]


def null_count_exprs(columns: Iterable[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def check_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """One row per column with its NULL count (0 = pass)."""
    return _melt(df.agg(*null_count_exprs(columns)), columns, "not_null")


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Count of non-NULL values outside ``values`` (NULL passes)."""
    agg = df.agg(F.count_if(~F.col(column).isin(list(values))).alias(column))
    return _melt(agg, [column], "accepted_values")


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """The duplicated non-NULL values with their multiplicity."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """T2 summary: number of duplicated values (0 = pass)."""
    agg = unique_violations(df, column).agg(F.count(F.lit(1)).alias(column))
    return _melt(agg, [column], "unique")


def _melt(agg: DataFrame, columns: Sequence[str], test: str, model: str = "") -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("failures"))
             for c in columns]
    return (agg.select(F.explode(F.array(*pairs)).alias("r"))
               .select(F.lit(model).alias("model"), "r.column_name", F.lit(test).alias("test"),
                       "r.failures"))


@dataclass(frozen=True)
class ModelTests:
    """Declared tests of one model (the YAML block of a model)."""
    model: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted_values: tuple[tuple[str, tuple], ...] = ()


def run_model_tests(df: DataFrame, spec: ModelTests) -> DataFrame:
    """All tests of one model: not_null + accepted_values in one aggregate,
    one grouped count per unique column. Columns are matched
    case-insensitively as the warehouse does."""
    exprs, names = [], []
    for c in spec.not_null:
        exprs.append(F.count_if(F.col(c).isNull()).alias(f"nn{len(names)}"))
        names.append((c, "not_null"))
    for c, vals in spec.accepted_values:
        exprs.append(F.count_if(~F.col(c).isin(list(vals))).alias(f"av{len(names)}"))
        names.append((c, "accepted_values"))
    parts = []
    if exprs:
        agg = df.agg(*exprs)
        pairs = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"),
                          F.col(agg.columns[i]).cast("bigint").alias("failures"))
                 for i, (c, t) in enumerate(names)]
        parts.append(agg.select(F.explode(F.array(*pairs)).alias("r"))
                        .select(F.lit(spec.model).alias("model"), "r.column_name", "r.test", "r.failures"))
    for c in spec.unique:
        u = unique_violations(df, c).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        parts.append(u.select(F.lit(spec.model).alias("model"), F.lit(c).alias("column_name"),
                              F.lit("unique").alias("test"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_suite(models: dict[str, DataFrame], specs: Sequence[ModelTests]) -> DataFrame:
    """Q13: every declared test over every model, as one DataFrame of
    (model, column_name, test, failures). A tested model that is not given is
    an error: pass the specs to run."""
    missing = [s.model for s in specs if s.model not in models]
    if missing:
        raise ValueError(f"no model {', '.join(missing)} to test")
    parts = [run_model_tests(models[s.model], s) for s in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- run metrics and probes (T4-T6) -----------------------------------------

def probe_counts(df: DataFrame, probes: dict[str, Column]) -> DataFrame:
    """T4/T5 as one aggregate: ``count_if`` of each probe plus the row count."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(p).alias(name) for name, p in probes.items()])


def observed(df: DataFrame, name: str, probes: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Attach a row count (plus probe counts) collected during the job that
    consumes ``df`` (e.g. the write): no extra pass over the data."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [F.count_if(p).alias(k) for k, p in (probes or {}).items()]
    return df.observe(obs, *exprs), obs
