"""Projections: rename/standardize, constant tags, NULL padding, alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rename(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    """Select ``source AS target`` in the given order. Source names
    resolve case-insensitively. (One ``selectExpr``: a single projection
    built in one call rather than one call per column.)"""
    return df.selectExpr(*[f"{_q(src)} AS {_q(dst)}" for src, dst in mapping])


def tag(df: DataFrame, column: str, value) -> DataFrame:
    """Constant column."""
    return df.withColumn(column, F.lit(value))


def align(df: DataFrame, schema: StructType, renames: dict[str, str] | None = None, also: tuple[str, ...] = (),
          lenient: bool = False) -> DataFrame:
    """Project onto ``schema``: take columns present (after optional
    renames), pad absent ones with a typed NULL, cast to the target type
    (``lenient``: a value that does not fit gives NULL instead of an error).
    Columns named in ``also`` follow as they are."""
    renames = renames or {}
    cast = "TRY_CAST" if lenient else "CAST"
    present = {c.lower(): (c, t) for c, t in df.dtypes}
    out = []
    for f in schema.fields:
        src = renames.get(f.name, f.name)
        t = f.dataType.simpleString()
        if src is None or src.lower() not in present:
            out.append(f"CAST(NULL AS {t}) AS {_q(f.name)}")
        elif present[src.lower()][1] == t:
            out.append(f"{_q(present[src.lower()][0])} AS {_q(f.name)}")
        else:
            out.append(f"{cast}({_q(present[src.lower()][0])} AS {t}) AS {_q(f.name)}")
    return df.selectExpr(*out, *map(_q, also))


def union_aligned(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name over frames already aligned to one schema."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def passthrough(df: DataFrame) -> DataFrame:
    """``SELECT *``."""
    return df.select("*")
