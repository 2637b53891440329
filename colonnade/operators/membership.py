"""Row union and membership tests.

Membership is a join against the distinct right-hand values; Spark broadcasts
them when their size is under its threshold, also at run time.  NaN never matches
(numpy equality), unlike Spark's join equality where NaN = NaN.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def append(df: DataFrame, other: DataFrame, verify_integrity: bool = False, key: Sequence[str] = ()) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    out = df.unionByName(other, allowMissingColumns=True)
    if verify_integrity:
        if not key:
            raise ValueError("verify_integrity needs the key columns")
        if out.groupBy(*key).count().where("count > 1").limit(1).count():
            raise ValueError("indexes have overlapping values")
    return out


def _distinct_values(values: DataFrame, col: str) -> DataFrame:
    v = values.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull())
    if isinstance(values.schema[col].dataType, (T.DoubleType, T.FloatType)):
        v = v.where(~F.isnan("_v"))
    return v.distinct()


def in1d(df: DataFrame, col: str, values: DataFrame, values_col: str, name: str = "in1d",
         invert: bool = False) -> DataFrame:
    """Boolean per row: is ``df[col]`` among ``values[values_col]``.  Two
    valued: null and NaN count as absent (with ``invert``: present)."""
    v = _distinct_values(values, values_col).withColumn("_hit", F.lit(True))
    key = F.col(col)
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        key = F.when(~F.isnan(col), key)
    j = df.join(v, key == F.col("_v"), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select(*[df[c] for c in df.columns], (~hit if invert else hit).alias(name))


def isin(df: DataFrame, values, cols: Sequence[str] | None = None, prefix: str = "isin_") -> DataFrame:
    """Cell membership.  ``values``: a list (tested on every column), a dict
    ``{col: list}``, or a DataFrame with the same columns (frame form: equal
    at the same key and column; pass ``cols`` = key columns first)."""
    cols = cols or df.columns
    if isinstance(values, DataFrame):
        raise TypeError("use isin_frame for the frame form")
    if isinstance(values, Mapping):
        return df.select(*df.columns, *[F.col(c).isin(list(values.get(c, []))).alias(prefix + c)
                                        if values.get(c) else F.lit(False).alias(prefix + c) for c in cols])
    return df.select(*df.columns, *[F.coalesce(F.col(c).isin(list(values)), F.lit(False)).alias(prefix + c) for c in cols])


def isin_frame(df: DataFrame, other: DataFrame, key: Sequence[str], cols: Sequence[str],
               prefix: str = "isin_") -> DataFrame:
    """Frame form: True where ``other`` holds the same value at the same key
    and column (null-safe equality is not used: nulls never match)."""
    key = list(key)
    j = df.alias("a").join(other.alias("b"), key, "left")
    return j.select(*[F.col(f"a.{c}") if c not in key else F.col(c) for c in df.columns],
                    *[F.coalesce(F.col(f"a.{c}") == F.col(f"b.{c}"), F.lit(False)).alias(prefix + c) for c in cols])


def isin_frame_values(df: DataFrame, col: str, values: DataFrame, values_col: str, name: str) -> DataFrame:
    """``df[col]`` in a large value set held by another frame (join form)."""
    return in1d(df, col, values, values_col, name)


def row_any_isin(df: DataFrame, cols: Sequence[str], values: Sequence) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.coalesce(F.col(c).isin(list(values)), F.lit(False)) for c in cols])
