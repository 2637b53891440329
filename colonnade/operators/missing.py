"""Missing values: flags, drop, fill.  NaN counts as missing."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.functions.columns import FLOATING


def isna_col(df: DataFrame, c: str):
    e = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, FLOATING):
        e = e | F.isnan(c)
    return e


def isna(df: DataFrame, cols: Sequence[str] | None = None, keep: Sequence[str] = (), notna: bool = False) -> DataFrame:
    cols = cols or [c for c in df.columns if c not in keep]
    return df.select(*keep, *[(~isna_col(df, c) if notna else isna_col(df, c)).alias(c) for c in cols])


def dropna(df: DataFrame, how: str | None = None, thresh: int | None = None,
           subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows by ``how`` (any / all) xor ``thresh`` (min non-null cells)."""
    if how is not None and thresh is not None:
        raise TypeError("how and thresh exclude each other")
    subset = list(subset or df.columns)
    valid = functools.reduce(lambda a, b: a + b, [(~isna_col(df, c)).cast("int") for c in subset])
    if thresh is not None:
        return df.where(valid >= thresh)
    if (how or "any") == "any":
        return df.where(valid == len(subset))
    return df.where(valid > 0)


def dropna_columns(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """Drop columns with missing cells: one count aggregate, then select."""
    cols = list(subset or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(~isna_col(df, c), 1)).alias(c) for c in cols]).first()
    n = counts["_n"]
    drop = [c for c in cols if (counts[c] < n if how == "any" else counts[c] == 0)]
    return df.drop(*drop)


def fillna(df: DataFrame, value) -> DataFrame:
    """Scalar or per-column dict (NaN is filled too)."""
    if isinstance(value, Mapping):
        return df.withColumns({c: F.when(isna_col(df, c), F.lit(v)).otherwise(F.col(c)) for c, v in value.items()})
    return df.fillna(value)


def fillna_frame(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Fill from another frame aligned on the key (join + coalesce)."""
    key = list(key)
    shared = [c for c in df.columns if c in other.columns and c not in key]
    j = df.alias("a").join(other.alias("b"), key, "left")
    return j.select(*[F.col(c) if c in key else (F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)
                                                 if c in shared else F.col(f"a.{c}")) for c in df.columns])
