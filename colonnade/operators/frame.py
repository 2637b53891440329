"""Projections, filters and element-wise operators (column expressions only).

Row labels are explicit key columns; an operator that needs them takes a
``key`` argument.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions.columns import (clip as clip_col, col, floor_div, floor_mod, int_floor_div, int_floor_mod,
                                         is_numeric)

_TYPE_GROUPS = {
    "number": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
               T.DoubleType, T.DecimalType),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "int": (T.IntegerType, T.LongType),
    "int32": (T.IntegerType,),
    "int64": (T.LongType,),
    "float": (T.DoubleType, T.FloatType),
    "float64": (T.DoubleType,),
    "float32": (T.FloatType,),
    "bool": (T.BooleanType,),
    "object": (T.StringType,),
    "string": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "timedelta": (T.DayTimeIntervalType,),
}


def getitem(df: DataFrame, key) -> DataFrame:
    """Column name, list of names, or a boolean Column (row filter)."""
    if isinstance(key, Column):
        return df.filter(key)
    if isinstance(key, str):
        return df.select(key)
    return df.select(*key)


def filter_mask(df: DataFrame, mask: Column) -> DataFrame:
    """Keep rows whose mask is True.  A NULL mask drops the row already in
    Spark's filter, so the predicate is passed as is and reaches the scan."""
    return df.filter(mask)


def query(df: DataFrame, expr: str, **variables) -> DataFrame:
    """String predicate in Spark SQL syntax; ``:name`` parameters bind
    ``variables`` safely through ``spark.sql`` named arguments."""
    if not variables:
        return df.filter(F.expr(expr))
    view = f"_q_{abs(hash(expr)) % 10**9}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT * FROM {view} WHERE {expr}", args=variables)


def eval_expr(df: DataFrame, expr: str) -> DataFrame:
    """``c = a + b`` assigns a column; a bare expression returns one column."""
    assigned = re.match(r"\s*(\w+)\s*=(?!=)(.*)$", expr, re.S)
    if assigned:
        return df.withColumn(assigned[1], F.expr(assigned[2].strip()))
    return df.selectExpr(expr)


def select_dtypes(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """Select columns by type group; include and exclude must not overlap."""
    inc = [include] if isinstance(include, str) else list(include or [])
    exc = [exclude] if isinstance(exclude, str) else list(exclude or [])
    if not inc and not exc:
        raise ValueError("name a type group to include or exclude")
    if set(inc) & set(exc):
        raise ValueError("include and exclude overlap")

    def match(dt, groups):
        return any(isinstance(dt, _TYPE_GROUPS[g]) for g in groups)

    keep = [f.name for f in df.schema.fields
            if (not inc or match(f.dataType, inc)) and not match(f.dataType, exc)]
    return df.select(*keep)


def insert(df: DataFrame, loc: int, column: str, value, allow_duplicates: bool = False) -> DataFrame:
    if column in df.columns and not allow_duplicates:
        raise ValueError(f"the frame has a column {column} already")
    v = value if isinstance(value, Column) else F.lit(value)
    cols = [F.col(c) for c in df.columns]
    return df.select(*cols[:loc], v.alias(column), *cols[loc:])


def assign(df: DataFrame, **kwargs) -> DataFrame:
    """Later assignments see earlier ones (callables receive the frame)."""
    for name, v in kwargs.items():
        if callable(v) and not isinstance(v, Column):
            v = v(df)
        df = df.withColumn(name, v if isinstance(v, Column) else F.lit(v))
    return df


def setitem(df: DataFrame, key, value, cols: Sequence[str] | None = None) -> DataFrame:
    """Assign by name, by a list of names, or by a boolean mask Column
    (``mask -> value`` on ``cols``, default every numeric column)."""
    if isinstance(key, Column):
        cols = cols or [f.name for f in df.schema.fields if is_numeric(f.dataType)]
        return df.select(*[F.when(F.coalesce(key, F.lit(False)), F.lit(value)).otherwise(F.col(c)).alias(c)
                           if c in cols else F.col(c) for c in df.columns])
    if isinstance(key, str):
        key = [key]
        value = [value]
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in zip(key, value)})


def drop(df: DataFrame, columns=(), key: str | None = None, labels=(), errors: str = "raise") -> DataFrame:
    missing_cols = [c for c in columns if c not in df.columns]
    if missing_cols and errors == "raise":
        raise KeyError(f"{missing_cols} not found")
    out = df.drop(*[c for c in columns if c in df.columns])
    if key is not None and labels:
        out = out.filter(~F.col(key).isin(list(labels)))
    return out


def rename(df: DataFrame, mapper: Mapping[str, str] | Callable[[str], str], errors: str = "ignore") -> DataFrame:
    if callable(mapper):
        mapper = {c: mapper(c) for c in df.columns}
    if errors == "raise":
        absent = [c for c in mapper if c not in df.columns]
        if absent:
            raise KeyError(f"{absent} not found")
    return df.withColumnsRenamed({k: v for k, v in mapper.items() if k in df.columns})


def set_axis(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    if len(labels) != len(df.columns):
        raise ValueError("length mismatch")
    return df.toDF(*labels)


def pop(df: DataFrame, item: str) -> tuple[DataFrame, DataFrame]:
    """Return (the column as a frame, the frame without it)."""
    if item not in df.columns:
        raise KeyError(item)
    return df.select(item), df.drop(item)


def reindex_columns(df: DataFrame, columns: Sequence[str], fill_value=None) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill_value).alias(c) for c in columns])


_OPS = {
    "add": lambda a, b: a + b, "sub": lambda a, b: a - b, "mul": lambda a, b: a * b,
    "truediv": lambda a, b: a / b, "floordiv": floor_div, "mod": floor_mod,
    "pow": lambda a, b: F.pow(a, b),
    "eq": lambda a, b: a == b, "ne": lambda a, b: a != b, "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b, "gt": lambda a, b: a > b, "ge": lambda a, b: a >= b,
}


def arith(df: DataFrame, cols: Sequence[str], op: str, other, keep: Sequence[str] = ()) -> DataFrame:
    """Frame op scalar / row vector (dict per column) / column vector (a
    Column applied to every listed column)."""
    f = _OPS[op]

    def rhs(c):
        if isinstance(other, Mapping):
            v = other.get(c)
            return F.lit(v) if not isinstance(v, Column) else v
        return other if isinstance(other, Column) else F.lit(other)

    return df.select(*keep, *[f(F.col(c), rhs(c)).alias(c) for c in cols])


def arith_frames(left: DataFrame, right: DataFrame, key: Sequence[str], op: str,
                 fill_value=None) -> DataFrame:
    """Frame op frame aligned on ``key`` (full outer join) and on column
    names; columns on one side only become null.  With ``fill_value`` a cell
    missing on exactly one side takes the fill first."""
    f = _OPS[op]
    lc = [c for c in left.columns if c not in key]
    rc = [c for c in right.columns if c not in key]
    j = left.alias("l").join(right.alias("r"), list(key), "full")
    out = []
    for c in sorted(set(lc) | set(rc)):
        if c in lc and c in rc:
            a, b = F.col(f"l.{c}"), F.col(f"r.{c}")
            if fill_value is not None:
                a, b = combine_fill(a, b, fill_value)
            out.append(f(a, b).alias(c))
        else:
            out.append(F.lit(None).cast("double").alias(c))
    return j.select(*key, *out)


def combine_fill(a: Column, b: Column, fill_value) -> tuple[Column, Column]:
    """If exactly one side is null it takes ``fill_value``; both null stay null."""
    fv = F.lit(fill_value)
    a2 = F.when(a.isNull() & b.isNotNull(), fv).otherwise(a)
    b2 = F.when(b.isNull() & a.isNotNull(), fv).otherwise(b)
    return a2, b2


def divmod_cols(a, b, integral: bool = False) -> tuple[Column, Column]:
    """Quotient and modulus; ``integral`` (both are integers) computes them exactly for all 64-bit values."""
    return (int_floor_div(a, b), int_floor_mod(a, b)) if integral else (floor_div(a, b), floor_mod(a, b))


def reorder_levels(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Put the key columns ``order`` first, in that order; drop none."""
    rest = [c for c in df.columns if c not in order]
    return df.select(*order, *rest)


def round_frame(df: DataFrame, decimals=0) -> DataFrame:
    """Half-to-even rounding; an int for all numeric columns or a dict."""
    def dec(c):
        if isinstance(decimals, Mapping):
            return decimals.get(c)
        return decimals

    return df.select(*[F.bround(F.col(f.name), dec(f.name)).alias(f.name)
                       if is_numeric(f.dataType) and dec(f.name) is not None else F.col(f.name)
                       for f in df.schema.fields])


def clip(df: DataFrame, lower=None, upper=None, cols: Sequence[str] | None = None) -> DataFrame:
    cols = cols or [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    return df.withColumns({c: clip_col(c, lower, upper).cast(df.schema[c].dataType) for c in cols})


def where(df: DataFrame, cond: Callable[[str], Column] | Column, other=None,
          cols: Sequence[str] | None = None) -> DataFrame:
    """Keep values where cond is True, else ``other`` (NULL cond = False)."""
    cols = cols or df.columns
    def c_of(c):
        return cond(c) if callable(cond) and not isinstance(cond, Column) else cond
    return df.withColumns({c: F.when(F.coalesce(c_of(c), F.lit(False)), F.col(c)).otherwise(
        other if isinstance(other, Column) else F.lit(other)) for c in cols})


def mask(df: DataFrame, cond, other=None, cols: Sequence[str] | None = None) -> DataFrame:
    """Inverse of ``where``: replace where cond is True."""
    cols = cols or df.columns
    def c_of(c):
        return cond(c) if callable(cond) and not isinstance(cond, Column) else cond
    return df.withColumns({c: F.when(F.coalesce(c_of(c), F.lit(False)),
                                     other if isinstance(other, Column) else F.lit(other)).otherwise(F.col(c))
                           for c in cols})


def replace(df: DataFrame, to_replace, value=None, cols: Sequence[str] | None = None,
            regex: bool = False) -> DataFrame:
    """Scalar, list or dict replacement; with ``regex`` a pattern per column."""
    if not regex:
        if isinstance(to_replace, Mapping) and value is None:
            return df.replace(dict(to_replace), subset=cols)
        return df.replace(to_replace, value, subset=cols)
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pats = to_replace if isinstance(to_replace, Mapping) else {to_replace: value}
    out = {}
    for c in cols:
        e = F.col(c)
        for p, v in pats.items():
            e = F.regexp_replace(e, p, v)
        out[c] = e
    return df.withColumns(out)


def compare_cols(df: DataFrame, a: str, b: str, op: str) -> Column:
    return _OPS[op](col(a), col(b))
