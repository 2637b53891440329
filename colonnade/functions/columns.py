"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in ex]


def missing(c) -> Column:
    """True for NULL, and for NaN in floating columns (both are missing)."""
    c = col(c)
    return c.isNull() | F.isnan(c)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Normalize NaN to NULL in floating columns, once, at the library edge."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, FLOATING)
              and (cols is None or f.name in cols)]
    if not fields:
        return df
    return df.withColumns({f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in fields})


def sort_key(c, ascending: bool = True, na_position: str = "last") -> Column:
    """Sort expression with explicit null placement (default: nulls last in
    both directions)."""
    c = col(c)
    if ascending:
        return c.asc_nulls_last() if na_position == "last" else c.asc_nulls_first()
    return c.desc_nulls_last() if na_position == "last" else c.desc_nulls_first()


def sort_keys(by: Sequence, ascending=True, na_position: str = "last") -> list[Column]:
    if isinstance(ascending, bool):
        ascending = [ascending] * len(by)
    if len(ascending) != len(by):
        raise ValueError("ascending must match the length of by")
    return [sort_key(c, a, na_position) for c, a in zip(by, ascending)]


def floor_div(a, b) -> Column:
    """Floor division (Python ``//``) of floating values."""
    a, b = col(a), col(b)
    return F.floor(a / b)


def floor_mod(a, b) -> Column:
    """``a - floor(a/b)*b``: the result takes the sign of the divisor."""
    a, b = col(a), col(b)
    return a - F.floor(a / b) * b


def int_floor_mod(a, b) -> Column:
    """Exact modulus of integers, with the sign of the divisor; null for a zero divisor."""
    a, b = col(a), F.nullif(col(b), F.lit(0))
    rest = a % b
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest)


def int_floor_div(a, b) -> Column:
    """Exact floor division of integers (no detour over doubles, which are exact below 2^53 only); null for a zero
    divisor.  Once the remainder is taken off, the quotient is whole and its decimal division exact."""
    a, b = col(a), F.nullif(col(b), F.lit(0))
    exact = a.cast("decimal(20,0)") - int_floor_mod(a, b).cast("decimal(20,0)")
    return (exact / b.cast("decimal(20,0)")).cast("bigint")


def clip(c, lower=None, upper=None) -> Column:
    """Null bound means no bound; null data stays null."""
    c = col(c)
    out = c
    if lower is not None:
        lo = col(lower) if not isinstance(lower, (int, float)) else F.lit(lower)
        out = F.when(lo.isNotNull() & (out < lo), lo).otherwise(out)
    if upper is not None:
        hi = col(upper) if not isinstance(upper, (int, float)) else F.lit(upper)
        out = F.when(hi.isNotNull() & (out > hi), hi).otherwise(out)
    return F.when(c.isNotNull(), out) if lower is not None or upper is not None else c


def round_half_even(c, decimals: int = 0) -> Column:
    """numpy rounding convention (half to even)."""
    return F.bround(col(c), decimals)


def strip(c) -> Column:
    """Python ``str.strip``: all leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def null_safe_ne(a, b) -> Column:
    return ~col(a).eqNullSafe(col(b))


def bounded_distinct(df: DataFrame, c: str, limit: int = 10_000, what: str = "values") -> list:
    """Sorted distinct non-null values of a column that must stay small
    (labels, classes, pivot values); raises instead of pulling an unbounded
    list to the driver."""
    vals = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"more than {limit} distinct {what} in {c}")
    return vals
