"""Reshape: pivot, pivot tables, stack / unstack / melt, explode, transpose.

Pivots always take (or compute once) an explicit list of column values so
the output schema is fixed and Spark does not run a separate distinct job
per call; the value list is bounded by ``MAX_PIVOT_VALUES``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.operators.aggregates import agg_expr

MAX_PIVOT_VALUES = 10_000
MAX_TRANSPOSE_ROWS = 1_000


def pivot_values(df: DataFrame, columns: str) -> list:
    vals = [r[0] for r in df.select(columns).distinct().orderBy(columns).limit(MAX_PIVOT_VALUES + 1).collect()]
    if len(vals) > MAX_PIVOT_VALUES:
        raise ValueError("too many pivot values")
    return vals


def pivot(df: DataFrame, index: Sequence[str], columns: str, values: str, col_values: Sequence | None = None) -> DataFrame:
    """Long to wide without aggregation; duplicate (index, column) pairs raise."""
    index = list(index)
    if df.groupBy(*index, columns).count().where("count > 1").limit(1).count():
        raise ValueError("an (index, column) pair occurs more than once")
    col_values = list(col_values) if col_values is not None else pivot_values(df, columns)
    return df.groupBy(*index).pivot(columns, col_values).agg(F.first(values))


def pivot_table(df: DataFrame, values: str | Sequence[str], index: Sequence[str], columns: str | Sequence[str], aggfunc="mean",
                fill_value=None, col_values: Sequence | None = None, dropna: bool = True) -> DataFrame:
    """Pivot with aggregation.  ``aggfunc`` may be a name, a list (one
    sub-table per function) or a dict of names or lists per value
    column.  Output columns are ``{func}_{column value}``, with ``{value}_`` in front when there are several value
    columns; several column keys give values joined by ``_``.  ``fill_value`` fills missing combinations after
    aggregation; ``dropna`` drops output columns that are entirely null."""
    index = list(index)
    many = not isinstance(values, str)
    values = list(values) if many else [values]
    if not isinstance(columns, str):
        df = df.withColumn("_columns", F.concat_ws("_", *[F.col(c).cast("string") for c in columns]))
        columns = "_columns"
    col_values = list(col_values) if col_values is not None else pivot_values(df, columns)
    aggs = []
    for v in values:
        own = aggfunc.get(v, []) if isinstance(aggfunc, Mapping) else aggfunc
        for f in [own] if isinstance(own, str) else own:
            for c in col_values:
                name = f"{v}_{f}_{c}" if many else f"{f}_{c}"
                aggs.append(agg_expr(f, F.when(F.col(columns) == F.lit(c), F.col(v))).alias(name))
                if f in ("sum", "prod", "count", "size", "nunique"):  # no row of the combination: missing, not zero
                    seen = F.count(F.when(F.col(columns) == F.lit(c), F.lit(1)))
                    inner = F.count(F.when(F.col(columns) == F.lit(c), F.lit(1))) if f == "size" else agg_expr(f, F.when(F.col(columns) == F.lit(c), F.col(v)))
                    aggs[-1] = F.when(seen > 0, inner).alias(name)
    out = df.groupBy(*index).agg(*aggs)
    rest = [c for c in out.columns if c not in index]
    if fill_value is not None:
        out = out.fillna(fill_value, subset=rest)
    if dropna:
        present = out.agg(*[F.count(c).alias(c) for c in rest]).first().asDict()
        out = out.select(*index, *[c for c in rest if present[c] > 0])
    return out


def stack(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable", val: str = "value",
          dropna: bool = True) -> DataFrame:
    """Columns to rows; ``dropna`` removes null cells."""
    out = df.unpivot(list(ids), list(cols), var, val)
    return out.where(F.col(val).isNotNull()) if dropna else out


def unstack(df: DataFrame, index: Sequence[str], level: str, values: str, fill_value=None,
            col_values: Sequence | None = None) -> DataFrame:
    """A key level to columns; missing combinations take ``fill_value``."""
    col_values = list(col_values) if col_values is not None else pivot_values(df, level)
    out = df.groupBy(*index).pivot(level, col_values).agg(F.first(values))
    if fill_value is not None:
        out = out.fillna(fill_value, subset=[str(v) for v in col_values])
    return out


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str] | None = None,
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Unpivot; null cells are kept."""
    value_vars = value_vars or [c for c in df.columns if c not in id_vars]
    return df.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def explode(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """List columns to rows.  Several columns must have equal lengths per
    row (checked with ``raise_error``); an empty or null list gives one row
    of nulls.  Adds the element position ``pos``."""
    columns = list(columns)
    keep = list(keep) or [c for c in df.columns if c not in columns]
    if len(columns) > 1:
        same = F.lit(True)
        for c in columns[1:]:
            same = same & (F.coalesce(F.size(columns[0]), F.lit(-1)) == F.coalesce(F.size(c), F.lit(-1)))
        df = df.withColumn("_chk", F.when(same, F.lit(True)).otherwise(
            F.raise_error(F.lit("list columns of one row differ in length"))))
        zipped = F.arrays_zip(*[F.col(c) for c in columns])
        out = df.select(*keep, "_chk", F.posexplode_outer(zipped).alias("pos", "_z"))
        return out.select(*keep, "pos", *[F.col("_z")[c].alias(c) for c in columns])
    return df.select(*keep, F.posexplode_outer(columns[0]).alias("pos", columns[0]))


def transpose(df: DataFrame, key: str, cols: Sequence[str] | None = None, name: str = "column") -> DataFrame:
    """Rows become columns (labelled by ``key``); values cast to one common
    type (double).  Only for frames of at most ``MAX_TRANSPOSE_ROWS`` rows,
    checked: the output schema grows with the row count."""
    cols = list(cols or [c for c in df.columns if c != key])
    labels = [r[0] for r in df.select(key).limit(MAX_TRANSPOSE_ROWS + 1).collect()]
    if len(labels) > MAX_TRANSPOSE_ROWS:
        raise ValueError("frame too large to transpose")
    long = df.select(F.col(key).cast("string").alias("_k"), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot("_k", cols, name, "_v")
    return long.groupBy(name).pivot("_k", [str(x) for x in labels]).agg(F.first("_v"))
