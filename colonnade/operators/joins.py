"""Joins, alignment and combination of frames keyed by explicit columns.

Join strategy (broadcast, shuffle hash, sort merge) is left to Catalyst and
AQE; these functions only express the logical join.  Key-aligned operators
(align, combine, combine_first, update, compare) are full or left outer
joins on the key followed by per-column expressions.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.columns import is_numeric


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def merge(left: DataFrame, right: DataFrame, how: str = "inner", on=None, left_on=None, right_on=None,
          suffixes=("_x", "_y"), indicator: bool = False, validate: str | None = None) -> DataFrame:
    """Column join with suffixes on overlapping non-key columns.

    ``indicator`` adds ``_merge`` (left_only / right_only / both) from two
    marker literals; ``validate`` raises when a checked side has duplicate
    keys (see ``validate_join``)."""
    if how == "cross":
        if on is not None or left_on is not None or right_on is not None or validate:
            raise ValueError("a cross join takes neither keys nor a cardinality check")
        left_on, right_on = [], []
    elif on is not None:
        left_on = right_on = _keys(on)
    left_on, right_on = _keys(left_on), _keys(right_on)
    if validate:
        bad = validate_join(left, right, left_on, right_on, validate)
        if bad.limit(1).count():
            raise ValueError(f"merge keys are not {validate}")
    same = on is not None
    lcols = [c for c in left.columns if not (same and c in left_on)]
    rcols = [c for c in right.columns if not (same and c in right_on)]
    overlap = set(lcols) & set(rcols)
    l2 = left.select(*[F.col(c).alias(c + suffixes[0]) if c in overlap else F.col(c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(c + suffixes[1]) if c in overlap else F.col(c) for c in right.columns])
    if indicator:
        l2 = l2.withColumn("_in_l", F.lit(True))
        r2 = r2.withColumn("_in_r", F.lit(True))
    how = {"outer": "full", "left": "left", "right": "right", "inner": "inner", "cross": "cross"}[how]
    if how == "cross":
        j = l2.crossJoin(r2)
    elif same:
        j = l2.join(r2, left_on, how)
    else:
        lk = [c + suffixes[0] if c in overlap else c for c in left_on]
        rk = [c + suffixes[1] if c in overlap else c for c in right_on]
        cond = functools.reduce(lambda a, b: a & b, [l2[a] == r2[b] for a, b in zip(lk, rk)])
        j = l2.join(r2, cond, how)
    if indicator:
        j = j.withColumn("_merge", F.when(F.col("_in_l") & F.col("_in_r"), "both")
                         .when(F.col("_in_l"), "left_only").otherwise("right_only")).drop("_in_l", "_in_r")
    return j


def join(left: DataFrame, right: DataFrame, on, how: str = "left", lsuffix: str = "", rsuffix: str = "",
         validate: str | None = None) -> DataFrame:
    """Key join (default left); overlapping columns need suffixes.  ``how="cross"`` pairs all rows and takes no key."""
    if how == "cross":
        if on:
            raise ValueError("a cross join takes no key")
        if set(left.columns) & set(right.columns) and not (lsuffix or rsuffix):
            raise ValueError("shared column names need a suffix")
        return merge(left, right, how="cross", suffixes=(lsuffix, rsuffix))
    keys = _keys(on)
    overlap = (set(left.columns) & set(right.columns)) - set(keys)
    if overlap and not (lsuffix or rsuffix):
        raise ValueError(f"shared column names need a suffix: {sorted(overlap)}")
    return merge(left, right, how=how, on=keys, suffixes=(lsuffix, rsuffix), validate=validate)


def join_list(frames: Sequence[DataFrame], on, how: str = "left") -> DataFrame:
    """Multi-way join on one key: a fold of joins.  All joins share the key,
    so Catalyst keeps one hash partitioning for the whole chain."""
    keys = _keys(on)
    return functools.reduce(lambda a, b: a.join(b, keys, {"outer": "full"}.get(how, how)), frames)


def validate_join(left: DataFrame, right: DataFrame, left_on, right_on, validate: str) -> DataFrame:
    """Offending keys for a cardinality check: rows (side, key, n) with n > 1
    on each side that must be unique (1:1, 1:m, m:1; m:m checks nothing)."""
    v = {"one_to_one": "1:1", "one_to_many": "1:m", "many_to_one": "m:1", "many_to_many": "m:m"}.get(validate, validate)
    left_on, right_on = _keys(left_on), _keys(right_on)
    parts = []

    def dups(df, keys, side):
        # grouped by the columns themselves; joined to one text only for the report
        k = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in keys])
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
            .select(F.lit(side).alias("side"), k.alias("key"), "n")

    if v in ("1:1", "1:m"):
        parts.append(dups(left, left_on, "left"))
    if v in ("1:1", "m:1"):
        parts.append(dups(right, right_on, "right"))
    if not parts:
        return left.sparkSession.createDataFrame([], "side string, key string, n bigint")
    return functools.reduce(DataFrame.unionByName, parts)


def to_long(df: DataFrame, key: Sequence[str], cols: Sequence[str] | None = None,
            var: str = "column", val: str = "value") -> DataFrame:
    """Wide to long on the listed (numeric) columns, values as double."""
    cols = cols or [c for c in df.columns if c not in key]
    d = df.select(*key, *[F.col(c).cast("double").alias(c) for c in cols])
    return d.unpivot(list(key), list(cols), var, val)


def lookup(df: DataFrame, key: str, pairs: DataFrame, row_col: str, label_col: str,
           check: bool = True) -> DataFrame:
    """For each (row label, column label) pair, the cell of ``df``.  A label
    missing from ``df`` is an error (checked by an anti join)."""
    cols = [c for c in df.columns if c != key]
    if check:
        bad = pairs.where(~F.col(label_col).isin(cols)).limit(1).count() + \
            pairs.join(df.select(F.col(key).alias(row_col)), row_col, "left_anti").limit(1).count()
        if bad:
            raise KeyError("lookup label not found")
    long = to_long(df, [key], cols, "_label", "value").withColumnRenamed(key, row_col)
    return pairs.join(long, (pairs[row_col] == long[row_col]) & (pairs[label_col] == long["_label"]), "left") \
        .select(pairs["*"], long["value"])


def align(left: DataFrame, right: DataFrame, key: Sequence[str], join: str = "outer",
          fill_value=None) -> tuple[DataFrame, DataFrame]:
    """Both frames conformed to the union (outer) / intersection (inner) /
    one side's keys and to the union of columns; missing cells = fill."""
    key = list(key)
    how = {"outer": "full", "inner": "inner", "left": "left", "right": "right"}[join]
    keys = left.select(*key).join(right.select(*key), key, how) if how != "full" else \
        left.select(*key).unionByName(right.select(*key)).distinct()
    cols = [c for c in left.columns if c not in key] + [c for c in right.columns if c not in key and c not in left.columns]

    def conform(df):
        j = keys.join(df, key, "left")
        fv = F.lit(fill_value)
        return j.select(*key, *[F.coalesce(F.col(c), fv).alias(c) if c in df.columns and fill_value is not None
                                else (F.col(c) if c in df.columns else fv.alias(c)) for c in cols])
    return conform(left), conform(right)


def reindex_rows(df: DataFrame, key: str, labels: DataFrame, fill_value=None) -> DataFrame:
    """Rows conformed to a label table; missing labels become fill rows."""
    j = labels.select(F.col(labels.columns[0]).alias(key)).join(df, key, "left")
    if fill_value is None:
        return j
    return j.fillna({c: fill_value for c in df.columns if c != key and is_numeric(df.schema[c].dataType)})


def combine(left: DataFrame, right: DataFrame, key: Sequence[str], func: Callable[[Column, Column], Column],
            fill_value=None, overwrite: bool = True) -> DataFrame:
    """Outer-aligned column-wise ``func(left, right)`` over the union of
    columns; ``fill_value`` replaces a one-sided missing cell first.  Without ``overwrite`` a column that the right
    frame lacks, or has only nulls in, keeps the left values."""
    key = list(key)
    empty: set[str] = set()
    if not overwrite:
        shared = [c for c in right.columns if c not in key]
        seen = right.agg(*[F.count(c).alias(c) for c in shared]).first() if shared else {}
        empty = {c for c in shared if seen[c] == 0}
    j = left.alias("l").join(right.alias("r"), key, "full")
    out = []
    lcols = [c for c in left.columns if c not in key]
    rcols = [c for c in right.columns if c not in key]
    for c in lcols + [c for c in rcols if c not in lcols]:
        a = F.col(f"l.{c}") if c in lcols else F.lit(None)
        b = F.col(f"r.{c}") if c in rcols else F.lit(None)
        if fill_value is not None:
            fv = F.lit(fill_value)
            a, b = F.when(a.isNull() & b.isNotNull(), fv).otherwise(a), F.when(b.isNull() & a.isNotNull(), fv).otherwise(b)
        if not overwrite and (c not in rcols or c in empty):
            out.append((F.col(f"l.{c}") if c in lcols else F.lit(None)).alias(c))
        else:
            out.append(func(a, b).alias(c))
    return j.select(*key, *out)


def combine_first(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Union of keys and columns; the left value wins when non-null."""
    return combine(left, right, key, lambda a, b: F.coalesce(a, b))


def update(left: DataFrame, right: DataFrame, key: Sequence[str], overwrite: bool = True,
           errors: str = "ignore", filter_func: Callable[[Column], Column] | None = None) -> DataFrame:
    """Left join: non-null values of ``right`` overwrite (or, without
    overwrite, only fill nulls of) the shared columns of ``left``; with ``filter_func`` only cells for which it holds
    are replaced."""
    key = list(key)
    shared = [c for c in left.columns if c in right.columns and c not in key]
    j = left.alias("l").join(right.alias("r"), key, "left")
    if errors == "raise":
        clash = functools.reduce(lambda a, b: a | b, [F.col(f"l.{c}").isNotNull() & F.col(f"r.{c}").isNotNull()
                                                      for c in shared], F.lit(False))
        if j.where(clash).limit(1).count():
            raise ValueError("data overlaps")
    sel = []
    for c in left.columns:
        if c in key:
            sel.append(F.col(c))
        elif c in shared:
            e = F.coalesce(F.col(f"r.{c}"), F.col(f"l.{c}")) if overwrite else F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}"))
            if filter_func is not None:
                e = F.when(F.coalesce(filter_func(F.col(f"l.{c}")), F.lit(False)), e).otherwise(F.col(f"l.{c}"))
            sel.append(e.alias(c))
        else:
            sel.append(F.col(f"l.{c}"))
    return j.select(*sel)


def compare(left: DataFrame, right: DataFrame, key: Sequence[str], cols: Sequence[str] | None = None,
            keep_equal: bool = False) -> DataFrame:
    """Differing cells side by side, long form: key, column, self, other
    (values as text; null-safe comparison)."""
    key = list(key)
    cols = cols or [c for c in left.columns if c not in key and c in right.columns]
    j = left.alias("l").join(right.alias("r"), key, "inner")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         F.col(f"l.{c}").cast("string").alias("self"),
                                         F.col(f"r.{c}").cast("string").alias("other"),
                                         (~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).alias("diff"))
                                for c in cols]))
    out = j.select(*key, cells.alias("c")).select(*key, "c.column", "c.self", "c.other", "c.diff")
    if not keep_equal:
        out = out.where("diff")
    return out.drop("diff")


def dot(left: DataFrame, key: Sequence[str], right: DataFrame, right_key: str) -> DataFrame:
    """Matrix product ``left @ right``.

    ``left`` holds numeric columns whose names must equal the row labels of
    ``right`` (``right_key``), which is checked on both sides.  The long forms are joined on the inner label (Spark
    broadcasts the right side when it is small) and summed by (row, column)."""
    key = list(key)
    inner = [c for c in left.columns if c not in key]
    out_cols = [c for c in right.columns if c != right_key]
    spark = left.sparkSession
    names = spark.createDataFrame([(c,) for c in inner], "_k string")
    labels = right.select(F.col(right_key).cast("string").alias("_k"))
    if not labels.join(names, "_k", "left_anti").isEmpty() or not names.join(labels, "_k", "left_anti").isEmpty():
        raise ValueError("matrices are not aligned")
    ll = to_long(left, key, inner, "_k", "_lv")
    rl = right.select(F.col(right_key).cast("string").alias("_k"), *[F.col(c).cast("double").alias(f"_r_{c}") for c in out_cols])
    sums = [F.sum(F.col("_lv") * F.col(f"_r_{c}")).alias(c) for c in out_cols]
    return ll.join(rl, "_k").groupBy(*key).agg(*sums)
