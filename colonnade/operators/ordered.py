"""Order-dependent operators (shift, diff, fills, interpolation, duplicate
marks) and sorting / top-n / de-duplication.

Every function takes an explicit ``order`` (a total order; add a unique tie
breaker) and optional ``by`` keys.  They run on ``plans.ordered``: range
partitions plus a carry across partition boundaries, so neither a hot key
nor a global order ends up in a single task.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colonnade.functions.columns import nan_to_null, sort_keys
from colonnade.plans.ordered import BFill, FFill, Lag, Lead, Pos, RPos, ordered_scan


def _order(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _reverse(order: Sequence) -> list[Column]:
    """The reverse of an order given as column names (ascending)."""
    return [F.col(c).desc() for c in order]


def shifts(df: DataFrame, spec: Sequence[tuple], order: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Several shifts along one order in one scan: ``spec`` has (column, periods, new name, fill value).  Positive periods
    look back, negative ones ahead; positions with no source row take the fill value (existing nulls stay)."""
    ops, res = [Pos("_pos"), RPos("_rpos")], {}
    for i, (c, periods, name, fill_value) in enumerate(spec):
        if periods == 0:
            res[name] = F.col(c)
            continue
        ops.append(Lag(c, periods, f"_s{i}") if periods > 0 else Lead(c, -periods, f"_s{i}"))
        missing = F.col("_pos" if periods > 0 else "_rpos") < abs(periods)
        res[name] = F.col(f"_s{i}") if fill_value is None else F.when(missing, F.lit(fill_value)).otherwise(F.col(f"_s{i}"))
    out = ordered_scan(df, _order(order), by, ops)
    return out.withColumns(res).drop("_pos", "_rpos", *[f"_s{i}" for i in range(len(spec))])


def shift(df: DataFrame, cols: Sequence[str], periods: int, order: Sequence, by: Sequence[str] = (),
          fill_value=None, suffix: str = "") -> DataFrame:
    """Values ``periods`` rows earlier (negative: later) along ``order``;
    positions with no source row take ``fill_value`` (existing nulls stay)."""
    if periods == 0:
        return df
    return shifts(df, [(c, periods, f"{c}{suffix}", fill_value) for c in cols], order, by)


def diff(df: DataFrame, cols: Sequence[str], periods: int, order: Sequence, by: Sequence[str] = (),
         suffix: str = "_diff") -> DataFrame:
    """``x - shift(x, periods)``; integral float periods are accepted."""
    if isinstance(periods, float):
        if not periods.is_integer():
            raise ValueError("periods must be a whole number")
        periods = int(periods)
    s = shift(df, cols, periods, order, by, suffix="_prev")
    return s.withColumns({f"{c}{suffix}": F.col(c) - F.col(f"{c}_prev") for c in cols}) \
        .drop(*[f"{c}_prev" for c in cols])


def ffill(df: DataFrame, cols: Sequence[str], order: Sequence, by: Sequence[str] = (),
          limit: int | None = None) -> DataFrame:
    """Forward fill; ``limit`` = max consecutive filled rows."""
    df = nan_to_null(df, cols)
    ops = [FFill(c, f"_f_{c}", f"_fp_{c}") for c in cols] + [Pos("_pos")]
    out = ordered_scan(df, _order(order), by, ops)
    res = {}
    for c in cols:
        ok = F.lit(True) if limit is None else (F.col("_pos") - F.col(f"_fp_{c}") <= limit)
        res[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(ok, F.col(f"_f_{c}"))
    return out.withColumns(res).drop(*[f"_f_{c}" for c in cols], *[f"_fp_{c}" for c in cols], "_pos")


def bfill(df: DataFrame, cols: Sequence[str], order: Sequence, by: Sequence[str] = (),
          limit: int | None = None) -> DataFrame:
    """Backward fill; ``limit`` = max consecutive filled rows."""
    df = nan_to_null(df, cols)
    ops = [BFill(c, f"_b_{c}", f"_bp_{c}") for c in cols] + [Pos("_pos")]
    out = ordered_scan(df, _order(order), by, ops)
    res = {}
    for c in cols:
        ok = F.lit(True) if limit is None else (F.col(f"_bp_{c}") - F.col("_pos") <= limit)
        res[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(ok, F.col(f"_b_{c}"))
    return out.withColumns(res).drop(*[f"_b_{c}" for c in cols], *[f"_bp_{c}" for c in cols], "_pos")


def interpolate(df: DataFrame, cols: Sequence[str], order: Sequence, by: Sequence[str] = (),
                limit_direction: str = "forward", limit: int | None = None, limit_area: str | None = None) -> DataFrame:
    """Linear interpolation on row positions.  Forward direction: leading
    nulls stay null, trailing nulls take the last valid value; ``backward``: the other way round; ``both``
    fills either end.  ``limit``: at most so many nulls in a row, counted from the side(s) of the direction;
    ``limit_area``: ``inside`` fills only between valid values, ``outside`` only beyond them."""
    if limit_direction not in ("forward", "backward", "both"):
        raise ValueError("limit_direction is forward, backward or both")
    if limit_area not in (None, "inside", "outside"):
        raise ValueError("limit_area is inside or outside")
    df = nan_to_null(df, cols)
    ops = [Pos("_pos")]
    for c in cols:
        ops += [FFill(c, f"_pv_{c}", f"_pp_{c}"), BFill(c, f"_nv_{c}", f"_np_{c}")]
    out = ordered_scan(df, _order(order), by, ops)
    res = {}
    for c in cols:
        pv, pp, nv, np_ = (F.col(f"_pv_{c}"), F.col(f"_pp_{c}"), F.col(f"_nv_{c}"), F.col(f"_np_{c}"))
        lin = pv + (nv - pv) * (F.col("_pos") - pp) / (np_ - pp)
        inside = pv.isNotNull() & nv.isNotNull()
        from_left = F.lit(True) if limit is None else F.coalesce(F.col("_pos") - pp <= limit, F.lit(False))
        from_right = F.lit(True) if limit is None else F.coalesce(np_ - F.col("_pos") <= limit, F.lit(False))
        near = {"forward": from_left, "backward": from_right, "both": from_left | from_right}[limit_direction]
        e = F.when(F.col(c).isNotNull(), F.col(c))
        if limit_area != "outside":
            e = e.when(inside & near, lin)
        if limit_area != "inside":
            if limit_direction != "backward":
                e = e.when(~inside & pv.isNotNull() & from_left, pv)
            if limit_direction != "forward":
                e = e.when(~inside & nv.isNotNull() & from_right, nv)
        res[c] = e
    drop = ["_pos"] + [f"_{p}_{c}" for c in cols for p in ("pv", "pp", "nv", "np")]
    return out.withColumns(res).drop(*drop)


def transform(df: DataFrame, by: Sequence[str], exprs: dict[str, Column]) -> DataFrame:
    """Group-wise transform that keeps the input length: aggregate per group
    (partial aggregation handles hot keys) and join back on the keys."""
    aggs = df.groupBy(*by).agg(*[e.alias(f"_t_{n}") for n, e in exprs.items()])
    return df.join(aggs, list(by), "left").withColumnsRenamed({f"_t_{n}": n for n in exprs})


def duplicated(df: DataFrame, subset: Sequence[str], keep="first", order: Sequence = (),
               name: str = "duplicated") -> DataFrame:
    """Mark duplicates of ``subset`` (nulls compare equal).  keep='first' /
    'last' need ``order``; keep=False marks every member of a repeated key."""
    subset = list(subset)
    if keep is False:
        counts = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"))
        cond = functools.reduce(lambda a, b: a & b, [df[c].eqNullSafe(counts[c]) for c in subset])
        return df.join(counts, cond, "left").select(df["*"], (F.col("_n") > 1).alias(name))
    o = _order(order) if keep == "first" else _reverse(order)
    out = ordered_scan(df, o, subset, [Pos("_dpos")])
    return out.withColumn(name, F.col("_dpos") > 0).drop("_dpos")


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None, keep="first",
                    order: Sequence = ()) -> DataFrame:
    """Remove duplicates.  keep='first' / 'last' keep the first row of a key along ``order`` or its reverse
    (one aggregate, combined before the shuffle); keep=False drops every member of a repeated key; keep='any' uses
    dropDuplicates."""
    subset = list(subset or df.columns)
    if keep == "any":
        return df.dropDuplicates(subset)
    names = [c for c in order if isinstance(c, str)]
    if keep is False or len(names) != len(order) or not names:
        return duplicated(df, subset, keep, order, "_dup").where(~F.col("_dup")).drop("_dup")
    pick = F.min_by if keep == "first" else F.max_by
    at = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in names])
    kept = df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(subset)]).agg(pick(F.struct("*"), at).alias("_row"))
    return kept.select("_row.*")


def sort_values(df: DataFrame, by: Sequence[str], ascending=True, na_position: str = "last",
                key: Callable[[Column], Column] | None = None, position: str | None = None) -> DataFrame:
    """Global sort (range-partitioned by Spark); nulls last by default in
    both directions.  ``key`` maps each sort column (a function of Columns); ``position`` adds the 0-based place as a
    column of that name, which needs ``by`` to be a total order."""
    cols = [key(F.col(c)) if key else c for c in by]
    if position:
        df = ordered_scan(df, sort_keys(cols, ascending, na_position), [], [Pos(position)])
    return df.orderBy(*sort_keys(cols, ascending, na_position))


def sort_index(df: DataFrame, keys: Sequence[str], ascending=True, na_position: str = "last",
               position: str | None = None) -> DataFrame:
    return sort_values(df, keys, ascending, na_position, position=position)


def nlargest(df: DataFrame, n: int, columns: Sequence[str], keep: str = "first", tiebreak: Sequence[str] = (),
             smallest: bool = False) -> DataFrame:
    """Top n rows by ``columns``.  keep first / last break ties by
    ``tiebreak`` ascending / descending; keep='all' returns every row tied
    with the n-th (may exceed n).  Spark plans the limit as a per-partition
    top-n followed by a merge of n rows per partition."""
    asc = smallest
    keys = [F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c in columns]
    ties = [F.col(c).asc() if keep != "last" else F.col(c).desc() for c in tiebreak]
    top = df.orderBy(*keys, *ties).limit(n)
    if keep != "all":
        return top
    # the n-th row is in one of the first n distinct keys; whole keys are kept up to it (null keys too)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).orderBy(*keys).limit(n)
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)  # over at most n rows
    kept = groups.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < n)
    kept = kept.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
    same = functools.reduce(lambda a, b: a & b, [df[c].eqNullSafe(kept[f"_k_{c}"]) for c in columns])
    return df.join(kept, same, "left_semi")


def nsmallest(df: DataFrame, n: int, columns: Sequence[str], keep: str = "first",
              tiebreak: Sequence[str] = ()) -> DataFrame:
    return nlargest(df, n, columns, keep, tiebreak, smallest=True)


def set_index(df: DataFrame, keys: Sequence[str], verify_integrity: bool = False) -> DataFrame:
    """Key columns first; with ``verify_integrity`` duplicate keys raise."""
    keys = list(keys)
    if verify_integrity and df.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"index has duplicate keys: {keys}")
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def reset_index(df: DataFrame, order: Sequence, name: str = "index") -> DataFrame:
    """A new 0..n-1 label along ``order`` (no global window: range
    partitions plus per-partition offsets)."""
    return ordered_scan(df, _order(order), [], [Pos(name)])
