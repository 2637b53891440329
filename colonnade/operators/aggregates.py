"""Grouping, reductions, frequencies, quantiles and correlation matrices.

Aggregates use Spark's partial + final hash aggregation (map-side combine),
so a hot key is pre-aggregated before the shuffle.  Order statistics
(quantiles, ranks, modes) never sort a whole group inside one task: values
are first counted per distinct value, then positions come from a running
sum over range partitions (``plans.ordered``).
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions.columns import bounded_distinct, nan_to_null
from colonnade.plans.ordered import CumSum, Pos, ordered_scan
from colonnade.session import materialize

_AGG = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "prod": lambda c: F.coalesce(F.product(c), F.lit(1.0)),
    "mean": F.avg, "median": F.median, "min": F.min, "max": F.max,
    "count": F.count, "std": F.stddev_samp, "var": F.var_samp, "first": F.first, "last": F.last,
    "nunique": F.count_distinct, "size": lambda c: F.count(F.lit(1)),
    "sem": lambda c: F.stddev_samp(c) / F.sqrt(F.count(c)),
    "skew": lambda c: skew(c), "kurt": lambda c: kurt(c),
}


def skew(c) -> Column:
    """Unbiased (adjusted Fisher-Pearson) sample skewness; null below 3 rows."""
    c = F.col(c) if isinstance(c, str) else c
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def kurt(c) -> Column:
    """Unbiased excess kurtosis (Fisher); null below 4 rows."""
    c = F.col(c) if isinstance(c, str) else c
    n = F.count(c)
    g2 = F.kurtosis(c)
    return F.when(n > 3, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))


def agg_expr(func: str, c) -> Column:
    return _AGG[func](c)


def groupby(df: DataFrame, by: Sequence[str], aggs: Sequence[Column] | Mapping, dropna: bool = True,
            sort: bool = False) -> DataFrame:
    """Group and aggregate; ``dropna`` leaves out null keys, otherwise they
    form their own group."""
    df = nan_to_null(df)
    if dropna:
        df = df.where(functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by]))
    exprs = aggregate_exprs(aggs) if isinstance(aggs, Mapping) else list(aggs)
    out = df.groupBy(*by).agg(*exprs)
    return out.orderBy(*[F.col(k).asc_nulls_last() for k in by]) if sort else out


def aggregate_exprs(spec: Mapping) -> list[Column]:
    """``{col: func | [funcs]}`` -> ``col_func`` columns; ``{name: (col, func)}``
    (named aggregation) -> ``name``."""
    out = []
    for k, v in spec.items():
        if isinstance(v, tuple):
            c, f = v
            out.append(agg_expr(f, c).alias(k))
        else:
            for f in ([v] if isinstance(v, str) else v):
                out.append(agg_expr(f, k).alias(f"{k}_{f}"))
    return out


def aggregate(df: DataFrame, spec: Mapping | str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Ungrouped (or grouped) agg with a function name, list, dict or named spec."""
    if isinstance(spec, str):
        spec = {c: spec for c in df.columns if c not in by}
    elif not isinstance(spec, Mapping):
        spec = {c: list(spec) for c in df.columns if c not in by}
    exprs = aggregate_exprs(spec)
    df = nan_to_null(df)
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def reduce(df: DataFrame, ops: Sequence[str], cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Reductions per column (nulls skipped): ``{op}_{col}`` columns."""
    exprs = [agg_expr(op, c).alias(f"{op}_{c}") for c in cols for op in ops]
    df = nan_to_null(df)
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def any_all(df: DataFrame, conds: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """``any_<name>`` / ``all_<name>`` of boolean columns, nulls skipped
    (empty any = False, empty all = True)."""
    exprs = []
    for name, c in conds.items():
        exprs.append(F.coalesce(F.bool_or(c), F.lit(False)).alias(f"any_{name}"))
        exprs.append(F.coalesce(F.bool_and(c), F.lit(True)).alias(f"all_{name}"))
    return df.groupBy(*by).agg(*exprs)


def row_any(cols: Sequence) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(False)) for c in cols])


def count(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Non-null counts per column (per group)."""
    cols = cols or [c for c in df.columns if c not in by]
    return nan_to_null(df, cols).groupBy(*by).agg(*[F.count(c).alias(c) for c in cols])


def row_count(cols: Sequence[str]) -> Column:
    """Non-null cells per row (axis=1)."""
    return functools.reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])


def count_level(df: DataFrame, level: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Non-null counts by one key level; null level labels are left out."""
    return count(df.where(F.col(level).isNotNull()), cols, [level])


def nunique(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), dropna: bool = True) -> DataFrame:
    exprs = []
    for c in cols:
        e = F.count_distinct(c)
        if not dropna:
            e = e + F.max(F.col(c).isNull().cast("int"))
        exprs.append(e.alias(c))
    return nan_to_null(df, cols).groupBy(*by).agg(*exprs)


def value_counts(df: DataFrame, subset: Sequence[str], normalize: bool = False, dropna: bool = True,
                 sort: bool = True, ascending: bool = False) -> DataFrame:
    """Frequencies of distinct rows of ``subset``; ``normalize`` divides by
    the total kept (a scalar from the small counts table, no global window)."""
    d = nan_to_null(df.select(*subset))
    if dropna:
        d = d.dropna()
    counts = d.groupBy(*subset).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        counts = materialize(counts, "counts")  # small; the total and the shares read it
        total = counts.agg(F.sum("count")).first()[0] or 0
        counts = counts.select(*subset, (F.col("count") / F.lit(float(total) if total else float("nan"))).alias("proportion"))
    if sort:
        v = "proportion" if normalize else "count"
        counts = counts.orderBy(F.col(v).asc() if ascending else F.col(v).desc(), *subset)
    return counts


def mode(df: DataFrame, col: str, by: Sequence[str] = (), dropna: bool = True) -> DataFrame:
    """All values tied for the highest count (per group)."""
    d = nan_to_null(df.select(*by, col))
    if dropna:
        d = d.where(F.col(col).isNotNull())
    counts = d.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    if by:
        top = counts.groupBy(*by).agg(F.max("_n").alias("_m"))
        return counts.join(top, list(by)).where("_n = _m").select(*by, col)
    m = counts.agg(F.max("_n")).first()[0]
    return counts.where(F.col("_n") == F.lit(m)).select(col)


# -- order statistics by counted positions -----------------------------------

def value_positions(df: DataFrame, col: str, by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Distinct non-null values with their 0-based position range
    ``[_lo, _hi]`` in the sorted column (per group) and the group size."""
    df = nan_to_null(df, [col])
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_cnt"))
    counts = materialize(counts, "value-counts")  # read by the scan and the sizes
    cum = ordered_scan(counts, [F.col(col).asc()], list(by), [CumSum("_cnt", "_cum")], partitions)
    sizes = counts.groupBy(*by).agg(F.sum("_cnt").alias("_n")) if by else None
    cum = cum.withColumns({"_lo": F.col("_cum") - F.col("_cnt"), "_hi": F.col("_cum") - 1})
    if sizes is not None:
        cum = cum.join(sizes, list(by))
    else:
        n = counts.agg(F.sum("_cnt")).first()[0] or 0
        cum = cum.withColumn("_n", F.lit(n).cast("bigint"))
    return cum


def quantiles(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = (),
              interpolation="linear", name: str = "value") -> DataFrame:
    """Exact quantiles at ``qs`` (numpy positions h = q*(n-1)); one row per
    (group, q): ``by..., q, <name>``.  Interpolations: linear, lower, higher,
    midpoint, nearest (half to even, like numpy); a list of interpolations
    gives one column per interpolation from the same pass."""
    pos = value_positions(df, col, by)
    # each distinct value covers a range of positions: one conditional aggregate per quantile picks its two values
    picks = []
    for i, q in enumerate(qs):
        h = F.lit(float(q)) * (F.col("_n") - 1)
        for name_, at in (("l", F.floor(h)), ("h", F.ceil(h))):
            picks.append(F.max(F.when((F.col("_lo") <= at) & (F.col("_hi") >= at), F.col(col))).alias(f"_x{name_}{i}"))
    g = pos.groupBy(*by, "_n").agg(*picks)
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col(f"_xl{i}").alias("_xl"), F.col(f"_xh{i}").alias("_xh"))
                               for i, q in enumerate(qs)]))
    g = g.select(*by, "_n", each.alias("e")).select(*by, "_n", "e.*")
    h = (F.col("q") * (F.col("_n") - 1))
    frac = h - F.floor(h)
    xl, xh = F.col("_xl"), F.col("_xh")
    interps = [interpolation] if isinstance(interpolation, str) else list(interpolation)
    forms = {
        "linear": xl + (xh - xl) * frac, "lower": xl, "higher": xh, "midpoint": (xl + xh) / 2,
        "nearest": F.when(F.bround(h, 0) == F.floor(h), xl).otherwise(xh),
    }
    for i in interps:
        if i not in forms:
            raise ValueError(i)
    if isinstance(interpolation, str):
        return g.select(*by, "q", forms[interpolation].alias(name))
    return g.select(*by, "q", *[forms[i].alias(i) for i in interps])


def quantile_table(df: DataFrame, cols: Sequence[str], qs: Sequence[float], interpolation: str = "nearest") -> DataFrame:
    """Whole-row quantile: rows sorted by all columns, the row at position
    q*(n-1) (nearest / lower / higher)."""
    if interpolation not in ("nearest", "lower", "higher"):
        raise ValueError("table method supports nearest, lower, higher")
    counts = df.select(*cols).dropna().groupBy(*cols).agg(F.count(F.lit(1)).alias("_cnt"))
    cum = ordered_scan(counts, [F.col(c).asc() for c in cols], [], [CumSum("_cnt", "_cum")])
    n = counts.agg(F.sum("_cnt")).first()[0] or 0
    targets = []
    for q in qs:
        h = q * (n - 1)
        if interpolation == "lower":
            k = math.floor(h)
        elif interpolation == "higher":
            k = math.ceil(h)
        else:
            k = round(h)  # Python round is half to even, like numpy
        targets.append((float(q), int(k)))
    t = df.sparkSession.createDataFrame(targets, "q double, k long")
    j = cum.join(F.broadcast(t), (F.col("k") >= F.col("_cum") - F.col("_cnt")) & (F.col("k") < F.col("_cum")))
    return j.select("q", *cols)


def idxminmax(df: DataFrame, key: str, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Label of the min / max per column; ties go to the first label in key
    order; all-null columns give null."""
    exprs = []
    for c in cols:
        valid = F.col(c).isNotNull()
        exprs.append(F.min_by(F.when(valid, F.col(key)), F.when(valid, F.struct(F.col(c), F.col(key)))).alias(f"idxmin_{c}"))
        exprs.append(F.min_by(F.when(valid, F.col(key)), F.when(valid, F.struct((-F.col(c)).alias("v"), F.col(key)))).alias(f"idxmax_{c}"))
    return df.groupBy(*by).agg(*exprs)


def _pairs(cols):
    return list(itertools.product(cols, cols))


def corr(df: DataFrame, cols: Sequence[str], min_periods: int = 1, digits: int | None = None) -> DataFrame:
    """Pearson matrix, long form (col_a, col_b, corr): one aggregate over the
    pairwise-complete rows of every pair; diagonal 1; below ``min_periods``
    rows null."""
    exprs = []
    df = nan_to_null(df, cols)
    for a, b in _pairs(cols):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        n = F.count(F.when(both, F.lit(1)))
        v = F.lit(1.0) if a == b else F.corr(F.when(both, F.col(a)), F.when(both, F.col(b)))
        if a == b:
            v = F.when(F.stddev_pop(F.when(both, F.col(a))) > 0, v)
        v = F.when(n >= min_periods, v)
        if digits is not None:
            v = F.round(v, digits)
        exprs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), v.alias("corr")))
    return df.agg(F.array(*exprs).alias("m")).select(F.explode("m").alias("e")).select("e.*")


def cov(df: DataFrame, cols: Sequence[str], ddof: int = 1, min_periods: int = 1,
        digits: int | None = None) -> DataFrame:
    """Covariance matrix, long form (col_a, col_b, cov), pairwise complete."""
    exprs = []
    df = nan_to_null(df, cols)
    for a, b in _pairs(cols):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        n = F.count(F.when(both, F.lit(1)))
        v = F.covar_pop(F.when(both, F.col(a)), F.when(both, F.col(b))) * n / (n - ddof)
        v = F.when((n >= min_periods) & (n > ddof), v)
        if digits is not None:
            v = F.round(v, digits)
        exprs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), v.alias("cov")))
    return df.agg(F.array(*exprs).alias("m")).select(F.explode("m").alias("e")).select("e.*")


def multi_average_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Average ranks of several columns from ONE counted-position scan keyed
    by column name: (column, value, rank)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v"))
                                         for c in cols])).alias("e")).select("e._c", "e._v")
    counts = long.where(F.col("_v").isNotNull()).groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_cnt"))
    cum = ordered_scan(counts, [F.col("_v").asc()], ["_c"], [CumSum("_cnt", "_cum")])
    return cum.select("_c", "_v", (F.col("_cum") - (F.col("_cnt") - 1) / 2).alias("_rank"))


def corr_spearman(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Spearman: Pearson on average ranks of the complete rows.  Ranks of all
    columns come from one scan; each column takes its rank by a join on its
    value (AQE broadcasts the rank table when it is small)."""
    d = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in cols])).dropna()
    ranks = materialize(multi_average_ranks(d, cols), "ranks")
    # ranks meet distinct (pair of values, count) rows, never the rows themselves: a frequent value is one row of a pair
    exprs = []
    for a, b in itertools.combinations(cols, 2):
        pairs = d.groupBy(F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count(F.lit(1)).alias("_w"))
        for side, c in (("_a", a), ("_b", b)):
            own = ranks.where(F.col("_c") == c).select(F.col("_v").alias(side), F.col("_rank").alias(f"_r{side}"))
            pairs = pairs.join(own, side)
        pairs = materialize(pairs, "rank-pairs")
        x, y, w = F.col("_r_a"), F.col("_r_b"), F.col("_w")
        n = F.sum(w)
        mean = pairs.agg((F.sum(w * x) / n).alias("x"), (F.sum(w * y) / n).alias("y")).first()
        dx, dy = x - F.lit(mean["x"]), y - F.lit(mean["y"])
        v = F.sum(w * dx * dy) / F.sqrt(F.sum(w * dx * dx) * F.sum(w * dy * dy))
        exprs.append(pairs.agg(F.lit(a).alias("_x"), F.lit(b).alias("_y"), v.alias("corr")))
    one = d.agg(*[(F.min(c) < F.max(c)).alias(c) for c in cols]).first() if cols else {}
    rows = [(c, c, 1.0 if one[c] else None) for c in cols]
    for e in exprs:
        r = e.first()
        rows += [(r["_x"], r["_y"], r["corr"]), (r["_y"], r["_x"], r["corr"])]
    out = df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")
    return out.withColumn("corr", F.round("corr", digits)) if digits is not None else out


def corrwith(left: DataFrame, right: DataFrame, key: Sequence[str], drop: bool = False,
             digits: int | None = None) -> DataFrame:
    """Correlation of same-named columns of two frames inner-aligned on key;
    unmatched columns give null unless ``drop``."""
    key = list(key)
    lc = [c for c in left.columns if c not in key]
    rc = [c for c in right.columns if c not in key]
    shared = [c for c in lc if c in rc]
    j = left.alias("l").join(right.alias("r"), key, "inner")
    exprs = []
    for c in shared:
        v = F.corr(F.col(f"l.{c}"), F.col(f"r.{c}"))
        exprs.append(F.struct(F.lit(c).alias("column"), (F.round(v, digits) if digits else v).alias("corr")))
    if not drop:
        for c in sorted(set(lc) ^ set(rc)):
            exprs.append(F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("corr")))
    return j.agg(F.array(*exprs).alias("m")).select(F.explode("m").alias("e")).select("e.*")


_RAW = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "median": F.median,
        "std": F.stddev_samp, "var": F.var_samp}


def pivot_margins(df: DataFrame, index: str, columns: str, values: str, aggfuncs: Sequence[str],
                  margins_name: str = "All", col_values: Sequence | None = None) -> DataFrame:
    """pivot_table with margins in ONE aggregate: grouping sets (index) and
    () with a conditional aggregate per column value plus the unconditional
    margin column; the margin row is named from ``grouping()``, never from a
    null test.  Output columns ``{agg}_{column value}`` and
    ``{agg}_{margins_name}``; a combination without rows is null."""
    if col_values is None:
        col_values = bounded_distinct(df, columns, 10_000, "pivot columns")
    exprs = []
    for f in aggfuncs:
        for v in col_values:
            e = _RAW[f](F.when(F.col(columns) == F.lit(v), F.col(values)))
            if f == "count":
                e = F.when(e > 0, e)
            exprs.append(e.alias(f"{f}_{v}"))
        exprs.append(_RAW[f](F.col(values)).alias(f"{f}_{margins_name}"))
    g = df.groupingSets([[index], []], index).agg(*exprs, F.grouping(index).alias("_gi"))
    names = [f"{f}_{v}" for f in aggfuncs for v in [*col_values, margins_name]]
    return g.select(F.when(F.col("_gi") == 1, F.lit(margins_name)).otherwise(F.col(index).cast("string")).alias(index),
                    *names)


# -- Kendall tau-b without pairs ------------------------------------------------

def _pairs_within(df: DataFrame, cols: Sequence[str]) -> float:
    """Number of row pairs tied on ``cols``: sum of t(t-1)/2 over groups."""
    r = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_t")) \
        .agg(F.sum(F.col("_t") * (F.col("_t") - 1) / 2)).first()[0]
    return float(r or 0.0)


def kendall_tau_b(df: DataFrame, x: str, y: str, tiebreak: str) -> tuple[float, int]:
    """Exact Kendall tau-b of two columns over their complete rows, in
    O(n log n) work and without enumerating pairs.

    Rows are numbered by (x asc, y desc, tiebreak); with that order, every
    pair (i before j) with y_i < y_j has x_i < x_j.  A = number of such pairs
    is counted on the implicit merge tree over positions: at every level
    each row of a right child counts the rows of its left sibling with a
    smaller y, as a running sum keyed by the parent node (one range-carry
    scan over all levels at once, so no node, not even the root, sits in a
    single task).  Then S = 2A - (n0 - n1) + (n2 - n3) and
    tau_b = S / sqrt((n0 - n1) (n0 - n2))."""
    d = df.select(F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(tiebreak).alias("_id")) \
        .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    if isinstance(d.schema["_x"].dataType, (T.DoubleType, T.FloatType)):
        d = d.where(~F.isnan("_x"))
    if isinstance(d.schema["_y"].dataType, (T.DoubleType, T.FloatType)):
        d = d.where(~F.isnan("_y"))
    n = d.count()
    if n < 2:
        return float("nan"), n
    ranked = ordered_scan(d, [F.col("_x").asc(), F.col("_y").desc(), F.col("_id").asc()], [], [Pos("_pos")])
    levels = max(1, math.ceil(math.log2(n)))
    lv = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_lv")
    tree = ranked.select("_y", "_pos", lv).select(
        "_y", "_lv", F.expr("shiftright(_pos, _lv + 1)").alias("_node"),
        (F.expr("shiftright(_pos, _lv) % 2") == 0).cast("int").alias("_left"))
    # at equal y, right rows come first so the running count stays strict
    scanned = ordered_scan(tree, [F.col("_y").asc(), F.col("_left").asc()], ["_lv", "_node"],
                           [CumSum("_left", "_lefts")])
    a = scanned.where("_left = 0").agg(F.sum("_lefts")).first()[0] or 0
    n0 = n * (n - 1) / 2
    n1, n2, n3 = _pairs_within(d, ["_x"]), _pairs_within(d, ["_y"]), _pairs_within(d, ["_x", "_y"])
    s = 2 * a - (n0 - n1) + (n2 - n3)
    den = math.sqrt((n0 - n1) * (n0 - n2))
    return (s / den if den > 0 else float("nan")), n


def corr_kendall(df: DataFrame, cols: Sequence[str], tiebreak: str, digits: int | None = None) -> DataFrame:
    """Kendall tau-b matrix, long form (col_a, col_b, corr), pairwise complete."""
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            if a == b:
                v = 1.0
            else:
                v, _ = kendall_tau_b(df, a, b, tiebreak)
            if digits is not None and v == v:
                v = round(v, digits)
            rows.append((a, b, v))
            if a != b:
                rows.append((b, a, v))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")
