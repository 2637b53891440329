"""Round-robin linear imputation from the second moments of each missing pattern.

Without bounds every imputed cell is a linear function of its row's observed cells, the same for all rows that miss the same
columns. So one pass gives the second moments of every pattern (the Gram matrix of the rows with a leading one, missing cells at
the column mean), and a regression of any later round follows from them: the driver keeps a linear map for each pattern, and the
moments after some imputations are those maps applied to both sides of the Gram. A round costs one pass that measures the largest
change of a cell. The result is exactly that of regressing column after column on the rows where it is observed.

With bounds, which are not linear, or with more patterns than ``MOST_NUMBERS`` allows, each column of a round takes an aggregate of
its own, and each round is written.

Defined cases: a column without any value stays null and takes no part; rows without any value get the means as a start as
well; NaN counts as null; with one column or nothing missing nothing but the means is imputed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.ml.linalg import gram
from colonnade.session import materialize

MOST_NUMBERS = 1 << 23  # of all patterns' moments
ORDERS = ("ascending", "descending", "roman", "arabic", "random")


def swept(g: np.ndarray, j: int, others: Sequence[int], alpha: float) -> np.ndarray:
    """Coefficients of column ``j`` on the leading one and ``others``, from the Gram with a leading one: the others, centred by
    sweeping the one out, with ``alpha`` on their diagonal. Entries of columns that are not used are zero."""
    out = np.zeros(len(g))
    n = g[0, 0]
    if n <= 0:
        return out
    centred = g - np.outer(g[:, 0], g[0]) / n
    o = list(others)
    if o:
        out[o] = np.linalg.solve(centred[np.ix_(o, o)] + alpha * np.eye(len(o)), centred[o, j])
    out[0] = (g[0, j] - g[0] @ np.where(np.arange(len(g)) > 0, out, 0)) / n
    return out


def order_of(cols: Sequence[int], missing: np.ndarray, order: str, rng) -> list[int]:
    """Columns with missing cells in the order of a round: by how many miss, left to right (roman), right to left (arabic), or drawn."""
    have = [j for j in cols if missing[j] > 0]
    if order == "ascending":
        return sorted(have, key=lambda j: (missing[j], j))
    if order == "descending":
        return sorted(have, key=lambda j: (-missing[j], j))
    if order == "arabic":
        return have[::-1]
    return [have[i] for i in rng.permutation(len(have))] if order == "random" else have


def nearest(j: int, cols: Sequence[int], corr: np.ndarray, n: int | None, rng) -> list[int]:
    """The columns that ``j`` is regressed on: all others, or ``n`` drawn without replacement by absolute correlation."""
    others = [o for o in cols if o != j]
    if n is None or n >= len(others):
        return others
    p = np.maximum(np.abs(corr[j, others]), 1e-6)
    return sorted(rng.choice(others, n, replace=False, p=p / p.sum()).tolist())


def iterative_impute(df: DataFrame, cols: Sequence[str], max_iter: int = 10, tol: float = 1e-3, alpha: float = 1e-6, keep: Sequence[str] = (),
                     order: str = "ascending", n_nearest_features: int | None = None, min_value="observed", max_value="observed", seed: int = 0) -> tuple[DataFrame, int]:
    """(``keep`` and ``cols`` with the missing cells imputed, number of rounds). Cells start at the column mean; in each round each column
    with missing cells, in ``order``, is regressed (ridge ``alpha``) on the others over the rows where it is observed. It ends when no
    cell changes by ``tol`` times the largest absolute observed value. ``min_value`` and ``max_value`` bound the
    imputed cells: 'observed' (the column's own least and greatest value), None, a number, or one for each column."""
    if order not in ORDERS:
        raise ValueError(f"order is one of {', '.join(ORDERS)}")
    cols, keep = list(cols), list(keep)
    d = len(cols)
    given = [None if isinstance(v, str) else np.broadcast_to(np.array(far if v is None else v, float), (d,)) for v, far in ((min_value, -np.inf), (max_value, np.inf))]
    if given[0] is not None and given[1] is not None and not (given[0] < given[1]).all():
        raise ValueError("a lower bound is not below its upper bound")
    value = {c: F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double")) for c in cols}
    rows = df.select(*keep, *[value[c].alias(c) for c in cols])
    s = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"a{i}") for i, c in enumerate(cols)], *[F.count(c).alias(f"c{i}") for i, c in enumerate(cols)],
                 *[F.max(F.abs(c)).alias(f"x{i}") for i, c in enumerate(cols)], *[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(cols) for f in (F.min, F.max)]).first()
    limits = [np.array([far if s[f"{side}{i}"] is None else s[f"{side}{i}"] for i in range(d)]) if g is None else g
              for g, side, far in zip(given, ("min", "max"), (-np.inf, np.inf))]
    missing = np.array([s["n"] - s[f"c{i}"] for i in range(d)])
    used = [j for j in range(d) if s[f"c{j}"]]
    start = rows.select(*keep, *[F.coalesce(F.col(c), F.lit(s[f"a{i}"])).alias(c) for i, c in enumerate(cols)],
                        F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols]).alias("_pattern"))
    if max_iter == 0 or not s["n"] or len(used) < 2 or not missing[used].any():
        return start.drop("_pattern"), 0
    start = materialize(start, "impute-start")
    rng = np.random.default_rng(seed)
    scale = tol * max(abs(s[f"x{j}"]) for j in used)
    patterns = start.select("_pattern").distinct().count()
    if np.isinf(limits[0]).all() and np.isinf(limits[1]).all() and patterns * (d + 1) ** 2 <= MOST_NUMBERS:
        return by_patterns(start, cols, keep, used, missing, max_iter, scale, alpha, order, n_nearest_features, rng)
    return by_columns(start, cols, keep, used, missing, max_iter, scale, alpha, order, n_nearest_features, limits, rng)


def pattern_moments(start: DataFrame, cols: list[str]) -> dict[str, np.ndarray]:
    """The Gram matrix of (1, columns) of every missing pattern, from one pass."""
    d = len(cols)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            x, pattern = with_one(b, cols), np.array(b.column("_pattern").to_pylist(), object)
            for p in set(pattern.tolist()):
                own = x[pattern == p]
                sums[p] = sums.get(p, 0) + own.T @ own
        for p, g in sums.items():
            yield pa.record_batch([pa.array([p] * g.size, pa.string()), pa.array(np.arange(g.size)), pa.array(g.ravel())], ["pattern", "i", "s"])

    out: dict[str, np.ndarray] = {}
    for r in start.select("_pattern", *cols).mapInArrow(run, "pattern string, i long, s double").groupBy("pattern", "i").agg(F.sum("s").alias("s")).toLocalIterator():
        out.setdefault(r["pattern"], np.zeros((d + 1) ** 2))[r["i"]] = r["s"]
    return {p: g.reshape(d + 1, d + 1) for p, g in sorted(out.items())}


def with_one(b: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    x = np.ones((b.num_rows, len(cols) + 1))
    for i, c in enumerate(cols):
        x[:, i + 1] = np.nan_to_num(b.column(c).to_numpy(zero_copy_only=False).astype(float))  # a column without values is zero
    return x


def by_patterns(start, cols, keep, used, missing, max_iter, scale, alpha, order, n_nearest, rng):
    d = len(cols)
    moments = pattern_moments(start, cols)
    maps = {p: np.eye(d + 1) for p in moments}
    corr = correlation(sum(moments.values()))
    rounds = 0
    for rounds in range(1, max_iter + 1):
        before = {p: m.copy() for p, m in maps.items()}
        for j in order_of(used, missing, order, rng):
            g = sum((maps[p] @ g @ maps[p].T for p, g in moments.items() if p[j] == "0"), np.zeros((d + 1, d + 1)))
            w = swept(g, j + 1, [o + 1 for o in nearest(j, used, corr, n_nearest, rng)], alpha)
            for p in maps:
                if p[j] == "1":
                    maps[p][j + 1] = w @ maps[p]
        if largest_change(start, cols, {p: maps[p] - before[p] for p in maps}) < scale:
            break

    def fill(batches):
        for b in batches:
            x, pattern = with_one(b, cols), np.array(b.column("_pattern").to_pylist(), object)
            out = x.copy()
            for p in set(pattern.tolist()):
                own = pattern == p
                at = [0] + [j + 1 for j in range(d) if p[j] == "1"]
                out[np.ix_(own, at)] = x[own] @ maps[p][at].T
            yield pa.record_batch([*[b.column(c) for c in keep], *[pa.array(out[:, j + 1]) if j in used else b.column(c).cast(pa.float64()) for j, c in enumerate(cols)]], [*keep, *cols])

    schema = T.StructType([*[start.schema[c] for c in keep], *[T.StructField(c, T.DoubleType()) for c in cols]])
    return start.select(*keep, *cols, "_pattern").mapInArrow(fill, schema), rounds


def largest_change(start: DataFrame, cols: list[str], change: dict[str, np.ndarray]) -> float:
    """The largest absolute entry of each row's change, over all rows: one pass."""

    def run(batches):
        most = 0.0
        for b in batches:
            x, pattern = with_one(b, cols), np.array(b.column("_pattern").to_pylist(), object)
            for p in set(pattern.tolist()):
                most = max(most, np.abs(x[pattern == p] @ change[p].T).max(initial=0.0))
        yield pa.record_batch([pa.array([float(most)])], ["most"])

    return start.select(*cols, "_pattern").mapInArrow(run, "most double").agg(F.max("most")).first()[0] or 0.0


def correlation(g: np.ndarray) -> np.ndarray:
    """Correlations of the columns from a Gram with a leading one."""
    c = (g - np.outer(g[:, 0], g[0]) / g[0, 0])[1:, 1:]
    root = np.sqrt(np.maximum(np.diag(c), 1e-300))
    return c / np.outer(root, root)


def by_columns(start, cols, keep, used, missing, max_iter, scale, alpha, order, n_nearest, limits, rng):
    """The same rounds with one aggregate for each column, for bounded cells."""
    names = [cols[j] for j in used]
    cur = start
    g = gram(cur, names)
    full = np.zeros((len(cols) + 1, len(cols) + 1))
    at = [0] + [j + 1 for j in used]
    full[np.ix_(at, at)] = np.block([[np.array([[g.n]]), g.sx[None, :]], [g.sx[:, None], g.xx]])
    corr = correlation(full)
    rounds = 0
    for rounds in range(1, max_iter + 1):
        todo = order_of(used, missing, order, rng)
        cur = cur.withColumns({f"_p{j}": F.col(cols[j]) for j in todo})
        for j in todo:
            others = nearest(j, used, corr, n_nearest, rng)
            own = gram(cur.where(F.substring("_pattern", j + 1, 1) == "0"), [cols[o] for o in others], cols[j])
            m = np.block([[np.array([[own.n]]), own.sx[None, :], np.array([[own.sy]])], [own.sx[:, None], own.xx, own.xy[:, None]], [np.array([[own.sy]]), own.xy[None, :], np.array([[own.yy]])]])
            w = swept(m, len(others) + 1, range(1, len(others) + 1), alpha)
            value = F.lit(float(w[0]))
            for k, o in enumerate(others):
                value = value + F.col(cols[o]) * F.lit(float(w[k + 1]))
            for bound, pick in ((limits[0][j], F.greatest), (limits[1][j], F.least)):
                value = pick(value, F.lit(float(bound))) if np.isfinite(bound) else value
            cur = cur.withColumn(cols[j], F.when(F.substring("_pattern", j + 1, 1) == "1", value).otherwise(F.col(cols[j])))
        cur = materialize(cur, "imputed")
        change = cur.agg(F.max(F.greatest(*[F.abs(F.col(cols[j]) - F.col(f"_p{j}")) for j in todo], F.lit(0.0)))).first()[0]
        cur = cur.drop(*[f"_p{j}" for j in todo])
        if (change or 0.0) < scale:
            break
    return cur.select(*keep, *cols), rounds
