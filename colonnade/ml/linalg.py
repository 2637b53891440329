"""Distributed second moments and vector sums.

Every learner here reduces the data to statistics whose size depends on the
number of features only (d x d Gram matrices, k x d sums), computed by one
Spark aggregate; the small solves then run on the driver with numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FEATURES = 2048  # d x d statistics stay bounded


@dataclass
class Gram:
    cols: list[str]
    n: float
    sx: np.ndarray      # (d,)   sum of x
    xx: np.ndarray      # (d, d) sum of x x'
    sy: float = 0.0
    xy: np.ndarray | None = None  # (d,) sum of x y
    yy: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return self.sx / self.n

    def centered(self) -> tuple[np.ndarray, np.ndarray | None]:
        """Centered X'X and X'y."""
        m = self.mean
        cxx = self.xx - self.n * np.outer(m, m)
        cxy = None if self.xy is None else self.xy - self.n * m * (self.sy / self.n)
        return cxx, cxy

    def cov(self, ddof: int = 1) -> np.ndarray:
        return self.centered()[0] / (self.n - ddof)


SQL_GRAM_MAX = 8  # up to this many features the Gram is plain SQL aggregates


def gram(df: DataFrame, cols: Sequence[str], y: str | None = None, weight: str | None = None,
         by: str | None = None) -> Gram | dict:
    """One pass for n, sum x, sum x x' (and x y, y y); rows with a null
    feature are skipped.  With ``by``: one Gram per group value.

    Few features: plain SQL aggregates (JVM, codegen).  More features: each
    Arrow batch adds its numpy x'x to a per-partition accumulator and Spark
    sums the per-partition vectors (d^2 numbers per partition and group)."""
    cols = list(cols)
    d = len(cols)
    if d > MAX_FEATURES:
        raise ValueError("too many features for a dense Gram matrix")
    valid = F.lit(True)
    for c in cols + ([y] if y else []):
        valid = valid & F.col(c).isNotNull()
    base = df.where(valid)
    if d > SQL_GRAM_MAX:
        return _gram_numpy(base, cols, y, weight, by)
    w = F.col(weight) if weight else F.lit(1.0)
    x = [F.col(c).cast("double") for c in cols]
    exprs = [F.sum(w).alias("n")] + [F.sum(w * x[i]).alias(f"s{i}") for i in range(d)]
    exprs += [F.sum(w * x[i] * x[j]).alias(f"q{i}_{j}") for i in range(d) for j in range(i, d)]
    if y:
        yc = F.col(y).cast("double")
        exprs += [F.sum(w * yc).alias("sy"), F.sum(w * yc * yc).alias("yy")]
        exprs += [F.sum(w * x[i] * yc).alias(f"xy{i}") for i in range(d)]
    rows = base.groupBy(by).agg(*exprs).collect() if by else [base.agg(*exprs).first()]

    def build(r):
        xx = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                xx[i, j] = xx[j, i] = r[f"q{i}_{j}"] or 0.0
        g = Gram(cols, r["n"] or 0.0, np.array([r[f"s{i}"] or 0.0 for i in range(d)]), xx)
        if y:
            g.sy, g.yy = r["sy"] or 0.0, r["yy"] or 0.0
            g.xy = np.array([r[f"xy{i}"] or 0.0 for i in range(d)])
        return g

    return {r[by]: build(r) for r in rows} if by else build(rows[0])


def _gram_numpy(base: DataFrame, cols: list[str], y: str | None, weight: str | None, by: str | None):
    d = len(cols)
    width = 1 + d + d * d + (2 + d if y else 0)

    def stats(m: np.ndarray) -> np.ndarray:
        x = m[:, :d]
        w = m[:, d] if weight else np.ones(len(m))
        xw = x * w[:, None]
        parts = [[w.sum()], xw.sum(axis=0), (xw.T @ x).ravel()]
        if y:
            yv = m[:, -1]
            parts += [[(w * yv).sum(), (w * yv * yv).sum()], xw.T @ yv]
        return np.concatenate(parts)

    in_cols = cols + ([weight] if weight else []) + ([y] if y else [])
    sums = grouped_vector_sum(base, in_cols, stats, width, by)

    def build(v):
        g = Gram(cols, v[0], v[1:1 + d], v[1 + d:1 + d + d * d].reshape(d, d))
        if y:
            o = 1 + d + d * d
            g.sy, g.yy, g.xy = v[o], v[o + 1], v[o + 2:o + 2 + d]
        return g

    return {k: build(v) for k, v in sums.items()} if by else build(sums[None])


def grouped_vector_sum(df: DataFrame, cols: Sequence[str], fn: Callable[[np.ndarray], np.ndarray], width: int,
                       by: str | None = None) -> dict:
    """Like ``vector_sum`` but one vector per value of ``by`` (None key when
    ungrouped); only (groups x width) numbers per partition travel."""
    cols = list(cols)
    sel = df.select(*([by] if by else []), *[F.col(c).cast("double").alias(c) for c in cols])
    key_t = df.schema[by].dataType.simpleString() if by else "int"

    def run(batches):
        acc: dict = {}
        for pdf in batches:
            if not len(pdf):
                continue
            if by:
                for k, part in pdf.groupby(by, sort=False):
                    acc[k] = acc.get(k, 0) + fn(part[cols].to_numpy(dtype=float))
            else:
                acc[None] = acc.get(None, 0) + fn(pdf[cols].to_numpy(dtype=float))
        for k, v in acc.items():
            yield pd.DataFrame({"g": [k] * width, "i": np.arange(width, dtype=np.int64), "v": v})

    parts = sel.mapInPandas(run, f"g {key_t}, i long, v double")
    out: dict = {}
    for r in parts.groupBy("g", "i").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r["g"], np.zeros(width))[r["i"]] = r["v"]
    if not by and None not in out:
        out[None] = out.pop(next(iter(out))) if out else np.zeros(width)
    return out


def vector_sum(df: DataFrame, cols: Sequence[str], fn: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over rows of ``fn(X_batch)`` (a vector of ``width`` per batch),
    computed per Arrow batch in the executors and added by Spark: only
    ``width`` numbers per partition travel."""
    cols = list(cols)

    def run(batches):
        acc = np.zeros(width)
        for pdf in batches:
            if len(pdf):
                acc += fn(pdf[cols].to_numpy(dtype=float))
        yield pd.DataFrame({"i": np.arange(width, dtype=np.int64), "v": acc})

    parts = df.select(*cols).mapInPandas(run, "i long, v double")
    out = np.zeros(width)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def linear_predict(coef: Sequence[float], cols: Sequence[str], intercept: float = 0.0):
    """``intercept + sum(coef_i * col_i)`` as one literal expression."""
    e = F.lit(float(intercept))
    for c, w in zip(cols, coef):
        e = e + F.col(c) * F.lit(float(w))
    return e


EXPR_TERMS_MAX = 256  # larger linear maps run per Arrow batch in numpy


def affine_columns(df: DataFrame, mat: np.ndarray, cols: Sequence[str], names: Sequence[str],
                   offset: np.ndarray | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``names = mat @ (x - offset)``: literal column expressions for small
    maps (whole-stage codegen), a per-batch numpy product for large ones
    (one huge expression would exceed the generated-code size limit)."""
    offset = np.zeros(len(cols)) if offset is None else offset
    if mat.size > EXPR_TERMS_MAX:
        return _affine_numpy(df, np.asarray(mat, float), list(cols), list(names), np.asarray(offset, float), list(keep))
    exprs = []
    for k, n in enumerate(names):
        e = F.lit(0.0)
        for i, c in enumerate(cols):
            if mat[k, i] != 0.0:
                e = e + (F.col(c) - F.lit(float(offset[i]))) * F.lit(float(mat[k, i]))
        exprs.append(e.alias(n))
    return df.select(*keep, *exprs)


def _affine_numpy(df: DataFrame, mat: np.ndarray, cols: list[str], names: list[str], offset: np.ndarray,
                  keep: list[str]) -> DataFrame:
    from pyspark.sql import types as T
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, T.DoubleType()) for n in names])

    def run(batches):
        for pdf in batches:
            out = pdf[keep].copy()
            if len(pdf):
                z = (pdf[cols].to_numpy(dtype=float) - offset) @ mat.T
            else:
                z = np.zeros((0, len(names)))
            for k, n in enumerate(names):
                out[n] = z[:, k]
            yield out

    return df.select(*keep, *[c for c in cols if c not in keep]).mapInPandas(run, schema)
