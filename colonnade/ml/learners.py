"""Learners whose heavy step is a distributed aggregate or a Spark ML fit.

Gram-based models (ridge, OMP, PCA, factor analysis, sequential selection,
learning curves) need one aggregate of d x d statistics; the solve is a
small numpy problem on the driver.  Iterative models (FastICA, dictionary
learning, iterative imputation, self-training) run one aggregate per
iteration over a cached (and periodically checkpointed) frame.  Spark ML
learners are wrapped with the parameter mapping stated in each docstring.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, DecisionTreeClassifier)
from pyspark.ml.feature import DCT, Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions.columns import bounded_distinct
from colonnade.ml import trees as TR
from colonnade.ml.linalg import Gram, affine_columns, gram, grouped_vector_sum, linear_predict, vector_sum
from colonnade.ml.metrics import kfold
from colonnade.plans.ordered import CumSum, Pos, ordered_scan
from colonnade.session import materialize

# -- ridge / OMP --------------------------------------------------------------


@dataclass
class Linear:
    cols: list[str]
    coef: np.ndarray
    intercept: float

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, linear_predict(self.coef, self.cols, self.intercept))


def ridge_from_gram(g: Gram, alpha: float, fit_intercept: bool = True) -> Linear:
    """Solve (X'X + alpha I) w = X'y on centred statistics (n > d form)."""
    if fit_intercept:
        xx, xy = g.centered()
    else:
        xx, xy = g.xx, g.xy
    w = np.linalg.solve(xx + alpha * np.eye(len(g.cols)), xy)
    b = (g.sy / g.n - g.mean @ w) if fit_intercept else 0.0
    return Linear(g.cols, w, float(b))


def ridge(df: DataFrame, cols: Sequence[str], y: str, alpha: float = 1.0, fit_intercept: bool = True) -> Linear:
    return ridge_from_gram(gram(df, cols, y), alpha, fit_intercept)


def ridge_2f(df: DataFrame, x1: str, x2: str, y: str, alpha: float = 1.0) -> DataFrame:
    """Two-feature ridge in closed form (Cramer's rule) as one aggregate."""
    n = F.count(F.lit(1))
    s11, s22, s12 = n * F.covar_pop(x1, x1), n * F.covar_pop(x2, x2), n * F.covar_pop(x1, x2)
    s1y, s2y = n * F.covar_pop(x1, y), n * F.covar_pop(x2, y)
    a = F.lit(float(alpha))
    det = (s11 + a) * (s22 + a) - s12 * s12
    w1 = ((s22 + a) * s1y - s12 * s2y) / det
    w2 = ((s11 + a) * s2y - s12 * s1y) / det
    b = F.avg(y) - w1 * F.avg(x1) - w2 * F.avg(x2)
    return df.agg(w1.alias("w1"), w2.alias("w2"), b.alias("intercept"))


def omp_from_gram(g: Gram, n_nonzero: int | None = None, tol: float | None = None,
                  fit_intercept: bool = True) -> Linear:
    """Orthogonal matching pursuit on (centred) Gram statistics: greedily add
    the feature most correlated with the residual, refit least squares on
    the active set; stop at ``n_nonzero`` (default max(int(0.1 d), 1)) or
    when the residual sum of squares drops below ``tol``."""
    d = len(g.cols)
    xx, xy = g.centered() if fit_intercept else (g.xx, g.xy)
    yy = (g.yy - g.sy ** 2 / g.n) if fit_intercept else g.yy
    if n_nonzero is None and tol is None:
        n_nonzero = max(int(0.1 * d), 1)
    active: list[int] = []
    w = np.zeros(d)
    while True:
        corr = xy - xx @ w
        rss = yy - 2 * w @ xy + w @ xx @ w
        if (tol is not None and rss <= tol) or (n_nonzero is not None and len(active) >= n_nonzero) or len(active) == d:
            break
        cand = [i for i in range(d) if i not in active]
        j = max(cand, key=lambda i: abs(corr[i]) / math.sqrt(xx[i, i]) if xx[i, i] > 0 else 0.0)
        active.append(j)
        a = np.array(active)
        w = np.zeros(d)
        w[a] = np.linalg.solve(xx[np.ix_(a, a)], xy[a])
    b = (g.sy / g.n - g.mean @ w) if fit_intercept else 0.0
    return Linear(g.cols, w, float(b))


def ridge_classifier_cv(df: DataFrame, cols: Sequence[str], label: str, alphas: Sequence[float],
                        key: str, cv: int = 5) -> dict:
    """Targets +1/-1 per class; best alpha by mean CV accuracy.

    X'X does not depend on the class, so one grouped pass (per fold) gives
    X'X, sum x and X't for every class target; every (alpha, fold, class)
    model is then a d x d solve, and all accuracies come from one more pass."""
    cols = list(cols)
    d = len(cols)
    classes = bounded_distinct(df, label, 1000, "classes")
    f = kfold(df, cv, key).where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
    K = len(classes)

    def stats(m):
        x, lab = m[:, :d], m[:, d]
        t = np.where(lab[:, None] == np.array(classes, dtype=float)[None, :], 1.0, -1.0)   # (b, K)
        return np.concatenate([[len(m)], x.sum(axis=0), (x.T @ x).ravel(), t.sum(axis=0), (x.T @ t).ravel()])

    width = 1 + d + d * d + K + d * K
    per = grouped_vector_sum(f, cols + [label], stats, width, "fold")

    def unpack(v):
        o = 1 + d + d * d
        return v[0], v[1:1 + d], v[1 + d:o].reshape(d, d), v[o:o + K], v[o + K:].reshape(d, K)

    models = {}
    for k in range(cv):
        tot = sum(v for fk, v in per.items() if fk != k)
        n, sx, xx, st, xt = unpack(tot)
        mx = sx / n
        cxx = xx - n * np.outer(mx, mx)
        for a in alphas:
            W = np.linalg.solve(cxx + a * np.eye(d), xt - n * np.outer(mx, st / n))   # (d, K)
            b = st / n - mx @ W
            models[(a, k)] = (W, b)
    # accuracies of every (alpha, fold) model in one pass: per batch, numpy
    # decisions for the fold's models, correct counts summed by Spark
    cls_arr = np.array(classes, dtype=float)

    def correct(m):
        x, lab, fold = m[:, :d], m[:, d], m[:, d + 1]
        out = np.zeros(len(alphas) * cv + cv)
        for k in range(cv):
            sel = fold == k
            if not sel.any():
                continue
            out[len(alphas) * cv + k] = sel.sum()
            for ai, a in enumerate(alphas):
                W, b = models[(a, k)]
                pred = cls_arr[np.argmax(x[sel] @ W + b, axis=1)]
                out[ai * cv + k] = (pred == lab[sel]).sum()
        return out

    tot = grouped_vector_sum(f.withColumn("_fold", F.col("fold").cast("double")), cols + [label, "_fold"], correct,
                             len(alphas) * cv + cv)[None]
    sizes = tot[len(alphas) * cv:]
    scores = {a: float(np.mean([tot[ai * cv + k] / sizes[k] for k in range(cv) if sizes[k] > 0]))
              for ai, a in enumerate(alphas)}
    best_alpha = max(alphas, key=lambda a: (scores[a], -a))
    return {"alpha": best_alpha, "scores": scores}


@dataclass
class RidgeClassifier:
    """One ridge model a class (targets +1 and -1); the class with the highest value is predicted."""

    cols: list[str]
    classes: list[float]
    coef: np.ndarray  # (features, classes)
    intercept: np.ndarray
    alpha: float
    scores: dict[float, float]  # minus the mean squared leave-one-out error of each alpha

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        names = [f"_d{k}" for k in range(len(self.classes))]
        out = affine_columns(df, self.coef.T, self.cols, names, keep=list(keep))
        value = [F.col(c) + F.lit(float(b)) for c, b in zip(names, self.intercept)]
        best = F.array_max(F.array(*[F.struct(v.alias("v"), F.lit(-k).alias("k"), F.lit(float(c)).alias("c")) for k, (v, c) in enumerate(zip(value, self.classes))]))
        return out.select(*keep, best.getField("c").alias("prediction"))


def ridge_classifier_loo(df: DataFrame, cols: Sequence[str], label: str, alphas: Sequence[float], class_weight=None) -> RidgeClassifier:
    """The alpha with the smallest mean squared leave-one-out error over all classes, in closed form.

    A ridge fit is linear in the targets, so the error of a row when it is left out is its residual over 1 - h, h being its leverage
    w z'(Z'WZ + D)^-1 z with a leading one in z that D does not penalise. One pass sums Z'WZ and Z'WT; the eigenvectors of the
    centred Gram then serve all alphas, and a second pass adds up the squared errors of every alpha. Errors are weighted by
    ``class_weight`` (None, 'balanced' or a dict), as the fit is. Rows with a null take no part."""
    cols = list(cols)
    d = len(cols)
    rows = df.where(F.col(label).isNotNull()).where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
    rows, weight = with_class_weight(rows, label, class_weight)
    classes = [float(c) for c in bounded_distinct(rows, label, 1000, "classes")]
    if len(classes) < 2:
        raise ValueError("one label only")
    K, given = len(classes), np.array(classes)
    taken = [*cols, label] + ([weight] if weight else [])

    def parts(m):
        w = m[:, d + 1] if weight else np.ones(len(m))
        return m[:, :d], np.where(m[:, d][:, None] == given[None, :], 1.0, -1.0), w

    def moments(m):
        x, t, w = parts(m)
        return np.concatenate([[w.sum()], w @ x, ((x * w[:, None]).T @ x).ravel(), w @ t, ((x * w[:, None]).T @ t).ravel()])

    v = vector_sum(rows.select(*[F.col(c).cast("double").alias(c) for c in taken]), taken, moments, 1 + d + d * d + K + d * K)
    n, sx, xx = v[0], v[1:1 + d], v[1 + d:1 + d + d * d].reshape(d, d)
    st, xt = v[1 + d + d * d:1 + d + d * d + K], v[1 + d + d * d + K:].reshape(d, K)
    mean = sx / n
    values, axes = np.linalg.eigh(xx - n * np.outer(mean, mean))
    along = axes.T @ (xt - n * np.outer(mean, st / n))  # the targets' products with each eigenvector
    fits = {a: (W := axes @ (along / (np.maximum(values, 0) + a)[:, None]), st / n - mean @ W) for a in alphas}

    def errors(m):
        x, t, w = parts(m)
        z = ((x - mean) @ axes) ** 2
        out = []
        for a in alphas:
            W, b = fits[a]
            h = w * (1 / n + (z / (np.maximum(values, 0) + a)).sum(1))
            left = (t - x @ W - b) / np.maximum(1 - h, 1e-12)[:, None]
            out.append((w[:, None] * left * left).sum())
        return np.array(out)

    total = vector_sum(rows.select(*[F.col(c).cast("double").alias(c) for c in taken]), taken, errors, len(alphas))
    scores = {a: -float(e / (n * K)) for a, e in zip(alphas, total)}
    best = max(alphas, key=lambda a: (scores[a], -a))
    return RidgeClassifier(cols, classes, *fits[best], best, scores)


# -- PCA / factor analysis ----------------------------------------------------

@dataclass
class PCAModel:
    cols: list[str]
    mean: np.ndarray
    components: np.ndarray        # (k, d)
    explained_variance: np.ndarray
    explained_variance_ratio: np.ndarray
    noise_variance: float
    n: float
    whiten: bool = False

    def transform(self, df: DataFrame, keep: Sequence[str] = (), prefix: str = "pc") -> DataFrame:
        mat = self.components.copy()
        if self.whiten:
            mat = mat / np.sqrt(self.explained_variance)[:, None]
        return affine_columns(df, mat, self.cols, [f"{prefix}{i}" for i in range(len(mat))], self.mean, keep)

    def precision(self) -> np.ndarray:
        d = len(self.cols)
        comp = self.components
        ev = self.explained_variance
        if self.whiten:
            comp = comp * np.sqrt(ev)[:, None]
        diff = np.maximum(ev - self.noise_variance, 0.0)
        cov = comp.T @ np.diag(diff) @ comp + self.noise_variance * np.eye(d)
        return np.linalg.inv(cov)

    def score_samples(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Gaussian log-likelihood of every row (vectorized per batch)."""
        prec = self.precision()
        d = len(self.cols)
        logdet = np.linalg.slogdet(prec)[1]
        mean, cols = self.mean, list(self.cols)
        keep = list(keep)
        schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("loglik", T.DoubleType())])

        def run(batches):
            for pdf in batches:
                xc = pdf[cols].to_numpy(float) - mean
                ll = -0.5 * (np.einsum("ij,jk,ik->i", xc, prec, xc) + d * math.log(2 * math.pi) - logdet)
                out = pdf[keep].copy()
                out["loglik"] = ll
                yield out

        return df.select(*keep, *[c for c in cols if c not in keep]).mapInPandas(run, schema)


def _sign_fix(vecs: np.ndarray) -> np.ndarray:
    """Deterministic signs: the largest-magnitude loading of each component positive."""
    idx = np.argmax(np.abs(vecs), axis=1)
    signs = np.sign(vecs[np.arange(len(vecs)), idx])
    signs[signs == 0] = 1
    return vecs * signs[:, None]


def pca(df: DataFrame, cols: Sequence[str], n_components=None, whiten: bool = False) -> PCAModel:
    """PCA from the sample covariance (one aggregate) and ``eigh``.
    ``n_components``: int, a variance fraction in (0, 1), or None (all)."""
    g = gram(df, cols)
    cov = g.cov(ddof=1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.maximum(vals[order], 0.0), vecs[:, order].T
    ratio = vals / vals.sum() if vals.sum() > 0 else np.zeros_like(vals)
    d = len(cols)
    if n_components is None:
        k = d
    elif isinstance(n_components, float) and 0 < n_components < 1:
        k = int(np.searchsorted(np.cumsum(ratio), n_components, side="right") + 1)
        k = min(k, d)
    else:
        k = int(n_components)
    noise = float(vals[k:].mean()) if k < d else 0.0
    return PCAModel(list(cols), g.mean, _sign_fix(vecs[:k]), vals[:k], ratio[:k], noise, g.n, whiten)


@dataclass
class FAModel:
    cols: list[str]
    mean: np.ndarray
    components: np.ndarray   # (k, d)
    noise_variance: np.ndarray
    loglike: list
    n_iter: int

    def transform(self, df: DataFrame, keep: Sequence[str] = (), prefix: str = "f") -> DataFrame:
        w = self.components
        wpsi = w / self.noise_variance
        cov_z = np.linalg.inv(np.eye(len(w)) + wpsi @ w.T)
        return affine_columns(df, cov_z @ wpsi, self.cols, [f"{prefix}{i}" for i in range(len(w))], self.mean, keep)


def factor_analysis(df: DataFrame, cols: Sequence[str], n_components: int, tol: float = 1e-2,
                    max_iter: int = 1000) -> FAModel:
    """Factor analysis, x = mean + L f + e, by expectation-maximisation on second moments: one distributed Gram, then
    k x k and d x d algebra.  The posterior moments of the factors given the data covariance S are
    E[f x'] = B S and E[f f'] = I - B L + B S B' with B = L' (L L' + Psi)^-1; the loadings and noise that maximise the
    expected likelihood follow in closed form.  Starts from the leading eigenvectors; stops when the Gaussian
    log-likelihood gains less than ``tol``.  Loadings are turned so that L' Psi^-1 L is diagonal, largest factor first."""
    g = gram(df, cols)
    n, d, k = g.n, len(cols), n_components
    moments = g.cov(ddof=0)
    floor = 1e-12
    vals, vecs = np.linalg.eigh(moments)
    load = vecs[:, ::-1][:, :k] * np.sqrt(np.maximum(vals[::-1][:k], floor))
    noise = np.maximum(np.diag(moments) - (load ** 2).sum(axis=1), 0.05 * np.maximum(np.diag(moments), floor))
    history: list[float] = []
    for _ in range(max_iter):
        model = load @ load.T + np.diag(noise)
        solved = np.linalg.solve(model, np.column_stack([load, moments]))
        gain, spread = solved[:, :k].T, np.trace(solved[:, k:])
        history.append(float(-0.5 * n * (d * math.log(2 * math.pi) + np.linalg.slogdet(model)[1] + spread)))
        if len(history) > 1 and history[-1] - history[-2] < tol:
            break
        cross = moments @ gain.T                                  # E[x f']
        second = np.eye(k) - gain @ load + gain @ cross           # E[f f']
        load = np.linalg.solve(second.T, cross.T).T
        noise = np.maximum(np.diag(moments) - np.einsum("ij,ij->i", load, cross), floor)
    turn = np.linalg.eigh((load / noise[:, None]).T @ load)[1][:, ::-1]
    return FAModel(list(cols), g.mean, _sign_fix((load @ turn).T), noise, history, len(history))


# -- FastICA ------------------------------------------------------------------

@dataclass
class ICAModel:
    cols: list[str]
    mean: np.ndarray
    unmixing: np.ndarray   # (k, d) applied to centred data
    n_iter: int

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return affine_columns(df, self.unmixing, self.cols, [f"s{i}" for i in range(len(self.unmixing))],
                              self.mean, keep)


def _sym_decorrelate(w: np.ndarray) -> np.ndarray:
    s, u = np.linalg.eigh(w @ w.T)
    return (u * (1.0 / np.sqrt(np.maximum(s, 1e-300)))) @ u.T @ w


def fast_ica(df: DataFrame, cols: Sequence[str], n_components: int | None = None, fun: str = "logcosh",
             max_iter: int = 200, tol: float = 1e-4, seed: int = 0) -> ICAModel:
    """Parallel FastICA: whitening from the covariance, then fixed-point
    updates; each update is one pass that sums g(Wx) x' and g'(Wx) per
    Arrow batch (k x d numbers per partition)."""
    cols = list(cols)
    g = gram(df, cols)
    d = len(cols)
    k = n_components or d
    vals, vecs = np.linalg.eigh(g.cov(ddof=0))
    order = np.argsort(vals)[::-1][:k]
    whiten = (vecs[:, order] / np.sqrt(vals[order])).T   # (k, d)
    mean = g.mean
    data = df.select(*cols).where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)).cache()
    rng = np.random.default_rng(seed)
    w = _sym_decorrelate(rng.standard_normal((k, k)))
    it = 0
    try:
        for it in range(1, max_iter + 1):
            def stats(x, w=w):
                z = (x - mean) @ whiten.T          # whitened (b, k)
                wx = z @ w.T                       # (b, k)
                if fun == "logcosh":
                    gx, gp = np.tanh(wx), 1 - np.tanh(wx) ** 2
                elif fun == "exp":
                    e = np.exp(-wx ** 2 / 2)
                    gx, gp = wx * e, (1 - wx ** 2) * e
                else:
                    gx, gp = wx ** 3, 3 * wx ** 2
                return np.concatenate([(gx.T @ z).ravel(), gp.sum(axis=0)])
            v = vector_sum(data, cols, stats, k * k + k)
            new = v[:k * k].reshape(k, k) / g.n - (v[k * k:] / g.n)[:, None] * w
            new = _sym_decorrelate(new)
            lim = np.max(np.abs(np.abs(np.einsum("ij,ij->i", new, w)) - 1))
            w = new
            if lim < tol:
                break
    finally:
        data.unpersist()
    return ICAModel(cols, mean, w @ whiten, it)


# -- sparse coding ------------------------------------------------------------

def sparse_encode_threshold(df: DataFrame, cols: Sequence[str], dictionary: np.ndarray, alpha: float,
                            keep: Sequence[str] = (), positive: bool = False) -> DataFrame:
    """Soft-threshold codes: c = D x, code = sign(c) max(|c| - alpha, 0)."""
    out = affine_columns(df, dictionary, cols, [f"_c{j}" for j in range(len(dictionary))], None, keep)
    codes = {}
    for j in range(len(dictionary)):
        c = F.col(f"_c{j}")
        v = F.greatest(F.abs(c) - F.lit(alpha), F.lit(0.0))
        codes[f"code{j}"] = (F.when(c >= 0, v) if positive else F.signum(c) * v) + F.lit(0.0)
    return out.withColumns(codes).drop(*[f"_c{j}" for j in range(len(dictionary))])


def _omp_rows(x: np.ndarray, dictionary: np.ndarray, n_nonzero: int) -> np.ndarray:
    """OMP codes for a batch of rows against unit-norm atoms."""
    codes = np.zeros((len(x), len(dictionary)))
    dt = dictionary.T
    for r, v in enumerate(x):
        resid, active = v.copy(), []
        for _ in range(n_nonzero):
            j = int(np.argmax(np.abs(dictionary @ resid)))
            if j in active:
                break
            active.append(j)
            sol, *_ = np.linalg.lstsq(dt[:, active], v, rcond=None)
            resid = v - dt[:, active] @ sol
        if active:
            codes[r, active] = sol
    return codes


def sparse_encode_omp(df: DataFrame, cols: Sequence[str], dictionary: np.ndarray, n_nonzero: int,
                      keep: Sequence[str] = ()) -> DataFrame:
    """OMP codes, rows independent: computed per Arrow batch."""
    cols, keep = list(cols), list(keep)
    k = len(dictionary)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(f"code{j}", T.DoubleType()) for j in range(k)])

    def run(batches):
        for pdf in batches:
            c = _omp_rows(pdf[cols].to_numpy(float), dictionary, n_nonzero)
            out = pdf[keep].copy()
            for j in range(k):
                out[f"code{j}"] = c[:, j]
            yield out

    return df.select(*keep, *[c for c in cols if c not in keep]).mapInPandas(run, schema)


def lasso_codes(x: np.ndarray, dictionary: np.ndarray, alpha: float, positive: bool = False, tol: float = 1e-10, max_iter: int = 2000) -> np.ndarray:
    """Codes that minimise |x - code D|^2 / 2 + alpha |code|_1 for each row of a batch: coordinate descent on the dictionary's
    Gram, one coefficient of all rows at a time; rows that no longer move are left out of further sweeps."""
    g = dictionary @ dictionary.T
    against = x @ dictionary.T
    codes = np.zeros_like(against)
    open_ = np.arange(len(x))
    for _ in range(max_iter):
        a, c, moved = codes[open_], against[open_], np.zeros(len(open_))
        for j in range(len(dictionary)):
            if g[j, j] <= 0:
                continue
            want = c[:, j] - a @ g[:, j] + a[:, j] * g[j, j]
            want = (np.maximum(want - alpha, 0) if positive else np.sign(want) * np.maximum(np.abs(want) - alpha, 0)) / g[j, j]
            moved = np.maximum(moved, np.abs(want - a[:, j]))
            a[:, j] = want
        codes[open_] = a
        open_ = open_[moved > tol * (1 + np.abs(a).max(1, initial=0))]
        if len(open_) == 0:
            break
    return codes


def sparse_encode_lasso(df: DataFrame, cols: Sequence[str], dictionary: np.ndarray, alpha: float, keep: Sequence[str] = (), positive: bool = False) -> DataFrame:
    """Lasso codes, rows independent: computed per Arrow batch."""
    cols, keep = list(cols), list(keep)
    k = len(dictionary)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(f"code{j}", T.DoubleType()) for j in range(k)])

    def run(batches):
        for pdf in batches:
            c = lasso_codes(pdf[cols].to_numpy(float), dictionary, alpha, positive)
            out = pdf[keep].copy()
            for j in range(k):
                out[f"code{j}"] = c[:, j]
            yield out

    return df.select(*keep, *[c for c in cols if c not in keep]).mapInPandas(run, schema)


def atoms_in_turn(dic: np.ndarray, ata: np.ndarray, atx: np.ndarray) -> np.ndarray:
    """Each atom in turn at its best for the codes, given the others, and scaled back where its norm is above 1: the cost does not rise.
    Atoms that no code uses stay."""
    dic = dic.copy()
    for j in range(len(dic)):
        if ata[j, j] > 1e-12:
            dic[j] += (atx[j] - ata[j] @ dic) / ata[j, j]
            dic[j] /= max(np.linalg.norm(dic[j]), 1.0)
    return dic


def dict_learning(df: DataFrame, cols: Sequence[str], n_components: int, alpha: float = 0.1, max_iter: int = 20, tol: float = 1e-6,
                  seed: int = 0, method: str = "threshold") -> tuple[np.ndarray, list[float]]:
    """Alternating minimization: codes (per batch; soft thresholds or, with ``method`` 'lasso', lasso codes) and a
    dictionary update from the aggregates A'A and A'X; stops when the
    relative change of the cost is below ``tol``."""
    if method not in ("threshold", "lasso"):
        raise ValueError("method is 'threshold' or 'lasso'")
    cols = list(cols)
    d = len(cols)
    rng = np.random.default_rng(seed)
    dic = rng.standard_normal((n_components, d))
    dic /= np.linalg.norm(dic, axis=1, keepdims=True)
    data = df.select(*cols).where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)).cache()
    costs = []
    k = n_components
    try:
        for _ in range(max_iter):
            def stats(x, dic=dic):
                c = dic @ x.T
                a = lasso_codes(x, dic, alpha) if method == "lasso" else (np.sign(c) * np.maximum(np.abs(c) - alpha, 0.0)).T      # (b, k)
                r = x - a @ dic
                cost = 0.5 * (r * r).sum() + alpha * np.abs(a).sum()
                return np.concatenate([(a.T @ a).ravel(), (a.T @ x).ravel(), [cost]])
            v = vector_sum(data, cols, stats, k * k + k * d + 1)
            ata, atx, cost = v[:k * k].reshape(k, k), v[k * k:k * k + k * d].reshape(k, d), v[-1]
            if method == "lasso":
                dic = atoms_in_turn(dic, ata, atx)
            else:
                new = np.linalg.solve(ata + 1e-10 * np.eye(k), atx)
                norms = np.linalg.norm(new, axis=1, keepdims=True)
                dic = np.where(norms > 0, new / np.maximum(norms, 1e-300), dic)
            costs.append(float(cost))
            if len(costs) > 1 and abs(costs[-2] - costs[-1]) < tol * costs[-1]:
                break
    finally:
        data.unpersist()
    return dic, costs


# -- selection and curves -----------------------------------------------------

def _combine(grams: list[Gram]) -> Gram:
    return Gram(grams[0].cols, sum(g.n for g in grams), sum(g.sx for g in grams), sum(g.xx for g in grams),
                sum(g.sy for g in grams), sum(g.xy for g in grams), sum(g.yy for g in grams))


def _sub(g: Gram, idx: list[int]) -> Gram:
    a = np.array(idx)
    return Gram([g.cols[i] for i in idx], g.n, g.sx[a], g.xx[np.ix_(a, a)], g.sy, g.xy[a], g.yy)


def _r2_on(test: Gram, m: Linear, idx: list[int]) -> float:
    """R^2 of a linear model on a fold, from the fold's Gram statistics."""
    a = np.array(idx)
    w, b = m.coef, m.intercept
    xx, xy, sx = test.xx[np.ix_(a, a)], test.xy[a], test.sx[a]
    sse = test.yy - 2 * w @ xy - 2 * b * test.sy + w @ xx @ w + 2 * b * w @ sx + test.n * b * b
    sst = test.yy - test.sy ** 2 / test.n
    return 1 - sse / sst if sst > 0 else 0.0


def sequential_feature_selection(df: DataFrame, cols: Sequence[str], y: str, key: str, n_features_to_select=None,
                                 direction: str = "forward", cv: int = 5, alpha: float = 1e-6,
                                 tol: float | None = None) -> list[str]:
    """Greedy forward / backward selection by mean CV R^2 of a ridge model.
    All candidate scores come from one grouped Gram aggregate (per fold)."""
    cols = list(cols)
    per = gram(kfold(df, cv, key), cols, y, by="fold")
    folds = sorted(per)
    d = len(cols)
    target = n_features_to_select or (d // 2 if tol is None else None)

    def score(idx):
        s = []
        for k in folds:
            train = _combine([per[f] for f in folds if f != k])
            m = ridge_from_gram(_sub(train, idx), alpha)
            s.append(_r2_on(per[k], m, idx))
        return float(np.mean(s))

    chosen = [] if direction == "forward" else list(range(d))
    best = -np.inf if direction == "forward" else score(chosen)
    while True:
        if target is not None and len(chosen) == (target if direction == "forward" else target):
            break
        cands = [i for i in range(d) if i not in chosen] if direction == "forward" else list(chosen)
        if not cands or (direction == "backward" and len(chosen) == 1):
            break
        trial = {i: score(sorted(chosen + [i]) if direction == "forward" else [j for j in chosen if j != i])
                 for i in cands}
        i = max(trial, key=lambda t: (trial[t], -t))
        if tol is not None and trial[i] - best < tol:
            break
        best = trial[i]
        chosen = sorted(chosen + [i]) if direction == "forward" else [j for j in chosen if j != i]
    return [cols[i] for i in chosen]


def learning_curve(df: DataFrame, cols: Sequence[str], y: str, key: str, train_sizes=(0.1, 0.325, 0.55, 0.775, 1.0),
                   cv: int = 5, alpha: float = 1e-6, fold: Column | None = None, order: Sequence[Column] | None = None) -> DataFrame:
    """Train / test R^2 of a ridge model for k folds x train sizes.  Train sets are prefixes of each training fold along ``order``
    (default: by a hash of ``key``); ``fold`` (0 to cv - 1) defaults to a hash of ``key``.

    One ordered scan numbers the rows and counts the rows of each fold before them, so each row's place in every training fold is
    known, and with it the prefixes that hold it.  Rows of one fold that are in the same prefixes form a group (at most cv (cv x
    sizes + 1) of them); one grouped Gram serves all cells: a cell's Gram is a sum of groups."""
    order = list(order) if order is not None else [F.xxhash64(F.col(key), F.lit(7)), F.col(key)]
    f = (kfold(df, cv, key) if fold is None else df.withColumn("fold", fold.cast("int")))
    names = [f"_o{i}" for i in range(len(order))]
    sizes = {r["fold"]: r["n"] for r in f.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    bounds = [sorted(max(int(math.floor(s * (n - sizes.get(k, 0)))), 1) for s in train_sizes) for k in range(cv)]
    marked = f.select(*cols, y, "fold", *[o.alias(c) for o, c in zip(order, names)], *[(F.col("fold") == k).cast("long").alias(f"_f{k}") for k in range(cv)])
    numbered = ordered_scan(marked, [F.col(c).asc() for c in names], [], [Pos("_pos"), *[CumSum(f"_f{k}", f"_c{k}") for k in range(cv)]])
    places = []
    for k in range(cv):
        place = F.col("_pos") - F.col(f"_c{k}") + F.col(f"_f{k}")
        places.append(sum(((place >= b).cast("int") for b in bounds[k]), F.lit(0)))
    groups = gram(numbered.withColumn("_g", F.concat_ws(",", "fold", *[p.cast("string") for p in places])), cols, y, by="_g")
    parts = [([int(v) for v in g.split(",")], m) for g, m in groups.items()]
    rows, idx = [], list(range(len(cols)))
    for k in range(cv):
        test = _combine([m for g, m in parts if g[0] == k]) if any(g[0] == k for g, _ in parts) else None
        for b in bounds[k]:
            below = sum(x < b for x in bounds[k])  # a row is in the prefix if it is past no more bounds than those below it
            own = [m for g, m in parts if g[0] != k and g[1 + k] <= below]
            if own and test is not None:
                train = _combine(own)
                model = ridge_from_gram(train, alpha)
                rows.append((k, int(train.n), float(_r2_on(train, model, idx)), float(_r2_on(test, model, idx))))
    return df.sparkSession.createDataFrame(rows, "fold int, n_train long, train_score double, test_score double")


# -- Spark ML wrappers --------------------------------------------------------

def assemble(df: DataFrame, cols: Sequence[str] | None = None, array_col: str | None = None,
             out: str = "features") -> DataFrame:
    """Feature vector from numeric columns or from an array column."""
    if array_col:
        return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def with_class_weight(df: DataFrame, label: str, class_weight, weight: str | None = None) -> tuple[DataFrame, str | None]:
    """``df`` with a row weight per class (and times ``weight``): a dict of weights (1 for classes not in it), or
    ``"balanced"`` for rows / (classes * rows of the class).  Returns the frame and the weight column."""
    if class_weight is None:
        return df, weight
    if class_weight == "balanced":
        sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
        class_weight = {k: sum(sizes.values()) / (len(sizes) * n) for k, n in sizes.items()}
    w = F.lit(1.0)
    for k, v in class_weight.items():
        w = F.when(F.col(label) == F.lit(k), F.lit(float(v))).otherwise(w)
    return df.withColumn("_class_weight", w * F.col(weight) if weight else w), "_class_weight"


def logistic(df: DataFrame, label: str, C: float = 1.0, penalty: str = "l2", l1_ratio: float = 0.0,
             max_iter: int = 100, tol: float = 1e-4, multi_class: str = "auto", weight: str | None = None, class_weight=None):
    """Spark ML logistic regression with sklearn-style parameters:
    regParam = 1 / (C n) (sklearn's C scales the summed loss, Spark's
    objective is the mean loss), elasticNetParam from the penalty,
    standardization off.  ``multi_class='ovr'`` wraps OneVsRest; ``class_weight`` as in ``with_class_weight``."""
    df, weight = with_class_weight(df, label, class_weight, weight)
    n = df.count()
    reg = 0.0 if penalty in (None, "none") else 1.0 / (C * n)
    enet = {"l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio}.get(penalty, 0.0)
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=enet,
                            maxIter=max_iter, tol=tol, standardization=False,
                            family="multinomial" if multi_class == "multinomial" else "auto")
    if weight:
        lr.setWeightCol(weight)
    if multi_class == "ovr":
        return OneVsRest(classifier=lr, featuresCol="features", labelCol=label).fit(df)
    return lr.fit(df)


def logistic_path(df: DataFrame, label: str, Cs: Sequence[float], penalty: str = "l2", max_iter: int = 100) -> DataFrame:
    """Coefficients for each C: one ``fitMultiple`` over a parameter grid."""
    n = df.count()
    lr = LogisticRegression(featuresCol="features", labelCol=label, standardization=False, maxIter=max_iter,
                            elasticNetParam=1.0 if penalty == "l1" else 0.0)
    grid = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in Cs]).build()
    rows = []
    for i, model in lr.fitMultiple(df, grid):
        coef = model.coefficientMatrix.toArray().ravel().tolist()
        icpt = model.interceptVector.toArray().ravel().tolist()
        rows.append((float(Cs[i]), coef, icpt))
    return df.sparkSession.createDataFrame(rows, "C double, coef array<double>, intercept array<double>")


def linear_svc(df: DataFrame, label: str, C: float = 1.0, max_iter: int = 1000, tol: float = 1e-4,
               class_weight=None):
    """Linear SVM (hinge loss, L2) one-vs-rest.  regParam = 1 / (C n).
    Spark offers no squared hinge or L1 penalty."""
    df, weight = with_class_weight(df, label, class_weight)
    n = df.count()
    svc = LinearSVC(featuresCol="features", labelCol=label, regParam=1.0 / (C * n), maxIter=max_iter, tol=tol,
                    standardization=False)
    if weight:
        svc.setWeightCol(weight)
    n_classes = df.select(label).distinct().count()
    if n_classes > 2:
        return OneVsRest(classifier=svc, featuresCol="features", labelCol=label).fit(df)
    return svc.fit(df)


def bin_edges(df: DataFrame, cols: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each column but the last. Up to ``max_bins`` values are told apart, at the middle between
    neighbors, as Spark's trees do; columns with more values are cut at quantiles."""
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    few = [c for c in cols if sizes[c] <= 2 * max_bins]  # the estimate is off by a few hundredths
    values = {c: [r[0] for r in df.select(c).distinct().limit(max_bins + 1).collect()] for c in few}
    values = {c: np.unique(np.array(v, float)) for c, v in values.items()}
    edges = {c: (v[:-1] + v[1:]) / 2 for c, v in values.items() if len(v) <= max_bins}
    many = [c for c in cols if c not in edges]
    edges |= dict(zip(many, TR.edges_of(df, many, max_bins))) if many else {}
    return [edges[c] for c in cols]


@dataclass
class BinnedGbt:
    """Boosted trees of Spark on bin numbers, and the edges that give the bins of the vectors in ``features``."""

    model: GBTRegressionModel
    edges: list[np.ndarray]

    @property
    def trees(self):
        return self.model.trees

    @property
    def treeWeights(self):
        return self.model.treeWeights

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"_b{i}" for i in range(len(self.edges))]
        rows = binned_features(df, self.edges).withColumn("_bins", array_to_vector(F.array(*names)))
        return self.model.copy().setFeaturesCol("_bins").transform(rows).drop("_bins", *names)

    def staged(self, df: DataFrame, stages: Sequence[int], keep: Sequence[str]) -> DataFrame:
        """``keep`` and the sums of the first m trees: looked up in a table of all bins where that is small, else by walks
        through the trees."""
        walk, sizes = tree_walks(self.model, stages), [len(e) + 1 for e in self.edges]
        table = walk(np.stack([x.ravel() for x in np.indices(sizes)], 1)) if math.prod(sizes) <= TABLE else None
        names = [f"_b{i}" for i in range(len(sizes))]

        def run(batches):
            for b in batches:
                codes = TR.columns_matrix(b, names).astype(np.int64)
                sums = walk(codes) if table is None else table[np.ravel_multi_index(tuple(codes.T), sizes)]
                yield pa.record_batch([*[b.column(c) for c in keep], *[pa.array(x) for x in sums.T]], [*keep, *[f"stage_{m}" for m in stages]])

        schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(f"stage_{m}", T.DoubleType()) for m in stages]])
        return binned_features(df, self.edges).select(*keep, *names).mapInArrow(run, schema)


TABLE = 1 << 16  # combinations of bins up to which staged sums are held in a table


def binned_features(df: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """``df`` with the bins of its vectors, _b0 and so on as doubles: the number of edges below each entry."""
    x = vector_to_array("features")
    df = df.withColumns({f"_x{i}": x[i] for i in range(len(edges))} | {f"_b{i}": F.lit(0.0) for i, e in enumerate(edges) if not len(e)})
    cut = [i for i, e in enumerate(edges) if len(e)]
    if cut:  # a bucket holds its lower end, a bin its upper one
        splits = [[-math.inf, *np.nextafter(edges[i], math.inf).tolist(), math.inf] for i in cut]
        df = Bucketizer(splitsArray=splits, inputCols=[f"_x{i}" for i in cut], outputCols=[f"_b{i}" for i in cut]).transform(df)
    return df.drop(*[f"_x{i}" for i in range(len(edges))])


def tree_walks(model: GBTRegressionModel, stages: Sequence[int]):
    """A function of a matrix of bins that gives the weighted sums of the first m trees, a column for each stage. The nodes
    are read from the model's text; a leaf leads to itself."""
    trees: list[tuple[np.ndarray, ...]] = []
    lines = [x.strip() for x in model.toDebugString.splitlines()[1:]]
    lines = iter([x for x in lines if x and not x.startswith("Tree ")])

    def node(rows: list) -> int:
        at, line = len(rows), next(lines)
        rows.append(None)
        if line.startswith("Predict: "):
            rows[at] = (0, math.inf, at, at, float(line.removeprefix("Predict: ")))
            return at
        feature, cut = line.removeprefix("If (feature ").removesuffix(")").split(" <= ")
        left = node(rows)
        next(lines)  # Else
        rows[at] = (int(feature), float(cut), left, node(rows), 0.0)
        return at

    for tree in model.trees[:max(stages)]:
        rows: list = []
        node(rows)
        feature, cut, left, right, value = (np.array(x) for x in zip(*rows))
        trees.append((feature, cut, left, right, value, tree.depth))
    weights = list(model.treeWeights)

    def walk(codes: np.ndarray) -> np.ndarray:
        every, total, out = np.arange(len(codes)), np.zeros(len(codes)), {}
        for k, (feature, cut, left, right, value, depth) in enumerate(trees, 1):
            at = np.zeros(len(codes), np.int64)
            for _ in range(depth):
                at = np.where(codes[every, feature[at]] <= cut[at], left[at], right[at])
            total = total + value[at] * weights[k - 1]
            out[k] = total
        return np.stack([out.get(m, total) for m in stages], 1)

    return walk


def gbt_regressor(df: DataFrame, label: str, loss: str = "squared", learning_rate: float = 0.1, max_iter: int = 20,
                  max_bins: int = 255, max_depth: int = 5, seed: int = 0):
    """Gradient-boosted trees (squared or absolute loss).  Spark has no
    Poisson loss.

    With the squared loss, rows in the same bins of all features get the same predictions, and what their labels differ
    by adds the same to both sides of every split: Spark's trees are fitted on the number and the mean label of the rows of
    each combination of bins, so the many passes of boosting do not grow with the rows but with those combinations."""
    if loss not in ("squared", "absolute"):
        raise ValueError("Spark GBT supports squared and absolute losses")
    max_bins = min(max_bins, 256)
    gbt = GBTRegressor(featuresCol="features", labelCol=label, lossType=loss, stepSize=learning_rate,
                       maxIter=max_iter, maxBins=max_bins, maxDepth=max_depth, seed=seed)
    first = df.select(F.size(vector_to_array("features")).alias("d")).first()
    if loss == "absolute" or not first:
        return gbt.fit(df)
    names = [f"_x{i}" for i in range(first["d"])]
    x, y = vector_to_array("features"), F.col(label).cast("double")
    edges = bin_edges(df.select(*[x[i].alias(c) for i, c in enumerate(names)]), names, max_bins)
    y = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))).otherwise(y)
    bins = [f"_b{i}" for i in range(len(edges))]
    cells = binned_features(df.select("features", y.alias("_y")), edges).groupBy(*bins) \
        .agg(F.avg("_y").alias(label), F.count(F.lit(1)).cast("double").alias("_weight"))
    cells = materialize(cells, "cells").select(array_to_vector(F.array(*bins)).alias("features"), label, "_weight")
    return BinnedGbt(gbt.setWeightCol("_weight").fit(cells), edges)


def staged_predict(model, df: DataFrame, stages: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """Predictions using only the first m trees, for each m in ``stages``."""
    if isinstance(model, BinnedGbt):
        return model.staged(df, stages, keep)
    trees, weights = model.trees, model.treeWeights
    out = df
    for i, t in enumerate(trees[:max(stages)]):
        out = t.setPredictionCol(f"_t{i}").setFeaturesCol("features").transform(out)
    return out.select(*keep, *[sum(F.col(f"_t{i}") * F.lit(weights[i]) for i in range(m)).alias(f"stage_{m}")
                               for m in stages])


def gbt_classifier(df: DataFrame, label: str, learning_rate: float = 0.1, n_estimators: int = 20,
                   subsample: float = 1.0, max_depth: int = 3, seed: int = 0):
    """Gradient-boosted tree classifier (logistic loss, binary)."""
    return GBTClassifier(featuresCol="features", labelCol=label, stepSize=learning_rate, maxIter=n_estimators,
                         subsamplingRate=subsample, maxDepth=max_depth, seed=seed).fit(df)


def bagging(df: DataFrame, label: str, key: str, n_estimators: int = 10, max_depth: int = 5, seed: int = 0):
    """Bootstrap aggregation: bag b weights each row by a Poisson(1) count
    drawn from a hash of (row key, b) (no resampled copies); one weighted
    tree per bag; prediction by majority vote."""
    models = []
    for b in range(n_estimators):
        u = (F.pmod(F.xxhash64(F.col(key), F.lit(seed * 1000 + b)), F.lit(1 << 30)) + 0.5) / F.lit(float(1 << 30))
        # inverse Poisson(1) CDF
        cdf, k, e = [], 0, math.exp(-1.0)
        p, acc = e, e
        expr = F.lit(0)
        while acc < 1 - 1e-12 and k < 20:
            expr = F.when(u > F.lit(acc), F.lit(k + 1)).otherwise(expr)
            k += 1
            p = p / k
            acc += p
        w = df.withColumn("_w", expr.cast("double")).where("_w > 0")
        models.append(DecisionTreeClassifier(featuresCol="features", labelCol=label, weightCol="_w",
                                             maxDepth=max_depth, seed=seed + b).fit(w))
    return models


def bagging_predict(models, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    out = df
    for i, m in enumerate(models):
        out = m.setPredictionCol(f"_p{i}").setProbabilityCol(f"_q{i}").setRawPredictionCol(f"_r{i}").transform(out)
    votes = F.array(*[F.col(f"_p{i}") for i in range(len(models))])
    counts = F.aggregate(votes, F.create_map().cast("map<double,int>"),
                         lambda acc, v: F.map_concat(F.map_filter(acc, lambda k, _: k != v),
                                                     F.create_map(v, F.coalesce(F.element_at(acc, v), F.lit(0)) + 1)))
    best = F.array_sort(F.transform(F.map_entries(counts),
                                    lambda e: F.struct((-e["value"]).alias("neg_votes"), e["key"].alias("label"))))[0]
    return out.select(*keep, best.getField("label").alias("prediction"))


def mlp(df: DataFrame, label: str, hidden: Sequence[int] = (16,), max_iter: int = 100, seed: int = 0):
    """Multi-layer perceptron (sigmoid hidden layers, softmax output, L-BFGS)."""
    d = len(df.select("features").first()[0])
    k = df.select(label).distinct().count()
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=[d, *hidden, k],
                                          maxIter=max_iter, seed=seed).fit(df)


def self_training(df: DataFrame, label: str, key: str, threshold: float = 0.75, max_iter: int = 10,
                  criterion: str = "threshold", k_best: int = 10) -> tuple[DataFrame, str, int]:
    """Self-training with a logistic base model.  Label -1 = unlabeled.  Each
    round fits on the labeled rows, predicts the rest and adopts rows whose
    top probability exceeds ``threshold`` (or the ``k_best`` most
    confident); records the round a label was added and the stop reason (all_labeled, no_change, one_class or
    max_iter)."""
    cur = materialize(df.withColumn("_y", F.col(label).cast("double"))
                      .withColumn("labeled_iter", F.when(F.col(label) != -1, F.lit(0))))
    reason, it = "max_iter", 0
    for it in range(1, max_iter + 1):
        train = cur.where("_y != -1")
        if train.select("_y").distinct().limit(2).count() < 2:
            reason = "one_class"  # nothing to learn from
            break
        model = LogisticRegression(featuresCol="features", labelCol="_y", maxIter=100).fit(train)
        pred = model.transform(cur.where("_y = -1"))
        pred = pred.withColumn("_conf", F.array_max(vector_to_array("probability")))
        if criterion == "threshold":
            new = pred.where(F.col("_conf") > threshold)
        else:
            new = pred.orderBy(F.col("_conf").desc(), key).limit(k_best)
        new = new.select(key, F.col("prediction").alias("_new"))
        if new.limit(1).count() == 0:
            reason = "no_change"
            break
        cur = materialize(cur.join(new, key, "left").withColumns({
            "labeled_iter": F.when(F.col("_new").isNotNull(), F.lit(it)).otherwise(F.col("labeled_iter")),
            "_y": F.coalesce(F.col("_new"), F.col("_y"))}).drop("_new"))
        if cur.where("_y = -1").limit(1).count() == 0:
            reason = "all_labeled"
            break
    return cur.withColumnRenamed("_y", "transduction"), reason, it


def dct_rows(df: DataFrame, array_col: str, keep: Sequence[str] = (), inverse: bool = False) -> DataFrame:
    """Orthonormal 1-D type-II DCT of a vector column (Spark ML ``DCT``)."""
    v = df.select(*keep, array_to_vector(F.col(array_col).cast("array<double>")).alias("_v"))
    out = DCT(inverse=inverse, inputCol="_v", outputCol="_d").transform(v)
    return out.select(*keep, vector_to_array("_d").alias("dct"))

