"""Linear classifiers by Newton steps whose sums for all models come from one pass.

A model is a pair of a strength C and a class against the rest. Every round is one pass over the rows: each task computes, for all
models that are still open, the loss, its gradient and its Hessian (matrix products of the batch), and Spark adds the sums; so the
number of passes does not depend on how many strengths and classes there are. The driver solves each model's small problem: the
Newton equations for the l2 penalty, and for l1 the quadratic with the penalty by coordinate descent (its steps leave
coefficients at zero exactly). Where a full step does not lower the objective enough, one more pass evaluates shorter steps of all
such models at once.

The objective is that of the usual C parameter: ``C * sum of weighted losses + penalty``, with ``|w|^2 / 2`` or ``|w|_1``. Losses:
logistic and squared hinge. The intercept is not penalised unless asked for.

Rows with a null label or a null feature take no part in fitting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.session import materialize

NUMBERS = 1 << 22  # sums of one pass; models beyond it are solved in further groups
STEPS = 2.0 ** -np.arange(1, 21)  # shorter steps that are tried


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def logistic_terms(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature in the margin y f."""
    p = sigmoid(-m)
    return np.logaddexp(0, -m), -p, p * (1 - p)


def squared_hinge_terms(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    short = np.maximum(1 - m, 0)
    return short * short, -2 * short, 2.0 * (short > 0)


TERMS = {"logistic": logistic_terms, "squared_hinge": squared_hinge_terms}


@dataclass
class LinearModels:
    """Coefficients for each strength and class: coef (strengths, classes, features), intercept (strengths, classes). Two labels
    have one model, of the second label."""

    cols: list[str]
    labels: list[float]
    strengths: list[float]
    coef: np.ndarray
    intercept: np.ndarray
    passes: int = 0
    gradients: np.ndarray = field(default_factory=lambda: np.zeros(0))  # what is left of each model's optimality condition

    def predict(self, df: DataFrame, keep: Sequence[str] = (), strength: int = 0, name: str = "prediction") -> DataFrame:
        """``keep`` and the label with the highest decision value (null where a feature is)."""
        coef, intercept, labels = self.coef[strength], self.intercept[strength], np.array(self.labels)

        def run(batches):
            for b in batches:
                x = columns_matrix(b, self.cols)
                f = x @ coef.T + intercept
                best = (f[:, 0] > 0).astype(int) if len(labels) == 2 else f.argmax(1)
                yield pa.record_batch([*[b.column(c) for c in keep], pa.array(labels[best], mask=np.isnan(x).any(1))], [*keep, name])

        schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(name, T.DoubleType())])
        return df.select(*dict.fromkeys([*keep, *self.cols])).mapInArrow(run, schema)


def columns_matrix(batch: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    out = np.empty((batch.num_rows, len(cols)))
    for f, c in enumerate(cols):
        out[:, f] = batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out


def rows_matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def added(rows: DataFrame, size: int, partial) -> np.ndarray:
    """The sum over all tasks of the vectors ``partial(x, y, w)``, added by Spark."""

    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += partial(rows_matrix(b), b.column("y").to_numpy(), b.column("w").to_numpy())
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["i", "s"])

    got = rows.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros(size)
    out[got.column("i").to_numpy()] = got.column("s").to_numpy()
    return out


def signs(y: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """1 where a row has the model's class, else -1."""
    return np.where(y[:, None] == classes[None, :], 1.0, -1.0)


def fit(df: DataFrame, cols: Sequence[str], label: str, strengths: Sequence[float] = (1.0,), loss: str = "logistic", penalty: str | None = "l2",
        fit_intercept: bool = True, penalise_intercept: bool = False, weight: str | None = None, class_weight=None, tol: float = 1e-8, max_iter: int = 100,
        start: LinearModels | None = None, most: int = 1000) -> LinearModels:
    """All strengths and classes of one loss and penalty. ``start`` gives the first coefficients (of as many strengths and
    classes, or of one strength for all): a warm start. ``class_weight`` is None, 'balanced' or a dict."""
    if loss not in TERMS or penalty not in ("l1", "l2", None):
        raise ValueError("loss is 'logistic' or 'squared_hinge', penalty 'l1', 'l2' or None")
    cols = list(cols)
    fine = F.col(label).isNotNull()
    for c in cols:
        fine = fine & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    x = F.array(*[F.col(c).cast("double") for c in cols], *([F.lit(1.0)] if fit_intercept else []))
    base = df.where(fine).select(x.alias("x"), F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    rows = materialize(base, "linear-rows")  # the input is computed once, for the counts and all passes
    counts = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    labels = sorted(r["y"] for r in counts)
    if not 2 <= len(labels) <= most:
        raise ValueError(f"{len(labels)} labels; 2 to {most} are possible")
    if class_weight is not None:
        n = {r["y"]: r["n"] for r in counts}
        given = {k: sum(n.values()) / (len(n) * v) for k, v in n.items()} if class_weight == "balanced" else class_weight
        factor = F.lit(1.0)
        for k, v in given.items():
            factor = F.when(F.col("y") == float(k), F.lit(float(v))).otherwise(factor)
        rows = rows.withColumn("w", F.col("w") * factor)
    against = labels[1:] if len(labels) == 2 else labels
    pairs = [(c, k) for c in strengths for k in against]
    d = len(cols) + fit_intercept
    w = np.zeros((len(pairs), d))
    if start is not None:
        own = np.concatenate([start.coef, start.intercept[..., None]], 2)[..., :d]
        w[:] = np.broadcast_to(own, (len(strengths), len(against), d)).reshape(len(pairs), d)
    penalised = np.ones(d)
    if fit_intercept and not penalise_intercept:
        penalised[-1] = 0
    at_once = max(1, NUMBERS // (d * d + d + 1))
    out = LinearModels(cols, labels, list(strengths), np.zeros(0), np.zeros(0))
    left = np.zeros(len(pairs))
    for begin in range(0, len(pairs), at_once):
        part = slice(begin, begin + at_once)
        w[part], left[part], n = solve(rows, w[part], np.array([c for c, _ in pairs[part]]), np.array([k for _, k in pairs[part]]), TERMS[loss], penalty, penalised, tol, max_iter)
        out.passes += n
    w = w.reshape(len(strengths), len(against), d)
    out.coef, out.intercept = w[..., :len(cols)], w[..., -1] if fit_intercept else np.zeros(w.shape[:2])
    out.gradients = left.reshape(len(strengths), len(against))
    return out


def solve(rows, w, c, classes, terms, penalty, penalised, tol, max_iter) -> tuple[np.ndarray, np.ndarray, int]:
    """Coefficients, optimality residuals and the number of passes of all models in ``w``."""
    m, d = w.shape
    passes, still, first = 0, np.ones(m, bool), None
    left = np.full(m, np.inf)
    w = w.copy()
    for _ in range(max_iter):
        open_ = np.flatnonzero(still)
        loss, grad, hess = derivatives(rows, w[open_], classes[open_], terms)
        passes += 1
        loss, grad, hess = loss * c[open_], grad * c[open_, None], hess * c[open_, None, None]
        now = np.array([objective_left(g, w[i], penalty, penalised) for g, i in zip(grad, open_)])
        left[open_] = now
        first = np.maximum(np.abs(grad).max(1), 1.0) if first is None else first
        still[open_[now <= tol * first[open_]]] = False
        rest = np.flatnonzero(now > tol * first[open_])
        if len(rest) == 0:
            break
        models = open_[rest]
        step = np.stack([direction(hess[r], grad[r], w[i], penalty, penalised) for r, i in zip(rest, models)])
        value = loss[rest] + np.array([cost(w[i], penalty, penalised) for i in models])
        slope = np.array([grad[r] @ s + cost(w[i] + s, penalty, penalised) - cost(w[i], penalty, penalised) for r, s, i in zip(rest, step, models)])
        # the full step and shorter ones, all in one pass
        sizes = np.append(1.0, STEPS)
        tried = losses(rows, w[models], step, sizes, classes[models], terms) * c[models, None]
        passes += 1
        for at, i in enumerate(models):
            total = tried[at] + np.array([cost(w[i] + t * step[at], penalty, penalised) for t in sizes])
            good = np.flatnonzero(total <= value[at] + 1e-4 * sizes * min(slope[at], 0.0) + 1e-14 * abs(value[at]))
            if len(good) == 0:
                still[i] = False  # no step helps any more: rounding is reached
            else:
                w[i] += sizes[good[0]] * step[at]
    return w, left, passes


def derivatives(rows, w, classes, terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian sums of all models, from one pass."""
    m, d = w.shape

    def partial(x, y, weight):
        s = signs(y, classes)
        loss, slope, curve = terms(s * (x @ w.T))
        slope, curve = slope * s * weight[:, None], curve * weight[:, None]
        return np.concatenate([weight @ loss, (slope.T @ x).ravel(), *[(x.T @ (x * curve[:, i:i + 1])).ravel() for i in range(m)]])

    out = added(rows, m + m * d + m * d * d, partial)
    return out[:m], out[m:m + m * d].reshape(m, d), out[m + m * d:].reshape(m, d, d)


def losses(rows, w, step, sizes, classes, terms) -> np.ndarray:
    """Loss sums of all models at w + size * step for every size, from one pass."""
    m = len(w)

    def partial(x, y, weight):
        s = signs(y, classes)
        at, move = s * (x @ w.T), s * (x @ step.T)
        return np.concatenate([weight @ terms(at + t * move)[0] for t in sizes])

    return added(rows, m * len(sizes), partial).reshape(len(sizes), m).T


def cost(w: np.ndarray, penalty: str | None, penalised: np.ndarray) -> float:
    if penalty == "l1":
        return float(np.abs(w * penalised).sum())
    return float(0.5 * (w * w * penalised).sum()) if penalty == "l2" else 0.0


def objective_left(grad: np.ndarray, w: np.ndarray, penalty: str | None, penalised: np.ndarray) -> float:
    """The largest violation of the optimality condition: the gradient, or for l1 the least subgradient."""
    if penalty == "l2":
        grad = grad + w * penalised
    elif penalty == "l1":
        grad = np.where(w != 0, grad + np.sign(w) * penalised, np.sign(grad) * np.maximum(np.abs(grad) - penalised, 0))
    return float(np.abs(grad).max())


def direction(hess: np.ndarray, grad: np.ndarray, w: np.ndarray, penalty: str | None, penalised: np.ndarray) -> np.ndarray:
    """The step to the minimum of the quadratic model plus the penalty."""
    d = len(w)
    damp = 1e-10 * (np.trace(hess) / d + 1)
    if penalty != "l1":
        p = penalised if penalty == "l2" else np.zeros(d)
        return -np.linalg.solve(hess + np.diag(p) + damp * np.eye(d), grad + w * p)
    h = hess + damp * np.eye(d)
    step, image, first = np.zeros(d), np.zeros(d), None
    for _ in range(1000):  # coordinate descent: soft thresholds of one coefficient at a time
        most = 0.0
        for j in range(d):
            want = w[j] + step[j] - (grad[j] + image[j]) / h[j, j]
            want = np.sign(want) * max(abs(want) - penalised[j] / h[j, j], 0.0)
            move = want - w[j] - step[j]
            if move:
                step[j] += move
                image += move * h[:, j]
                most = max(most, abs(move) * np.sqrt(h[j, j]))
        first = most if first is None else first
        if most <= max(1e-3 * first, 1e-12):  # a step need not be exact: the next round corrects it
            break
    return step
