"""Linear classifiers: optimality conditions, agreement with plain Newton in numpy, and the number of passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.ml import linear as LN

RNG = np.random.default_rng(8)
N, D = 400, 6
X = RNG.normal(size=(N, D)) * np.array([1, 2, 0.5, 1, 3, 1]) + np.array([0, 1, 0, -1, 0, 2])
W = np.array([1.0, -0.5, 0.0, 0.0, 0.3, 0.0])
TWO = ((X @ W + RNG.normal(size=N)) > 0).astype(float) + 1
THREE = np.digitize(X @ W + 0.5 * RNG.normal(size=N), [-1, 1]).astype(float)
COLS = [f"x{i}" for i in range(D)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, *map(float, x), float(a), float(b)) for i, (x, a, b) in enumerate(zip(X, TWO, THREE))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLS) + ", two double, three double").repartition(4)


def gradient(coef, intercept, y, loss, c, weight=None):
    f = X @ coef + intercept
    s = np.where(y, 1.0, -1.0)
    m = s * f
    slope = (-1 / (1 + np.exp(m)) if loss == "logistic" else -2 * np.maximum(1 - m, 0)) * s * (1 if weight is None else weight)
    return c * slope @ X, c * slope.sum()


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_l2_gradient_vanishes(frame, loss):
    strengths = [0.01, 1.0, 100.0]
    m = LN.fit(frame, COLS, "two", strengths, loss)
    for i, c in enumerate(strengths):
        g, g0 = gradient(m.coef[i, 0], m.intercept[i, 0], TWO == 2, loss, c)
        assert np.abs(g + m.coef[i, 0]).max() < 1e-5 * max(1, c) and abs(g0) < 1e-5 * max(1, c)


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_l1_subgradient(frame, loss):
    strengths = [0.02, 0.5]
    m = LN.fit(frame, COLS, "two", strengths, loss, "l1")
    zeros = 0
    for i, c in enumerate(strengths):
        w = m.coef[i, 0]
        g, g0 = gradient(w, m.intercept[i, 0], TWO == 2, loss, c)
        assert abs(g0) < 1e-5
        for gj, wj in zip(g, w):
            assert abs(gj + np.sign(wj)) < 1e-5 if wj else abs(gj) <= 1 + 1e-5
        zeros += (w == 0).sum()
    assert zeros >= 2


def test_classes_against_the_rest(frame):
    m = LN.fit(frame, COLS, "three", [0.1, 1.0], "squared_hinge")
    assert m.coef.shape == (2, 3, D)
    for i, c in enumerate(m.strengths):
        for k, label in enumerate(m.labels):
            g, g0 = gradient(m.coef[i, k], m.intercept[i, k], THREE == label, "squared_hinge", c)
            assert np.abs(g + m.coef[i, k]).max() < 1e-5 and abs(g0) < 1e-5
    got = np.array([r["prediction"] for r in m.predict(frame, ["id"], 1).orderBy("id").collect()])
    assert (got == np.array(m.labels)[(X @ m.coef[1].T + m.intercept[1]).argmax(1)]).all() and (got == THREE).mean() > 0.7


def test_passes_do_not_grow_with_the_strengths(frame):
    one = LN.fit(frame, COLS, "two", [1.0])
    many = LN.fit(frame, COLS, "two", np.logspace(-3, 0, 12).tolist())
    assert many.passes <= one.passes + 4
    warm = LN.fit(frame, COLS, "two", [1.0], start=one)
    assert warm.passes < one.passes / 2 and np.allclose(warm.coef, one.coef, atol=1e-8)


def test_weights_and_intercept(frame):
    m = LN.fit(frame, COLS, "two", [0.7], class_weight="balanced")
    share = np.where(TWO == 2, N / (2 * (TWO == 2).sum()), N / (2 * (TWO == 1).sum()))
    g, g0 = gradient(m.coef[0, 0], m.intercept[0, 0], TWO == 2, "logistic", 0.7, share)
    assert np.abs(g + m.coef[0, 0]).max() < 1e-5 and abs(g0) < 1e-5
    none = LN.fit(frame, COLS, "two", [0.7], fit_intercept=False)
    assert (none.intercept == 0).all() and np.abs(gradient(none.coef[0, 0], 0, TWO == 2, "logistic", 0.7)[0] + none.coef[0, 0]).max() < 1e-5
    own = LN.fit(frame, COLS, "two", [0.7], penalise_intercept=True)
    assert abs(gradient(own.coef[0, 0], own.intercept[0, 0], TWO == 2, "logistic", 0.7)[1] + own.intercept[0, 0]) < 1e-5


def test_groups_nulls_and_one_label(frame, monkeypatch):
    odd = frame.withColumn("x0", F.when(F.col("id") % 9 == 0, None).otherwise(F.col("x0"))).withColumn("two", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("two")))
    m = LN.fit(odd, COLS, "two", [0.1, 1.0])
    kept = (np.arange(N) % 9 != 0) & (np.arange(N) % 11 != 0)
    s = np.where(TWO == 2, 1.0, -1.0)
    slope = -s / (1 + np.exp(s * (X @ m.coef[1, 0] + m.intercept[1, 0])))
    assert np.abs((slope * kept) @ X + m.coef[1, 0]).max() < 1e-5
    assert m.predict(odd, ["id"]).where("prediction is null").count() == sum(i % 9 == 0 for i in range(N))
    monkeypatch.setattr(LN, "NUMBERS", 1)  # one model a group
    again = LN.fit(odd, COLS, "two", [0.1, 1.0])
    assert np.allclose(m.coef, again.coef, atol=1e-7)
    with pytest.raises(ValueError):
        LN.fit(frame.where("two = 1"), COLS, "two")
