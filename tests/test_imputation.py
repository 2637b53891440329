"""Round-robin imputation against the plain algorithm in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.ml import imputation as IM

RNG = np.random.default_rng(17)
N, D = 120, 4
BASE = RNG.normal(size=(N, 2)) @ RNG.normal(size=(2, D)) + 0.3 * RNG.normal(size=(N, D)) + np.arange(D) * 3
X = np.where(RNG.random((N, D)) < np.array([0.0, 0.1, 0.3, 0.2]), np.nan, BASE)
COLS = [f"x{i}" for i in range(D)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, *[None if np.isnan(v) and i % 2 else float(v) for v in x]) for i, x in enumerate(X)]  # nulls and NaN
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLS)).repartition(4)


def plain(x, rounds, order, low=-np.inf, high=np.inf, tol=0.0):
    gone = np.isnan(x)
    cur = np.where(gone, np.nanmean(x, 0), x)
    for r in range(1, rounds + 1):
        before = cur.copy()
        for j in order:
            others = [o for o in range(x.shape[1]) if o != j]
            have = ~gone[:, j]
            a, y = cur[np.ix_(have, others)], cur[have, j]
            c = a - a.mean(0)
            w = np.linalg.solve(c.T @ c + 1e-6 * np.eye(len(others)), c.T @ (y - y.mean()))
            cur[gone[:, j], j] = np.clip((cur[np.ix_(gone[:, j], others)] - a.mean(0)) @ w + y.mean(), np.broadcast_to(low, D)[j], np.broadcast_to(high, D)[j])
        if np.abs(cur - before).max() < tol * np.nanmax(np.abs(x)):
            break
    return cur, r


def values(df):
    return np.array([[r[c] for c in COLS] for r in df.orderBy("id").collect()], float)


FEWEST = [1, 3, 2]
FREE = {"min_value": None, "max_value": None}


@pytest.mark.parametrize("order,plan", [("ascending", FEWEST), ("descending", FEWEST[::-1]), ("roman", [1, 2, 3]), ("arabic", [3, 2, 1])])
def test_orders(frame, order, plan):
    out, rounds = IM.iterative_impute(frame, COLS, 3, 0.0, keep=["id"], order=order, **FREE)
    assert rounds == 3 and np.allclose(values(out), plain(X, 3, plan)[0], atol=1e-8)


def test_stops_when_nothing_moves(frame):
    out, rounds = IM.iterative_impute(frame, COLS, 50, 1e-3, keep=["id"], **FREE)
    want, n = plain(X, 50, FEWEST, tol=1e-3)
    assert rounds == n < 50 and np.allclose(values(out), want, atol=1e-8)


def test_bounds(frame):
    out, _ = IM.iterative_impute(frame, COLS, 3, 0.0, keep=["id"], min_value=2.0, max_value=8.0)
    want = plain(X, 3, FEWEST, 2.0, 8.0)[0]
    assert np.allclose(values(out), want, atol=1e-8) and not np.allclose(want, plain(X, 3, FEWEST)[0])
    own = IM.iterative_impute(frame, COLS, 3, 0.0, keep=["id"])[0]  # by default each column's own range
    assert np.allclose(values(own), plain(X, 3, FEWEST, np.nanmin(X, 0), np.nanmax(X, 0))[0], atol=1e-8)
    with pytest.raises(ValueError):
        IM.iterative_impute(frame, COLS, min_value=3, max_value=3)


def test_both_ways_agree(frame, monkeypatch):
    monkeypatch.setattr(IM, "MOST_NUMBERS", 0)
    assert np.allclose(values(IM.iterative_impute(frame, COLS, 3, 0.0, keep=["id"], **FREE)[0]), plain(X, 3, FEWEST)[0], atol=1e-8)


def test_nearest_features(frame):
    out, _ = IM.iterative_impute(frame, COLS, 2, 0.0, keep=["id"], n_nearest_features=2, seed=3, **FREE)
    got = values(out)
    assert not np.isnan(got).any() and np.allclose(got[~np.isnan(X)], X[~np.isnan(X)])
    again = values(IM.iterative_impute(frame, COLS, 2, 0.0, keep=["id"], n_nearest_features=2, seed=3, **FREE)[0])
    assert np.allclose(got, again) and not np.allclose(got, plain(X, 2, FEWEST)[0])
    picks = [tuple(IM.nearest(0, range(4), np.array([[1, 0.9, 0.1, 0.0]] * 4), 1, np.random.default_rng(s))) for s in range(200)]
    assert picks.count((1,)) > 150 and picks.count((2,)) > picks.count((3,))


def test_edge_cases(frame, spark):
    none = frame.withColumn("x1", F.lit(None).cast("double"))
    got = IM.iterative_impute(none, COLS, 2, keep=["id"])[0]
    assert got.where("x1 is not null").count() == 0 and got.where("x2 is null or x3 is null").count() == 0
    assert IM.iterative_impute(frame.limit(0), COLS, 2, keep=["id"])[0].count() == 0
    one, rounds = IM.iterative_impute(frame, ["x2"], 2, keep=["id"])
    assert rounds == 0 and np.allclose(sorted(r["x2"] for r in one.collect()), np.sort(np.where(np.isnan(X[:, 2]), np.nanmean(X[:, 2]), X[:, 2])))
