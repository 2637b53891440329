"""Round trips and invariants of operators (not tied to SQL)."""

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import functions as F

from colonnade.ml import features as FT
from colonnade.ml import learners as L
from colonnade.ml import metrics as MT
from colonnade.operators import reshape as RS
from colonnade.sources.tables import Tables
from tests.conftest import SF_SMALL


def test_pivot_unpivot_round_trip(spark):
    df = spark.createDataFrame([(i, c, float(i * 10 + j)) for i in range(5) for j, c in enumerate("abc")],
                               "i long, c string, v double")
    wide = RS.pivot(df, ["i"], "c", "v", ["a", "b", "c"])
    back = RS.melt(wide, ["i"], ["a", "b", "c"], "c", "v")
    assert sorted(back.collect()) == sorted(df.collect())


def test_explode_collect_round_trip(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["a", "b", "c"]), (2, [], [])], "id long, x array<int>, y array<string>")
    ex = RS.explode(df, ["x", "y"], keep=["id"])
    assert ex.where("id = 2").count() == 1  # empty list gives one null row
    got = ex.where("id = 1").groupBy("id").agg(F.array_sort(F.collect_list("x")).alias("x")).first()["x"]
    assert got == [1, 2, 3]


def test_scale_inverse_round_trip(spark):
    li = Tables(spark, SF_SMALL).lineitem.select("l_quantity", "l_discount")
    st = FT.fit_std_scaler(li, ["l_quantity", "l_discount"])
    z = FT.std_scale(li, st)
    m = z.agg(F.avg("l_quantity"), F.stddev_pop("l_quantity")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1) < 1e-9
    back = FT.std_unscale(z, st).agg(F.max(F.abs(F.col("l_quantity")))).first()[0]
    assert abs(back - li.agg(F.max("l_quantity")).first()[0]) < 1e-9


def test_norm_ppf(spark):
    df = spark.createDataFrame([(p,) for p in (0.025, 0.5, 0.975)], "p double")
    got = [r[0] for r in df.select(MT.norm_ppf("p")).collect()]
    want = [NormalDist().inv_cdf(p) for p in (0.025, 0.5, 0.975)]
    assert np.allclose(got, want)


def test_probplot_normal_data_fits(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(rng.normal(3, 2, 400))], "id long, x double")
    _pts, fit = MT.probplot(df, "x", ["id"])
    r = fit.first()
    assert r["r"] > 0.99 and abs(r["slope"] - 2) < 0.3 and abs(r["intercept"] - 3) < 0.3


def test_kbins_kmeans_edges_sorted(spark):
    li = Tables(spark, SF_SMALL).lineitem
    e = FT.kmeans_edges(li, "l_extendedprice", 4)
    assert e == sorted(e) and len(e) == 5


def test_pca_variance_ratio(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3)) @ np.array([[3, 0, 0], [0, 1, 0], [0, 0, 0.1]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    m = L.pca(df, ["a", "b", "c"], n_components=2)
    assert m.explained_variance_ratio[0] > 0.85
    ref = np.linalg.eigh(np.cov(x.T))[0][::-1][:2]
    assert np.allclose(m.explained_variance, ref)


def test_ridge_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2))
    y = x @ np.array([2.0, -1.0]) + 0.5 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    m = L.ridge(df, ["a", "b"], "y", alpha=1.0)
    xc = x - x.mean(0)
    w = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ (y - y.mean()))
    assert np.allclose(m.coef, w)
    r2 = L.ridge_2f(df, "a", "b", "y", 1.0).first()
    assert math.isclose(r2["w1"], w[0], rel_tol=1e-9) and math.isclose(r2["w2"], w[1], rel_tol=1e-9)


def test_auc_ties_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert MT.roc_auc(df, "y", "s") == (1 + 0.5 + 1 + 1) / 4


def _kendall_brute(x, y):
    n = len(x)
    s = n1 = n2 = 0
    for i in range(n):
        for j in range(i + 1, n):
            dx, dy = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
            s += dx * dy
            n1 += dx == 0
            n2 += dy == 0
    n0 = n * (n - 1) / 2
    return s / math.sqrt((n0 - n1) * (n0 - n2))


def test_kendall_matches_brute_force(spark):
    from colonnade.operators.aggregates import kendall_tau_b
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, 120)
    y = (x + rng.integers(0, 4, 120)) % 7
    df = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x long, y long")
    got, n = kendall_tau_b(df, "x", "y", "id")
    assert n == 120
    assert math.isclose(got, _kendall_brute(x, y), rel_tol=1e-12)
