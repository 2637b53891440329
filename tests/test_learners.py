"""Learners against numpy on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from colonnade.ml import imputation as IM
from colonnade.ml import learners as L
from colonnade.ml import neighbors as NB
from colonnade.ml import spectral as SP
from colonnade.ml.linalg import gram

N, D = 240, 6
COLS = [f"x{i}" for i in range(D)]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    factors = rng.normal(size=(N, 2))
    x = factors @ rng.normal(size=(2, D)) + 0.5 * rng.normal(size=(N, D)) + np.arange(D)
    y = 3 * x[:, 1] - 2 * x[:, 4] + 0.5
    label = (x[:, 0] + 0.3 * rng.normal(size=N) > x[:, 0].mean()).astype(float)
    return x, y, label


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y, label = data
    rows = [(i, *map(float, r), float(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, label))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLS) + ", y double, label double").repartition(4).cache()


@pytest.fixture(scope="module")
def vectors(frame):
    return L.assemble(frame, COLS).cache()


def by_id(df, *cols):
    return np.array([[r[c] for c in cols] for r in df.orderBy("id").select(*cols).collect()], float)


def gaussian(x, mean, cov):
    z = x - mean
    return -0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) + x.shape[1] * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1])


def test_omp_recovers_the_active_set(frame):
    m = L.omp_from_gram(gram(frame, COLS, "y"), n_nonzero=2)
    assert np.allclose(m.coef, [0, 3, 0, 0, -2, 0], atol=1e-8) and m.intercept == pytest.approx(0.5)


def test_sequential_selection(frame):
    assert L.sequential_feature_selection(frame, COLS, "y", "id", n_features_to_select=2, cv=3) == ["x1", "x4"]
    assert L.sequential_feature_selection(frame, COLS, "y", "id", n_features_to_select=2, cv=3, direction="backward") == ["x1", "x4"]


def test_pca_scores(frame, data):
    x = data[0]
    m = L.pca(frame, COLS, n_components=2)
    vals = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    noise = vals[2:].mean()
    cov = m.components.T @ np.diag(vals[:2] - noise) @ m.components + noise * np.eye(D)
    assert np.allclose(by_id(m.score_samples(frame, keep=["id"]), "loglik")[:, 0], gaussian(x, x.mean(0), cov))


def test_factor_analysis_likelihood(frame, data):
    x = data[0]
    m = L.factor_analysis(frame, COLS, 2, tol=1e-6, max_iter=3000)
    cov = m.components.T @ m.components + np.diag(m.noise_variance)
    assert all(b >= a - 1e-6 for a, b in zip(m.loglike, m.loglike[1:]))
    assert m.loglike[-1] == pytest.approx(gaussian(x, x.mean(0), cov).sum(), abs=0.01)
    better = L.factor_analysis(frame, COLS, 3, tol=1e-6, max_iter=3000)
    assert better.loglike[-1] >= m.loglike[-1] - 1e-3  # comparable across the number of factors
    s = m.components / m.noise_variance @ m.components.T
    assert np.allclose(s - np.diag(np.diag(s)), 0, atol=1e-6 * np.abs(s).max())
    z = by_id(m.transform(frame, keep=["id"]), "f0", "f1")
    want = (x - x.mean(0)) @ np.linalg.inv(cov) @ m.components.T
    assert np.allclose(z, want, atol=1e-8)


def test_fast_ica_separates_sources(spark):
    rng = np.random.default_rng(5)
    s = np.c_[rng.uniform(-1, 1, 1500), rng.laplace(size=1500)]
    x = s @ np.array([[1.0, 0.6], [0.4, 1.2]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    out = by_id(L.fast_ica(df, ["a", "b"], fun="cube", max_iter=100).transform(df, keep=["id"]), "s0", "s1")
    c = np.abs(np.corrcoef(out.T, s.T)[:2, 2:])
    assert (c.max(axis=1) > 0.97).all() and set(c.argmax(axis=1)) == {0, 1}


def test_dictionary_learning_lowers_cost(frame, data):
    dic, costs = L.dict_learning(frame, COLS, 3, alpha=0.1, max_iter=15)
    assert dic.shape == (3, D) and np.allclose(np.linalg.norm(dic, axis=1), 1)
    x = data[0]
    code = x @ dic.T
    code = np.sign(code) * np.maximum(np.abs(code) - 0.1, 0)
    got = by_id(L.sparse_encode_threshold(frame, COLS, dic, 0.1, keep=["id"]), "code0", "code1", "code2")
    assert np.allclose(got, code)


def test_omp_codes(frame, data):
    x = data[0]
    dic = np.linalg.qr(np.random.default_rng(0).normal(size=(D, D)))[0][:4]
    got = by_id(L.sparse_encode_omp(frame, COLS, dic, 2, keep=["id"]), *[f"code{j}" for j in range(4)])
    c = x @ dic.T  # orthonormal atoms: the two largest products are the codes
    want = np.where(np.abs(c) >= np.sort(np.abs(c), axis=1)[:, -2:-1], c, 0)
    assert np.allclose(got, want)


def test_iterative_imputer(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=200), rng.normal(size=200)
    c = 2 * a - b + 1
    rows = [(i, float(a[i]), float(b[i]), None if i % 5 == 0 else float(c[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    out, rounds = IM.iterative_impute(df, ["a", "b", "c"], keep=["id"])
    seen = np.array([r[3] for r in rows if r[3] is not None])
    want = np.where(np.arange(200) % 5 == 0, np.clip(c, seen.min(), seen.max()), c)
    assert rounds <= 10 and np.allclose(by_id(out, "c")[:, 0], want, atol=1e-4)


def test_learning_curve(frame):
    rows = L.learning_curve(frame, COLS, "y", "id", train_sizes=(0.5, 1.0), cv=3).collect()
    assert len(rows) == 6 and {r["fold"] for r in rows} == {0, 1, 2}
    for k in range(3):
        half, whole = sorted(r["n_train"] for r in rows if r["fold"] == k)
        assert half == whole // 2 and 120 < whole < 200
    assert all(r["test_score"] > 0.999 for r in rows)


def test_ridge_classifier_cv(frame):
    res = L.ridge_classifier_cv(frame, COLS, "label", [0.1, 1000.0], "id", cv=3)
    assert res["scores"][res["alpha"]] == max(res["scores"].values()) > 0.85


@pytest.mark.parametrize("positive", [False, True])
def test_lasso_codes(frame, data, positive):
    """The subgradient of every row's objective vanishes at its codes."""
    x, alpha = data[0], 0.8
    dic = np.random.default_rng(4).normal(size=(5, D))
    dic /= np.linalg.norm(dic, axis=1, keepdims=True)
    a = by_id(L.sparse_encode_lasso(frame, COLS, dic, alpha, ["id"], positive), *[f"code{j}" for j in range(5)])
    slope = (a @ dic - x) @ dic.T
    assert np.abs(slope[a != 0] + alpha * np.sign(a[a != 0])).max() < 1e-6 and (a == 0).any()
    assert (slope[a == 0] >= -alpha - 1e-6).all() and (positive or (slope[a == 0] <= alpha + 1e-6).all())
    assert not positive or (a >= 0).all()


def test_dictionary_by_lasso(frame):
    dic, costs = L.dict_learning(frame, COLS, 3, alpha=0.3, max_iter=8, method="lasso")
    assert all(b <= a * (1 + 1e-9) for a, b in zip(costs, costs[1:])) and costs[-1] < 0.9 * costs[0]
    assert (np.linalg.norm(dic, axis=1) <= 1 + 1e-12).all()


@pytest.mark.parametrize("class_weight", [None, "balanced"])
def test_ridge_leave_one_out(spark, data, class_weight):
    """The closed form equals refitting without each of 50 rows."""
    x, label = data[0][:50], np.digitize(data[0][:50, 0], [data[0][:, 0].mean() - 1, data[0][:, 0].mean() + 1]).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, label))], "id long, " + ", ".join(f"{c} double" for c in COLS) + ", kind double")
    classes, n = np.unique(label, return_counts=True)
    w = np.ones(50) if class_weight is None else (50 / (len(classes) * n))[np.searchsorted(classes, label)]
    t = np.where(label[:, None] == classes[None, :], 1.0, -1.0)

    def fit(rows, a):
        z = np.c_[np.ones(len(rows)), x[rows]]
        return np.linalg.solve(z.T @ (z * w[rows, None]) + a * np.diag([0.0] + [1.0] * D), z.T @ (t[rows] * w[rows, None]))

    alphas = [0.01, 1.0, 30.0]
    m = L.ridge_classifier_loo(df, COLS, "kind", alphas, class_weight)
    every = np.arange(50)
    for a in alphas:
        left = np.array([t[i] - np.r_[1, x[i]] @ fit(np.delete(every, i), a) for i in range(50)])
        assert m.scores[a] == pytest.approx(-(w[:, None] * left ** 2).sum() / (w.sum() * len(classes)), rel=1e-9)
    assert m.alpha == max(alphas, key=lambda a: m.scores[a])
    best = fit(every, m.alpha)
    assert np.allclose(m.coef, best[1:], atol=1e-9) and np.allclose(m.intercept, best[0], atol=1e-9)
    assert (by_id(m.predict(df, ["id"]), "prediction")[:, 0] == classes[(np.c_[np.ones(50), x] @ best).argmax(1)]).all()


def test_learning_curve_cells(frame, data):
    """Every cell equals a fit on the prefix itself."""
    out = {(r["fold"], r["n_train"]): (r["train_score"], r["test_score"]) for r in L.learning_curve(
        frame, COLS[:3], "y", "id", train_sizes=(0.3, 0.05, 1.0), cv=3, alpha=0.5, fold=F.col("id") % 3, order=[(F.col("id") * 37) % 240, F.col("id")]).collect()}
    x, y = data[0][:, :3], data[1]
    turn = sorted(range(N), key=lambda i: ((i * 37) % 240, i))
    assert len(out) == 9
    for k in range(3):
        train, test = [i for i in turn if i % 3 != k], [i for i in turn if i % 3 == k]
        for share in (0.3, 0.05, 1.0):
            own = train[:int(share * len(train))]
            c = x[own] - x[own].mean(0)
            w = np.linalg.solve(c.T @ c + 0.5 * np.eye(3), c.T @ (y[own] - y[own].mean()))
            for rows, score in zip((own, test), out[k, len(own)]):
                z = (x[rows] - x[own].mean(0)) @ w + y[own].mean()
                assert score == pytest.approx(1 - ((y[rows] - z) ** 2).sum() / ((y[rows] - y[rows].mean()) ** 2).sum(), rel=1e-6)


def test_logistic_matches_its_objective(vectors, data):
    x, _, label = data
    p = by_id(L.logistic(vectors, "label", C=1.0, tol=1e-9).transform(vectors).select("id", vector_to_array("probability")[1].alias("p")), "p")[:, 0]
    z = np.c_[x, np.ones(N)]
    grad = z.T @ (p - label)  # minus w / C for the weights, 0 for the intercept
    logit = np.log(p / (1 - p))
    w = np.linalg.lstsq(z, logit, rcond=None)[0]
    assert np.allclose(grad[:-1], -w[:-1], atol=0.02) and abs(grad[-1]) < 0.02


def test_logistic_path_grows(vectors):
    norm = [(r["C"], np.linalg.norm(r["coef"])) for r in L.logistic_path(vectors, "label", [0.01, 1.0, 100.0]).collect()]
    assert [n for _, n in sorted(norm)] == sorted(n for _, n in norm)


@pytest.mark.parametrize("fit", ["svc", "gbt", "bagging", "mlp"])
def test_classifiers_beat_the_majority(vectors, data, fit):
    if fit == "svc":
        out = L.linear_svc(vectors, "label").transform(vectors)
    elif fit == "gbt":
        out = L.gbt_classifier(vectors, "label", n_estimators=10).transform(vectors)
    elif fit == "mlp":
        out = L.mlp(vectors, "label", hidden=(4,)).transform(vectors)
    else:
        out = L.bagging_predict(L.bagging(vectors, "label", "id", n_estimators=5, max_depth=3), vectors, ["id"])
    assert (by_id(out, "prediction")[:, 0] == data[2]).mean() > 0.85


def test_gbt_regressor_stages(vectors, data):
    m = L.gbt_regressor(vectors, "y", max_iter=20, max_depth=4, learning_rate=0.3)
    out = by_id(L.staged_predict(m, vectors, [1, 5, 20], keep=["id"]), "stage_1", "stage_5", "stage_20")
    err = ((out - data[1][:, None]) ** 2).mean(0)
    assert err[0] > err[1] > err[2] and err[2] < 0.1 * data[1].var()


def test_gbt_is_fitted_on_cells(spark, monkeypatch):
    """Rows of the same bins go into the rounds once, with the trees of Spark's fit on all rows."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 6, 900), rng.integers(0, 5, 900), rng.integers(0, 2, 900)]).astype(float)
    y = x[:, 0] ** 2 - 3 * x[:, 1] * x[:, 2] + rng.normal(size=900)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = L.assemble(spark.createDataFrame(rows, "id long, a double, b double, c double, y double"), ["a", "b", "c"]).cache()
    sizes, real = [], L.materialize
    monkeypatch.setattr(L, "materialize", lambda d, *a: sizes.append((out := real(d, *a)).count()) or out)
    model = L.gbt_regressor(df, "y", max_iter=6, max_depth=3)
    assert sizes == [len(np.unique(x, axis=0))]
    plain = L.GBTRegressor(featuresCol="features", labelCol="y", stepSize=0.1, maxIter=6, maxBins=255, maxDepth=3, seed=0).fit(df)
    want = by_id(L.staged_predict(plain, df, [2, 6], keep=["id"]), "stage_2", "stage_6")
    assert np.allclose(by_id(L.staged_predict(model, df, [2, 6], keep=["id"]), "stage_2", "stage_6"), want, rtol=1e-9)
    assert np.allclose(by_id(model.transform(df), "prediction")[:, 0], want[:, 1], rtol=1e-9)
    monkeypatch.setattr(L, "TABLE", 1)
    assert np.allclose(by_id(model.staged(df, [2, 6], ["id"]), "stage_2", "stage_6"), want, rtol=1e-9)
    few = L.gbt_regressor(df, "y", max_iter=3, max_depth=2, max_bins=4)  # more values than bins
    assert all(len(e) <= 3 for e in few.edges)
    with pytest.raises(Exception, match="Null or NaN"):
        L.gbt_regressor(df.withColumn("y", F.when(F.col("id") > 0, F.col("y"))), "y")


def test_self_training_labels_the_rest(vectors, data):
    partly = vectors.withColumn("part", F.when(F.col("id") % 4 == 0, F.col("label").cast("int")).otherwise(F.lit(-1)))
    out, reason, rounds = L.self_training(partly, "part", "id", threshold=0.6)
    got = by_id(out, "transduction")[:, 0]
    assert reason in ("all_labeled", "no_change") and rounds >= 1
    assert (got[got >= 0] == data[2][got >= 0]).mean() > 0.85
    one = vectors.withColumn("part", F.when(F.col("id") == 0, F.lit(1)).otherwise(F.lit(-1)))
    assert L.self_training(one, "part", "id")[1] == "one_class"


def test_spectral_splits_two_blobs(spark):
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(size=(40, 3)), rng.normal(size=(40, 3)) + 30]
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "id long, v array<double>")
    out = {r["id"]: r["cluster"] for r in SP.spectral(NB.Space(df, "id", "v"), 2, n_neighbors=5).collect()}
    assert len(out) == 80
    share = [np.mean([out[i] == out[0] for i in part]) for part in (range(40), range(40, 80))]
    assert share[0] > 0.9 and share[1] < 0.1  # nothing links the blobs
