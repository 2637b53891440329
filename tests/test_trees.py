"""Histogram trees against a plain recursive grower in numpy, losses, bagging and its out-of-bag score."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.ml import trees as TR

RNG = np.random.default_rng(21)
N = 300
X = np.column_stack([RNG.normal(size=N).round(2), RNG.integers(0, 6, N).astype(float), RNG.normal(size=N), RNG.exponential(size=N)])
MEAN = np.exp(0.5 * X[:, 0] + 0.3 * (X[:, 1] > 2) - 0.2 * X[:, 2])
Y = RNG.poisson(MEAN).astype(float)
KIND = ((X[:, 0] > 0).astype(int) + (X[:, 3] > 1)).astype(float)
COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, *map(float, x), float(y), float(k)) for i, (x, y, k) in enumerate(zip(X, Y, KIND))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, kind double").repartition(4)


def grow(codes, g, h, w, depth, least, ridge, features):
    """{rows: value} of a tree's leaves: best gain first, ties to the lower feature and bin. ``g`` has a column for each output."""
    out = np.zeros((len(codes), g.shape[1]))

    def score(rows):
        return (g[rows].sum(0) ** 2).sum() / max(h[rows].sum() + ridge, 1e-12)

    def split(rows, level):
        out[rows] = -g[rows].sum(0) / max(h[rows].sum() + ridge, 1e-300)
        if level == depth:
            return
        best = (1e-10 * (1 + score(rows)), None)
        for f in features:
            for b in range(codes[rows, f].max(initial=0)):
                left = rows[codes[rows, f] <= b]
                right = rows[codes[rows, f] > b]
                if w[left].sum() >= least and w[right].sum() >= least:
                    gain = round(score(left) + score(right) - score(rows), 9)
                    if gain > best[0]:
                        best = (gain, (left, right))
        if best[1]:
            for part in best[1]:
                split(part, level + 1)

    split(np.flatnonzero(w > 0), 0)
    return out


def boosted(codes, y, loss, rounds, depth, rate, least):
    start = {"squared": y.mean(), "poisson": np.log(max(y.mean(), 1e-300)), "logistic": np.log(max(y.mean(), 1e-9) / max(1 - y.mean(), 1e-9))}[loss]
    raw, stages = np.full(len(y), start), []
    for _ in range(rounds):
        mean = {"squared": raw, "poisson": np.exp(raw), "logistic": 1 / (1 + np.exp(-raw))}[loss]
        h = {"squared": np.ones(len(y)), "poisson": mean, "logistic": mean * (1 - mean)}[loss]
        raw = raw + rate * grow(codes, (mean - y)[:, None], h, np.ones(len(y)), depth, least, 0.0, range(codes.shape[1]))[:, 0]
        stages.append({"squared": raw, "poisson": np.exp(raw), "logistic": 1 / (1 + np.exp(-raw))}[loss])
    return stages


def by_id(df, *cols):
    return np.array([[r[c] for c in cols] for r in df.orderBy("id").select(*cols).collect()], float)


def test_edges(frame):
    edges = TR.edges_of(frame, COLS, 16)
    assert all(len(e) <= 15 for e in edges) and edges[1].tolist() == [0, 1, 2, 3, 4]
    codes = TR.bin_codes(X, edges)
    assert (np.bincount(codes[:, 2]) > 5).all()
    assert TR.bin_codes(np.array([[np.nan] * 4]), edges).tolist() == [[0] * 4]


@pytest.mark.parametrize("loss", ["squared", "poisson"])
def test_regression_equals_numpy(frame, loss):
    model = TR.boost(frame, COLS, "y", loss, learning_rate=0.3, max_iter=4, max_depth=3, max_bins=12, least=5)
    got = by_id(model.staged(frame, [1, 2, 4], ["id"]), "stage_1", "stage_2", "stage_4")
    want = boosted(TR.bin_codes(X, model.edges), Y, loss, 4, 3, 0.3, 5)
    assert np.allclose(got, np.column_stack([want[0], want[1], want[3]]), rtol=1e-9)


def test_poisson_deviance_falls(frame, monkeypatch):
    monkeypatch.setattr(TR, "KEPT", 2)  # raw predictions are written and read again
    model = TR.boost(frame, COLS, "y", "poisson", learning_rate=0.3, max_iter=6, max_depth=2, max_bins=16, least=5)
    got = by_id(model.staged(frame, range(1, 7), ["id"]), *[f"stage_{m}" for m in range(1, 7)])
    assert (got > 0).all()
    term = np.where(Y[:, None] > 0, Y[:, None] * np.log(np.where(Y[:, None] > 0, Y[:, None], 1) / got), 0) - (Y[:, None] - got)
    deviance = 2 * term.sum(0)
    assert (np.diff(deviance) < 0).all()
    assert np.allclose(got[:, -1], boosted(TR.bin_codes(X, model.edges), Y, "poisson", 6, 2, 0.3, 5)[-1], rtol=1e-9)


def test_boosting_passes_over_cells(frame, monkeypatch):
    """With a gradient linear in the label, rows of the same bins are one row of the passes."""
    sizes, real = [], TR.materialize
    monkeypatch.setattr(TR, "materialize", lambda df, name: sizes.append((out := real(df, name)).count()) or out)
    model = TR.boost(frame, ["b"], "y", "poisson", learning_rate=0.3, max_iter=3, max_depth=2, max_bins=16, least=5)
    codes = TR.bin_codes(X[:, 1:2], model.edges)
    assert sizes == [len(np.unique(codes))]
    got = by_id(model.staged(frame, [3], ["id"]), "stage_3")[:, 0]
    assert np.allclose(got, boosted(codes, Y, "poisson", 3, 2, 0.3, 5)[-1], rtol=1e-9)


def test_absolute_loss(frame):
    model = TR.boost(frame, COLS, "y", "absolute", learning_rate=0.5, max_iter=5, max_depth=2, least=10)
    got = by_id(model.staged(frame, [1, 5], ["id"]), "stage_1", "stage_5")
    error = np.abs(got - Y[:, None]).mean(0)
    assert error[1] < error[0] < np.abs(Y - np.median(Y)).mean()


def test_classes(frame):
    two = TR.boost_classes(frame.withColumn("up", (F.col("kind") > 0).cast("int")), COLS, "up", learning_rate=0.3, max_iter=3, max_depth=2, max_bins=10, least=5)
    p = np.array([r["probability"][1] for r in two.classify(frame, ["id"]).orderBy("id").collect()])
    assert np.allclose(p, boosted(TR.bin_codes(X, two.edges), (KIND > 0).astype(float), "logistic", 3, 2, 0.3, 5)[-1], rtol=1e-9)
    three = TR.boost_classes(frame, COLS, "kind", learning_rate=0.5, max_iter=5, max_depth=2, least=5)
    out = three.classify(frame, ["id"]).orderBy("id").collect()
    assert (np.array([r["prediction"] for r in out]) == KIND).mean() > 0.97
    assert all(abs(sum(r["probability"]) - 1) < 1e-12 for r in out)


def test_bagging_equals_numpy(frame, spark):
    model = TR.bag(frame, COLS, "kind", "id", n_estimators=4, max_samples=0.7, max_features=3, max_depth=3, max_bins=10, least=2, seed=5)
    key = np.array([r[0] for r in frame.orderBy("id").select(F.xxhash64("id")).collect()])
    codes = TR.bin_codes(X, model.edges)
    own = (KIND[:, None] == np.array(model.labels)[None, :]).astype(float)
    for t in range(4):
        w = TR.bag_weights(key, t, 0.7, True, 5)
        assert 0.5 < w.mean() < 0.9 and w.max() > 1
        rng_features = [f for f in range(4) if f in set(model.trees.feature[t][model.trees.feature[t] >= 0])]
        assert len(rng_features) <= 3
    full = TR.bag(frame, COLS, "kind", "id", n_estimators=3, max_depth=3, max_bins=10, least=2, seed=6)
    codes = TR.bin_codes(X, full.edges)
    for t in range(3):
        w = TR.bag_weights(key, t, 1.0, True, 6)
        want = grow(codes, -own * w[:, None], w, w, 3, 2, 0.0, range(4))
        held = w > 0
        assert np.allclose(full.trees.predict(codes, t)[held], want[held], atol=1e-9)


def test_out_of_bag(frame):
    model = TR.bag(frame, COLS, "kind", "id", n_estimators=15, max_depth=4, least=2, seed=3)
    key = np.array([r[0] for r in frame.orderBy("id").select(F.xxhash64("id")).collect()])
    codes = TR.bin_codes(X, model.edges)
    votes = np.zeros((N, len(model.labels)))
    for t in range(15):
        out = TR.bag_weights(key, t, 1.0, True, 3) == 0
        votes[out, model.trees.predict(codes, t).argmax(1)[out]] += 1
    any_vote = votes.sum(1) > 0
    want = (np.array(model.labels)[votes.argmax(1)] == KIND)[any_vote].mean()
    assert model.oob_score(frame, "kind", "id") == pytest.approx(want)
    assert (by_id(model.predict(frame, ["id"]), "prediction")[:, 0] == KIND).mean() > 0.95
    pasted = TR.bag(frame, COLS, "kind", "id", n_estimators=3, max_samples=0.5, bootstrap=False, seed=3)
    assert 0.8 < pasted.oob_score(frame, "kind", "id") <= 1


def test_groups_of_trees_and_missing_values(frame, spark):
    """Trees grown in several passes are those of one pass; null labels are left out, null features go to the first bin."""
    odd = frame.withColumn("a", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("a"))).withColumn("kind", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("kind")))
    one = TR.bag(odd, COLS, "kind", "id", n_estimators=3, max_depth=2, max_bins=10, seed=1)
    before = TR.CELLS
    grown = TR.grow.__defaults__
    try:
        TR.grow.__defaults__ = (*grown[:-1], 1)
        again = TR.bag(odd, COLS, "kind", "id", n_estimators=3, max_depth=2, max_bins=10, seed=1)
    finally:
        TR.grow.__defaults__ = grown
    assert before == TR.CELLS and (one.trees.feature == again.trees.feature).all() and np.allclose(one.trees.value, again.trees.value)
    assert one.predict(odd, ["id"]).where("prediction is null").count() == 0
    with pytest.raises(ValueError):
        TR.boost(odd.limit(0), COLS, "y")
    with pytest.raises(ValueError):
        TR.boost(frame.withColumn("y", -F.col("y")), COLS, "y", "poisson")
