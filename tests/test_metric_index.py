"""The metric index against all pairs: neighbor queries, how many candidates they look at, clusters, eigenvectors of affinities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.ml import neighbors as NB
from colonnade.ml import spectral as SP

RNG = np.random.default_rng(12)
CENTRES = RNG.normal(size=(8, 5)) * 10
#: groups with a hot one, repeated points, and points between the groups
POINTS = np.concatenate([CENTRES[RNG.integers(0, 8, 500)] + RNG.normal(size=(500, 5)) * 0.3, np.repeat(CENTRES[:1], 150, 0),
                         CENTRES[:4].repeat(5, 0) * 0.5, RNG.normal(size=(30, 5)) * 10])
N = len(POINTS)


def distances(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))


D = distances(POINTS)


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, list(map(float, p))) for i, p in enumerate(POINTS)] + [(N, None)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(4)


@pytest.fixture(scope="module", params=[{}, {"balls": 9, "block": 40, "group": 25}, {"balls": 1}])
def space(frame, request):
    return NB.Space(frame, "id", "v", **request.param)


def test_knn_with_ties(space):
    got = {}
    for r in space.knn(6).collect():
        got.setdefault(r["i"], {})[r["rank"]] = (r["dist"], r["j"])
    for i in range(N):
        want = sorted(zip(D[i], range(N)))[:6]
        mine = [got[i][k] for k in range(1, 7)]
        assert [j for _, j in mine] == [j for _, j in want] and np.allclose([d for d, _ in mine], [d for d, _ in want], atol=1e-12)


def test_knn_of_few_points(spark):
    few = NB.Space(spark.createDataFrame([(i, [float(i)]) for i in range(3)], "id long, v array<double>"), "id", "v", balls=3)
    assert sorted((r["i"], r["j"], r["rank"]) for r in few.knn(5).collect()) == [(0, 0, 1), (0, 1, 2), (0, 2, 3), (1, 0, 2), (1, 1, 1), (1, 2, 3), (2, 0, 3), (2, 1, 2), (2, 2, 1)]
    none = NB.Space(spark.createDataFrame([], "id long, v array<double>"), "id", "v")
    assert none.knn(5).count() == 0 and NB.single_link(none, 1.0).count() == 0


def test_text_ids(spark):
    rows = [(f"p{i:02d}", [float(i % 7), float(i // 7)]) for i in range(40)]
    got = {(r["i"], r["j"]) for r in NB.Space(spark.createDataFrame(rows, "id string, v array<double>"), "id", "v", balls=4).within(
        spark.createDataFrame(rows, "_id string, _v array<double>"), 1.0).collect()}
    assert got == {(a, b) for a, x in rows for b, y in rows if np.hypot(x[0] - y[0], x[1] - y[1]) <= 1}


@pytest.mark.parametrize("strict", [False, True])
def test_within(space, strict):
    r = float(D[3, 20])
    got = sorted((x["i"], x["j"]) for x in space.within(space.points, r, strict).select("i", "j").collect())
    i, j = np.nonzero(D < r if strict else D <= r)
    assert got == sorted(zip(i.tolist(), j.tolist()))


def test_few_candidates(frame, monkeypatch):
    """Of points in separate groups, queries meet their own group's blocks, not all points."""
    space = NB.Space(frame, "id", "v", balls=9)
    asks = space.points.select(F.col("_id").alias("i"), F.col("_v").alias("vi"), F.lit(2.0).alias("reach"))
    sent = space.addressed(asks, space.sizes, space.radius)
    met = sent.groupBy("ball").count().collect()
    pairs = sum(r["count"] * int(space.sizes[r["ball"]]) for r in met)
    assert int((D <= 2.0).sum()) <= pairs <= 0.4 * N * N


def components(near):
    label = np.arange(len(near))
    while True:
        new = np.array([label[near[i]].min() if near[i].any() else label[i] for i in range(len(near))])
        if (new == label).all():
            return label
        label = new


def test_single_link(space):
    got = {r["id"]: r["cluster"] for r in NB.single_link(space, 1.2).collect()}
    assert [got[i] for i in range(N)] == components(D < 1.2).tolist()


@pytest.mark.parametrize("eps,least", [(0.7, 8), (3.0, 4)])
def test_density(space, eps, least):
    got = {r["id"]: r["cluster"] for r in NB.density_clusters(space, eps, least).collect()}
    near = D <= eps
    core = near.sum(1) >= least
    own = components(near & core[None, :] & core[:, None])
    want = [own[i] if core[i] else min((own[j] for j in np.flatnonzero(near[i] & core)), default=-1) for i in range(N)]
    assert [got[i] for i in range(N)] == want


def test_core_distance(space):
    got = {r["id"]: r["core_distance"] for r in NB.core_distance(space, 5).collect()}
    assert np.allclose([got[i] for i in range(N)], np.sort(D, 1)[:, 4], atol=1e-12)
    got = {r["id"]: r["core_distance"] for r in NB.core_distance(space, 5, max_eps=1.0).collect()}
    want = np.sort(D, 1)[:, 4]
    assert np.allclose([got[i] for i in range(N)], np.where(want <= 1.0, want, np.inf), atol=1e-12)


def angle(a, b):
    """Sine of the largest angle between the spans of two sets of columns."""
    a, b = np.linalg.qr(a)[0], np.linalg.qr(b)[0]
    return np.linalg.norm(a - b @ (b.T @ a), 2)


BLOBS = np.concatenate([RNG.normal(size=(30, 3)) + c for c in ([0, 0, 0], [5, 0, 0], [0, 6, 1], [4, 4, 4])])


@pytest.mark.parametrize("affinity", ["knn", "rbf"])
def test_eigenvectors(spark, affinity):
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(BLOBS)], "id long, v array<double>")
    space = NB.Space(df, "id", "v", balls=3, block=50, group=40)
    d = distances(BLOBS)
    if affinity == "knn":
        a = np.zeros_like(d)
        for i in range(len(d)):
            a[i, [j for _, j in sorted(zip(d[i], range(len(d))))[:9]]] = 1
        a = (a + a.T) / 2
        of = SP.GraphAffinity(NB.knn_graph(space, 9), df)
    else:
        a = np.exp(-0.3 * d * d)
        of = SP.RbfAffinity(space, 0.3)
    scale = 1 / np.sqrt(a.sum(1))
    values, vectors = np.linalg.eigh(scale[:, None] * a * scale[None, :])
    out, found, residual = SP.leading(of, 4, tol=1e-9)
    got = np.array([r["v"] for r in out.orderBy("id").collect()])
    assert np.allclose(found, values[::-1][:4], atol=1e-9) and residual.max() <= 1e-9
    assert angle(got, vectors[:, ::-1][:, :4]) < 1e-6


def test_rbf_graph(spark):
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(BLOBS[:40])], "id long, v array<double>")
    got = {(r["src"], r["dst"]): r["weight"] for r in SP.rbf_graph(NB.Space(df, "id", "v"), 0.3).collect()}
    want = np.exp(-0.3 * distances(BLOBS[:40]) ** 2)
    assert len(got) == 1600 and all(abs(got[i, j] - want[i, j]) < 1e-12 for i in range(40) for j in range(40))


@pytest.mark.parametrize("affinity", ["nearest_neighbors", "rbf"])
def test_spectral_clusters(spark, affinity):
    apart = np.concatenate([RNG.normal(size=(25, 3)) + c for c in ([0, 0, 0], [20, 0, 0], [0, 20, 0])])
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(apart)], "id long, v array<double>")
    got = {r["id"]: r["cluster"] for r in SP.spectral(NB.Space(df, "id", "v"), 3, affinity, n_neighbors=6, gamma=0.2).collect()}
    groups = [{got[i] for i in range(k * 25, k * 25 + 25)} for k in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3


def test_queries_travel_in_units(spark):
    """Points without structure need all balls; a query is sent once a unit, not once a ball, in batches of bounded size."""
    x = np.random.default_rng(5).normal(size=(600, 16))
    df = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(x)], "id long, v array<double>").coalesce(1)
    space = NB.Space(df, "id", "v", balls=40, block=200)
    units = {u for _, u, _ in space.units}
    asks, used = space.sent(space.asks(float("inf")), space.sizes, space.radius)
    assert len(units) <= 6 and asks.count() == 600 * len(units) and used.count() == len(units) ** 2
    sizes = asks.mapInArrow(lambda batches: (NB.pa.record_batch([NB.pa.array([b.num_rows])], ["n"]) for b in batches), "n long").collect()
    assert max(r["n"] for r in sizes) <= NB.SENT_ROWS
    got = {(r["i"], r["rank"]): r["j"] for r in space.knn(3).collect()}
    d = distances(x)
    assert all([got[i, k] for k in (1, 2, 3)] == np.lexsort((np.arange(600), d[i]))[:3].tolist() for i in range(600))
