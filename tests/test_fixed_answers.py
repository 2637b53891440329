"""Cases that earlier gave wrong answers: null keys, 64-bit values, cross joins, composite keys, text labels, far points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.functions.columns import int_floor_div, int_floor_mod
from colonnade.ml import features as FT
from colonnade.ml import metrics as MT
from colonnade.ml import neighbors as NB
from colonnade.operators import aggregates as A
from colonnade.operators import frame as O
from colonnade.operators import joins as J
from colonnade.operators import ordered as R
from colonnade.operators import timeseries as TS
from colonnade.plans.components import connected_components


def test_nlargest_all_with_null_key(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, None)], "id long, v double")
    assert sorted(r["id"] for r in R.nlargest(df, 2, ["v"], keep="all").collect()) == [1, 2, 3]
    assert [r["id"] for r in R.nlargest(df, 1, ["v"], keep="all").collect()] == [1]


def test_integers_beyond_doubles(spark):
    big = (1 << 60) + 1
    cases = [(a, b) for a in (big, -big, 7, -7, 0, (1 << 63) - 1, -(1 << 63)) for b in (1, -1, 3, -3, 10) if not (a == -(1 << 63) and b == -1)]
    df = spark.createDataFrame(cases, "a long, b long")
    for r in df.select("a", "b", int_floor_div("a", "b").alias("q"), int_floor_mod("a", "b").alias("m")).collect():
        assert (r["q"], r["m"]) == divmod(r["a"], r["b"])
    out = O.clip(spark.createDataFrame([(big,), (None,)], "a long"), lower=5, cols=["a"])
    assert sorted((r["a"] for r in out.collect()), key=str) == [big, None]


def test_cross_joins(spark):
    a, b = spark.range(3).withColumnRenamed("id", "x"), spark.range(2).withColumnRenamed("id", "y")
    assert J.merge(a, b, how="cross").count() == 6
    assert J.join(a, b, None, how="cross").count() == 6
    with pytest.raises(ValueError):
        J.join(a, b, "x", how="cross")


def test_eval_with_comparison(spark):
    df = spark.createDataFrame([(1, 2), (3, 2)], "a int, b int")
    assert [r["c"] for r in O.eval_expr(df, "c = a >= b").collect()] == [False, True]
    assert [r[0] for r in O.eval_expr(df, "a == b").collect()] == [False, False]


def test_validate_composite_keys(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "")], "x string, y string")
    assert J.validate_join(df, df, ["x", "y"], ["x", "y"], "1:1").count() == 0


def test_idx_of_text_labels(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("c", 3.0), ("d", None)], "k string, v double")
    r = A.idxminmax(df, "k", ["v"]).first()
    assert (r["idxmin_v"], r["idxmax_v"]) == ("b", "a")


def test_combine_keeps_left_for_empty_column(spark):
    a = spark.createDataFrame([(1, 5.0)], "k long, v double")
    b = spark.createDataFrame([(1, None)], "k long, v double")
    assert J.combine(a, b, ["k"], lambda x, y: y, overwrite=False).first()["v"] == 5.0


def test_resample_fills_only_counts(spark):
    df = spark.sql("select timestamp'2020-01-01 00:00:00' ts, 1.0 x union all select timestamp'2020-01-01 03:00:00', 2.0")
    out = TS.resample(df, "ts", "1 hour", [F.avg("x").alias("net"), F.count("x").alias("n")], count_cols=["n"])
    assert sorted((r["net"], r["n"]) for r in out.where("net is not null").collect()) == [(1.0, 1), (2.0, 1)]
    assert out.where("net is null and n = 0").count() == 2


def test_resample_right_closed(spark):
    df = spark.sql("select timestamp'2020-01-01 01:00:00' ts union all select timestamp'2020-01-01 01:30:00'")
    out = TS.resample(df, "ts", "1 hour", [F.count(F.lit(1)).alias("n")], closed="right", fill_empty=False)
    assert sorted((str(r["bucket"])[11:16], r["n"]) for r in out.collect()) == [("00:00", 1), ("01:00", 1)]


def test_ovo_weighted_text_classes(spark):
    rng = np.random.default_rng(4)
    classes, rows = ["a", "b", "c"], []
    for i in range(90):
        y = classes[int(rng.integers(0, 3)) if i % 2 else 0]
        rows += [(i, y, c, float(rng.random() + (c == y)), 1.0 + i % 3) for c in classes]
    long = spark.createDataFrame(rows, "row long, label string, cls string, p double, w double")

    def auc(pos, neg):
        return sum(wa * wb * ((a > b) + 0.5 * (a == b)) for a, wa in pos for b, wb in neg) / (sum(w for _, w in pos) * sum(w for _, w in neg))

    def pair(a, b):
        one = lambda x, o: auc([(p, w) for _, y, c, p, w in rows if c == x and y == x], [(p, w) for _, y, c, p, w in rows if c == x and y == o])
        return (one(a, b) + one(b, a)) / 2, sum(w for _, y, c, _, w in rows if c == a and y in (a, b))

    want = [pair(a, b) for a, b in (("a", "b"), ("a", "c"), ("b", "c"))]
    got = MT.roc_auc_multiclass(long, "row", "label", "cls", "p", "ovo", "weighted", "w")
    assert got == pytest.approx(sum(v * w for v, w in want) / sum(w for _, w in want))
    assert MT.roc_auc_multiclass(long, "row", "label", "cls", "p", "ovo", "macro", "w") == pytest.approx(np.mean([v for v, _ in want]))


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, nan, 4.0), (3, 3.0, 6.0), (4, None, 9.0)], "o long, x double, y double")
    st = FT.fit_std_scaler(df, ["x"])
    assert st.mean["x"] == 2.0 and st.n["x"] == 2
    filled = FT.impute(df, FT.fit_simple_imputer(df, ["x"], "mean"))
    assert [r["x"] for r in filled.orderBy("o").collect()] == [1.0, 2.0, 3.0, 2.0]
    assert [r["x"] for r in R.ffill(df, ["x"], ["o"]).orderBy("o").collect()] == [1.0, 1.0, 3.0, 3.0]
    assert FT.fit_missing_indicator(df, ["x", "y"]) == ["x"]
    c = {(r["col_a"], r["col_b"]): r["corr"] for r in A.corr(df, ["x", "y"]).collect()}
    assert c[("x", "y")] == pytest.approx(1.0)
    marked = FT.fit_simple_imputer(df, ["y"], "mean", missing_values=9.0)
    assert marked.fill["y"] == 4.0


def test_interpolate_limits(spark):
    x = [None, 1.0, None, None, None, 5.0, None, None]
    df = spark.createDataFrame(list(enumerate(x)), "o long, x double")
    run = lambda **kw: [r["x"] for r in R.interpolate(df, ["x"], ["o"], **kw).orderBy("o").collect()]
    assert run() == [None, 1.0, 2.0, 3.0, 4.0, 5.0, 5.0, 5.0]
    assert run(limit=1) == [None, 1.0, 2.0, None, None, 5.0, 5.0, None]
    assert run(limit_direction="backward") == [1.0, 1.0, 2.0, 3.0, 4.0, 5.0, None, None]
    assert run(limit_direction="both", limit=1) == [1.0, 1.0, 2.0, None, 4.0, 5.0, 5.0, None]
    assert run(limit_area="inside") == [None, 1.0, 2.0, 3.0, 4.0, 5.0, None, None]
    assert run(limit_area="outside") == [None, 1.0, None, None, None, 5.0, 5.0, 5.0]


def test_components_of_a_long_path(spark):
    edges = spark.range(499).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    more = spark.createDataFrame([(1000, 1001), (1002, 1001), (2000, 2000)], "u long, v long")
    out = {r["vertex"]: r["component"] for r in connected_components(edges.union(more)).collect()}
    assert all(out[i] == 0 for i in range(500))
    assert out[1000] == out[1001] == out[1002] == 1000 and out[2000] == 2000


def test_far_outlier_keeps_its_neighbors(spark):
    rng = np.random.default_rng(0)
    pts = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(rng.random((200, 2)))] + [(999, [500.0, 500.0])]
    space = NB.Space(spark.createDataFrame(pts, "id long, v array<double>"), "id", "v")
    x = np.array([p for _, p in pts])
    dist = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)
    got = {r["id"]: r["core_distance"] for r in NB.core_distance(space, 3).collect()}
    assert all(got[i] == pytest.approx(dist[k, 2]) for k, (i, _) in enumerate(pts))


def test_dense_cell_is_sliced(spark, monkeypatch):
    monkeypatch.setattr(NB, "CELL_ROWS", 7)
    rng = np.random.default_rng(1)
    pts = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(np.r_[rng.random((80, 2)) * 0.01, rng.random((20, 2))])]
    space = NB.Space(spark.createDataFrame(pts, "id long, v array<double>"), "id", "v")
    x = np.array([p for _, p in pts])
    want = {(i, j) for i in range(100) for j in range(100) if np.sqrt(((x[i] - x[j]) ** 2).sum()) <= 0.2}
    assert {(r["i"], r["j"]) for r in space.within(space.points, 0.2).collect()} == want


def test_step_size_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    r = MT.step_sizes(df, ["a", "b"], {"log": {"loss": "log"}, "sq": {"loss": "squared", "intercept": False},
                                       "avg": {"loss": "squared", "averaged": True}}).first()
    assert r["max_squared_sum"] == 25.0
    assert r["log"] == pytest.approx(1 / (0.25 * 26 + 0.5)) and r["sq"] == pytest.approx(1 / 25.5)
    assert r["avg"] == pytest.approx(1 / (2 * 26.5 + min(2 * 2 * 0.5, 26.5)))
    with pytest.raises(ValueError):
        MT.step_sizes(df, ["a"], {"x": {"loss": "hinge"}})


def test_norm_ppf_tails(spark):
    from statistics import NormalDist

    p = np.array([1e-12, 1e-6, 0.01, 0.3, 0.5, 0.7, 0.99, 1 - 1e-9])
    assert np.allclose(MT._ppf(p), [NormalDist().inv_cdf(v) for v in p], rtol=1e-9, atol=1e-9)
    assert np.isnan(MT._ppf(np.array([0.0, 1.0, -1.0]))).all()


def test_tfidf_terms(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "cat"), (3, "")], "doc_id long, text string")
    got = {(r["doc_id"], r["term"]): r["tf"] for r in FT.term_counts(df, ngram_range=(1, 2), stop_words=["the", "on"]).collect()}
    assert got == {(1, "cat"): 1, (1, "sat"): 1, (1, "mat"): 1, (1, "cat sat"): 1, (1, "sat mat"): 1, (2, "cat"): 1}
    chars = FT.tfidf(df, analyzer="char", ngram_range=(3, 3), norm=None, use_idf=False).collect()
    assert {r["term"] for r in chars if r["doc_id"] == 2} == {"cat"}


def test_class_weight(spark):
    from colonnade.ml import learners as L

    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "y double")
    out, name = L.with_class_weight(df, "y", "balanced")
    assert sorted(r[name] for r in out.collect()) == pytest.approx([4 / 6] * 3 + [2.0])
    out, name = L.with_class_weight(df, "y", {1.0: 5.0})
    assert sorted(r[name] for r in out.collect()) == [1.0, 1.0, 1.0, 5.0]


def test_pivot_table_forms(spark):
    from colonnade.operators import reshape as RS

    df = spark.createDataFrame([("a", "x", 1, 1.0, 10.0), ("a", "y", 2, 2.0, 20.0), ("b", "x", 1, 3.0, None), ("b", "x", 2, 5.0, 40.0)],
                               "k string, c string, d int, v double, w double")
    r = {r["k"]: r.asDict() for r in RS.pivot_table(df, ["v", "w"], ["k"], "c", {"v": ["sum", "max"], "w": "mean"}).collect()}
    assert r["b"] == {"k": "b", "v_sum_x": 8.0, "v_sum_y": None, "v_max_x": 5.0, "v_max_y": None, "w_mean_x": 40.0, "w_mean_y": None}
    r = {r["k"]: r.asDict() for r in RS.pivot_table(df, "v", ["k"], ["c", "d"], "sum", fill_value=0.0).collect()}
    assert r["a"] == {"k": "a", "sum_x_1": 1.0, "sum_x_2": 0.0, "sum_y_2": 2.0}
