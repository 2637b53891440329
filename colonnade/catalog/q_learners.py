"""2.15 Learners (and the iterative rows of 2.13 / 2.14).

Most learners are iterative or solver-based, so only their row counts are
checked by the driver (no SQL).  ``ridge_2f``, ``sparse_encode`` (threshold)
and ``dct_rows`` have closed forms with DuckDB oracles.
"""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.ml import imputation as IM
from colonnade.ml import learners as L
from colonnade.ml import linear as LN
from colonnade.ml import trees as TR
from colonnade.session import materialize
from colonnade.sources.tables import Tables

_REG = ["l_quantity", "l_discount", "l_tax"]


def _reg(spark, d):
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", *_REG, "l_extendedprice")


def _docs(spark, d):
    """Binary task: document features, label = quality (labelled docs)."""
    t = Tables(spark, d)
    n = F.col("n_chars") + 1
    feats = t.documents.select(
        "doc_id", F.log1p("n_chars").alias("f_len"),
        ((F.length("text") - F.length(F.regexp_replace("text", ",", ""))) / n * 100).alias("f_comma"),
        ((F.length("text") - F.length(F.regexp_replace("text", r"\.", ""))) / n * 100).alias("f_period"),
        ((F.length("text") - F.length(F.regexp_replace("text", "\n", ""))) / n * 100).alias("f_lines"))
    return feats


_DOC_F = ["f_len", "f_comma", "f_period", "f_lines"]


def _labelled_docs(spark, d):
    lab = Tables(spark, d).labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    return L.assemble(_docs(spark, d).join(lab, "doc_id"), _DOC_F)


def _emb(spark, d):
    e = Tables(spark, d).embeddings
    return L.assemble(e.select("vec_id", F.col("label").cast("double").alias("label"), "embedding"),
                      array_col="embedding")


DIMS = 64  # of the embeddings; every query reads them all
_E = [f"e{i}" for i in range(DIMS)]


def _emb_cols(spark, d):
    e = Tables(spark, d).embeddings
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(_E)])


def _emb_target(spark, d):
    """A target in the span of the features, so that selection has one right answer."""
    return _emb_cols(spark, d).withColumn("y", F.col("e0") * 3 - F.col("e5") * 2 + F.col("e7"))


@query("logistic")
def q_logistic(spark, d):
    df = _labelled_docs(spark, d)
    model = L.logistic(df, "label", C=1.0)
    return model.transform(df).select("doc_id", "prediction",
                                      F.round(vector_to_array("probability")[1], 9).alias("p1"))


@query("logistic_path")
def q_logistic_path(spark, d):
    """Coefficients for every strength and penalty, all strengths in the same passes; l1 starts from the l2 coefficients."""
    df = materialize(_labelled_docs(spark, d).select("label", *_DOC_F), "labelled-docs")  # both fits read it
    strengths = [0.01, 0.1, 1.0, 10.0, 100.0]
    smooth = LN.fit(df, _DOC_F, "label", strengths)
    sparse = LN.fit(df, _DOC_F, "label", strengths, penalty="l1", start=smooth)
    rows = [(p, float(c), m.coef[i, 0].tolist(), [float(m.intercept[i, 0])]) for p, m in (("l2", smooth), ("l1", sparse)) for i, c in enumerate(strengths)]
    return spark.createDataFrame(rows, "penalty string, C double, coef array<double>, intercept array<double>")


@query("linear_svc")
def q_linear_svc(spark, d):
    """Predictions by hinge loss, by squared hinge, and by squared hinge with the l1 penalty."""
    df = _emb(spark, d)
    hinge = L.linear_svc(df, "label", C=1.0, max_iter=1000).transform(df).select("vec_id", "label", "prediction")
    wide = _emb_cols(spark, d)
    squared = LN.fit(wide, _E, "label", [1.0], "squared_hinge").predict(wide, ["vec_id", *_E], name="squared_hinge")
    both = LN.fit(wide, _E, "label", [1.0], "squared_hinge", "l1", tol=1e-4).predict(squared, ["vec_id", "squared_hinge"], name="squared_hinge_l1")
    return hinge.join(both, "vec_id")


@query("ridge", sql="""
WITH m AS (SELECT avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3, avg(l_extendedprice) AS my, count(*) AS n,
  covar_pop(l_quantity, l_quantity) * count(*) + 1 AS a, covar_pop(l_quantity, l_discount) * count(*) AS b, covar_pop(l_quantity, l_tax) * count(*) AS c,
  covar_pop(l_discount, l_discount) * count(*) + 1 AS e, covar_pop(l_discount, l_tax) * count(*) AS f, covar_pop(l_tax, l_tax) * count(*) + 1 AS i,
  covar_pop(l_quantity, l_extendedprice) * count(*) AS y1, covar_pop(l_discount, l_extendedprice) * count(*) AS y2,
  covar_pop(l_tax, l_extendedprice) * count(*) AS y3 FROM lineitem),
w AS (SELECT *, a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c) AS det,
  (e * i - f * f) * y1 + (c * f - b * i) * y2 + (b * f - c * e) * y3 AS n1,
  (f * c - b * i) * y1 + (a * i - c * c) * y2 + (c * b - a * f) * y3 AS n2,
  (b * f - e * c) * y1 + (b * c - a * f) * y2 + (a * e - b * b) * y3 AS n3 FROM m)
SELECT l_orderkey, l_linenumber, round(my + n1 / det * (l_quantity - m1) + n2 / det * (l_discount - m2) + n3 / det * (l_tax - m3), 3) AS prediction
FROM lineitem, w""")
def q_ridge(spark, d):
    df = _reg(spark, d)
    m = L.ridge(df, _REG, "l_extendedprice", alpha=1.0)
    return m.predict(df).select("l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


@query("ridge_2f", sql="""
WITH s AS (SELECT count(*) * covar_pop(l_quantity, l_quantity) AS s11, count(*) * covar_pop(l_discount, l_discount) AS s22,
  count(*) * covar_pop(l_quantity, l_discount) AS s12, count(*) * covar_pop(l_quantity, l_extendedprice) AS s1y,
  count(*) * covar_pop(l_discount, l_extendedprice) AS s2y, avg(l_quantity) AS m1, avg(l_discount) AS m2,
  avg(l_extendedprice) AS my FROM lineitem),
w AS (SELECT ((s22 + 1.0) * s1y - s12 * s2y) / ((s11 + 1.0) * (s22 + 1.0) - s12 * s12) AS w1,
             ((s11 + 1.0) * s2y - s12 * s1y) / ((s11 + 1.0) * (s22 + 1.0) - s12 * s12) AS w2, m1, m2, my FROM s)
SELECT round(w1, 4) AS w1, round(w2, 4) AS w2, round(my - w1 * m1 - w2 * m2, 4) AS intercept FROM w""")
def q_ridge_2f(spark, d):
    out = L.ridge_2f(Tables(spark, d).lineitem, "l_quantity", "l_discount", "l_extendedprice", 1.0)
    return out.select(*[F.round(c, 4).alias(c) for c in ("w1", "w2", "intercept")])


@query("ridge_clf_cv")
def q_ridge_clf_cv(spark, d):
    """Each alpha's accuracy over three folds and its leave-one-out error; predictions of the better are tested, not returned."""
    rows = _emb_cols(spark, d)
    res = L.ridge_classifier_cv(rows, _E, "label", [0.1, 1.0, 10.0], "vec_id", cv=3)
    loo = L.ridge_classifier_loo(rows, _E, "label", [0.1, 1.0, 10.0], class_weight="balanced")
    right = loo.predict(rows, ["label"]).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    return spark.createDataFrame([(float(a), float(s), a == res["alpha"], loo.scores[a], a == loo.alpha, right) for a, s in res["scores"].items()],
                                 "alpha double, cv_accuracy double, best boolean, loo_score double, loo_best boolean, loo_fit_accuracy double")


@query("omp", sql="""SELECT 'e' || (range) AS feature, CAST(CASE range WHEN 0 THEN 3 WHEN 5 THEN -2 WHEN 7 THEN 1 ELSE 0 END AS DOUBLE) AS coef
FROM range((SELECT max(len(embedding)) FROM embeddings))""")
def q_omp(spark, d):
    from colonnade.ml.linalg import gram
    m = L.omp_from_gram(gram(_emb_target(spark, d), _E, "y"), n_nonzero=3)
    return spark.createDataFrame([(c, round(float(w), 6) + 0.0) for c, w in zip(m.cols, m.coef)], "feature string, coef double")


@query("pca")
def q_pca(spark, d):
    df = _emb_cols(spark, d)
    return L.pca(df, _E, n_components=5).transform(df, keep=["vec_id"])


@query("pca_score")
def q_pca_score(spark, d):
    df = _emb_cols(spark, d)
    return L.pca(df, _E, n_components=10).score_samples(df, keep=["vec_id"])


@query("factor_analysis")
def q_factor_analysis(spark, d):
    df = _emb_cols(spark, d)
    return L.factor_analysis(df, _E, 3).transform(df, keep=["vec_id"])


@query("fast_ica")
def q_fast_ica(spark, d):
    df = _reg(spark, d)
    return L.fast_ica(df, _REG).transform(df, keep=["l_orderkey", "l_linenumber"])


def _label_atoms(spark, d):
    """Dictionary from the data: the unit-norm mean embedding of each label."""
    e = Tables(spark, d).embeddings
    m = e.select("label", F.posexplode("embedding").alias("i", "v")) \
        .groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("v")).collect()
    labels = sorted({r["label"] for r in m})
    dim = max(r["i"] for r in m) + 1
    dic = np.zeros((len(labels), dim))
    for r in m:
        dic[labels.index(r["label"]), r["i"]] = r["v"]
    return dic / np.linalg.norm(dic, axis=1, keepdims=True), dim


@query("sparse_encode", sql="""
WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
a0 AS (SELECT label AS atom, i, avg(v) AS v FROM e GROUP BY label, i),
nrm AS (SELECT atom, sqrt(sum(v * v)) AS nn FROM a0 GROUP BY atom),
a AS (SELECT atom, i, v / nn AS v FROM a0 JOIN nrm USING (atom)),
c AS (SELECT e.vec_id, a.atom, sum(e.v * a.v) AS c FROM e JOIN a USING (i) GROUP BY e.vec_id, a.atom)
SELECT vec_id, CAST(atom AS BIGINT) AS atom, round(sign(c) * greatest(abs(c) - 0.05, 0) + 0.0, 6) + 0.0 AS code FROM c""")
def q_sparse_encode(spark, d):
    dic, dim = _label_atoms(spark, d)
    df = _emb_cols(spark, d)
    codes = L.sparse_encode_threshold(df, [f"e{i}" for i in range(dim)], dic, 0.05, keep=["vec_id"])
    long = codes.unpivot("vec_id", [f"code{j}" for j in range(len(dic))], "atom", "code")
    return long.select("vec_id", F.expr("CAST(substring(atom, 5) AS BIGINT)").alias("atom"),
                       (F.round("code", 6) + F.lit(0.0)).alias("code"))


@query("dict_learning")
def q_dict_learning(spark, d):
    df = _emb_cols(spark, d)
    dic, _costs = L.dict_learning(df, _E, 5, alpha=0.05, max_iter=100, tol=1e-4, method="lasso")
    return L.sparse_encode_lasso(df, _E, dic, 0.05, keep=["vec_id"])


def _reg_vec(spark, d):
    return L.assemble(_reg(spark, d), _REG)


@query("gbt_regressor")
def q_gbt_regressor(spark, d):
    """Squared loss after 50 and 100 rounds, and the Poisson mean of the quantity after 5 and 10."""
    df = _reg_vec(spark, d)
    model = L.gbt_regressor(df, "l_extendedprice", max_iter=100, max_depth=3)
    counts = TR.boost(df, ["l_extendedprice", "l_discount", "l_tax"], "l_quantity", "poisson", learning_rate=0.3, max_iter=10, max_depth=3, max_bins=64)
    out = L.staged_predict(model, df, [50, 100], keep=["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"])
    keep = ["l_orderkey", "l_linenumber", "stage_50", "stage_100"]
    out = counts.staged(out, [5, 10], keep)
    return out.select(*keep, F.col("stage_5").alias("poisson_5"), F.col("stage_10").alias("poisson_10"))


@query("gbt_classifier")
def q_gbt_classifier(spark, d):
    df = _labelled_docs(spark, d)
    return L.gbt_classifier(df, "label", n_estimators=100).transform(df).select("doc_id", "prediction")


@query("bagging")
def q_bagging(spark, d):
    """Votes of all bags, votes of the bags that do not hold the document, and the out-of-bag accuracy."""
    df = _labelled_docs(spark, d).select("doc_id", "label", *_DOC_F)
    bags = TR.bag(df, _DOC_F, "label", "doc_id", n_estimators=10, max_samples=0.8, max_features=0.75, max_depth=3)
    out = bags.predict(df, ["doc_id", *_DOC_F]).withColumnRenamed("prediction", "vote").withColumnRenamed("share", "vote_share")
    oob = bags.predict(out, ["doc_id", "vote", "vote_share"], oob_key="doc_id")
    return oob.select("doc_id", F.col("vote").alias("prediction"), "vote_share", F.col("prediction").alias("oob_prediction"),
                      F.lit(bags.oob_score(df, "label", "doc_id")).alias("oob_score"))


@query("mlp")
def q_mlp(spark, d):
    df = _emb(spark, d)
    return L.mlp(df, "label", hidden=(16,), max_iter=200).transform(df).select("vec_id", "prediction")


@query("dct_rows", sql="""
WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS n, CAST(unnest(embedding) AS DOUBLE) AS x,
                  len(embedding) AS nn FROM embeddings),
k AS (SELECT range AS k FROM range(64))
SELECT vec_id, CAST(k AS BIGINT) AS k, round(sum(x * cos(pi() * (2 * n + 1) * k / (2 * nn)))
  * CASE WHEN k = 0 THEN sqrt(1.0 / max(nn)) ELSE sqrt(2.0 / max(nn)) END, 6) + 0.0 AS value
FROM e, k GROUP BY vec_id, k""")
def q_dct_rows(spark, d):
    e = Tables(spark, d).embeddings
    out = L.dct_rows(e, "embedding", keep=["vec_id"])
    return out.select("vec_id", F.posexplode("dct").alias("k", "value")) \
        .select("vec_id", F.col("k").cast("bigint").alias("k"), (F.round("value", 6) + F.lit(0.0)).alias("value"))


def _impute_round(k: int) -> str:
    """One round in SQL: the price on quantity and discount, then the discount on quantity and price (ridge 1e-6)."""
    def column(step, y, x, before, after):
        return f"""
s{step} AS (SELECT avg(q) AS mq, avg({x}) AS mx, avg({y}) AS my, count(*) * covar_pop(q, q) + 1e-6 AS qq, count(*) * covar_pop(q, {x}) AS qx,
  count(*) * covar_pop({x}, {x}) + 1e-6 AS xx, count(*) * covar_pop(q, {y}) AS qy, count(*) * covar_pop({x}, {y}) AS xy FROM {before} WHERE NOT no_{y}),
w{step} AS (SELECT mq, mx, my, (xx * qy - qx * xy) / (qq * xx - qx * qx) AS wq, (qq * xy - qx * qy) / (qq * xx - qx * qx) AS wx FROM s{step}),
{after} AS (SELECT * REPLACE (CASE WHEN no_{y} THEN my + wq * (q - mq) + wx * ({x} - mx) ELSE {y} END AS {y}) FROM {before}, (SELECT mq, mx, my, wq, wx FROM w{step}))"""
    drop = "SELECT * EXCLUDE (mq, mx, my, wq, wx) FROM"
    return (column(f"{k}a", "p", "d", f"t{k - 1}", f"u{k}_") + f",\nu{k} AS ({drop} u{k}_)," + column(f"{k}b", "d", "p", f"u{k}", f"t{k}_") + f",\nt{k} AS ({drop} t{k}_)")


@query("iterative_imputer", sql=f"""
WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS q, l_partkey % 7 = 0 AS no_p, l_partkey % 5 = 0 AS no_d,
  CASE WHEN l_partkey % 7 <> 0 THEN l_extendedprice END AS p, CASE WHEN l_partkey % 5 <> 0 THEN l_discount END AS d FROM lineitem),
t0 AS (SELECT * REPLACE (coalesce(p, (SELECT avg(p) FROM n)) AS p, coalesce(d, (SELECT avg(d) FROM n)) AS d) FROM n),{_impute_round(1)},{_impute_round(2)},{_impute_round(3)}
SELECT l_orderkey, l_linenumber, l_partkey, q AS l_quantity, round(p, 2) AS l_extendedprice, round(d, 7) AS l_discount FROM t3""")
def q_iterative_imputer(spark, d):
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.when(F.col("l_partkey") % 7 == 0, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_partkey") % 5 == 0, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"))
    out, _it = IM.iterative_impute(li, ["l_quantity", "l_extendedprice", "l_discount"], max_iter=3, tol=0.0,
                                   keep=["l_orderkey", "l_linenumber", "l_partkey"], min_value=None, max_value=None)
    return out.withColumns({"l_extendedprice": F.round("l_extendedprice", 2), "l_discount": F.round("l_discount", 7)})


_CURVE = "l_quantity, l_discount, l_tax, l_extendedprice"


@query("learning_curve", sql=f"""
WITH f AS (SELECT l_orderkey * 100 + l_linenumber AS rid, (l_orderkey * 100 + l_linenumber) % 3 AS fold, {_CURVE} FROM lineitem),
t AS (SELECT k, f.*, row_number() OVER (PARTITION BY k ORDER BY rid, {_CURVE}) AS pos, count(*) OVER (PARTITION BY k) AS n FROM f, range(3) r(k) WHERE fold <> k),
s AS (SELECT DISTINCT k, greatest(CAST(floor(x * n) AS BIGINT), 1) AS m FROM t, (VALUES (0.1::DOUBLE), (0.325), (0.55), (0.775), (1.0)) v(x)),
g AS (SELECT s.k, m, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3, avg(l_extendedprice) AS my,
  covar_pop(l_quantity, l_quantity) * m + 1e-6 AS a, covar_pop(l_quantity, l_discount) * m AS b, covar_pop(l_quantity, l_tax) * m AS c,
  covar_pop(l_discount, l_discount) * m + 1e-6 AS e, covar_pop(l_discount, l_tax) * m AS f, covar_pop(l_tax, l_tax) * m + 1e-6 AS i,
  covar_pop(l_quantity, l_extendedprice) * m AS y1, covar_pop(l_discount, l_extendedprice) * m AS y2, covar_pop(l_tax, l_extendedprice) * m AS y3
  FROM s JOIN t ON t.k = s.k AND pos <= m GROUP BY s.k, m),
w AS (SELECT *, a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c) AS det, (e * i - f * f) * y1 + (c * f - b * i) * y2 + (b * f - c * e) * y3 AS n1,
  (f * c - b * i) * y1 + (a * i - c * c) * y2 + (c * b - a * f) * y3 AS n2, (b * f - e * c) * y1 + (b * c - a * f) * y2 + (a * e - b * b) * y3 AS n3 FROM g),
p AS (SELECT w.k, w.m, true AS train, l_extendedprice AS y, my + n1 / det * (l_quantity - m1) + n2 / det * (l_discount - m2) + n3 / det * (l_tax - m3) AS z
  FROM w JOIN t ON t.k = w.k AND pos <= w.m
  UNION ALL SELECT w.k, w.m, false, l_extendedprice, my + n1 / det * (l_quantity - m1) + n2 / det * (l_discount - m2) + n3 / det * (l_tax - m3) FROM w JOIN f ON fold = w.k),
r AS (SELECT k, m, train, 1 - sum((y - z) * (y - z)) / (var_pop(y) * count(*)) AS r2 FROM p GROUP BY ALL)
SELECT CAST(a.k AS INTEGER) AS fold, a.m AS n_train, round(a.r2, 6) AS train_score, round(b.r2, 6) AS test_score FROM r a JOIN r b ON a.k = b.k AND a.m = b.m AND a.train AND NOT b.train""")
def q_learning_curve(spark, d):
    rows = _reg(spark, d).withColumn("rid", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    out = L.learning_curve(rows, _REG, "l_extendedprice", "rid", cv=3, fold=F.col("rid") % 3, order=[F.col(c) for c in ("rid", *_REG, "l_extendedprice")])
    return out.withColumns({"train_score": F.round("train_score", 6), "test_score": F.round("test_score", 6)})


@query("seq_feature_sel", sql="""SELECT CAST(row_number() OVER (ORDER BY range) - 1 AS INTEGER) AS step, 'e' || range AS feature
FROM range((SELECT max(len(embedding)) FROM embeddings)) WHERE range IN (0, 5, 7)""")
def q_seq_feature_sel(spark, d):
    chosen = L.sequential_feature_selection(_emb_target(spark, d), _E, "y", "vec_id", n_features_to_select=3, cv=3)
    return spark.createDataFrame([(i, c) for i, c in enumerate(chosen)], "step int, feature string")


@query("self_training")
def q_self_training(spark, d):
    t = Tables(spark, d)
    lab = t.labels.select("doc_id", F.col("quality").alias("y"))
    df = _docs(spark, d).join(lab, "doc_id", "left").withColumn("y", F.coalesce("y", F.lit(-1)))
    out, reason, it = L.self_training(L.assemble(df, _DOC_F), "y", "doc_id", threshold=0.6, max_iter=10)
    return out.select("doc_id", "transduction", "labeled_iter", F.lit(reason).alias("stop_reason"))
