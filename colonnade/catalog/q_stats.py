"""2.14 Statistics, metrics, model selection."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.ml import metrics as MT
from colonnade.sources.tables import Tables


@query("probplot", sql="""
SELECT row_number() OVER (ORDER BY value, event_id) - 1 AS pos, value AS osr,
  round(CASE WHEN row_number() OVER (ORDER BY value, event_id) = count(*) OVER () THEN pow(0.5, 1.0 / count(*) OVER ())
             WHEN row_number() OVER (ORDER BY value, event_id) = 1 THEN 1 - pow(0.5, 1.0 / count(*) OVER ())
             ELSE (row_number() OVER (ORDER BY value, event_id) - 0.3175) / (count(*) OVER () + 0.365) END, 12) AS m
FROM events WHERE value IS NOT NULL""")
def q_probplot(spark, d):
    pts, _fit = MT.probplot(Tables(spark, d).events, "value", ["event_id"])
    return pts.select("pos", "osr", F.round("m", 12).alias("m"))


@query("confusion_matrix", sql="""
WITH c AS (SELECT quality AS "true", toxic AS pred, count(*) AS n FROM labels GROUP BY 1, 2),
l AS (SELECT quality AS v FROM labels UNION SELECT toxic FROM labels),
g AS (SELECT a.v AS "true", b.v AS pred FROM l a, l b),
m AS (SELECT g."true", g.pred, coalesce(c.n, 0) AS n FROM g LEFT JOIN c ON g."true" = c."true" AND g.pred = c.pred)
SELECT "true", pred, round(n / sum(n) OVER (PARTITION BY "true"), 12) AS count FROM m""")
def q_confusion_matrix(spark, d):
    cm = MT.confusion_matrix(Tables(spark, d).labels, "quality", "toxic", normalize="true")
    return cm.withColumn("count", F.round("count", 12))


def _scored(spark, d):
    t = Tables(spark, d)
    return t.labels.join(t.documents.select("doc_id", "n_chars", "text"), "doc_id")


_SCORED_SQL = "(SELECT l.doc_id, quality, toxic, n_chars, text FROM labels l JOIN documents USING (doc_id))"


@query("roc_auc", sql=f"""
WITH r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS rk
           FROM {_SCORED_SQL})
SELECT round((sum(CASE WHEN quality = 1 THEN rk END) - count(CASE WHEN quality = 1 THEN 1 END) * (count(CASE WHEN quality = 1 THEN 1 END) + 1) / 2.0)
  / (count(CASE WHEN quality = 1 THEN 1 END) * count(CASE WHEN quality = 0 THEN 1 END)), 12) AS auc FROM r""")
def q_roc_auc(spark, d):
    auc = MT.auc_by_groups(_scored(spark, d), F.col("quality") == 1, "n_chars")
    return auc.select(F.round("auc", 12).alias("auc"))


@query("roc_auc_partial", sql=f"""
WITH g AS (SELECT n_chars AS s, sum(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) AS p,
                  sum(CASE WHEN quality = 1 THEN 0.0 ELSE 1.0 END) AS n FROM {_SCORED_SQL} GROUP BY n_chars),
c AS (SELECT *, sum(n) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp,
                sum(p) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
                sum(p) OVER () AS PP, sum(n) OVER () AS NN FROM g),
x AS (SELECT fp / NN AS x1, tp / PP AS y1, (fp - n) / NN AS x0, (tp - p) / PP AS y0 FROM c),
a AS (SELECT sum(CASE WHEN x1 <= 0.3 THEN (x1 - x0) * (y0 + y1) / 2
                     WHEN x0 < 0.3 THEN (0.3 - x0) * (y0 + (y0 + (y1 - y0) * (0.3 - x0) / (x1 - x0))) / 2
                     ELSE 0.0 END) AS pa FROM x)
SELECT round(0.5 * (1 + (pa - 0.5 * 0.3 * 0.3) / (0.3 - 0.5 * 0.3 * 0.3)), 12) AS auc FROM a""")
def q_roc_auc_partial(spark, d):
    out = MT.partial_auc(_scored(spark, d), F.col("quality") == 1, "n_chars", 0.3)
    return out.select(F.round("auc", 12).alias("auc"))


def _softmax_long(spark, d):
    """Class scores over all 64 dimensions: similarity to the class mean (rounded, so that both engines see the same
    ties).  Classes are texts."""
    e = Tables(spark, d).embeddings.select("vec_id", F.concat(F.lit("c"), F.col("label").cast("string")).alias("label"),
                                           F.posexplode("embedding").alias("i", "v")).withColumn("v", F.col("v").cast("double"))
    means = e.groupBy(F.col("label").alias("cls"), "i").agg(F.avg("v").alias("m"))
    return e.join(means, "i").groupBy("vec_id", "label", "cls").agg(F.round(F.sum(F.col("v") * F.col("m")), 6).alias("p"))


_SOFTMAX_SQL = """
x AS (SELECT vec_id, 'c' || label AS label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
m AS (SELECT label AS cls, i, avg(v) AS m FROM x GROUP BY 1, 2),
sm AS (SELECT vec_id, label, cls, round(sum(v * m), 6) AS p FROM x JOIN m USING (i) GROUP BY 1, 2, 3)"""


def _auc_sql(src, pos, score, keys):
    k = ", ".join(keys)
    kp = f"PARTITION BY {k}" if keys else ""
    return f"""(SELECT {k + ',' if keys else ''}
   (sum(CASE WHEN {pos} THEN rk END) - count(CASE WHEN {pos} THEN 1 END) * (count(CASE WHEN {pos} THEN 1 END) + 1) / 2.0)
   / (count(CASE WHEN {pos} THEN 1 END) * count(CASE WHEN NOT ({pos}) THEN 1 END)) AS auc,
   count(CASE WHEN {pos} THEN 1 END) AS n_pos, count(*) AS n_all
   FROM (SELECT *, rank() OVER ({kp} ORDER BY {score}) + (count(*) OVER ({kp}{',' if keys else 'PARTITION BY'} {score}) - 1) / 2.0 AS rk
         FROM {src}) {'GROUP BY ' + k if keys else ''})"""


@query("roc_auc_multi", sql=f"""
WITH {_SOFTMAX_SQL},
ovr AS {_auc_sql('sm', 'label = cls', 'p', ['cls'])},
pr AS (SELECT a.cls AS ca, b.cls AS cb FROM (SELECT DISTINCT cls FROM sm) a, (SELECT DISTINCT cls FROM sm) b WHERE a.cls <> b.cls),
sub AS (SELECT sm.*, ca, cb FROM sm JOIN pr ON sm.cls = pr.ca AND sm.label IN (pr.ca, pr.cb)),
ovo AS {_auc_sql('sub', 'label = ca', 'p', ['ca', 'cb'])},
ovo2 AS (SELECT least(ca, cb) AS lo, greatest(ca, cb) AS hi, avg(auc) AS auc, max(n_all) AS w FROM ovo GROUP BY 1, 2)
SELECT round((SELECT avg(auc) FROM ovr), 9) AS ovr_macro,
       round((SELECT sum(auc * n_pos) / sum(n_pos) FROM ovr), 9) AS ovr_weighted,
       round((SELECT avg(auc) FROM ovo2), 9) AS ovo_macro,
       round((SELECT sum(auc * w) / sum(w) FROM ovo2), 9) AS ovo_weighted""")
def q_roc_auc_multi(spark, d):
    long = _softmax_long(spark, d)
    forms = {f"{m}_{a}": MT.roc_auc_multiclass(long, "vec_id", "label", "cls", "p", m, a)
             for m in ("ovr", "ovo") for a in ("macro", "weighted")}
    return spark.range(1).select(*[F.round(F.lit(v), 9).alias(n) for n, v in forms.items()])


def _multilabel_long(spark, d):
    s = _scored(spark, d)
    commas = F.length("text") - F.length(F.regexp_replace("text", ",", ""))
    return s.select("doc_id", F.explode(F.array(
        F.struct(F.lit("quality").alias("label"), F.col("quality").alias("y"), F.col("n_chars").cast("double").alias("score")),
        F.struct(F.lit("toxic").alias("label"), F.col("toxic").alias("y"), commas.cast("double").alias("score")))).alias("e")) \
        .select("doc_id", "e.*")


_ML_SQL = f"""
lng AS (SELECT doc_id, 'quality' AS label, quality AS y, CAST(n_chars AS DOUBLE) AS score FROM {_SCORED_SQL}
        UNION ALL SELECT doc_id, 'toxic', toxic, CAST(length(text) - length(replace(text, ',', '')) AS DOUBLE) FROM {_SCORED_SQL})"""


@query("roc_auc_multilabel", sql=f"""
WITH {_ML_SQL},
micro AS {_auc_sql('lng', 'y = 1', 'score', [])},
per AS {_auc_sql('lng', 'y = 1', 'score', ['label'])}
SELECT round((SELECT auc FROM micro), 12) AS micro, round((SELECT avg(auc) FROM per), 12) AS macro,
       round((SELECT sum(auc * n_pos) / sum(n_pos) FROM per), 12) AS weighted""")
def q_roc_auc_multilabel(spark, d):
    long = _multilabel_long(spark, d)
    vals = [MT.roc_auc_multilabel(long, "doc_id", "label", "y", "score", a) for a in ("micro", "macro", "weighted")]
    return spark.range(1).select(*[F.round(F.lit(v), 12).alias(n) for v, n in zip(vals, ["micro", "macro", "weighted"])])


@query("leave_one_label_out", sql="""
WITH f AS (SELECT quality * 2 + toxic AS fold, count(*) AS n_test, (SELECT count(*) FROM labels) - count(*) AS n_train
FROM labels GROUP BY 1)
SELECT doc_id, fold AS test_fold, n_test, n_train FROM labels JOIN f ON fold = quality * 2 + toxic""")
def q_leave_one_label_out(spark, d):
    lab = Tables(spark, d).labels.withColumn("group", F.col("quality") * 2 + F.col("toxic"))
    assign, folds = MT.leave_one_label_out(lab, "group")
    return assign.join(folds, F.col("test_fold") == F.col("fold")).select("doc_id", "test_fold", "n_test", "n_train")


_STEP_COLS = ["l_discount", "l_tax", "l_quantity"]


@query("auto_step_size", sql="""
WITH m AS (SELECT max(l_discount * l_discount + l_tax * l_tax + (l_quantity / 50) * (l_quantity / 50)) AS mss,
                  count(*) AS n FROM lineitem),
l AS (SELECT mss, n, 1.0 / n AS a, 0.25 * (mss + 1) + 1.0 / n AS lip_log, mss + 1 + 1.0 / n AS lip_sq FROM m)
SELECT round(mss, 12) AS max_squared_sum, round(1.0 / lip_log, 12) AS step_log, round(1.0 / lip_sq, 12) AS step_squared,
  round(1.0 / (2 * lip_log + least(2 * n * a, lip_log)), 12) AS step_saga FROM l""")
def q_auto_step_size(spark, d):
    li = Tables(spark, d).lineitem.withColumn("l_quantity", F.col("l_quantity") / 50)
    out = MT.step_sizes(li, _STEP_COLS, {"step_log": {"loss": "log"}, "step_squared": {"loss": "squared"},
                                         "step_saga": {"loss": "log", "averaged": True}})
    return out.select(*[F.round(c, 12).alias(c) for c in out.columns])
