"""2.13 Feature preparation."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.catalog.q_aggregates import NULLED_USER
from colonnade.catalog.q_frame import NULLED_VALUE, events_with_nulls
from colonnade.ml import features as FT
from colonnade.sources.tables import Tables

_SC = ["l_quantity", "l_extendedprice", "l_discount"]


def _z_sql(c):
    return (f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}")


@query("std_scaler", sql=f"SELECT l_orderkey, l_linenumber, {', '.join(_z_sql(c) for c in _SC)} FROM lineitem")
def q_std_scaler(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", *_SC)
    out = FT.std_scale(li, FT.fit_std_scaler(li, _SC))
    return out.withColumns({c: F.round(c, 6) for c in _SC})


_WC = ["l_extendedprice", "l_discount"]


@query("std_scaler_weighted", sql="WITH m AS (SELECT " + ", ".join(
    f"sum(l_quantity * {c}) / sum(l_quantity) AS m_{c}" for c in _WC) + " FROM lineitem), v AS (SELECT " + ", ".join(
    f"sqrt(sum(l_quantity * ({c} - m_{c}) ^ 2) / sum(l_quantity)) AS s_{c}" for c in _WC) + " FROM lineitem, m) "
    "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in _WC) + " FROM lineitem, m, v")
def q_std_scaler_weighted(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", *_WC)
    out = FT.std_scale(li, FT.fit_std_scaler(li, _WC, weight="l_quantity"))
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _WC])


# digits chosen per column so that float noise between engines cannot cross a
# rounding boundary (means of cents are exact decimals; variances are not)
_VAR_DIGITS = {"l_quantity": 6, "l_extendedprice": 0, "l_discount": 9}


@query("std_scaler_partial", sql="\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 9) AS mean, round(var_pop({c}), {_VAR_DIGITS[c]}) AS var "
    "FROM lineitem" for c in _SC))
def q_std_scaler_partial(spark, d):
    li = Tables(spark, d).lineitem.withColumn("batch", F.year("l_shipdate"))
    merged = FT.merge_moments(FT.batch_moments(li, _SC, "batch"), _SC)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c)["n"].alias("n"),
                                        F.round(F.col(c)["mean"], 9).alias("mean"),
                                        F.round(F.col(c)["var"], _VAR_DIGITS[c]).alias("var")) for c in _SC]))
    return merged.select(rows.alias("r")).select("r.*")


@query("std_scaler_inverse", sql=f"SELECT l_orderkey, l_linenumber, {', '.join(f'round({c}, 6) AS {c}' for c in _SC)} FROM lineitem")
def q_std_scaler_inverse(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", *_SC)
    st = FT.fit_std_scaler(li, _SC)
    back = FT.std_unscale(FT.std_scale(li, st), st)
    return back.withColumns({c: F.round(c, 6) for c in _SC})


_IMP = f"(SELECT event_id, {NULLED_VALUE} AS value, {NULLED_USER} AS user_id FROM events)"
_MODE_SQL = f"(SELECT user_id FROM {_IMP} WHERE user_id IS NOT NULL GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)"


def _imp_input(spark, d):
    return events_with_nulls(Tables(spark, d)).withColumn("user_id", F.expr(NULLED_USER)).select("event_id", "value", "user_id")


@query("simple_imputer", sql=f"""SELECT event_id, round(coalesce(value, avg(value) OVER ()), 6) AS value_mean,
  coalesce(value, quantile_cont(value, 0.5) OVER ()) AS value_median, coalesce(user_id, {_MODE_SQL}) AS user_mode,
  coalesce(value, 0) AS value_const FROM {_IMP}""")
def q_simple_imputer(spark, d):
    ev = _imp_input(spark, d)
    mean = FT.impute(ev.select("event_id", "value"), FT.fit_simple_imputer(ev, ["value"], "mean"))
    med = FT.impute(ev.select("event_id", "value"), FT.fit_simple_imputer(ev, ["value"], "median"))
    mode = FT.impute(ev.select("event_id", "user_id"), FT.fit_simple_imputer(ev, ["user_id"], "most_frequent"))
    const = FT.impute(ev.select("event_id", "value"), FT.fit_simple_imputer(ev, ["value"], "constant"))
    return mean.select("event_id", F.round("value", 6).alias("value_mean")) \
        .join(med.withColumnRenamed("value", "value_median"), "event_id") \
        .join(mode.withColumnRenamed("user_id", "user_mode"), "event_id") \
        .join(const.withColumnRenamed("value", "value_const"), "event_id")


@query("simple_imputer_ind", sql=f"""SELECT event_id, round(coalesce(value, avg(value) OVER ()), 6) AS value,
  coalesce(user_id, {_MODE_SQL}) AS user_id, CAST(value IS NULL AS INTEGER) AS value_missing,
  CAST(user_id IS NULL AS INTEGER) AS user_id_missing FROM {_IMP}""")
def q_simple_imputer_ind(spark, d):
    ev = _imp_input(spark, d)
    a = FT.impute(ev.select("event_id", "value"), FT.fit_simple_imputer(ev, ["value"], "mean"), add_indicator=True)
    b = FT.impute(ev.select("event_id", "user_id"), FT.fit_simple_imputer(ev, ["user_id"], "most_frequent"),
                  add_indicator=True)
    return a.withColumn("value", F.round("value", 6)).join(b, "event_id")


@query("simple_imputer_inv", sql=f"SELECT event_id, value, user_id FROM {_IMP}")
def q_simple_imputer_inv(spark, d):
    ev = _imp_input(spark, d)
    st = FT.fit_simple_imputer(ev, ["value", "user_id"], "most_frequent")
    return FT.unimpute(FT.impute(ev, st, add_indicator=True), st).select("event_id", "value", "user_id")


@query("missing_indicator", sql=f"""SELECT event_id, value IS NULL AS value_missing, user_id IS NULL AS user_id_missing
FROM {_IMP}""")
def q_missing_indicator(spark, d):
    ev = _imp_input(spark, d)
    cols = ["value", "user_id", "event_id"]
    fitted = FT.fit_missing_indicator(ev, cols)
    return FT.missing_indicator(ev, fitted, cols, keep=["event_id"])


def _uniform_sql(c, n):
    step = f"((max({c}) OVER () - min({c}) OVER ()) / {n}.0)"
    return " + ".join(f"CAST({c} >= min({c}) OVER () + {i} * {step} AS INTEGER)" for i in range(1, n))


@query("kbins_uniform", sql=f"""SELECT l_orderkey, l_linenumber, CAST({_uniform_sql('l_extendedprice', 5)} AS DOUBLE) AS l_extendedprice
FROM lineitem""")
def q_kbins_uniform(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return FT.kbins_transform(li, {"l_extendedprice": FT.uniform_edges(li, "l_extendedprice", 5)})


@query("kbins_quantile", sql="""WITH e AS (SELECT quantile_cont(l_extendedprice, 0.25) AS e1, quantile_cont(l_extendedprice, 0.5) AS e2,
  quantile_cont(l_extendedprice, 0.75) AS e3 FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice >= e1 AS INTEGER) + CAST(l_extendedprice >= e2 AS INTEGER)
  + CAST(l_extendedprice >= e3 AS INTEGER) AS DOUBLE) AS l_extendedprice FROM lineitem, e""")
def q_kbins_quantile(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return FT.kbins_transform(li, {"l_extendedprice": FT.quantile_edges(li, "l_extendedprice", 4)})


@query("kbins_weighted", sql="""
WITH s AS (SELECT l_extendedprice AS x, sum(l_quantity) AS w FROM lineitem GROUP BY 1),
c AS (SELECT x, sum(w) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS cw, sum(w) OVER () AS tot FROM s),
e AS (SELECT (SELECT min(x) FROM c WHERE cw >= 0.25 * tot) AS e1, (SELECT min(x) FROM c WHERE cw >= 0.5 * tot) AS e2,
             (SELECT min(x) FROM c WHERE cw >= 0.75 * tot) AS e3)
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice >= e1 AS INTEGER) + CAST(l_extendedprice >= e2 AS INTEGER)
  + CAST(l_extendedprice >= e3 AS INTEGER) AS DOUBLE) AS l_extendedprice FROM lineitem, e""")
def q_kbins_weighted(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    edges = FT.weighted_quantile_edges(li, "l_extendedprice", "l_quantity", 4)
    return FT.kbins_transform(li, {"l_extendedprice": edges}).drop("l_quantity")


@query("kbins_kmeans")
def q_kbins_kmeans(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return FT.kbins_transform(li, {"l_extendedprice": FT.kmeans_edges(li, "l_extendedprice", 4)})


@query("kbins_transform", sql="WITH b AS (SELECT l_orderkey, l_linenumber, " + _uniform_sql("l_discount", 4)
       + " AS b FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
           f"CAST(b = {i} AS DOUBLE) AS l_discount_{i}" for i in range(4)) + " FROM b")
def q_kbins_transform(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_discount")
    return FT.kbins_transform(li, {"l_discount": FT.uniform_edges(li, "l_discount", 4)}, encode="onehot-dense")


@query("kbins_inverse", sql="""
WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
e AS (SELECT lo, hi, (hi - lo) / 5.0 AS step FROM m),
b AS (SELECT l_orderkey, l_linenumber, """ + " + ".join(
    f"CAST(l_extendedprice >= lo + {i} * step AS INTEGER)" for i in range(1, 5)) + """ AS b, lo, hi, step FROM lineitem, e)
SELECT l_orderkey, l_linenumber, round(((CASE WHEN b = 0 THEN lo ELSE lo + b * step END)
  + (CASE WHEN b + 1 = 5 THEN hi ELSE lo + (b + 1) * step END)) * 0.5, 6) AS l_extendedprice FROM b""")
def q_kbins_inverse(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    edges = {"l_extendedprice": FT.uniform_edges(li, "l_extendedprice", 5)}
    out = FT.kbins_inverse(FT.kbins_transform(li, edges), edges)
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 6))


@query("tfidf", sql=r"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
tc AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
n AS (SELECT count(DISTINCT doc_id) AS n FROM documents),
dfq AS (SELECT term, count(*) AS df FROM tc GROUP BY term HAVING count(*) >= 2),
w AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tc JOIN dfq USING (term), n),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS nn FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / nn, 9) AS tfidf FROM w JOIN nrm USING (doc_id)""")
def q_tfidf(spark, d):
    out = FT.tfidf(Tables(spark, d).documents, min_df=2)
    return out.withColumn("tfidf", F.round("tfidf", 9))


@query("char_ngrams", sql=r"""
WITH w AS (SELECT item_id, unnest(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: length(x) > 0)) AS w
           FROM benchmark),
p AS (SELECT item_id, ' ' || w || ' ' AS w FROM w),
g AS (SELECT item_id, unnest(list_transform(range(1, length(w) - 2 + 2), lambda i: substring(w, i, 2))) AS ngram FROM p
      UNION ALL
      SELECT item_id, unnest(list_transform(range(1, length(w) - 3 + 2), lambda i: substring(w, i, 3))) AS ngram FROM p
      WHERE length(w) >= 3)
SELECT item_id, ngram, count(*) AS count FROM g GROUP BY item_id, ngram""")
def q_char_ngrams(spark, d):
    return FT.char_ngrams(Tables(spark, d).benchmark, (2, 3), "char_wb", doc="item_id")
