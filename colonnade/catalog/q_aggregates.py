"""2.4 Aggregations."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.catalog.q_frame import NULLED_VALUE, events_with_nulls
from colonnade.operators import aggregates as A
from colonnade.sources.tables import Tables

NULLED_TYPE = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END"
NULLED_USER = "CASE WHEN user_id % 13 = 0 THEN NULL ELSE user_id END"


def _r(c, d=6):
    return F.round(c, d)


@query("groupby", sql=f"""
SELECT et AS event_type, count(*) AS n, round(sum(v), 2) AS total, round(avg(v), 6) AS mean
FROM (SELECT {NULLED_TYPE} AS et, {NULLED_VALUE} AS v FROM events) WHERE et IS NOT NULL GROUP BY et""")
def q_groupby(spark, d):
    ev = events_with_nulls(Tables(spark, d)).withColumn("event_type", F.expr(NULLED_TYPE))
    return A.groupby(ev, ["event_type"], [F.count(F.lit(1)).alias("n"), _r(F.sum("value"), 2).alias("total"),
                                          _r(F.avg("value")).alias("mean")], dropna=True)


@query("aggregate", sql="""
SELECT l_returnflag, sum(l_quantity) AS l_quantity_sum, avg(l_quantity) AS l_quantity_mean, max(l_quantity) AS l_quantity_max,
  min(l_discount) AS l_discount_min, round(avg(l_discount), 6) AS avg_disc FROM lineitem GROUP BY l_returnflag""")
def q_aggregate(spark, d):
    li = Tables(spark, d).lineitem
    out = A.aggregate(li.select("l_returnflag", "l_quantity", "l_discount"),
                      {"l_quantity": ["sum", "mean", "max"], "l_discount": "min", "avg_disc": ("l_discount", "mean")},
                      by=["l_returnflag"])
    return out.withColumn("avg_disc", _r(F.col("avg_disc")))


@query("reduce_sum", sql=f"""
SELECT user_id, round(coalesce(sum(v), 0), 6) AS sum_value, round(coalesce(product(1 + v / 1000), 1), 6) AS prod_value,
  round(avg(v), 6) AS mean_value, round(median(v), 6) AS median_value, min(v) AS min_value, max(v) AS max_value,
  round(stddev_samp(v), 6) AS std_value, round(var_samp(v), 6) AS var_value,
  round(skewness(v), 6) AS skew_value, round(kurtosis(v), 6) AS kurt_value
FROM (SELECT user_id, {NULLED_VALUE} AS v FROM events) GROUP BY user_id""")
def q_reduce_sum(spark, d):
    ev = events_with_nulls(Tables(spark, d)).withColumn("pv", 1 + F.col("value") / 1000)
    r = A.reduce(ev, ["sum", "mean", "median", "min", "max", "std", "var", "skew", "kurt"], ["value"], by=["user_id"])
    p = A.reduce(ev, ["prod"], ["pv"], by=["user_id"]).withColumnRenamed("prod_pv", "prod_value")
    out = r.join(p, "user_id")
    return out.select("user_id", *[_r(F.col(c)).alias(c) if c not in ("min_value", "max_value") else F.col(c)
                                   for c in out.columns if c != "user_id"])


@query("any_all", sql=f"""
SELECT user_id, coalesce(bool_or(v > 95), false) AS any_high, coalesce(bool_and(v > 1), true) AS all_high,
  coalesce(bool_or(event_type = 'error'), false) AS any_err, coalesce(bool_and(event_type = 'error'), true) AS all_err
FROM (SELECT user_id, event_type, {NULLED_VALUE} AS v FROM events) GROUP BY user_id""")
def q_any_all(spark, d):
    ev = events_with_nulls(Tables(spark, d))
    out = A.any_all(ev, {"high": F.col("value") > 95, "err": F.col("event_type") == "error"}, by=["user_id"])
    # 'high' uses two thresholds: any > 95, all > 1
    alt = A.any_all(ev, {"high": F.col("value") > 1}, by=["user_id"]).select("user_id", "all_high")
    return out.drop("all_high").join(alt, "user_id")


@query("count", sql=f"""
SELECT event_type, count(v) AS value, count(props) AS props, count(user_id) AS user_id,
  sum(CAST(v IS NOT NULL AS INTEGER) + CAST(props IS NOT NULL AS INTEGER)) AS row_cells
FROM (SELECT event_type, props, user_id, {NULLED_VALUE} AS v FROM events) GROUP BY event_type""")
def q_count(spark, d):
    ev = events_with_nulls(Tables(spark, d)).withColumn("_cells", A.row_count(["value", "props"]))
    c = A.count(ev, ["value", "props", "user_id"], by=["event_type"])
    rc = ev.groupBy("event_type").agg(F.sum("_cells").alias("row_cells"))
    return c.join(rc, "event_type")


@query("count_level", sql=f"""
SELECT u AS user_id, count(v) AS value, count(event_type) AS event_type
FROM (SELECT {NULLED_USER} AS u, event_type, {NULLED_VALUE} AS v FROM events) WHERE u IS NOT NULL GROUP BY u""")
def q_count_level(spark, d):
    ev = events_with_nulls(Tables(spark, d)).withColumn("user_id", F.expr(NULLED_USER))
    return A.count_level(ev, "user_id", ["value", "event_type"])


@query("nunique", sql=f"""
SELECT event_type, count(DISTINCT user_id) AS user_id,
  count(DISTINCT v) + max(CAST(v IS NULL AS INTEGER)) AS value
FROM (SELECT event_type, user_id, {NULLED_VALUE} AS v FROM events) GROUP BY event_type""")
def q_nunique(spark, d):
    ev = events_with_nulls(Tables(spark, d))
    a = A.nunique(ev, ["user_id"], by=["event_type"], dropna=True)
    b = A.nunique(ev, ["value"], by=["event_type"], dropna=False)
    return a.join(b, "event_type")


@query("value_counts", sql="""
SELECT l_returnflag, l_linestatus, count(*) / (SELECT count(*) FROM lineitem) AS proportion
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_value_counts(spark, d):
    return A.value_counts(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus"], normalize=True)


@query("mode", sql="""
WITH c AS (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_quantity FROM c WHERE n = (SELECT max(n) FROM c c2 WHERE c2.l_returnflag = c.l_returnflag)""")
def q_mode(spark, d):
    return A.mode(Tables(spark, d).lineitem, "l_quantity", by=["l_returnflag"])


_QS = (0.1, 0.3, 0.5, 0.75, 0.9)


def _interp_sql(interp):
    return {"linear": "xl + (xh - xl) * (h - floor(h))", "lower": "xl", "higher": "xh",
            "midpoint": "(xl + xh) / 2", "nearest": "CASE WHEN round_even(h, 0) = floor(h) THEN xl ELSE xh END"}[interp]


_Q_SQL = f"""
WITH s AS (SELECT l_returnflag, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS rn,
                  count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem),
q AS (SELECT unnest({list(_QS)}) AS q),
t AS (SELECT DISTINCT l_returnflag, q, n, q * (n - 1) AS h FROM s, q),
v AS (SELECT t.l_returnflag, t.q, t.h,
        (SELECT x FROM s WHERE s.l_returnflag = t.l_returnflag AND s.rn = floor(t.h)) AS xl,
        (SELECT x FROM s WHERE s.l_returnflag = t.l_returnflag AND s.rn = ceil(t.h)) AS xh FROM t)
SELECT l_returnflag, CAST(q AS DOUBLE) AS q, {{cols}} FROM v"""


@query("quantile", sql=_Q_SQL.format(cols=", ".join(f"round({_interp_sql(i)}, 6) AS {i}" for i in
                                                    ("linear", "lower", "higher", "midpoint", "nearest"))))
def q_quantile(spark, d):
    interps = ["linear", "lower", "higher", "midpoint", "nearest"]
    out = A.quantiles(Tables(spark, d).lineitem, "l_extendedprice", _QS, by=["l_returnflag"], interpolation=interps)
    return out.withColumns({i: _r(F.col(i)) for i in interps})


@query("quantile_table", sql="""
WITH s AS (SELECT l_quantity, l_discount, row_number() OVER (ORDER BY l_quantity, l_discount) - 1 AS rn,
                  count(*) OVER () AS n FROM lineitem),
q AS (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]) AS q)
SELECT CAST(q AS DOUBLE) AS q, l_quantity, l_discount FROM s, q WHERE rn = round_even(q * (n - 1), 0)""")
def q_quantile_table(spark, d):
    return A.quantile_table(Tables(spark, d).lineitem, ["l_quantity", "l_discount"], [0.1, 0.25, 0.5, 0.75, 0.9])


@query("idxminmax", sql="""
SELECT o_orderstatus, first(o_orderkey ORDER BY o_totalprice, o_orderkey) AS idxmin_o_totalprice,
  first(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS idxmax_o_totalprice FROM orders GROUP BY o_orderstatus""")
def q_idxminmax(spark, d):
    return A.idxminmax(Tables(spark, d).orders, "o_orderkey", ["o_totalprice"], by=["o_orderstatus"])


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pair_sql(cols, fn, name, digits, diag_one=False):
    parts = []
    for a in cols:
        for b in cols:
            v = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END" if diag_one and a == b else f"{fn}({a}, {b})"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({v}, {digits}) AS {name} FROM lineitem")
    return "\nUNION ALL ".join(parts)


@query("corr", sql=_pair_sql(_CORR_COLS, "corr", "corr", 10, diag_one=True))
def q_corr(spark, d):
    return A.corr(Tables(spark, d).lineitem, _CORR_COLS, digits=10)


_SP_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("corr_spearman", sql="WITH r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _SP_COLS)
    + " FROM lineitem) " + _pair_sql(_SP_COLS, "corr", "corr", 10, diag_one=True).replace("FROM lineitem", "FROM r"))
def q_corr_spearman(spark, d):
    return A.corr_spearman(Tables(spark, d).lineitem, _SP_COLS, digits=10)


_COV_COLS = ["l_quantity", "l_discount", "l_tax"]


@query("cov", sql=_pair_sql(_COV_COLS, "covar_samp", "cov", 9))
def q_cov(spark, d):
    return A.cov(Tables(spark, d).lineitem, _COV_COLS, ddof=1, digits=9)


@query("corrwith", sql="""
WITH l AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS price, count(*) AS lines FROM lineitem GROUP BY 1),
r AS (SELECT o_orderkey AS k, o_totalprice AS price, o_custkey FROM orders)
SELECT 'price' AS "column", round(corr(l.price, r.price), 10) AS corr FROM l JOIN r USING (k)
UNION ALL SELECT 'lines', CAST(NULL AS DOUBLE) UNION ALL SELECT 'o_custkey', CAST(NULL AS DOUBLE)""")
def q_corrwith(spark, d):
    t = Tables(spark, d)
    left = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("price"),
                                                                   F.count(F.lit(1)).alias("lines"))
    right = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), "o_custkey")
    return A.corrwith(left, right, ["k"], digits=10)


@query("pivot_margins", sql="""
WITH g AS (SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'All' ELSE l_returnflag END AS f,
                  CASE WHEN grouping(l_linestatus) = 1 THEN 'All' ELSE l_linestatus END AS s,
                  sum(l_quantity) AS sm, avg(l_quantity) AS mn
           FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), (l_linestatus), ()))
SELECT f AS l_returnflag,
  max(CASE WHEN s = 'F' THEN sm END) AS sum_F, max(CASE WHEN s = 'O' THEN sm END) AS sum_O, max(CASE WHEN s = 'All' THEN sm END) AS sum_All,
  round(max(CASE WHEN s = 'F' THEN mn END), 9) AS mean_F, round(max(CASE WHEN s = 'O' THEN mn END), 9) AS mean_O,
  round(max(CASE WHEN s = 'All' THEN mn END), 9) AS mean_All
FROM g GROUP BY f""")
def q_pivot_margins(spark, d):
    out = A.pivot_margins(Tables(spark, d).lineitem, "l_returnflag", "l_linestatus", "l_quantity", ["sum", "mean"],
                          col_values=["F", "O"])
    return out.withColumns({c: _r(F.col(c), 9) for c in out.columns if c.startswith("mean_")})


_KC = ["e0", "e1", "e2"]
_KENDALL_PAIR_SQL = """SELECT '{a}' AS col_a, '{b}' AS col_b, round(
  sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b}))
  / sqrt((count(*) - count(CASE WHEN p.{a} = q.{a} THEN 1 END)) * (count(*) - count(CASE WHEN p.{b} = q.{b} THEN 1 END))), 12)
  AS corr FROM e p JOIN e q ON p.vec_id < q.vec_id"""


@query("corr_kendall", sql="WITH e AS (SELECT vec_id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(3)) + " FROM embeddings) " + "\nUNION ALL ".join(
    [_KENDALL_PAIR_SQL.format(a=a, b=b) for a in _KC for b in _KC if a != b]
    + [f"SELECT '{a}' AS col_a, '{a}' AS col_b, CAST(1.0 AS DOUBLE) AS corr" for a in _KC]))
def q_corr_kendall(spark, d):
    e = Tables(spark, d).embeddings.select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(3)])
    return A.corr_kendall(e, _KC, "vec_id", digits=12)
