"""2.3 Joins, alignment, combination."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.operators import joins as J
from colonnade.operators.timeseries import time_grid
from colonnade.sources.tables import Tables


@query("merge", sql="""
SELECT coalesce(l.custkey, r.custkey) AS custkey, l.o_orderkey, l.amount AS amount_x, r.amount AS amount_y, r.c_name,
  CASE WHEN l.custkey IS NOT NULL AND r.custkey IS NOT NULL THEN 'both'
       WHEN l.custkey IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
FROM (SELECT o_orderkey, o_custkey AS custkey, o_totalprice AS amount FROM orders) l
FULL JOIN (SELECT c_custkey AS custkey, c_acctbal AS amount, c_name FROM customer) r ON l.custkey = r.custkey""")
def q_merge(spark, d):
    t = Tables(spark, d)
    left = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("amount"))
    right = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"), "c_name")
    return J.merge(left, right, how="outer", on="custkey", indicator=True, validate="many_to_one")


@query("join_key", sql="""
SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_acctbal
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_join_key(spark, d):
    t = Tables(spark, d)
    right = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal")
    return J.join(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), right, "o_custkey", how="left")


@query("join_list", sql="""
SELECT c_custkey AS custkey, c_name, n_orders, total, last_order
FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1) b ON b.o_custkey = c_custkey""")
def q_join_list(spark, d):
    t = Tables(spark, d)
    base = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    stats = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    last = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.max("o_orderdate").alias("last_order"))
    return J.join_list([base, stats, last], "custkey", how="left")


@query("join_validate", sql="""
SELECT 'left' AS side, CAST(o_orderkey AS VARCHAR) AS key, count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1
UNION ALL
SELECT 'right' AS side, CAST(l_orderkey AS VARCHAR) AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def q_join_validate(spark, d):
    t = Tables(spark, d)
    return J.validate_join(t.orders, t.lineitem, ["o_orderkey"], ["l_orderkey"], "one_to_one")


@query("lookup", sql="""
SELECT o_orderkey, o_custkey AS row_label, col_label,
  CASE WHEN col_label = 'c_acctbal' THEN c_acctbal ELSE CAST(c_nationkey AS DOUBLE) END AS value
FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'c_acctbal' ELSE 'c_nationkey' END AS col_label FROM orders) p
LEFT JOIN customer ON c_custkey = p.o_custkey""")
def q_lookup(spark, d):
    t = Tables(spark, d)
    pairs = t.orders.select("o_orderkey", F.col("o_custkey").alias("row_label"),
                            F.when(F.col("o_orderstatus") == "F", "c_acctbal").otherwise("c_nationkey").alias("col_label"))
    cust = t.customer.select("c_custkey", "c_acctbal", "c_nationkey")
    return J.lookup(cust, "c_custkey", pairs, "row_label", "col_label")


def _cust_stats(t):
    return t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))


def _supp_stats(t):
    return t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("bal"), F.max("s_acctbal").alias("max_bal"))


_STATS_SQL = """
l AS (SELECT c_nationkey AS nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer GROUP BY 1),
r AS (SELECT s_nationkey AS nationkey, count(*) AS n, round(sum(s_acctbal), 2) AS bal, max(s_acctbal) AS max_bal FROM supplier GROUP BY 1)"""


@query("align", sql=f"""
WITH {_STATS_SQL}, k AS (SELECT nationkey FROM l UNION SELECT nationkey FROM r)
SELECT 'left' AS side, k.nationkey, coalesce(l.n, 0) AS n, coalesce(l.bal, 0) AS bal, CAST(0 AS DOUBLE) AS max_bal
FROM k LEFT JOIN l USING (nationkey)
UNION ALL
SELECT 'right' AS side, k.nationkey, coalesce(r.n, 0), coalesce(r.bal, 0), coalesce(r.max_bal, 0)
FROM k LEFT JOIN r USING (nationkey)""")
def q_align(spark, d):
    t = Tables(spark, d)
    a, b = J.align(_cust_stats(t), _supp_stats(t), ["nationkey"], "outer", fill_value=0)
    return a.select(F.lit("left").alias("side"), "*").unionByName(b.select(F.lit("right").alias("side"), "*"))


@query("reindex_rows", sql="""
WITH days AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders),
per AS (SELECT o_orderdate AS day, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT day, coalesce(n, 0) AS n, coalesce(total, 0) AS total FROM days LEFT JOIN per USING (day)""")
def q_reindex_rows(spark, d):
    o = Tables(spark, d).orders
    per = o.groupBy(F.col("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    days = time_grid(o, "o_orderdate", "1 day", "day")
    return J.reindex_rows(per, "day", days, fill_value=0)


@query("combine", sql=f"""
WITH {_STATS_SQL}, j AS (
  SELECT coalesce(l.nationkey, r.nationkey) AS nationkey,
    CASE WHEN l.n IS NULL AND r.n IS NOT NULL THEN 0 ELSE l.n END AS ln,
    CASE WHEN r.n IS NULL AND l.n IS NOT NULL THEN 0 ELSE r.n END AS rn,
    CASE WHEN l.bal IS NULL AND r.bal IS NOT NULL THEN 0 ELSE l.bal END AS lb,
    CASE WHEN r.bal IS NULL AND l.bal IS NOT NULL THEN 0 ELSE r.bal END AS rb,
    CASE WHEN r.max_bal IS NOT NULL THEN 0 END AS lm, r.max_bal AS rm
  FROM l FULL JOIN r ON l.nationkey = r.nationkey)
SELECT nationkey, CASE WHEN ln < rn THEN ln ELSE rn END AS n, CASE WHEN lb < rb THEN lb ELSE rb END AS bal,
  CASE WHEN lm < rm THEN lm ELSE rm END AS max_bal FROM j""")
def q_combine(spark, d):
    t = Tables(spark, d)
    return J.combine(_cust_stats(t), _supp_stats(t), ["nationkey"],
                     lambda a, b: F.when(a < b, a).otherwise(b), fill_value=0)


@query("combine_first", sql=f"""
WITH {_STATS_SQL}
SELECT coalesce(l.nationkey, r.nationkey) AS nationkey, coalesce(l.n, r.n) AS n,
  coalesce(CASE WHEN l.n < 60 THEN NULL ELSE l.bal END, r.bal) AS bal, r.max_bal AS max_bal
FROM l FULL JOIN r ON l.nationkey = r.nationkey""")
def q_combine_first(spark, d):
    t = Tables(spark, d)
    left = _cust_stats(t).withColumn("bal", F.when(F.col("n") < 60, F.lit(None)).otherwise(F.col("bal")))
    return J.combine_first(left, _supp_stats(t), ["nationkey"])


@query("update", sql="""
SELECT c_custkey, coalesce(r.c_acctbal, customer.c_acctbal) AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS c_acctbal FROM orders GROUP BY 1) r
ON r.o_custkey = c_custkey""")
def q_update(spark, d):
    t = Tables(spark, d)
    right = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"))
    return J.update(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment"), right, ["c_custkey"])


_MODIFIED = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderpriority FROM orders"""


@query("compare", sql=f"""
WITH r AS ({_MODIFIED}), j AS (
  SELECT o.o_orderkey, unnest([
    {{'column': 'o_orderstatus', 'self': o.o_orderstatus, 'other': r.o_orderstatus, 'diff': o.o_orderstatus IS DISTINCT FROM r.o_orderstatus}},
    {{'column': 'o_custkey', 'self': CAST(o.o_custkey AS VARCHAR), 'other': CAST(r.o_custkey AS VARCHAR), 'diff': o.o_custkey IS DISTINCT FROM r.o_custkey}},
    {{'column': 'o_orderpriority', 'self': o.o_orderpriority, 'other': r.o_orderpriority, 'diff': o.o_orderpriority IS DISTINCT FROM r.o_orderpriority}}
  ]) AS c FROM orders o JOIN r ON o.o_orderkey = r.o_orderkey)
SELECT o_orderkey, c['column'] AS "column", c['self'] AS self, c['other'] AS other FROM j WHERE c['diff']""")
def q_compare(spark, d):
    o = Tables(spark, d).orders
    left = o.select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    right = o.selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus",
        "CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey", "o_orderpriority")
    return J.compare(left, right, ["o_orderkey"])


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("dot", sql="""
WITH lft AS (SELECT l_orderkey, sum(l_quantity) AS qty, round(sum(l_discount), 2) AS disc FROM lineitem GROUP BY 1),
p AS (SELECT l_orderkey, r_name, qty * CAST(r_regionkey + 1 AS DOUBLE) + disc * CAST(10 * (r_regionkey + 1) AS DOUBLE) AS v
      FROM lft, region)
SELECT l_orderkey, """ + ", ".join(f"first(v) FILTER (r_name = '{r}') AS \"{r}\"" for r in _REGIONS) + " FROM p GROUP BY l_orderkey")
def q_dot(spark, d):
    t = Tables(spark, d)
    left = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"),
                                                F.round(F.sum("l_discount"), 2).alias("disc"))
    # right-hand matrix from region: rows qty / disc, one column per region
    w = t.region.select("r_name", (F.col("r_regionkey") + 1).cast("double").alias("qty"),
                        (10 * (F.col("r_regionkey") + 1)).cast("double").alias("disc"))
    right = J.to_long(w, ["r_name"], ["qty", "disc"], "k", "v").groupBy("k").pivot("r_name").agg(F.first("v"))
    return J.dot(left, ["l_orderkey"], right, "k")
