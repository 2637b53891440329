"""2.2 Projections, filters, predicates and element-wise operators."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.operators import frame as O
from colonnade.sources.tables import Tables

NULLED_VALUE = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END"


def events_with_nulls(t: Tables):
    return t.events.withColumn("value", F.expr(NULLED_VALUE))


@query("getitem", sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 30")
def q_getitem(spark, d):
    li = O.getitem(Tables(spark, d).lineitem, ["l_orderkey", "l_partkey", "l_quantity"])
    return O.getitem(li, F.col("l_quantity") > 30)


@query("filter_mask", sql="SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def q_filter_mask(spark, d):
    o = Tables(spark, d).orders
    return O.filter_mask(o, (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F"))


@query("query_expr", sql="SELECT * FROM lineitem WHERE l_discount > CAST(0.05 AS DOUBLE) AND l_returnflag = 'R'")
def q_query_expr(spark, d):
    return O.query(Tables(spark, d).lineitem, "l_discount > :d AND l_returnflag = :f", d=0.05, f="R")


@query("eval_expr", sql="SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def q_eval_expr(spark, d):
    return O.eval_expr(Tables(spark, d).lineitem, "net = l_extendedprice * (1 - l_discount)")


@query("select_dtypes", sql="SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def q_select_dtypes(spark, d):
    return O.select_dtypes(Tables(spark, d).customer, include="number", exclude=["bool"])


@query("insert_col", sql="""SELECT o_orderkey, o_totalprice > 200000 AS big, o_custkey, o_orderstatus, o_totalprice,
  o_orderdate, o_orderpriority FROM orders""")
def q_insert_col(spark, d):
    return O.insert(Tables(spark, d).orders, 1, "big", F.col("o_totalprice") > 200000)


@query("assign", sql="""SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax,
  l_extendedprice * (1 - l_discount) AS revenue, (l_extendedprice * (1 - l_discount)) * (1 + l_tax) AS gross FROM lineitem""")
def q_assign(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    return O.assign(li, revenue=lambda f: F.col("l_extendedprice") * (1 - F.col("l_discount")),
                    gross=lambda f: F.col("revenue") * (1 + F.col("l_tax")))


@query("setitem", sql="""SELECT event_id, ts, user_id, event_type, props,
  CASE WHEN value > 90 THEN 0.0 ELSE value END AS value, value * 2 AS value_x2, upper(event_type) AS kind FROM events""")
def q_setitem(spark, d):
    ev = Tables(spark, d).events
    ev = O.setitem(ev, ["value_x2", "kind"], [F.col("value") * 2, F.upper("event_type")])
    return O.setitem(ev, F.col("value") > 90, 0.0, cols=["value"])


@query("drop_cols", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus NOT IN ('P')")
def q_drop_cols(spark, d):
    return O.drop(Tables(spark, d).orders, ["o_orderpriority", "o_totalprice"], key="o_orderstatus", labels=["P"])


@query("rename", sql="SELECT c_custkey, c_name AS name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer")
def q_rename(spark, d):
    return O.rename(Tables(spark, d).customer, {"c_name": "name", "c_acctbal": "balance", "c_phone": "phone"})


@query("set_axis", sql="SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def q_set_axis(spark, d):
    return O.set_axis(Tables(spark, d).nation, ["key", "name", "region"])


@query("pop", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def q_pop(spark, d):
    _popped, rest = O.pop(Tables(spark, d).orders, "o_orderpriority")
    return rest


@query("reindex_cols", sql="SELECT c_custkey, c_name, 'n/a' AS c_phone, c_acctbal FROM customer")
def q_reindex_cols(spark, d):
    return O.reindex_columns(Tables(spark, d).customer, ["c_custkey", "c_name", "c_phone", "c_acctbal"], fill_value="n/a")


def _by_nation(df, key, bal):
    return df.groupBy(F.col(key).alias("nationkey")).agg(
        F.round(F.sum(bal), 2).alias("bal"), F.count(F.lit(1)).alias("n"))


@query("arith_ops", sql="""
WITH l AS (SELECT c_nationkey AS nationkey, round(sum(c_acctbal), 2) AS bal, count(*) AS n FROM customer GROUP BY 1),
     r AS (SELECT s_nationkey AS nationkey, round(sum(s_acctbal), 2) AS bal, count(*) AS n FROM supplier GROUP BY 1)
SELECT coalesce(l.nationkey, r.nationkey) AS nationkey, l.bal - r.bal AS bal, l.n - r.n AS n
FROM l FULL JOIN r ON l.nationkey = r.nationkey""")
def q_arith_ops(spark, d):
    t = Tables(spark, d)
    return O.arith_frames(_by_nation(t.customer, "c_nationkey", "c_acctbal"),
                          _by_nation(t.supplier, "s_nationkey", "s_acctbal"), ["nationkey"], "sub")


@query("cmp_ops", sql="""SELECT l_orderkey, l_linenumber, l_extendedprice > l_quantity * 1000 AS gt,
  l_discount = l_tax AS eq, l_returnflag <= 'N' AS le FROM lineitem""")
def q_cmp_ops(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     O.compare_cols(li, "l_extendedprice", F.col("l_quantity") * 1000, "gt").alias("gt"),
                     O.compare_cols(li, "l_discount", "l_tax", "eq").alias("eq"),
                     O.compare_cols(li, "l_returnflag", F.lit("N"), "le").alias("le"))


@query("divmod", sql="""SELECT l_orderkey, l_linenumber,
  CAST(((l_partkey + 1152921504606846976)::HUGEINT - (((l_partkey + 1152921504606846976)::HUGEINT % 7) + 7) % 7) // 7 AS BIGINT) AS div_big,
  CAST((l_partkey + 1152921504606846976) % 7 AS BIGINT) AS mod_big,
  CAST(floor(l_partkey / -7) AS BIGINT) AS div_key, l_partkey - CAST(floor(l_partkey / -7) AS BIGINT) * -7 AS mod_key,
  CAST(floor(l_extendedprice / 7.5) AS DOUBLE) AS div_price, l_extendedprice - floor(l_extendedprice / 7.5) * 7.5 AS mod_price
FROM lineitem""")
def q_divmod(spark, d):
    li = Tables(spark, d).lineitem
    dk, mk = O.divmod_cols("l_partkey", F.lit(-7).cast("bigint"), integral=True)
    db, mb = O.divmod_cols(F.col("l_partkey") + F.lit(1 << 60), F.lit(7).cast("bigint"), integral=True)  # beyond doubles
    dp, mp = O.divmod_cols("l_extendedprice", F.lit(7.5))
    return li.select("l_orderkey", "l_linenumber", db.alias("div_big"), mb.alias("mod_big"), dk.alias("div_key"), mk.alias("mod_key"),
                     dp.cast("double").alias("div_price"), mp.alias("mod_price"))


@query("combine_fill", sql="""
WITH l AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS tot FROM orders GROUP BY 1),
     r AS (SELECT c_custkey AS o_custkey, c_acctbal AS tot FROM customer)
SELECT coalesce(l.o_custkey, r.o_custkey) AS o_custkey,
  CASE WHEN l.tot IS NULL AND r.tot IS NOT NULL THEN 0.0 ELSE l.tot END
  + CASE WHEN r.tot IS NULL AND l.tot IS NOT NULL THEN 0.0 ELSE r.tot END AS tot
FROM l FULL JOIN r ON l.o_custkey = r.o_custkey""")
def q_combine_fill(spark, d):
    t = Tables(spark, d)
    left = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("tot"))
    right = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("tot"))
    return O.arith_frames(left, right, ["o_custkey"], "add", fill_value=0.0)


@query("reorder_levels", sql="""SELECT c_mktsegment, c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS bal
FROM customer GROUP BY c_nationkey, c_mktsegment""")
def q_reorder_levels(spark, d):
    g = Tables(spark, d).customer.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))
    return O.reorder_levels(g, ["c_mktsegment", "c_nationkey"])


@query("round", sql="""SELECT l_orderkey, l_linenumber, round_even(l_extendedprice, 0) AS l_extendedprice,
  round_even(l_discount, 1) AS l_discount, round_even(l_tax, 1) AS l_tax, l_returnflag FROM lineitem""")
def q_round(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
                                          "l_returnflag")
    return O.round_frame(li, {"l_extendedprice": 0, "l_discount": 1, "l_tax": 1})


@query("clip", sql="""SELECT l_orderkey, l_linenumber, greatest(l_partkey + 1152921504606846976, 1152921504606846977 + 50) AS big,
  CASE WHEN l_quantity < 5 THEN 5 WHEN l_quantity > 45 THEN 45 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_discount < 0.02 THEN 0.02 ELSE l_discount END AS l_discount FROM lineitem""")
def q_clip(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                          (F.col("l_partkey") + F.lit(1 << 60)).alias("big"))
    li = O.clip(li, lower=(1 << 60) + 51, cols=["big"])  # 64-bit values that doubles cannot hold
    return O.clip(O.clip(li, 5, 45, ["l_quantity"]), lower=0.02, cols=["l_discount"])


@query("where", sql=f"""SELECT event_id, user_id,
  CASE WHEN coalesce(({NULLED_VALUE}) > 50, false) THEN ({NULLED_VALUE}) ELSE -1.0 END AS value FROM events""")
def q_where(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "user_id", "value")
    return O.where(ev, F.col("value") > 50, -1.0, cols=["value"])


@query("mask", sql=f"""SELECT event_id, user_id,
  CASE WHEN coalesce(({NULLED_VALUE}) > 50, false) THEN NULL ELSE ({NULLED_VALUE}) END AS value FROM events""")
def q_mask(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "user_id", "value")
    return O.mask(ev, F.col("value") > 50, None, cols=["value"])


@query("replace", sql=r"""SELECT o_orderkey, o_orderstatus,
  regexp_replace(CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END,
                 '^(\d)-', 'P\1-') AS o_orderpriority FROM orders""")
def q_replace(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o = O.replace(o, {"1-URGENT": "urgent", "5-LOW": "low"}, cols=["o_orderpriority"])
    return O.replace(o, {r"^(\d)-": "P$1-"}, cols=["o_orderpriority"], regex=True)
