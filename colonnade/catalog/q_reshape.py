"""2.7 Set operations and membership, 2.8 reshape, 2.9 missing values."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.catalog.q_joins import _REGIONS
from colonnade.catalog.q_frame import NULLED_VALUE, events_with_nulls
from colonnade.catalog.q_aggregates import NULLED_USER
from colonnade.operators import membership as MB
from colonnade.operators import missing as MS
from colonnade.operators import reshape as RS
from colonnade.sources.tables import Tables

# -- 2.7 ----------------------------------------------------------------------


@query("append", sql="""
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def q_append(spark, d):
    t = Tables(spark, d)
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                          F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return MB.append(c, s, verify_integrity=True, key=["kind", "id"])


@query("isin", sql="""SELECT l_orderkey, l_linenumber, l_returnflag IN ('R', 'A') AS isin_l_returnflag,
  l_linestatus IN ('F') AS isin_l_linestatus, l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45) AS big_part
FROM lineitem""")
def q_isin(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_partkey")
    out = MB.isin(li, {"l_returnflag": ["R", "A"], "l_linestatus": ["F"]}, cols=["l_returnflag", "l_linestatus"])
    out = MB.isin_frame_values(out, "l_partkey", t.part.where("p_size > 45"), "p_partkey", "big_part")
    return out.drop("l_returnflag", "l_linestatus", "l_partkey")


_X_SQL = "CASE WHEN event_id % 9 = 0 THEN 'NaN'::DOUBLE ELSE round(value, 0) END"
_SET_SQL = "(SELECT DISTINCT round(l_tax * 1000, 0) FROM lineitem)"


def _in1d_input(spark, d):
    t = Tables(spark, d)
    ev = t.events.select("event_id", F.when(F.col("event_id") % 9 == 0, F.lit(float("nan")))
                         .otherwise(F.round("value", 0)).alias("x"))
    values = t.lineitem.select(F.round(F.col("l_tax") * 1000, 0).alias("t"))
    return ev, values


@query("in1d", sql=f"""SELECT event_id, x, coalesce(x IN {_SET_SQL} AND NOT isnan(x), false) AS in1d
FROM (SELECT event_id, {_X_SQL} AS x FROM events)""")
def q_in1d(spark, d):
    ev, values = _in1d_input(spark, d)
    return MB.in1d(ev, "x", values, "t")


@query("in1d_invert", sql=f"""SELECT event_id, x, NOT coalesce(x IN {_SET_SQL} AND NOT isnan(x), false) AS in1d
FROM (SELECT event_id, {_X_SQL} AS x FROM events)""")
def q_in1d_invert(spark, d):
    ev, values = _in1d_input(spark, d)
    return MB.in1d(ev, "x", values, "t", invert=True)


# -- 2.8 ----------------------------------------------------------------------

_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("pivot", sql="SELECT o_custkey, " + ", ".join(
    f"nullif(count(*) FILTER (o_orderpriority = '{p}'), 0) AS \"{p}\"" for p in _PRIOS) + " FROM orders GROUP BY o_custkey")
def q_pivot(spark, d):
    per = Tables(spark, d).orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return RS.pivot(per, ["o_custkey"], "o_orderpriority", "n")


@query("pivot_table", sql="""SELECT l_returnflag,
  coalesce(round(avg(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 6), 0) AS mean_F,
  coalesce(round(avg(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END), 6), 0) AS mean_O
FROM lineitem GROUP BY l_returnflag""")
def q_pivot_table(spark, d):
    out = RS.pivot_table(Tables(spark, d).lineitem, "l_extendedprice", ["l_returnflag"], "l_linestatus",
                         aggfunc="mean", fill_value=0, col_values=["F", "O"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean_F", "mean_O")})


@query("pivot_table_multi", sql="""SELECT l_returnflag,
  sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS sum_F, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS sum_O,
  count(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS count_F, count(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS count_O
FROM lineitem GROUP BY l_returnflag""")
def q_pivot_table_multi(spark, d):
    return RS.pivot_table(Tables(spark, d).lineitem, "l_quantity", ["l_returnflag"], "l_linestatus",
                          aggfunc=["sum", "count"], col_values=["F", "O"], dropna=False)


@query("stack", sql=f"""
SELECT event_id, 'value' AS variable, v AS value FROM (SELECT event_id, {NULLED_VALUE} AS v FROM events) WHERE v IS NOT NULL
UNION ALL SELECT event_id, 'user_id', CAST(user_id AS DOUBLE) FROM events""")
def q_stack(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "value", F.col("user_id").cast("double").alias("user_id"))
    return RS.stack(ev, ["event_id"], ["value", "user_id"])


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("unstack", sql="SELECT c_nationkey, " + ", ".join(
    f"count(*) FILTER (c_mktsegment = '{s}') AS \"{s}\"" for s in _SEGMENTS) + " FROM customer GROUP BY c_nationkey")
def q_unstack(spark, d):
    per = Tables(spark, d).customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return RS.unstack(per, ["c_nationkey"], "c_mktsegment", "n", fill_value=0)


@query("melt", sql="""SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem""")
def q_melt(spark, d):
    li = Tables(spark, d).lineitem
    return RS.melt(li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"),
                   ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"])


@query("explode", sql="""
WITH s AS (SELECT conv_id, turn, string_split(text, chr(10)) AS sentence FROM conversations)
SELECT conv_id, turn, generate_subscripts(sentence, 1) - 1 AS pos, unnest(sentence) AS sentence,
  length(unnest(sentence)) AS length FROM s""")
def q_explode(spark, d):
    c = Tables(spark, d).conversations
    s = c.select("conv_id", "turn", F.split("text", "\n").alias("sentence"))
    s = s.withColumn("length", F.transform("sentence", lambda x: F.length(x)))
    return RS.explode(s, ["sentence", "length"], keep=["conv_id", "turn"]).withColumn("pos", F.col("pos").cast("bigint"))


@query("transpose", sql="""
WITH s AS (SELECT r_name, CAST(count(*) AS DOUBLE) AS n_nations, CAST(sum(n_nationkey) AS DOUBLE) AS key_sum,
                  CAST(r_regionkey AS DOUBLE) AS regionkey
           FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name, r_regionkey),
u AS (UNPIVOT s ON n_nations, key_sum, regionkey INTO NAME "column" VALUE v)
SELECT "column", """ + ", ".join(f"first(v) FILTER (r_name = '{r}') AS \"{r}\"" for r in _REGIONS) + " FROM u GROUP BY \"column\"")
def q_transpose(spark, d):
    t = Tables(spark, d)
    s = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name", "r_regionkey").agg(
        F.count(F.lit(1)).alias("n_nations"), F.sum("n_nationkey").alias("key_sum")) \
        .withColumnRenamed("r_regionkey", "regionkey")
    return RS.transpose(s.select("r_name", "n_nations", "key_sum", "regionkey"), "r_name")


# -- 2.9 ----------------------------------------------------------------------

_NAN_VALUE = f"CASE WHEN event_id % 9 = 0 THEN 'NaN'::DOUBLE ELSE {NULLED_VALUE} END"


@query("isna", sql=f"""SELECT event_id, ({_NAN_VALUE}) IS NULL OR isnan({_NAN_VALUE}) AS value, props IS NULL AS props,
  NOT (({_NAN_VALUE}) IS NULL OR isnan({_NAN_VALUE})) AS value_notna FROM events""")
def q_isna(spark, d):
    ev = events_with_nulls(Tables(spark, d)).withColumn(
        "value", F.when(F.col("event_id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    a = MS.isna(ev, ["value", "props"], keep=["event_id"])
    b = MS.isna(ev, ["value"], keep=["event_id"], notna=True).withColumnRenamed("value", "value_notna")
    return a.join(b, "event_id")


@query("dropna", sql=f"""SELECT event_id, v AS value, u AS user_id, event_type FROM
  (SELECT event_id, event_type, {NULLED_VALUE} AS v, {NULLED_USER} AS u FROM events) WHERE v IS NOT NULL AND u IS NOT NULL""")
def q_dropna(spark, d):
    ev = events_with_nulls(Tables(spark, d)).withColumn("user_id", F.expr(NULLED_USER))
    return MS.dropna(ev.select("event_id", "value", "user_id", "event_type"), how="any", subset=["value", "user_id"])


@query("fillna", sql=f"""SELECT event_id, coalesce({NULLED_VALUE}, 0.0) AS value, coalesce({NULLED_USER}, -1) AS user_id
FROM events""")
def q_fillna(spark, d):
    ev = events_with_nulls(Tables(spark, d)).withColumn("user_id", F.expr(NULLED_USER))
    return MS.fillna(ev.select("event_id", "value", "user_id"), {"value": 0.0, "user_id": -1})
