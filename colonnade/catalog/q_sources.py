"""2.1 Scans, sources, sinks."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.corpus import manifest as M
from colonnade.sources.tables import Tables, to_orc, to_parquet, to_xml


@query("to_parquet", sql="SELECT * FROM orders")
def q_to_parquet(spark, d):
    return to_parquet(Tables(spark, d).orders, partition_cols=["o_orderstatus"])


@query("to_orc", sql="SELECT * FROM lineitem")
def q_to_orc(spark, d):
    return to_orc(Tables(spark, d).lineitem)


@query("to_xml", sql="SELECT * FROM customer")
def q_to_xml(spark, d):
    return to_xml(Tables(spark, d).customer, root_name="customers", row_name="customer")


MANIFEST_FROM_PART_SQL = """
SELECT p_brand AS lib, md5(p_name) AS sha, md5(p_name) AS issue_sha,
       (ARRAY['parameter','value','logic','addc','removec','removep','missing','modify'])[(p_size % 8) + 1] AS issue_type,
       CASE WHEN p_size % 2 = 0 THEN 'class' ELSE 'func' END AS granularity,
       replace(lower(p_type), ' ', '/') || '.py' AS filepath,
       CASE WHEN p_size % 2 = 0 THEN 'C' || CAST(p_partkey AS VARCHAR) ELSE 'f' || CAST(p_partkey AS VARCHAR) END AS docfrom,
       CASE WHEN p_size % 2 = 0 THEN 'C' || CAST(p_partkey AS VARCHAR) ELSE 'NA' END AS "class",
       'f' || CAST(p_partkey AS VARCHAR) AS func,
       'f' || CAST(p_partkey AS VARCHAR) AS exec_func,
       string_split(lower(p_type), ' ') AS params,
       CASE WHEN p_size % 3 = 0 THEN '(status = ''' || (['F','O','P'])[(p_partkey % 3) + 1] || ''') -> (priority != ''' || (['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'])[(p_size % 5) + 1] || ''')' ELSE 'NA' END AS constraints,
       'False' AS oracle,
       CASE WHEN p_size % 5 = 0 THEN 'True' ELSE NULL END AS cancheck
FROM part
"""


@query("manifest_scan", sql=f"""
SELECT lib, sha, issue_sha, issue_type, granularity, filepath, docfrom, "class", func, exec_func,
       array_to_string(params, '|') AS params, len(params) AS n_params, constraints, oracle, cancheck
FROM ({MANIFEST_FROM_PART_SQL})
""")
def q_manifest_scan(spark, d):
    m = M.scan_manifest(spark, M.write_manifest(M.manifest_from_part(Tables(spark, d).part)))
    return m.withColumns({"n_params": F.size("params").cast("bigint"),
                          "params": F.array_join("params", "|")})
