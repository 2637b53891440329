"""Manifest records: schema, scan, sink, target resolution and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.session import scratch_path

MANIFEST_FIELDS = ("lib sha issue_sha issue_type granularity filepath docfrom class func "
                   "exec_func").split()
MANIFEST_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in MANIFEST_FIELDS]
    + [T.StructField("params", T.ArrayType(T.StringType()), True),
       T.StructField("constraints", T.StringType(), True),
       T.StructField("oracle", T.StringType(), True),
       T.StructField("cancheck", T.StringType(), True)])

# The issue-type taxonomy (code, meaning), in documented order.
ISSUE_TYPES = [
    ("parameter", "Parameter Name Change"),
    ("value", "Value Change"),
    ("logic", "Logic Change"),
    ("addc", "Add Constraint"),
    ("removec", "Remove Constraint"),
    ("removep", "Remove Parameter"),
    ("missing", "Document Missing"),
    ("modify", "Modify Description"),
]

LIBS = ["scikit-learn", "numpy", "scipy", "pandas"]


def scan_manifest(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read manifest records with an explicit schema (fields vary by record:
    absent ones are NULL).  ``multiline`` reads a single JSON array file."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", multiline).json(path)


def write_manifest(df: DataFrame, path: str | None = None) -> str:
    path = path or scratch_path(df.sparkSession, "manifest")
    df.select(*[f.name for f in MANIFEST_SCHEMA.fields]).write.mode("overwrite").json(path)
    return path


def manifest_from_part(part: DataFrame) -> DataFrame:
    """Derive manifest records from ``part`` rows (one record per part)."""
    t = F.lower("p_type")
    even = (F.col("p_size") % 2) == 0
    key = F.col("p_partkey").cast("string")
    issue = F.element_at(F.array(*[F.lit(c) for c, _ in ISSUE_TYPES]), (F.col("p_size") % 8 + 1).cast("int"))
    words = F.split(t, " ")
    status = F.element_at(F.array(*[F.lit(x) for x in ["F", "O", "P"]]), (F.col("p_partkey") % 3 + 1).cast("int"))
    prio = F.element_at(F.array(*[F.lit(x) for x in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]]),
                        (F.col("p_size") % 5 + 1).cast("int"))
    constraint = F.when(F.col("p_size") % 3 == 0, F.concat(
        F.lit("(status = '"), status, F.lit("') -> (priority != '"), prio, F.lit("')"))).otherwise(F.lit("NA"))
    return part.select(
        F.col("p_brand").alias("lib"), F.md5("p_name").alias("sha"), F.md5("p_name").alias("issue_sha"),
        issue.alias("issue_type"),
        F.when(even, "class").otherwise("func").alias("granularity"),
        F.concat(F.replace(t, F.lit(" "), F.lit("/")), F.lit(".py")).alias("filepath"),
        F.when(even, F.concat(F.lit("C"), key)).otherwise(F.concat(F.lit("f"), key)).alias("docfrom"),
        F.when(even, F.concat(F.lit("C"), key)).otherwise(F.lit("NA")).alias("class"),
        F.concat(F.lit("f"), key).alias("func"), F.concat(F.lit("f"), key).alias("exec_func"),
        words.alias("params"), constraint.alias("constraints"), F.lit("False").alias("oracle"),
        F.when(F.col("p_size") % 5 == 0, "True").alias("cancheck"))


def flatten_path(path) -> Column:
    """``/`` becomes ``--``."""
    return F.replace(F.col(path) if isinstance(path, str) else path, F.lit("/"), F.lit("--"))


def resolve_targets(m: DataFrame) -> DataFrame:
    """Target name (class, or the function when class is ``NA``) and the
    document / output names built from lib, sha and the flattened path."""
    target = F.when(F.col("class") == "NA", F.col("func")).otherwise(F.col("class"))
    base = F.concat_ws("/", "lib", "sha", F.concat(flatten_path("filepath"), F.lit("=>"), target))
    return m.select("lib", "sha", "filepath", "class", "func", target.alias("target"),
                    F.concat(base, F.lit("_docstring.txt")).alias("doc_path"),
                    F.concat(base, F.lit("_pa.json")).alias("output_path"))


def libs_to_fetch(m: DataFrame, present: DataFrame) -> DataFrame:
    """One fetch per library; libraries already present are skipped."""
    return m.select("lib").distinct().join(present.select("lib"), "lib", "left_anti")


def isolate_records(m: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split records into (good, quarantine).  A record fails when a required
    field is empty; the error is kept in an ``error`` column and the run goes
    on with the rest."""
    req = ["lib", "sha", "filepath", "func"]
    err = F.concat_ws(",", *[F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.lit(c)) for c in req])
    tagged = m.withColumn("error", F.when(err != "", F.concat(F.lit("missing:"), err)))
    return tagged.where(F.col("error").isNull()).drop("error"), tagged.where(F.col("error").isNotNull())


def issue_taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ISSUE_TYPES, "code string, meaning string")


def issue_counts(m: DataFrame) -> DataFrame:
    """Records per issue type, joined to the (8-row, broadcast) taxonomy."""
    tax = issue_taxonomy(m.sparkSession)
    counts = m.groupBy("issue_type").agg(F.count(F.lit(1)).alias("n_records"))
    return F.broadcast(tax).join(counts, tax.code == counts.issue_type, "left") \
        .select("code", "meaning", F.coalesce("n_records", F.lit(0)).alias("n_records"))


_IMPL = r"^\(\s*(\w+)\s*(!=|=)\s*'([^']*)'\s*\)\s*->\s*\(\s*(\w+)\s*(!=|=)\s*'([^']*)'\s*\)$"


def parse_implication(c) -> list[Column]:
    """``(p = 'x') -> (q != 'y')`` into (p, op, x, q, op, y)."""
    c = F.col(c) if isinstance(c, str) else c
    names = ["a_param", "a_op", "a_value", "b_param", "b_op", "b_value"]
    return [F.regexp_extract(c, _IMPL, i + 1).alias(n) for i, n in enumerate(names)]


def implication_violations(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (long form: row_id, param, value) violating ``A -> B`` rules.

    The antecedent and the consequent are looked up by joins on the
    parameter name; a row violates a rule
    when A holds and B does not (a missing B value counts as not holding).
    """
    r = rules.select("rule_id", *parse_implication("constraints")).where(F.col("a_param") != "")
    a = rows.alias("x").join(r.alias("r"), F.col("x.param") == F.col("r.a_param"))
    a_holds = F.when(F.col("r.a_op") == "=", F.col("x.value") == F.col("r.a_value")) \
        .otherwise(F.col("x.value") != F.col("r.a_value"))
    a = a.where(a_holds).select(F.col("x.row_id").alias("row_id"), "r.rule_id", "r.b_param", "r.b_op", "r.b_value")
    b = rows.select(F.col("row_id").alias("b_row"), F.col("param").alias("b_name"), F.col("value").alias("b_val"))
    j = a.join(b, (a.row_id == b.b_row) & (a.b_param == b.b_name), "left")
    b_holds = F.when(F.col("b_op") == "=", F.col("b_val") == F.col("b_value")) \
        .otherwise(F.col("b_val") != F.col("b_value"))
    return j.where(~F.coalesce(b_holds, F.lit(False))).select("row_id", "rule_id")


def long_rows(df: DataFrame, row_id: str, params: dict[str, str]) -> DataFrame:
    """(row_id, param, value) rows: one per listed column, values as text."""
    stacked = F.explode(F.array(*[F.struct(F.lit(p).alias("param"), F.col(c).cast("string").alias("value"))
                                  for p, c in params.items()]))
    return df.select(F.col(row_id).alias("row_id"), stacked.alias("pv")).select("row_id", "pv.param", "pv.value")
