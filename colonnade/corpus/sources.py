"""Definitions from Python source text, and their match to manifest targets.

``extract_defs`` parses each (path, source) row with the standard ``ast``
module inside ``mapInPandas`` (a small per-row helper; rows are independent
and spread over partitions) and emits one row per class, function or method
whose docstring passes the gate.  Decorators are dropped from the code,
method docstrings are filed under their class.  ``match_targets`` is an
equi-join on (lib, sha, filepath, name); when a name occurs several times in
a file the last definition wins.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.corpus.docstrings import DOC_GATE

DEF_SCHEMA = ("lib string, sha string, filepath string, kind string, name string, parent string, "
              "line long, docstring string, code string")


def _defs_of(lib: str, sha: str, path: str, source: str) -> list[tuple]:
    try:
        tree = ast.parse(source)
    except SyntaxError:
        return []
    out = []

    def visit(node, parent_cls):
        for child in ast.iter_child_nodes(node):
            if isinstance(child, (ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef)):
                doc = ast.get_docstring(child)
                if doc and DOC_GATE in doc:
                    child.decorator_list = []
                    if isinstance(child, ast.ClassDef):
                        out.append((lib, sha, path, "class", child.name, None, child.lineno, doc, ast.unparse(child)))
                    elif parent_cls is None:
                        out.append((lib, sha, path, "function", child.name, None, child.lineno, doc,
                                    ast.unparse(child)))
                    else:
                        out.append((lib, sha, path, "method", child.name, parent_cls, child.lineno, doc, None))
                visit(child, child.name if isinstance(child, ast.ClassDef) else parent_cls)
            elif isinstance(child, (ast.stmt, ast.excepthandler, ast.match_case)):  # expressions hold no definitions
                visit(child, parent_cls)

    visit(tree, None)
    return out


TASKS_A_CORE = 4


def extract_defs(sources: DataFrame) -> DataFrame:
    """(lib, sha, filepath, source) rows -> one row per gated definition.  Parsing costs far more than reading, so the rows are
    dealt out evenly first, however few files or partitions they come in."""
    spark = sources.sparkSession
    tasks = max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cols = ["lib", "sha", "filepath", "kind", "name", "parent", "line", "docstring", "code"]

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                rows.extend(_defs_of(r.lib, r.sha, r.filepath, r.source))
            yield pd.DataFrame(rows, columns=cols)

    return sources.select("lib", "sha", "filepath", "source").repartition(tasks).mapInPandas(run, DEF_SCHEMA)


def match_targets(manifest: DataFrame, defs: DataFrame) -> DataFrame:
    """Targets of each record (its class or, for class NA, its function; and
    its docfrom) matched to definitions by name; last definition wins.
    Output: lib, sha, filepath, role (code / doc), name, kind, line."""
    target = F.when(F.col("class") == "NA", F.col("func")).otherwise(F.col("class"))
    roles = manifest.select("lib", "sha", "filepath", F.explode(F.array(
        F.struct(F.lit("code").alias("role"), target.alias("name")),
        F.struct(F.lit("doc").alias("role"), F.col("docfrom").alias("name")))).alias("t")) \
        .select("lib", "sha", "filepath", "t.role", "t.name").distinct()
    j = roles.join(defs, ["lib", "sha", "filepath", "name"])
    return j.groupBy("lib", "sha", "filepath", "role", "name").agg(
        F.max_by("kind", "line").alias("kind"), F.max("line").alias("line"))


def sources_from_part(part: DataFrame, docs: DataFrame) -> DataFrame:
    """Module sources built from ``part`` rows: a decorated function f<k>, a
    decorated class C<k> with a method ``fit``; all three carry the
    document text of ``docs`` (doc_id = p_partkey) as docstring."""
    ind = lambda n: F.concat(F.lit(" " * n), F.regexp_replace("text", "\n", "\n" + " " * n))
    k = F.col("p_partkey").cast("string")
    src = F.concat_ws("\n",
                      F.lit("import os"), F.lit(""), F.lit("@cache"),
                      F.concat(F.lit("def f"), k, F.lit("(a, b=1):")),
                      F.lit('    """'), ind(4), F.lit('    """'), F.lit("    return a"), F.lit(""),
                      F.lit("@register"), F.concat(F.lit("class C"), k, F.lit(":")),
                      F.lit('    """'), ind(4), F.lit('    """'), F.lit(""),
                      F.lit("    def fit(self, X):"), F.lit('        """'), ind(8), F.lit('        """'),
                      F.lit("        return self"), F.lit(""))
    t = F.lower("p_type")
    j = part.join(docs.select(F.col("doc_id").alias("p_partkey"), "text"), "p_partkey")
    return j.select(F.col("p_brand").alias("lib"), F.md5("p_name").alias("sha"),
                    F.concat(F.replace(t, F.lit(" "), F.lit("/")), F.lit(".py")).alias("filepath"),
                    src.alias("source"))
