"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm import (chosen_path, common, context_tree, cost_packing, decontaminate, fuse_dedup, language_id,
                           license_scan, multi_index, ordinal_toxicity, pivot_search, suffix_dedup, token_files, tokens, whitening)
from colonnade.session import scratch_path
from colonnade.sources.tables import load

SQL: dict[str, str] = {}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from the two thirds that are not held out."""
    return language_id.identify(load(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every text: fixed phrases and template containment."""
    return license_scan.scan(load(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text that repeated strings of 200 bytes cover."""
    return suffix_dedup.remove_repeats(load(spark, sf_dir, "documents"))


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram baseline and context-tree score of every text, learned from four fifths of them."""
    docs = load(spark, sf_dir, "documents")
    out = context_tree.score(docs, ~common.held_out(F.col("doc_id"), 5))
    return out.withColumn("held_out", common.held_out(F.col("doc_id"), 5))


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of the whole table on 4-word shingles."""
    return chosen_path.near_duplicates(load(spark, sf_dir, "documents")).drop("mark", "set_name")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every text."""
    return decontaminate.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, written as bit-packed segments, and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(load(spark, sf_dir, "documents"), path, tokens.vocabulary_path(), end_id=0)
    return token_files.read_token_files(spark, path)


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return cost_packing.pack(load(spark, sf_dir, "documents"), tokens.vocabulary_path(), 2048, end_id=1)


def op9_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity grade and expected severity of every text."""
    return ordinal_toxicity.grade_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op10_fuse_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of the whole table."""
    return fuse_dedup.dedup(load(spark, sf_dir, "documents"))


def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives within the windows of each anchor's positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multi_index.mine(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading components, scaled to unit variance."""
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


def op13_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return pivot_search.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKENS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

_TEMPLATE_ROWS = ", ".join(
    f"({t['template']}, '{t['label']}', {t['need']}, [{', '.join(repr(w) for w in t['words'])}])"
    for t in license_scan.template_sets(license_scan.TEMPLATES, license_scan.THRESHOLD))
_PHRASE_ROWS = ", ".join(f"([{', '.join(repr(w) for w in p.split())}], '{label}')" for p, label in license_scan.PHRASES.items())

SQL["op2_license_scan"] = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
ph(p, label) AS (VALUES {_PHRASE_ROWS}),
place AS (SELECT doc_id, label, unnest(list_filter(range(0, greatest(len(ws) - len(p) + 1, 0)), lambda i: ws[i + 1:i + len(p)] = p)) AS i FROM w, ph
       WHERE list_has_all(ws, p)),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM place GROUP BY doc_id),
t(id, label, need, words) AS (VALUES {_TEMPLATE_ROWS}),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS text FROM documents),
sets AS (SELECT doc_id, list_distinct({_WORDS}) AS ws FROM lines),
hit AS (SELECT doc_id, label, len(list_intersect(ws, words)) AS k, need, len(words) AS n FROM sets, t WHERE len(ws) >= need),
tmpl AS (SELECT doc_id, list(DISTINCT label) AS labels, max(k / n) AS score FROM hit WHERE k >= need GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(tmpl.labels, [])))), ',') AS labels, coalesce(score, 0) AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN tmpl USING (doc_id)
"""

SQL["op5_chosen_path"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_TOKENS} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS v, doc_id AS r FROM s UNION SELECT edge.b, reach.r FROM reach JOIN edge ON edge.a = reach.v)
SELECT s.doc_id, len(g) AS n_shingles, min(r) AS component_id, s.doc_id = min(r) AS kept FROM s JOIN reach ON v = s.doc_id GROUP BY s.doc_id, g
"""

SQL["op6_decontaminate"] = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(ws) >= 10 THEN list_transform(range(1, len(ws) - 8), lambda k: ws[k:k + 9])
                                             WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS g FROM i),
p AS (SELECT doc_id, generate_subscripts(ws, 1) - 1 AS pos, unnest(ws) AS term FROM w),
pos AS (SELECT doc_id, unnest(range(1, len(ws) - n + 2)) AS s, n, ws FROM w, (SELECT DISTINCT len(g) AS n FROM win) WHERE len(ws) >= n),
hit AS (SELECT doc_id, s, n, item_id FROM (SELECT doc_id, s, n, ws[s:s + n - 1] AS g FROM pos) JOIN win USING (g)),
cover AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS k FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hit GROUP BY doc_id),
df AS (SELECT term, count(*) AS n FROM p GROUP BY term),
tm AS (SELECT g, len(g) AS len, generate_subscripts(g, 1) - 1 AS off, unnest(g) AS term FROM (SELECT DISTINCT g FROM win)),
rk AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n, off) AS rank, count(*) OVER (PARTITION BY g) AS known FROM tm JOIN df USING (term)),
r AS (SELECT * FROM rk WHERE known = len AND rank <= 3),
a AS (SELECT r.g, r.len, doc_id, pos FROM r JOIN p USING (term) WHERE rank = 1),
b AS (SELECT a.g, a.doc_id, a.pos, a.len, count(DISTINCT rank) AS k FROM a JOIN r ON r.g = a.g AND rank > 1
      JOIN p ON p.term = r.term AND p.doc_id = a.doc_id AND abs(p.pos - a.pos) <= 15 GROUP BY ALL),
near AS (SELECT DISTINCT g, doc_id FROM b WHERE k = least(len, 3) - 1 UNION SELECT g, doc_id FROM a WHERE len = 1),
ni AS (SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM near JOIN win USING (g) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM w LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN ni USING (doc_id)
"""

SQL["op10_fuse_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""

_VECTORS = """f AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
x AS (SELECT vec_id, label, list_transform(v, lambda c: floor(256 * c)) AS x FROM f WHERE len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0)"""

SQL["op11_multi_index"] = f"""
WITH {_VECTORS},
l AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, x FROM x WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
      FROM l a JOIN l b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

SQL["op13_pivot_search"] = f"""
WITH {_VECTORS},
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score FROM x q JOIN x c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_license_scan, op3_suffix_dedup, op4_context_tree, op5_chosen_path, op6_decontaminate, op7_token_files, op8_cost_packing, op9_ordinal_toxicity,
    op10_fuse_dedup, op11_multi_index, op12_lanczos_whitening, op13_pivot_search)}
