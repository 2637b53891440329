"""2.12 Docstring corpus extraction.

Input documents are numpy-style docstrings that Spark builds from every
``part`` row (``docstrings_from_part``); the manifest is derived from
``part`` too.  The SQL oracle builds the same texts and parses them with
DuckDB window functions.
"""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.catalog.q_sources import MANIFEST_FROM_PART_SQL
from colonnade.corpus import docstrings as D
from colonnade.corpus import manifest as M
from colonnade.sources.tables import Tables, to_json_lines

_IND = "(CASE WHEN p_partkey % 3 = 0 THEN '    ' ELSE '' END)"
_IND2 = f"({_IND} || '    ')"
_W1 = "split_part(p_name, ' ', 1)"
_W2 = "split_part(p_name, ' ', 2)"
_T = "lower(p_type)"
_KEY2 = (f"([{_W2} || ', ' || {_T}, '(' || {_W2} || ', ' || {_T} || ')', '{{' || {_W2} || ',' || {_T} || '}}_x', "
         f"'*args', {_W2} || '.attr', {_W2} || '[0]', {_W2} || ' words', {_W2} || ' (float)', {_W1}])[(p_size % 9) + 1]")

DOCS_SQL = f"""
SELECT p_partkey AS doc_id,
  (['scikit-learn','numpy','scipy','pandas'])[(p_partkey % 4) + 1] AS lib,
  concat_ws(chr(10),
    {_W1} || ' ' || {_W2} || ' summary.',
    '',
    CASE WHEN p_size % 10 <> 7 THEN 'Parameters' END,
    CASE WHEN p_size % 10 <> 7 THEN '----------' END,
    CASE WHEN p_size % 4 = 1 THEN {_IND} || 'Text before the first entry' END,
    {_IND} || {_W1} || ' : int',
    {_IND2} || 'Size is ' || CAST(p_size AS VARCHAR) || ' ,or  ' || CAST(p_size + 1 AS VARCHAR) || '.',
    CASE WHEN p_size % 2 = 0 THEN '' END,
    {_IND2} || 'More for ' || p_brand,
    {_IND} || {_KEY2} || ' : ' || {_T} || ', optional',
    {_IND2} || 'Type ' || {_T} || '.',
    CASE WHEN p_size % 5 = 3 THEN {_IND} || 'line without colon' END,
    CASE WHEN p_size % 7 = 2 THEN 'Notes' END,
    CASE WHEN p_size % 3 = 0 THEN 'Attributes' END,
    CASE WHEN p_size % 3 = 0 THEN '----------' END,
    CASE WHEN p_size % 3 = 0 THEN {_IND} || {_W2} || ' : float' END,
    CASE WHEN p_size % 3 = 0 THEN {_IND2} || 'Price ' || CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) END,
    CASE WHEN p_size % 3 = 0 THEN {_IND} || 'n_' || {_W1} || '_ : int' END,
    'Returns',
    '-------',
    {_IND} || 'out : ndarray',
    {_IND2} || 'ignored : text',
    CASE WHEN p_size % 11 = 5 THEN 'See Also' END) AS text
FROM part
"""

_STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _strip(x: str) -> str:
    return _STRIP.format(x=x)


_IMPL_SQL = M._IMPL.replace("'", "''")
_HP = " OR ".join(f"starts_with(line, '{h}')" for h in D.HEADER_PREFIXES)
_UPTO = "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_WHOLE = "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"

PARSE_CTES = f"""
docs AS ({DOCS_SQL}),
l0 AS (SELECT doc_id, lib, string_split_regex(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') AS arr FROM docs),
l1 AS (SELECT doc_id, lib, generate_subscripts(arr, 1) - 1 AS line_no, unnest(arr) AS raw FROM l0),
lines AS (SELECT doc_id, lib, line_no, regexp_replace(raw, '\\s+$', '') AS line FROM l1),
c1 AS (SELECT *, ({_HP}) AS hp,
         CASE WHEN starts_with(line, 'Parameters') THEN 'param'
              WHEN starts_with(line, 'Attributes') THEN 'attr' ELSE 'none' END AS label FROM lines),
c2 AS (SELECT *, last_value(CASE WHEN NOT hp THEN line_no END IGNORE NULLS) {_UPTO} AS nh_last FROM c1),
c3 AS (SELECT *, hp AND ((line_no - (coalesce(nh_last, -1) + 1)) % 2 = 0) AS is_header FROM c2),
c4 AS (SELECT *, coalesce(lag(is_header) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS is_skipped,
         last_value(CASE WHEN is_header THEN label END IGNORE NULLS) {_UPTO} AS section,
         last_value(is_header) {_WHOLE} AS last_is_header FROM c3),
c5 AS (SELECT *, length(line) - length(ltrim(line, ' ')) AS indent,
         (NOT is_header AND NOT is_skipped AND section IN ('param', 'attr') AND contains(line, ':')) AS cand FROM c4),
c6 AS (SELECT *, first_value(CASE WHEN cand THEN indent END IGNORE NULLS) {_WHOLE} AS first_indent FROM c5),
c7 AS (SELECT *, cand AND indent = first_indent AS is_start FROM c6),
cl AS (SELECT *, NOT is_header AND NOT is_skipped AND coalesce(entry_line, -1) >= 0 AS is_member
       FROM (SELECT *, last_value(CASE WHEN is_start THEN line_no WHEN is_header THEN -1 END IGNORE NULLS) {_UPTO} AS entry_line FROM c7)),
ent AS (SELECT doc_id, lib, entry_line,
          max(CASE WHEN is_start THEN section END) AS section,
          max(CASE WHEN is_start THEN {_strip("split_part(line, ':', 1)")} END) AS key,
          regexp_replace({_strip("string_agg(piece, ' ' ORDER BY line_no)")}, '\\s*,\\s*', ', ', 'g') AS value
        FROM (SELECT *, CASE WHEN is_start THEN {_strip("substring(line, strpos(line, ':') + 1)")}
                             ELSE {_strip("line")} END AS piece
              FROM cl WHERE is_member AND NOT last_is_header)
        GROUP BY doc_id, lib, entry_line),
parsed AS (SELECT doc_id, lib, section, key, arg_max(value, entry_line) AS value, min(entry_line) AS pos
           FROM ent GROUP BY doc_id, lib, section, key),
cleaned AS (SELECT doc_id, lib, section, key, arg_max(value, pos) AS value, min(pos) AS pos FROM (
              SELECT doc_id, lib, section, value, pos,
                CASE WHEN strpos(key, '(') > 1 THEN {_strip("substring(key, 1, strpos(key, '(') - 1)")} ELSE key END AS key
              FROM parsed) GROUP BY doc_id, lib, section, key),
kept AS (SELECT * FROM cleaned WHERE NOT (contains(key, '*') OR (contains(key, ' ') AND NOT contains(key, ','))
                                          OR contains(key, '.') OR contains(key, '[') OR contains(key, ']'))),
written AS (SELECT DISTINCT doc_id FROM parsed WHERE section = 'param'),
kw AS (SELECT * FROM kept WHERE doc_id IN (SELECT doc_id FROM written)),
kinds AS (
  SELECT doc_id, lib, 'param' AS kind, key, value, pos FROM kw WHERE section = 'param'
  UNION ALL SELECT doc_id, lib, 'attr', key, value, pos FROM kw WHERE section = 'attr'
  UNION ALL SELECT doc_id, lib, 'pa', key, coalesce(a.value, p.value),
         CASE WHEN p.pos IS NOT NULL THEN p.pos ELSE a.pos + 1099511627776 END
  FROM (SELECT * FROM kw WHERE section = 'param') p
  FULL JOIN (SELECT * FROM kw WHERE section = 'attr') a USING (doc_id, lib, key)),
items AS (SELECT *, CASE
    WHEN NOT contains(key, ',') THEN [key]
    WHEN regexp_matches(key, '\\{{([^\\{{\\}}]+)\\}}_([a-zA-Z0-9_]+)') THEN
      list_transform(string_split(regexp_extract(key, '\\{{([^\\{{\\}}]+)\\}}_([a-zA-Z0-9_]+)', 1), ','),
                     lambda s: {_strip(_strip("s") + " || '_' || regexp_extract(key, '\\{([^\\{\\}]+)\\}_([a-zA-Z0-9_]+)', 2)")})
    WHEN regexp_matches(key, '\\(([^()]+)\\)') THEN
      CASE WHEN lib IN ('scipy', 'example') THEN
        [{_strip("array_to_string(list_transform(string_split(regexp_extract(key, '\\(([^()]+)\\)', 1), ','), lambda s: " + _strip("s") + "), '_and_')")}]
      ELSE list_transform(string_split(regexp_extract(key, '\\(([^()]+)\\)', 1), ','), lambda s: {_strip("s")}) END
    ELSE list_transform(string_split(key, ','), lambda s: {_strip("s")}) END AS parts FROM kinds),
final AS (SELECT doc_id, lib, kind, k AS key, arg_max(value, pos * 1000 + item) AS value FROM (
            SELECT doc_id, lib, kind, value, pos, generate_subscripts(parts, 1) AS item, unnest(parts) AS k FROM items)
          GROUP BY doc_id, lib, kind, k)
"""


def _parse(spark, d):
    return D.parse(D.docstrings_from_part(Tables(spark, d).part))


@query("doc_gate", sql=f"WITH docs AS ({DOCS_SQL}) SELECT doc_id, lib FROM docs WHERE contains(text, 'Parameters' || chr(10) || '-----')")
def q_doc_gate(spark, d):
    return D.doc_gate(D.docstrings_from_part(Tables(spark, d).part)).select("doc_id", "lib")


@query("doc_sections", sql=f"WITH {PARSE_CTES} SELECT doc_id, line_no, section, is_header, is_skipped FROM cl")
def q_doc_sections(spark, d):
    return _parse(spark, d)["lines"].select("doc_id", "line_no", "section", "is_header", "is_skipped")


@query("doc_keys", sql=f"""WITH {PARSE_CTES}
SELECT doc_id, section, line_no, {_strip("split_part(line, ':', 1)")} AS key FROM cl WHERE is_start AND NOT last_is_header""")
def q_doc_keys(spark, d):
    return D.entry_keys(_parse(spark, d)["lines"]).select("doc_id", "section", "line_no", "key")


@query("doc_fold", sql=f"WITH {PARSE_CTES} SELECT doc_id, section, key, value, pos FROM parsed")
def q_doc_fold(spark, d):
    return _parse(spark, d)["parsed"].select("doc_id", "section", "key", "value", "pos")


@query("key_clean", sql=f"WITH {PARSE_CTES} SELECT doc_id, section, key, value FROM cleaned")
def q_key_clean(spark, d):
    return _parse(spark, d)["cleaned"].select("doc_id", "section", "key", "value")


@query("key_filter", sql=f"WITH {PARSE_CTES} SELECT doc_id, section, key, value FROM kept")
def q_key_filter(spark, d):
    return _parse(spark, d)["kept"].select("doc_id", "section", "key", "value")


@query("key_split", sql=f"WITH {PARSE_CTES} SELECT doc_id, kind, key, value FROM final WHERE kind <> 'pa'")
def q_key_split(spark, d):
    return _parse(spark, d)["final"].where("kind <> 'pa'").select("doc_id", "kind", "key", "value")


@query("pa_merge", sql=f"WITH {PARSE_CTES} SELECT doc_id, key, value FROM final WHERE kind = 'pa'")
def q_pa_merge(spark, d):
    return _parse(spark, d)["final"].where("kind = 'pa'").select("doc_id", "key", "value")


@query("empty_guard", sql=f"""WITH {PARSE_CTES}
SELECT w.doc_id, count(f.key) AS n_keys FROM written w LEFT JOIN final f ON f.doc_id = w.doc_id AND f.kind = 'param'
GROUP BY w.doc_id""")
def q_empty_guard(spark, d):
    p = _parse(spark, d)
    f = p["final"].where("kind = 'param'")
    return p["written"].join(f, "doc_id", "left").groupBy("doc_id").agg(F.count("key").alias("n_keys"))


def _json_map_sql(kind):
    return ("'{' || coalesce(string_agg(to_json(key) || ':' || to_json(value), ',' ORDER BY key) "
            f"FILTER (kind = '{kind}'), '') || '}}'")


@query("pa_json_sink", sql="WITH " + PARSE_CTES + " SELECT doc_id, lib, '{' || " + " || ',' || ".join(
    f"'\"{k}\":' || {_json_map_sql(k)}" for k in ("param", "attr", "pa")) + " || '}' AS json FROM final GROUP BY doc_id, lib")
def q_pa_json_sink(spark, d):
    out = D.to_pa_json(_parse(spark, d)["final"])
    return to_json_lines(out, partition_cols=["lib"])


# -- manifest-level jobs ------------------------------------------------------

def _manifest(spark, d):
    return M.manifest_from_part(Tables(spark, d).part)


@query("target_name", sql=f"""
SELECT lib, sha, filepath, "class", func, CASE WHEN "class" = 'NA' THEN func ELSE "class" END AS target,
  lib || '/' || sha || '/' || replace(filepath, '/', '--') || '=>' || CASE WHEN "class" = 'NA' THEN func ELSE "class" END || '_docstring.txt' AS doc_path,
  lib || '/' || sha || '/' || replace(filepath, '/', '--') || '=>' || CASE WHEN "class" = 'NA' THEN func ELSE "class" END || '_pa.json' AS output_path
FROM ({MANIFEST_FROM_PART_SQL})""")
def q_target_name(spark, d):
    return M.resolve_targets(_manifest(spark, d))


@query("flatten_path", sql=f"SELECT filepath, replace(filepath, '/', '--') AS flat_path FROM ({MANIFEST_FROM_PART_SQL})")
def q_flatten_path(spark, d):
    return _manifest(spark, d).select("filepath", M.flatten_path("filepath").alias("flat_path"))


@query("lib_dedupe", sql=f"""
SELECT DISTINCT lib FROM ({MANIFEST_FROM_PART_SQL}) m
WHERE lib NOT IN (SELECT DISTINCT p_brand FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INTEGER) % 2 = 0)""")
def q_lib_dedupe(spark, d):
    present = Tables(spark, d).part.where("CAST(split_part(p_brand, '#', 2) AS INT) % 2 = 0").select(F.col("p_brand").alias("lib"))
    return M.libs_to_fetch(_manifest(spark, d), present)


_BLANKED_SQL = f"""
SELECT CASE WHEN p_size % 13 = 0 THEN '' ELSE lib END AS lib, sha, filepath,
       CASE WHEN p_size % 17 = 0 THEN NULL ELSE func END AS func, issue_type
FROM ({MANIFEST_FROM_PART_SQL}) JOIN part ON func = 'f' || CAST(p_partkey AS VARCHAR)"""


@query("record_isolation", sql=f"""
SELECT lib, sha, filepath, func, issue_type,
  CASE WHEN concat_ws(',', CASE WHEN coalesce(trim(lib), '') = '' THEN 'lib' END,
                           CASE WHEN coalesce(trim(sha), '') = '' THEN 'sha' END,
                           CASE WHEN coalesce(trim(filepath), '') = '' THEN 'filepath' END,
                           CASE WHEN coalesce(trim(func), '') = '' THEN 'func' END) <> ''
       THEN 'missing:' || concat_ws(',', CASE WHEN coalesce(trim(lib), '') = '' THEN 'lib' END,
                           CASE WHEN coalesce(trim(sha), '') = '' THEN 'sha' END,
                           CASE WHEN coalesce(trim(filepath), '') = '' THEN 'filepath' END,
                           CASE WHEN coalesce(trim(func), '') = '' THEN 'func' END) END AS error
FROM ({_BLANKED_SQL})""")
def q_record_isolation(spark, d):
    part = Tables(spark, d).part
    m = M.manifest_from_part(part).withColumn("_k", F.expr("CAST(substring(func, 2) AS BIGINT)"))
    m = m.join(part.select(F.col("p_partkey").alias("_k"), "p_size"), "_k")
    m = m.select(F.when(F.col("p_size") % 13 == 0, F.lit("")).otherwise(F.col("lib")).alias("lib"), "sha", "filepath",
                 F.when(F.col("p_size") % 17 == 0, F.lit(None)).otherwise(F.col("func")).alias("func"), "issue_type")
    good, bad = M.isolate_records(m)
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


@query("issue_taxonomy", sql=f"""
WITH tax(code, meaning) AS (VALUES {", ".join(f"('{c}', '{m}')" for c, m in M.ISSUE_TYPES)})
SELECT code, meaning, coalesce(n, 0) AS n_records FROM tax
LEFT JOIN (SELECT issue_type, count(*) AS n FROM ({MANIFEST_FROM_PART_SQL}) GROUP BY issue_type) c ON c.issue_type = tax.code""")
def q_issue_taxonomy(spark, d):
    return M.issue_counts(_manifest(spark, d))


@query("implication", sql=f"""
WITH rules AS (SELECT DISTINCT constraints AS rule_id, constraints FROM ({MANIFEST_FROM_PART_SQL}) WHERE constraints <> 'NA'),
r AS (SELECT rule_id,
        regexp_extract(constraints, '{_IMPL_SQL}', 1) AS a_param, regexp_extract(constraints, '{_IMPL_SQL}', 2) AS a_op,
        regexp_extract(constraints, '{_IMPL_SQL}', 3) AS a_value, regexp_extract(constraints, '{_IMPL_SQL}', 4) AS b_param,
        regexp_extract(constraints, '{_IMPL_SQL}', 5) AS b_op, regexp_extract(constraints, '{_IMPL_SQL}', 6) AS b_value
      FROM rules WHERE regexp_extract(constraints, '{_IMPL_SQL}', 1) <> ''),
rows AS (SELECT o_orderkey AS row_id, 'status' AS param, o_orderstatus AS value FROM orders
         UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders),
a AS (SELECT x.row_id, r.rule_id, r.b_param, r.b_op, r.b_value FROM rows x JOIN r ON x.param = r.a_param
      WHERE CASE WHEN r.a_op = '=' THEN x.value = r.a_value ELSE x.value <> r.a_value END)
SELECT a.row_id, a.rule_id FROM a LEFT JOIN rows b ON a.row_id = b.row_id AND a.b_param = b.param
WHERE NOT coalesce(CASE WHEN a.b_op = '=' THEN b.value = a.b_value ELSE b.value <> a.b_value END, false)""")
def q_implication(spark, d):
    o = Tables(spark, d).orders
    rules = _manifest(spark, d).where("constraints <> 'NA'").select(
        F.col("constraints").alias("rule_id"), "constraints").distinct()
    rows = M.long_rows(o, "o_orderkey", {"status": "o_orderstatus", "priority": "o_orderpriority"})
    return M.implication_violations(rows, rules)


# -- definitions from source text ------------------------------------------------

def _sources(spark, d):
    from colonnade.corpus.sources import sources_from_part
    part = Tables(spark, d).part
    return sources_from_part(part, D.docstrings_from_part(part))


_DEFS_SQL = f"""docs AS ({DOCS_SQL}),
p AS (SELECT p_partkey, p_brand AS lib, md5(p_name) AS sha, replace(lower(p_type), ' ', '/') || '.py' AS filepath,
             len(string_split(text, chr(10))) AS t, contains(text, 'Parameters' || chr(10) || '-----') AS gated
      FROM part JOIN docs ON doc_id = p_partkey)"""


@query("extract_defs", sql=f"""
WITH {_DEFS_SQL}
SELECT lib, sha, filepath, 'function' AS kind, 'f' || p_partkey AS name, NULL AS parent, CAST(4 AS BIGINT) AS line FROM p WHERE gated
UNION ALL SELECT lib, sha, filepath, 'class', 'C' || p_partkey, NULL, CAST(10 + t AS BIGINT) FROM p WHERE gated
UNION ALL SELECT lib, sha, filepath, 'method', 'fit', 'C' || p_partkey, CAST(14 + 2 * t AS BIGINT) FROM p WHERE gated""")
def q_extract_defs(spark, d):
    from colonnade.corpus.sources import extract_defs
    return extract_defs(_sources(spark, d)).select("lib", "sha", "filepath", "kind", "name", "parent", "line")


@query("def_target_join", sql=f"""
WITH docs AS ({DOCS_SQL}),
p AS (SELECT p_partkey, p_brand AS lib, md5(p_name) AS sha, replace(lower(p_type), ' ', '/') || '.py' AS filepath,
             len(string_split(text, chr(10))) AS t, contains(text, 'Parameters' || chr(10) || '-----') AS gated
      FROM part JOIN docs ON doc_id = p_partkey),
defs AS (SELECT lib, sha, filepath, 'function' AS kind, 'f' || CAST(p_partkey AS VARCHAR) AS name, CAST(4 AS BIGINT) AS line FROM p WHERE gated
         UNION ALL SELECT lib, sha, filepath, 'class', 'C' || CAST(p_partkey AS VARCHAR), CAST(10 + t AS BIGINT) FROM p WHERE gated
         UNION ALL SELECT lib, sha, filepath, 'method', 'fit', CAST(14 + 2 * t AS BIGINT) FROM p WHERE gated),
m AS ({MANIFEST_FROM_PART_SQL}),
roles AS (SELECT DISTINCT lib, sha, filepath, 'code' AS role, CASE WHEN "class" = 'NA' THEN func ELSE "class" END AS name FROM m
          UNION SELECT DISTINCT lib, sha, filepath, 'doc', docfrom FROM m)
SELECT r.lib, r.sha, r.filepath, r.role, r.name, arg_max(kind, line) AS kind, max(line) AS line
FROM roles r JOIN defs USING (lib, sha, filepath, name) GROUP BY r.lib, r.sha, r.filepath, r.role, r.name""")
def q_def_target_join(spark, d):
    from colonnade.corpus.sources import extract_defs, match_targets
    return match_targets(_manifest(spark, d), extract_defs(_sources(spark, d)))
