"""Numpy-style docstring parsing as a set-based Spark job.

A document is one input row (``doc_id, lib, text``).  Arrow batches of
documents are split into lines, classified and folded with array operations
inside the batch, so no text is shuffled; key rules, collisions and merging
are Spark aggregates over the finished entries, keyed by ``doc_id``.

Semantics (per document):

* a line is a header when it starts (column 0, after right-strip) with one
  of ``HEADER_PREFIXES``; Parameters and Attributes open a section, the
  others close it;
* the line after a header is consumed whatever it is, so in a run of
  adjacent header lines only every other one counts;
* a line with ``:`` inside an open section, at the indent of the first such
  line of the document, starts an entry (key before the first colon);
  other lines of the section continue the open entry; text between a header
  and the first entry is dropped;
* entry values are the stripped pieces joined by one space, stripped, with
  ``\\s*,\\s*`` replaced by ``", "``; a repeated key keeps its last value;
* a document whose last line is a header is malformed and yields nothing;
  a document without parameter entries writes nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Header prefixes recognised at column 0, in the documented order.
HEADER_PREFIXES = ["Parameters", "Attributes", "Returns", "return", "Examples", "Example",
                   "Yields", "Notes", "See Also", "Raises", "References"]
# The docstring gate marker.
DOC_GATE = "Parameters\n-----"
# Libraries whose "(a, b)" keys combine into "a_and_b".
COMBINE_PAREN_LIBS = ["scipy", "example"]

_WS_STRIP = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _WS_STRIP, "")


def doc_gate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Only docstrings containing the ``Parameters\\n-----`` marker."""
    return docs.where(F.col(text).contains(DOC_GATE))


# Every document is parsed inside its row: Arrow batches of documents become arrays of lines, and all states (header
# runs, sections, entries) are running maxima over line numbers that restart with each document.

_NEWLINE = "\r\n|\r|\n"
_SPACE = " \t\n\x0b\f\r"
LINE_SCHEMA = ("lib string, line_no int, line string, is_header boolean, is_skipped boolean, section string, last_is_header boolean, "
               "indent int, first_indent int, is_start boolean, entry_line int, is_member boolean")
ENTRY_SCHEMA = "lib string, section string, entry_line int, key string, value string"


def _line_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, dict[str, np.ndarray]]:
    """Document number and text of every line of a batch, and the line states."""
    body = pc.replace_substring_regex(pc.fill_null(batch.column("text"), ""), f"({_NEWLINE})$", "", max_replacements=1)
    lists = pc.split_pattern_regex(body, _NEWLINE)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    line = pc.utf8_rtrim(pc.list_flatten(lists), characters=_SPACE)
    doc = np.repeat(np.arange(len(size)), size)
    begin = (np.cumsum(size) - size)[doc]
    at = np.arange(len(doc))

    def starts(prefix):
        return pc.starts_with(line, pattern=prefix).to_numpy(zero_copy_only=False)

    def latest(mark):  # the last marked line of the document up to here, -1 for none
        seen = np.maximum.accumulate(np.where(mark, at, -1)) if len(at) else at
        return np.where(seen >= begin, seen, -1)

    like = np.zeros(len(at), bool)
    for prefix in HEADER_PREFIXES:
        like |= starts(prefix)
    label = np.where(starts("Parameters"), 1, np.where(starts("Attributes"), 2, 0))
    plain = latest(~like)
    header = like & ((at - np.where(plain < 0, begin, plain + 1)) % 2 == 0)  # 1st, 3rd, .. of a run of header lines
    skipped = np.append(False, header[:-1])[:len(at)] & (at > begin)
    opened = latest(header)
    section = np.where(opened < 0, -1, label[opened] if len(at) else 0)
    content = ~header & ~skipped
    indent = (pc.utf8_length(line).to_numpy(zero_copy_only=False) - pc.utf8_length(pc.utf8_ltrim(line, characters=" ")).to_numpy(zero_copy_only=False))
    candidate = content & (section > 0) & pc.match_substring(line, ":").to_numpy(zero_copy_only=False)
    first = np.full(len(size), -1)
    found = np.flatnonzero(candidate)[::-1]
    first[doc[found]] = indent[found]  # the first candidate is written last
    first = first[doc]
    start = candidate & (indent == first)
    entry = latest(start | header)
    inside = (entry >= 0) & ~header[entry] if len(at) else np.zeros(0, bool)
    last = np.zeros(len(size), bool)
    last[doc] = header  # the last line of a document is written last
    return doc, line, {"line_no": at - begin, "is_header": header, "is_skipped": skipped, "section": section, "last_is_header": last[doc],
                       "indent": indent, "first_indent": first, "is_start": start,
                       "entry_line": np.where(entry < 0, -2, np.where(inside, entry - begin, -1)), "is_member": content & inside}


_SECTIONS = np.array(["none", "param", "attr", None], dtype=object)


def classify_lines(docs: DataFrame) -> DataFrame:
    """One row per line (0-based, right-stripped; a final newline starts no further line) with section, header, skip,
    entry-start and entry membership columns.  No shuffle: rows are independent."""

    def run(batches):
        for b in batches:
            doc, line, x = _line_arrays(b)
            take = pa.array(doc)
            yield pa.record_batch([
                b.column("doc_id").take(take), b.column("lib").take(take), pa.array(x["line_no"], pa.int32()), line, pa.array(x["is_header"]),
                pa.array(x["is_skipped"]), pa.array(_SECTIONS[x["section"]].tolist(), pa.string()), pa.array(x["last_is_header"]),
                pa.array(x["indent"], pa.int32()), pa.array(x["first_indent"], pa.int32(), mask=x["first_indent"] < 0), pa.array(x["is_start"]),
                pa.array(x["entry_line"], pa.int32(), mask=x["entry_line"] == -2), pa.array(x["is_member"])],
                ["doc_id", *(c.split()[0] for c in LINE_SCHEMA.split(", "))])

    return docs.select("doc_id", "lib", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {LINE_SCHEMA}")


def entry_keys(cl: DataFrame) -> DataFrame:
    """Entry start lines: doc_id, lib, section, line_no, key."""
    return cl.where("is_start AND NOT last_is_header").select(
        "doc_id", "lib", "section", "line_no",
        strip(F.substring_index("line", ":", 1)).alias("key"))


def fold_entries(docs: DataFrame) -> DataFrame:
    """One row per entry: doc_id, lib, section, entry_line, key, value.  Lines are folded inside their document's row, so
    only finished entries leave it."""

    def run(batches):
        for b in batches:
            doc, line, x = _line_arrays(b)
            use = x["is_member"] & ~x["last_is_header"]
            doc, line, start = doc[use], line.filter(pa.array(use)), x["is_start"][use]
            piece = pc.if_else(pa.array(start), pc.replace_substring_regex(line, "^[^:]*:", ""), line)
            own = pa.table({"doc": doc, "entry": x["entry_line"][use], "piece": pc.utf8_trim(piece, characters=_SPACE), "at": np.arange(len(doc))})
            folded = own.group_by(["doc", "entry"], use_threads=False).aggregate([("piece", "list"), ("at", "min")]).sort_by("at_min")
            value = pc.utf8_trim(pc.binary_join(folded.column("piece_list").combine_chunks(), " "), characters=_SPACE)
            value = pc.replace_substring_regex(value, f"[{_SPACE}]*,[{_SPACE}]*", ", ")
            # entries come in the order of their first lines, which are the start lines
            key = pc.utf8_trim(pc.replace_substring_regex(line.filter(pa.array(start)), "(?s):.*$", ""), characters=_SPACE)
            take = folded.column("doc").combine_chunks()
            yield pa.record_batch([b.column("doc_id").take(take), b.column("lib").take(take),
                                   pa.array(_SECTIONS[x["section"][use][start]].tolist(), pa.string()),
                                   folded.column("entry").combine_chunks().cast(pa.int32()), key, value],
                                  ["doc_id", *(c.split()[0] for c in ENTRY_SCHEMA.split(", "))])

    return docs.select("doc_id", "lib", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {ENTRY_SCHEMA}")


def last_per_key(entries: DataFrame) -> DataFrame:
    """Repeated key in a section: last value wins; position = first occurrence."""
    return entries.groupBy("doc_id", "lib", "section", "key").agg(
        F.max_by("value", "entry_line").alias("value"),
        F.min("entry_line").alias("pos"))


def clean_keys(parsed: DataFrame) -> DataFrame:
    """Cut a key at ``(`` unless it is at position 0; on collision the key
    inserted last (largest first-occurrence position) wins, the cleaned key
    keeps the earliest position."""
    idx = F.instr("key", "(")
    ck = F.when(idx > 1, strip(F.expr("substring(key, 1, instr(key, '(') - 1)"))).otherwise(F.col("key"))
    extra = [c for c in ("_w",) if c in parsed.columns]
    return parsed.withColumn("key", ck).groupBy("doc_id", "lib", "section", "key", *extra).agg(
        F.max_by("value", "pos").alias("value"), F.min("pos").alias("pos"))


def filter_keys(cleaned: DataFrame) -> DataFrame:
    """Drop keys with ``*``, ``.``, ``[``, ``]``, or a space without a comma."""
    k = F.col("key")
    bad = k.contains("*") | (k.contains(" ") & ~k.contains(",")) | k.contains(".") \
        | k.contains("[") | k.contains("]")
    return cleaned.where(~bad)


# The patterns of the two composite key forms.
_BRACE = r"\{([^\{\}]+)\}_([a-zA-Z0-9_]+)"
_PAREN = r"\(([^()]+)\)"


def merge_pa(kept: DataFrame) -> DataFrame:
    """Stack param, attr and pa (= param then attr; attr wins on a shared key)
    as ``kind`` rows with an ordering position.

    One pass: every kept row is emitted once under its own section and once
    as a ``pa`` candidate; an aggregate keyed by ``doc_id`` resolves the
    candidates, so the doc_id partitioning of the job is reused (no join)."""
    is_attr = F.col("section") == "attr"
    cand = F.array(
        F.struct(F.col("section").alias("kind"), F.lit(0).alias("prio"), F.col("pos").alias("opos")),
        F.struct(F.lit("pa").alias("kind"), is_attr.cast("int").alias("prio"),
                 F.when(is_attr, F.col("pos") + F.lit(1 << 40)).otherwise(F.col("pos")).alias("opos")))
    ex = kept.select("doc_id", "lib", "key", "value", F.explode(cand).alias("c"))
    return ex.groupBy("doc_id", "lib", F.col("c.kind").alias("kind"), "key").agg(
        F.max_by("value", F.col("c.prio")).alias("value"), F.min(F.col("c.opos")).alias("pos"))


def split_keys(kinds: DataFrame) -> DataFrame:
    """Comma keys expand: ``{a,b}_x`` -> a_x, b_x; ``(a, b)`` -> a, b (or
    ``a_and_b`` for the combining libraries); else split on commas.  Later
    keys (in dict order) win on collision."""
    k = F.col("key")
    items_brace = F.transform(F.split(F.regexp_extract(k, _BRACE, 1), ","),
                              lambda s: strip(F.concat(strip(s), F.lit("_"), F.regexp_extract(k, _BRACE, 2))))
    paren_items = F.transform(F.split(F.regexp_extract(k, _PAREN, 1), ","), lambda s: strip(s))
    items = F.when(~k.contains(","), F.array(k)) \
        .when(k.rlike(_BRACE), items_brace) \
        .when(k.rlike(_PAREN), F.when(F.col("lib").isin(*COMBINE_PAREN_LIBS),
                                      F.array(strip(F.array_join(paren_items, "_and_")))).otherwise(paren_items)) \
        .otherwise(F.transform(F.split(k, ","), lambda s: strip(s)))
    ex = kinds.select("doc_id", "lib", "kind", "value", "pos", F.posexplode(items).alias("item", "key"))
    return ex.groupBy("doc_id", "lib", "kind", "key").agg(
        F.max_by("value", F.struct("pos", "item")).alias("value"),
        F.min(F.struct("pos", "item")).alias("_o")).select("doc_id", "lib", "kind", "key", "value")


def documents_with_params(parsed: DataFrame) -> DataFrame:
    """Documents that write output: at least one raw parameter entry."""
    return parsed.where("section = 'param'").select("doc_id").distinct()


def keep_written(parsed: DataFrame, df: DataFrame) -> DataFrame:
    """Rows of ``df`` whose document has a raw parameter entry (a flag
    aggregated per document and joined back on the shared doc_id
    partitioning)."""
    flags = parsed.groupBy("doc_id").agg(F.max((F.col("section") == "param").cast("int")).alias("_w"))
    return df.join(flags.where("_w = 1"), "doc_id", "left_semi")


def parse(docs: DataFrame, partitions: int | None = None) -> dict[str, DataFrame]:
    """The whole job; returns every stage keyed by name.

    Lines and entries come from each document's own row.  Only finished entries are shuffled, once, by doc_id; every
    later aggregate and window (all keyed by doc_id) reuses that partitioning."""
    cl = classify_lines(docs)
    # no explicit count unless asked: AQE may then coalesce small shuffles
    entries = fold_entries(docs)
    entries = entries.repartition(partitions, "doc_id") if partitions else entries.repartition("doc_id")
    parsed = last_per_key(entries)
    # documents that write output, flagged by a window on the doc_id
    # partitioning the job already has (no second pass over the lines)
    flagged = parsed.withColumn("_w", F.max((F.col("section") == "param").cast("int"))
                                .over(Window.partitionBy("doc_id")))
    cleaned = clean_keys(flagged)
    kept = filter_keys(cleaned)
    written = documents_with_params(parsed)
    final = split_keys(merge_pa(kept.where("_w = 1").drop("_w")))
    cleaned, kept = cleaned.drop("_w"), kept.drop("_w")
    return {"lines": cl, "entries": entries, "parsed": parsed, "cleaned": cleaned,
            "kept": kept, "written": written, "final": final}


def to_pa_json(final: DataFrame) -> DataFrame:
    """One JSON object ``{param, attr, pa}`` per document."""
    def m(kind):
        e = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("key", "value"))))
        return F.map_from_entries(e)
    g = final.groupBy("doc_id", "lib").agg(m("param").alias("param"), m("attr").alias("attr"), m("pa").alias("pa"))
    return g.select("doc_id", "lib", F.to_json(F.struct("param", "attr", "pa")).alias("json"))


def docstrings_from_part(part: DataFrame) -> DataFrame:
    """Numpy-style docstrings built from ``part`` rows (doc_id = p_partkey).

    The layout varies with ``p_size`` / ``p_partkey`` so that every parse
    rule is exercised: indented entries, continuation and blank lines,
    comma normalization, the key forms, repeated keys, text before the first
    entry, an entry line without colon, two headers in a row, attributes,
    documents without parameters and documents ending in a header."""
    s, k = F.col("p_size"), F.col("p_partkey")
    w1 = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    w2 = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    t = F.lower("p_type")
    ind = F.when(k % 3 == 0, F.lit("    ")).otherwise(F.lit(""))
    ind2 = F.concat(ind, F.lit("    "))
    has_params = s % 10 != 7
    key2 = F.element_at(F.array(
        F.concat(w2, F.lit(", "), t), F.concat(F.lit("("), w2, F.lit(", "), t, F.lit(")")),
        F.concat(F.lit("{"), w2, F.lit(","), t, F.lit("}_x")), F.lit("*args"),
        F.concat(w2, F.lit(".attr")), F.concat(w2, F.lit("[0]")), F.concat(w2, F.lit(" words")),
        F.concat(w2, F.lit(" (float)")), w1), (s % 9 + 1).cast("int"))
    price = F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")
    lines = [
        F.concat(w1, F.lit(" "), w2, F.lit(" summary.")),
        F.lit(""),
        F.when(has_params, F.lit("Parameters")),
        F.when(has_params, F.lit("----------")),
        F.when(s % 4 == 1, F.concat(ind, F.lit("Text before the first entry"))),
        F.concat(ind, w1, F.lit(" : int")),
        F.concat(ind2, F.lit("Size is "), s.cast("string"), F.lit(" ,or  "), (s + 1).cast("string"), F.lit(".")),
        F.when(s % 2 == 0, F.lit("")),
        F.concat(ind2, F.lit("More for "), F.col("p_brand")),
        F.concat(ind, key2, F.lit(" : "), t, F.lit(", optional")),
        F.concat(ind2, F.lit("Type "), t, F.lit(".")),
        F.when(s % 5 == 3, F.concat(ind, F.lit("line without colon"))),
        F.when(s % 7 == 2, F.lit("Notes")),
        F.when(s % 3 == 0, F.lit("Attributes")),
        F.when(s % 3 == 0, F.lit("----------")),
        F.when(s % 3 == 0, F.concat(ind, w2, F.lit(" : float"))),
        F.when(s % 3 == 0, F.concat(ind2, F.lit("Price "), price)),
        F.when(s % 3 == 0, F.concat(ind, F.lit("n_"), w1, F.lit("_ : int"))),
        F.lit("Returns"),
        F.lit("-------"),
        F.concat(ind, F.lit("out : ndarray")),
        F.concat(ind2, F.lit("ignored : text")),
        F.when(s % 11 == 5, F.lit("See Also")),
    ]
    lib = F.element_at(F.array(*[F.lit(x) for x in ["scikit-learn", "numpy", "scipy", "pandas"]]),
                       (k % 4 + 1).cast("int"))
    return part.select(k.alias("doc_id"), lib.alias("lib"), F.concat_ws("\n", *lines).alias("text"))
